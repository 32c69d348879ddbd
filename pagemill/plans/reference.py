"""The queries over the test tables, each beside DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.config import PackConfig, PageConfig
from pagemill.functions.pytext import NOT_SPACE, SPACE, lstrip, sql_hash, sql_strip, strip, words
from pagemill.operators import order, packing, pages, records
from pagemill.sources import files, raster
from pagemill.streaming.tokens import growing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CHUNK = 200


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    return t(spark, sf, "documents").select("doc_id", "text")


# Text, projections, limits ------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {sql_strip('text')} AS text, CAST(length({sql_strip('text')}) AS BIGINT) AS n FROM documents")
def strip_text(spark, sf):
    s = strip("text")
    return _numbered(spark, sf).select("doc_id", s.alias("text"), F.length(s).cast("long").alias("n"))


@query("SELECT doc_id, text AS document FROM documents")
def rename_project(spark, sf):
    return _numbered(spark, sf).withColumnRenamed("text", "document")


@query("SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'")
def split_scan(spark, sf):
    """One part of a named corpus, its other columns dropped."""
    return files.corpus(spark, sf, "documents.parquet", "en", "lang").drop("text", "source")


@query("SELECT doc_id, lang, n_chars FROM documents")
def all_splits_scan(spark, sf):
    return files.corpus(spark, sf, "documents.parquet").drop("text", "source")


@query("SELECT conv_id, turn, to_json({'file_name': conv_id || '-' || turn || '.jpg', 'text': text}) AS line FROM conversations")
def json_manifest(spark, sf):
    """The lines of a manifest."""
    name = F.concat(F.col("conv_id"), F.lit("-"), F.col("turn"), F.lit(".jpg")).alias("file_name")
    return t(spark, sf, "conversations").select("conv_id", "turn", F.to_json(F.struct(name, "text"), {"ignoreNullFields": "false"}).alias("line"))


@query("SELECT doc_id, regexp_replace(text, '^' || ? || '+', '') AS text FROM documents".replace("'^' || ? || '+'", "'^" + SPACE + "+'"))
def lstrip_text(spark, sf):
    return _numbered(spark, sf).select("doc_id", lstrip("text").alias("text"))


@query("SELECT item_id, 'eval_sample_' || (row_number() OVER (ORDER BY item_id) - 1) AS name FROM benchmark")
def sample_names(spark, sf):
    items = order.ordered_rank(t(spark, sf, "benchmark").select("item_id"), "item_id")
    return items.select("item_id", records.sample_key(F.col("pos") - 1).alias("name"))


@query("SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100")
def head_limit(spark, sf):
    return order.head(t(spark, sf, "documents").select("doc_id", "n_chars"), 100, "doc_id")


@query("SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 100) ORDER BY doc_id LIMIT 10")
def head_limit_nested(spark, sf):
    first = order.head(t(spark, sf, "documents").select("doc_id", "n_chars"), 100, "doc_id", clamped=False)
    return order.head(first, 10, "doc_id")


@query("SELECT doc_id, 'out/' || doc_id || '.jpg' AS image FROM documents")
def image_path(spark, sf):
    return t(spark, sf, "documents").select("doc_id", F.concat_ws("/", F.lit("out"), F.concat(F.col("doc_id").cast("string"), F.lit(".jpg"))).alias("image"))


@query("SELECT page_id, url, regexp_replace(regexp_extract(url, '[^/]*$'), '\\.[^.]*$', '') AS stem FROM pages")
def file_manifest(spark, sf):
    return t(spark, sf, "pages").select("page_id", "url", records.stem("url").alias("stem"))


@query("SELECT CAST(i AS BIGINT) AS id, CASE WHEN (" + sql_hash("'42:' || i") + " % 2) = 0 THEN 'First line.' ELSE 'Second line.' END AS text FROM range(50) r(i)")
def drawn_lines(spark, sf):
    return records.drawn(("First line.", "Second line."), 50, 42, spark)


@query(f"SELECT doc_id, CAST(12 AS INTEGER) AS font_size, CAST(512 AS INTEGER) AS image_width, CAST(512 AS INTEGER) AS image_height, CAST(72 AS INTEGER) AS image_dpi, 'center' AS text_vertical_alignment, 'left' AS text_horizontal_alignment, (['black', 'darkblue', 'darkred', 'darkgreen', 'brown'])[{sql_hash("'42:color'")} % 5 + 1] AS font_color FROM documents")
def constant_columns(spark, sf):
    one = t(spark, sf, "documents").select("doc_id", F.lit(0).alias("chunk_ix"), F.lit(0).alias("page_ix"))
    return pages.attributed(one, PageConfig()).drop("chunk_ix", "page_ix", "bg_color", "font_path")


# Chunks --------------------------------------------------------------------------------------------------------------

_CHUNKS = f"""
WITH RECURSIVE s AS (SELECT doc_id, {sql_strip('text')} AS x FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, x, list_filter(list_transform(string_split(replace(replace(replace(x, '! ', '!|'), '? ', '?|'), '. ', '.|'), '|'),
        lambda q: {sql_strip('q')}), lambda q: q <> '') AS ps FROM s WHERE length(x) > MOST),
f AS (SELECT doc_id, ps, 1 AS i, CAST('' AS VARCHAR) AS cur, CAST([] AS VARCHAR[]) AS done FROM p
      UNION ALL
      SELECT doc_id, ps, i + 1,
             CASE WHEN length(cur) + length(ps[i]) + 1 > MOST OR cur = '' THEN ps[i] ELSE cur || ' ' || ps[i] END,
             CASE WHEN length(cur) + length(ps[i]) + 1 > MOST AND cur <> '' THEN list_append(done, cur) ELSE done END
      FROM f WHERE i <= len(ps)),
c AS (SELECT doc_id, CASE WHEN cur <> '' THEN list_append(done, cur) ELSE done END AS cs FROM f WHERE i = len(ps) + 1
      UNION ALL SELECT doc_id, [x] FROM s WHERE length(x) <= MOST),
chunks AS (SELECT doc_id, unnest(range(len(cs))) AS chunk_ix, unnest(cs) AS chunk FROM c)
"""


def _chunk_sql(most: int, select: str) -> str:
    return _CHUNKS.replace("MOST", str(most)) + select


@query(_chunk_sql(CHUNK, "SELECT doc_id, CAST(chunk_ix AS INTEGER) AS chunk_ix, CAST(length(chunk) AS BIGINT) AS n, md5(chunk) AS digest FROM chunks"))
def sentence_chunks(spark, sf):
    found = pages.chunked(_numbered(spark, sf), CHUNK)
    return found.select("doc_id", "chunk_ix", F.length("chunk").cast("long").alias("n"), F.md5(F.col("chunk").cast("binary")).alias("digest"))


@query(_chunk_sql(2000, "SELECT doc_id, CAST(chunk_ix AS INTEGER) AS chunk_ix, CAST(length(chunk) AS BIGINT) AS n, md5(chunk) AS digest FROM chunks"))
def sentence_chunks_native(spark, sf):
    found = _numbered(spark, sf).where("text IS NOT NULL").select("doc_id", F.posexplode(pages.chunk_fold("text", 2000)).alias("chunk_ix", "chunk"))
    return found.select("doc_id", "chunk_ix", F.length("chunk").cast("long").alias("n"), F.md5(F.col("chunk").cast("binary")).alias("digest"))


@query(_chunk_sql(CHUNK, ", per AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id) SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS chunks, CAST(sum(greatest(n - 1, 0)) AS BIGINT) AS total_splits FROM per"))
def chunk_totals(spark, sf):
    per = pages.chunk_counts(_numbered(spark, sf), CHUNK).where("n > 0")
    return per.agg(F.count("*").alias("docs"), F.sum("n").cast("long").alias("chunks"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).cast("long").alias("total_splits"))


# Pages ---------------------------------------------------------------------------------------------------------------

PAGE = PageConfig()


@query(
    "WITH c AS (SELECT * FROM (VALUES (72), (96), (100), (150), (300)) v(dpi)), g AS (SELECT dpi, CAST(trunc(512 * (dpi / 72)) AS INTEGER) AS width, CAST(trunc(400 * (dpi / 72)) AS INTEGER) AS height, CAST(trunc(12 * (dpi / 72)) AS INTEGER) AS font_size FROM c) "
    "SELECT dpi, width, height, font_size, CAST(trunc(width * 0.9::DOUBLE) AS INTEGER) AS inner_width, CAST((width - CAST(trunc(width * 0.9::DOUBLE) AS INTEGER)) // 2 AS INTEGER) AS margin FROM g"
)
def page_geometry(spark, sf):
    rows = [(d, *pages.geometry(PageConfig(image_dpi=d, image_height=400)).values()) for d in (72, 96, 100, 150, 300)]
    return spark.createDataFrame(rows, "dpi int, width int, height int, font_size int, inner_width int, margin int")


@query(
    "WITH l AS (SELECT doc_id, CAST(length(text) AS BIGINT) % 60 AS n FROM documents), m AS (SELECT doc_id, n, 12 * n + 2 * (n - 1) AS total FROM l) "
    "SELECT doc_id, a.align AS align, CAST(CASE a.align WHEN 'top' THEN 0 WHEN 'bottom' THEN greatest(0, 512 - total) ELSE greatest(0, 512 - total) // 2 END AS BIGINT) AS top, "
    "CAST(CASE WHEN total <= 512 THEN n ELSE greatest(0, (512 - 12) // 14 + 1) END AS BIGINT) AS fit FROM m, (VALUES ('top'), ('bottom'), ('center')) a(align)"
)
def fitted_lines(spark, sf):
    rows = [(n, a, *pages.fitting(n, 512, 12, a)) for n in range(60) for a in ("top", "bottom", "center")]
    fits = spark.createDataFrame(rows, "n int, align string, top long, advance long, fit long")
    docs = t(spark, sf, "documents").select("doc_id", (F.length("text") % 60).alias("n"))
    return docs.join(F.broadcast(fits), "n").select("doc_id", "align", "top", "fit")


@query(
    "WITH l AS (SELECT doc_id, (length(text) % 60) * 7 AS w FROM documents) SELECT doc_id, a.align AS align, CAST(CASE a.align WHEN 'left' THEN 26 WHEN 'right' THEN 512 - 26 - w ELSE (512 - w) // 2 END AS BIGINT) AS x FROM l, (VALUES ('left'), ('right'), ('center')) a(align)"
)
def line_positions(spark, sf):
    measure, margin = pages.FixedWidth(), pages.geometry(PAGE)["margin"]
    rows = [(n, a, pages.line_x(a, 512, margin, measure.width("x" * n))) for n in range(60) for a in ("left", "right", "center")]
    docs = t(spark, sf, "documents").select("doc_id", (F.length("text") % 60).alias("n"))
    return docs.join(F.broadcast(spark.createDataFrame(rows, "n int, align string, x long")), "n").select("doc_id", "align", "x")


#: Characters of 7 pixels that a line of the page holds, lines of 12 and 2 that it holds.
WIDE = pages.geometry(PAGE)["inner_width"] // 7
DEEP = (PAGE.image_height - 12) // 14 + 1

#: Lines of all chunks: paragraphs in order, their words put together greedily.
_LINES = (
    _CHUNKS.replace("MOST", "2000")
    + f""", para AS (SELECT doc_id, chunk_ix, unnest(range(len(ps))) AS k, unnest(ps) AS p, len(ps) AS many FROM (SELECT doc_id, chunk_ix, string_split(chunk, chr(10)) AS ps FROM chunks)),
ws AS (SELECT doc_id, chunk_ix, k, many, regexp_extract_all(p, '{NOT_SPACE}+') AS w, replace(regexp_extract(p, '^{SPACE}*'), chr(9), '    ') AS indent FROM para),
g AS (SELECT doc_id, chunk_ix, k, many, w, 1 AS i, CAST('' AS VARCHAR) AS line, CAST([] AS VARCHAR[]) AS done, indent FROM ws
      UNION ALL
      SELECT doc_id, chunk_ix, k, many, w, i + 1,
             CASE WHEN i = 1 THEN indent || w[1] WHEN length(line) + 1 + length(w[i]) > {WIDE} THEN w[i] ELSE line || ' ' || w[i] END,
             CASE WHEN i > 1 AND length(line) + 1 + length(w[i]) > {WIDE} THEN list_append(done, line) ELSE done END, indent
      FROM g WHERE i <= len(w)),
made AS (SELECT doc_id, chunk_ix, k, CASE WHEN len(w) = 0 THEN [''] WHEN k = many - 1 THEN list_append(done, line) ELSE list_concat(done, [line, '']) END AS ls FROM g WHERE i = len(w) + 1),
whole AS (SELECT doc_id, chunk_ix, flatten(list(ls ORDER BY k)) AS ls FROM made GROUP BY doc_id, chunk_ix),
lines AS (SELECT doc_id, chunk_ix, unnest(range(len(ls))) AS line_ix, unnest(ls) AS line FROM whole)
"""
)


@query(_LINES + "SELECT doc_id, CAST(chunk_ix AS INTEGER) AS chunk_ix, CAST(line_ix AS INTEGER) AS line_ix, line FROM lines")
def wrap_fixed(spark, sf):
    return pages.wrapped(pages.chunked(_numbered(spark, sf), 2000), pages.geometry(PAGE)["inner_width"])


def _pages(spark, sf, carry: str) -> DataFrame:
    return pages.laid_out(_numbered(spark, sf), PAGE, carry=carry)


def _top_sql(n: str) -> str:
    return f"CASE WHEN 12 * {n} + 2 * ({n} - 1) <= 512 THEN (512 - 12 * {n} - 2 * ({n} - 1)) // 2 ELSE 0 END"


#: One line or one page in each step: `rest` is what the page begins with, `r` what of it is not yet a paragraph, `para` what of a
#: paragraph is not yet a line.
_BY_LENGTH = (
    _CHUNKS.replace("MOST", "2000")
    + f""", h AS (
  SELECT doc_id, chunk_ix, CAST(-1 AS BIGINT) AS page_ix, chunk AS rest, chunk AS r, CAST(NULL AS VARCHAR) AS para, CAST([] AS VARCHAR[]) AS ls, CAST(NULL AS VARCHAR) AS page, CAST(NULL AS BIGINT) AS top FROM chunks WHERE chunk <> ''
  UNION ALL
  SELECT doc_id, chunk_ix, CASE WHEN full_ THEN page_ix + 1 ELSE page_ix END,
         CASE WHEN full_ THEN next_ ELSE rest END,
         CASE WHEN full_ THEN next_ WHEN para IS NULL THEN CASE WHEN instr(r, chr(10)) > 0 THEN substr(r, instr(r, chr(10)) + 1) END ELSE r END,
         CASE WHEN full_ OR (para IS NULL AND first_ = '') THEN NULL WHEN para IS NULL THEN replace(regexp_extract(raw, '^{SPACE}*'), chr(9), '    ') || first_
              WHEN length(para) > length(line_) THEN substr(para, length(line_) + 2) END,
         CASE WHEN full_ THEN [] WHEN para IS NULL THEN CASE WHEN first_ = '' THEN list_append(ls, '') ELSE ls END
              WHEN length(para) = length(line_) AND r IS NOT NULL THEN list_concat(ls, [line_, '']) ELSE list_append(ls, line_) END,
         CASE WHEN full_ THEN shown END, CASE WHEN full_ THEN {_top_sql('len(ls)')} END
  FROM (SELECT *, regexp_replace(substr(rest, length(shown) + 1), '^{SPACE}+', '') AS next_,
               CASE WHEN length(para) <= {WIDE} THEN para WHEN instr(ltrim(left(para, {WIDE + 1})), ' ') = 0 THEN regexp_extract(para, '^ *[^ ]+') ELSE regexp_extract(left(para, {WIDE + 1}), '^(.*[^ ]) ', 1) END AS line_
        FROM (SELECT *, len(ls) > {DEEP} OR (r IS NULL AND para IS NULL) AS full_,
                     CASE WHEN instr(r, chr(10)) > 0 THEN left(r, instr(r, chr(10)) - 1) ELSE r END AS raw,
                     array_to_string(regexp_extract_all(raw, '{NOT_SPACE}+'), ' ') AS first_,
                     regexp_replace(array_to_string(ls[1:{DEEP}], chr(10)), '\n+$', '') AS shown
              FROM h WHERE rest <> '' AND (page IS NULL OR page <> ''))))
"""
)


@query(_BY_LENGTH + "SELECT doc_id, CAST(chunk_ix AS INTEGER) AS chunk_ix, CAST(page_ix AS INTEGER) AS page_ix, page AS text, CAST(top AS INTEGER) AS top, CAST(len(string_split(page, chr(10))) AS INTEGER) AS lines FROM h WHERE page <> ''")
def paginate_length(spark, sf):
    return _pages(spark, sf, "length")


#: Pages of the lines: each begins at the next line that is not blank.
_BY_SOURCE = (
    _LINES
    + f""", q AS (
  SELECT doc_id, chunk_ix, CAST(-1 AS BIGINT) AS page_ix, ls, CAST([] AS VARCHAR[]) AS shown, CAST(0 AS BIGINT) AS left_ FROM whole
  UNION ALL
  SELECT doc_id, chunk_ix, page_ix + 1, list_slice(body, {DEEP} + 1, len(body)), list_slice(body, 1, {DEEP}), len(body)
  FROM (SELECT *, list_slice(ls, list_position(list_transform(ls, lambda x: x <> ''), true), len(ls)) AS body FROM q WHERE len(list_filter(ls, lambda x: x <> '')) > 0)),
laid AS (SELECT doc_id, CAST(chunk_ix AS INTEGER) AS chunk_ix, CAST(page_ix AS INTEGER) AS page_ix, regexp_replace(array_to_string(shown, chr(10)), '\n+$', '') AS text, CAST({_top_sql('left_')} AS INTEGER) AS top FROM q WHERE page_ix >= 0)
"""
)


@query(f"SELECT doc_id, md5(array_to_string(regexp_extract_all(CASE WHEN length({sql_strip('text')}) > 2000 THEN replace(text, '|', ' ') ELSE text END, '{NOT_SPACE}+'), ' ')) AS digest FROM documents WHERE length({sql_strip('text')}) > 0")
def paginate_source(spark, sf):
    """Whatever chunks and pages a text takes, its words come back in order (where a text is cut, bars end sentences and go)."""
    laid = _pages(spark, sf, "source")
    parts = F.sort_array(F.collect_list(F.struct("chunk_ix", "page_ix", "text")))
    back = laid.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"))
    return back.select("doc_id", F.md5(F.array_join(words(F.col("text")), " ").cast("binary")).alias("digest"))


def _rgb_sql(ident: str) -> str:
    return ", ".join(f"CAST({sql_hash(f'{ident} || {chr(39)}:{x}{chr(39)}')} % {hi - lo + 1} + {lo} AS INTEGER) AS {x}" for x, (lo, hi) in pages.BACKGROUND.items())


@query(f"SELECT doc_id, {_rgb_sql(chr(39) + '42:' + chr(39) + ' || doc_id || ' + chr(39) + ':0:0' + chr(39))} FROM documents")
def page_attributes(spark, sf):
    one = t(spark, sf, "documents").select("doc_id", F.lit(0).alias("chunk_ix"), F.lit(0).alias("page_ix"))
    return pages.attributed(one, PAGE).select("doc_id", "bg_color.*")


@query(f"SELECT doc_id, CASE {sql_hash(chr(39) + '42:' + chr(39) + ' || doc_id || ' + chr(39) + ':0:0:font' + chr(39))} % 3 WHEN 0 THEN 'a.ttf' WHEN 1 THEN 'b.ttf' ELSE 'c.ttf' END AS font_path FROM documents")
def font_choice(spark, sf):
    one = t(spark, sf, "documents").select("doc_id", F.lit(0).alias("chunk_ix"), F.lit(0).alias("page_ix"))
    return pages.attributed(one, PageConfig(random_fonts=True), ("c.ttf", "a.ttf", "b.ttf")).select("doc_id", "font_path")


@query("SELECT doc_id, len(list_intersect(list_transform(string_split(text, ''), lambda c: CAST(unicode(c) AS INTEGER)), [225, 240, 233, 237, 243, 250, 253, 254, 230, 246])) > 0 AS covered FROM documents")
def font_coverage(spark, sf):
    from pagemill.sources.files import covers

    return _numbered(spark, sf).select("doc_id", covers(packing.codepoints("text"), "áðéíóúýþæö").alias("covered"))


@query(
    _BY_SOURCE
    + f"SELECT doc_id, chunk_ix, page_ix, text, top, CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines, 'default' AS font_path, {_rgb_sql("'42:' || doc_id || ':' || chunk_ix || ':' || page_ix")}, "
    f"(['black', 'darkblue', 'darkred', 'darkgreen', 'brown'])[{sql_hash(chr(39) + '42:color' + chr(39))} % 5 + 1] AS font_color, CAST(12 AS INTEGER) AS font_size, CAST(512 AS INTEGER) AS image_width, CAST(512 AS INTEGER) AS image_height, CAST(72 AS INTEGER) AS image_dpi, "
    f"CASE WHEN {sql_hash(chr(39) + '42:' + chr(39) + ' || doc_id')} % 10 < 8 THEN 'train' WHEN {sql_hash(chr(39) + '42:' + chr(39) + ' || doc_id')} % 10 = 8 THEN 'test' ELSE 'validation' END AS split FROM laid"
)
def page_manifest(spark, sf):
    """The flagship: chunks, pages, attributes and splits of all documents."""
    laid = _pages(spark, sf, "source")
    split = order.by_document(pages.attributed(laid, PAGE), "doc_id")
    return split.select("doc_id", "chunk_ix", "page_ix", "text", "top", "lines", "font_path", "bg_color.*", "font_color", "font_size", "image_width", "image_height", "image_dpi", "split")


@query(_BY_SOURCE + f"SELECT doc_id, chunk_ix, page_ix, CAST(512 AS INTEGER) AS width, CAST(512 AS INTEGER) AS height, CAST(36 * length(regexp_replace(text, '{SPACE}', '', 'g')) AS BIGINT) AS ink FROM laid")
def drawn_pages(spark, sf):
    """All pages drawn, written as PNG and read again. Without a font a letter is a box of 6 by 6 pixels."""
    drawn = pages.rendered(pages.attributed(_pages(spark, sf, "source"), PAGE), PAGE)
    return drawn.select("doc_id", "chunk_ix", "page_ix", raster.ink("image.bytes", "bg_color").alias("x")).select("doc_id", "chunk_ix", "page_ix", "x.*")


# Splits --------------------------------------------------------------------------------------------------------------

_RANKED = "WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents), h AS (SELECT *, CAST(ceil(n * 0.2::DOUBLE) AS BIGINT) AS held FROM r), s AS (SELECT doc_id, CASE WHEN k <= n - held THEN 'train' WHEN k <= n - held + CAST(ceil(held * 0.5::DOUBLE) AS BIGINT) THEN 'test' ELSE 'validation' END AS split FROM h) "


@query(_RANKED + "SELECT doc_id, split FROM s")
def split_documents(spark, sf):
    return order.three_way(t(spark, sf, "documents").select("doc_id"), "doc_id")


@query(_RANKED + "SELECT split, count(*) AS n FROM s GROUP BY split")
def split_counts(spark, sf):
    return split_documents(spark, sf).groupBy("split").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, CASE WHEN h < 8 THEN 'train' WHEN h = 8 THEN 'test' ELSE 'validation' END AS split FROM (SELECT doc_id, {sql_hash(chr(39) + '42:' + chr(39) + ' || doc_id')} % 10 AS h FROM documents)")
def split_by_document(spark, sf):
    return order.by_document(t(spark, sf, "documents").select("doc_id"), "doc_id")


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS BIGINT) AS rank FROM documents")
def shuffled(spark, sf):
    return order.hash_rank(t(spark, sf, "documents").select("doc_id"), "doc_id").withColumn("rank", F.col("rank").cast("long"))


# Tokens --------------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS codepoints, CAST(len(regexp_extract_all(text, '" + NOT_SPACE + "+')) AS BIGINT) AS words FROM documents")
def token_counts(spark, sf):
    return _numbered(spark, sf).select("doc_id", F.size(packing.codepoints("text")).cast("long").alias("codepoints"), F.size(packing.word_ids("text")).cast("long").alias("words"))


def _packed_sql(limit: str) -> str:
    return (
        "WITH d AS (SELECT doc_id, list_append(list_transform(list_filter(string_split(text, ''), lambda c: c <> ''), lambda c: CAST(unicode(c) AS INTEGER)), 0) AS ids FROM documents WHERE text IS NOT NULL), "
        "u AS (SELECT doc_id, unnest(ids) AS id, unnest(range(len(ids))) AS i FROM d), o AS (SELECT doc_id, coalesce(sum(len(ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM d), "
        "g AS (SELECT CAST(o.o + i AS BIGINT) AS p, id FROM u JOIN o USING (doc_id)), b AS (SELECT p // 512 AS block, count(*) AS n, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY p)) AS digest FROM g GROUP BY 1) "
        f"SELECT CAST(block AS BIGINT) AS block, digest FROM b WHERE n = 512 {limit}"
    )


def _blocks(spark, sf) -> DataFrame:
    return packing.packed(_numbered(spark, sf), 512, ids=packing.codepoints("text"), count=F.length("text"))


def _digested(blocks: DataFrame) -> DataFrame:
    return blocks.select(F.col("block").cast("long").alias("block"), F.md5(F.array_join(F.transform("input_ids", lambda x: x.cast("string")), ",").cast("binary")).alias("digest"))


@query(_packed_sql(""))
def packed_blocks(spark, sf):
    return _digested(_blocks(spark, sf))


@query(_packed_sql("ORDER BY block LIMIT 10"))
def packed_blocks_limited(spark, sf):
    return _digested(order.head(_blocks(spark, sf), PackConfig().max_eval, "block"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def decode_tokens(spark, sf):
    back = packing.decoded(packing.with_eos(packing.codepoints("text")))
    return _numbered(spark, sf).select("doc_id", F.md5(back.cast("binary")).alias("digest"))


@query("SELECT conv_id, turn, array_to_string(list_transform(list_transform(list_filter(string_split(text, ''), lambda c: c <> ''), lambda c: unicode(c)), lambda x: CASE WHEN x IN (32, 46) THEN -100 ELSE x END), ',') AS labels FROM conversations")
def label_mask(spark, sf):
    c = t(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.array_join(F.transform(packing.masked(packing.codepoints("text"), 32, 46), lambda x: x.cast("string")), ",").alias("labels"))


@query("WITH l AS (SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS n, CAST(max(length(text)) OVER (PARTITION BY conv_id) AS BIGINT) AS longest FROM conversations) SELECT conv_id, turn, longest AS length, longest - n AS pads FROM l")
def pad_batch(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", packing.codepoints(F.coalesce("text", F.lit(""))).alias("ids"))
    longest = F.max(F.size("ids")).over(Window.partitionBy("conv_id"))
    c = c.withColumn("to", longest)
    c = c.withColumn("padded", packing.padded("ids", F.col("to"), -1))
    return c.select("conv_id", "turn", F.size("padded").cast("long").alias("length"), F.size(F.filter("padded", lambda x: x == -1)).cast("long").alias("pads"))


# Records -------------------------------------------------------------------------------------------------------------


@query("WITH b AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS pos FROM benchmark), d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS pos FROM documents) SELECT CAST(pos AS BIGINT) AS pos, item_id, doc_id FROM b JOIN d USING (pos)")
def positional_zip(spark, sf):
    items = t(spark, sf, "benchmark").select("item_id")
    docs = order.head(t(spark, sf, "documents").select("doc_id"), items.count(), "doc_id")
    return records.positional_zip(items, docs, "item_id", "doc_id").select(F.col("pos").cast("long").alias("pos"), "item_id", "doc_id")


@query("SELECT coalesce(CAST(b.item_id AS VARCHAR), CAST(d.doc_id AS VARCHAR)) AS stem, b.item_id IS NOT NULL AND d.doc_id IS NOT NULL AS matched FROM benchmark b FULL JOIN documents d ON b.item_id = d.doc_id")
def stem_pairs(spark, sf):
    a = t(spark, sf, "benchmark").select(F.concat(F.lit("x/"), F.col("item_id"), F.lit(".jpg")).alias("image"))
    b = t(spark, sf, "documents").select(F.concat(F.lit("y/"), F.col("doc_id"), F.lit(".txt")).alias("script"))
    return records.stem_pairs(a, b, "image", "script").select("stem", "matched")


@query("SELECT conv_id, turn, 'User: Answer briefly. <image> OCR this image accurately.<end_of_utterance>' || chr(10) || 'Assistant: ' || text || '<end_of_utterance>' AS rendered FROM conversations")
def chat_messages(spark, sf):
    c = t(spark, sf, "conversations")
    return c.select("conv_id", "turn", records.render(records.ocr_messages("text")).alias("rendered"))


@query("SELECT conv_id, turn, 'User: ' || repeat('<image> ', CAST(turn % 3 AS INTEGER)) || text || '<end_of_utterance>' || chr(10) || 'Assistant:' AS prompt FROM conversations")
def chat_render(spark, sf):
    c = t(spark, sf, "conversations")
    return c.select("conv_id", "turn", records.render(records.prompt_messages(F.col("text"), (F.col("turn") % 3).cast("int")), generation=True).alias("prompt"))


@query("SELECT p_partkey, 'model.' || p_name AS added, p_name AS stripped, CASE WHEN p_brand LIKE 'Brand%' THEN substr(p_brand, 6) ELSE p_brand END AS other FROM part")
def key_remap(spark, sf):
    p = t(spark, sf, "part")
    added = records.add_prefix(F.col("p_name"))
    return p.select("p_partkey", added.alias("added"), records.strip_prefix(added).alias("stripped"), records.strip_prefix(F.col("p_brand"), "Brand").alias("other"))


@query("SELECT p_partkey AS key, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AS known FROM part")
def key_membership(spark, sf):
    keys = t(spark, sf, "part").select(F.col("p_partkey").alias("key"))
    target = t(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("key"))
    known = records.known_keys(keys, target, "key").withColumn("known", F.lit(True))
    return known.unionByName(records.unknown_keys(keys, target, "key").withColumn("known", F.lit(False)))


@query("SELECT CAST(sum(p_size) AS BIGINT) AS total, CAST(sum(p_size) FILTER (WHERE p_size % 2 = 0) AS BIGINT) AS trainable FROM part")
def conditional_sum(spark, sf):
    return t(spark, sf, "part").agg(F.sum("p_size").cast("long").alias("total"), F.sum(F.when(F.col("p_size") % 2 == 0, F.col("p_size"))).cast("long").alias("trainable"))


# Metrics -------------------------------------------------------------------------------------------------------------

_STEPS = "WITH s AS (SELECT user_id, value, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events), r AS (SELECT user_id, CAST(step AS BIGINT) AS step, value, CAST(16384 * step AS BIGINT) AS total_tokens_trained FROM s) "


def _steps(spark, sf) -> DataFrame:
    step = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    log = t(spark, sf, "events").select("user_id", "value", "ts", step.alias("step"))
    return records.running_tokens(log, "user_id", "step", records.tokens_per_step(8, 4, 512))


@query(_STEPS + "SELECT user_id, step, total_tokens_trained FROM r")
def running_tokens(spark, sf):
    return _steps(spark, sf).select("user_id", "step", "total_tokens_trained")


@query(_STEPS + "SELECT user_id, step, total_tokens_trained, CASE WHEN value > 0 THEN round(16384 / value, 6) END AS tokens_per_second FROM r WHERE step % 10 = 0")
def logged_steps(spark, sf):
    rate = F.round(records.rate(F.col("tokens_this_step"), F.col("value")), 6)
    return _steps(spark, sf).where("step % 10 = 0").select("user_id", "step", "total_tokens_trained", rate.alias("tokens_per_second"))


@query(
    "SELECT user_id, CAST(16384 * count(*) AS BIGINT) AS final_total_tokens, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / 60, 4) AS total_training_time_minutes, "
    "CASE WHEN epoch_us(max(ts)) - epoch_us(min(ts)) > 0 THEN round(16384 * count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 4) ELSE 0.0 END AS average_tokens_per_second FROM events GROUP BY user_id"
)
def final_rates(spark, sf):
    seconds = (F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp")))) / 1e6
    per = t(spark, sf, "events").groupBy("user_id").agg((F.count("*") * 16384).alias("final_total_tokens"), seconds.alias("s"))
    return per.select("user_id", "final_total_tokens", F.round(F.col("s") / 60, 4).alias("total_training_time_minutes"), F.round(records.average_rate(F.col("final_total_tokens"), F.col("s")), 4).alias("average_tokens_per_second"))


@query("SELECT user_id, arg_min(event_id, (value, event_id)) AS event_id, min(value) AS value FROM events GROUP BY user_id")
def best_checkpoint(spark, sf):
    return records.best(t(spark, sf, "events").where("value IS NOT NULL"), "user_id", "event_id", "value")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k <= 3")
def latest_checkpoints(spark, sf):
    return records.latest(t(spark, sf, "events").select("user_id", "event_id"), "user_id", "event_id")


@query("SELECT o_custkey, CAST(count(*) // 4 * 3 AS BIGINT) AS steps, CAST(4 AS INTEGER) AS effective_batch FROM orders GROUP BY o_custkey")
def step_plan(spark, sf):
    per = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return per.select("o_custkey", records.steps(F.col("n"), 2, 2, 3).alias("steps"), F.lit(records.tokens_per_step(2, 2, 1)).alias("effective_batch"))


@query("SELECT l_orderkey, round(sum(l_extendedprice) / 1073741824.0, 12) AS gb FROM lineitem GROUP BY l_orderkey")
def unit_scale(spark, sf):
    return t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice") / F.lit(float(1 << 30)), 12).alias("gb"))


@query("WITH c AS (SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL), g AS (SELECT conv_id, turn, string_agg(text, '') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS shown FROM c) SELECT conv_id, CAST(turn AS BIGINT) AS turn, md5(shown) AS digest FROM g UNION ALL SELECT DISTINCT conv_id, CAST(-1 AS BIGINT), md5('...') FROM c")
def token_stream(spark, sf):
    shown = growing(t(spark, sf, "conversations").where("text IS NOT NULL"), "conv_id", "turn", "text")
    return shown.select("conv_id", "turn", F.md5(F.col("shown").cast("binary")).alias("digest"))
