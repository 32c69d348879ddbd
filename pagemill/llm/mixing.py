"""Mixing sources to target weights by hash-threshold histograms.

Each document has a place in [0, 2**60) from the md5 of its id and text. For each source, the tokens are summed by the top
digit of that place (one pre-aggregated shuffle of counts), the bucket in which the budget ends is found from the
running sums, and only that bucket is split by the next digit, until one place is left. What lies below the threshold is
taken: no document is ever sorted, and thresholds of a smaller budget lie inside those of a larger one.

Nulls: a null text has size 0, a null source is a source of its own (the last), a null id hashes as "null".
Rows of equal id and text share a place. Where the budget ends among such rows, as many of them are taken as come nearest to it
(half of one is none); they are numbered there, so which of the equal rows are taken is left open, but not how many.
Empty input gives no rows; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.common import WORD, base_columns, cut, table

#: Most sources for which the per-source table (under 200 bytes a row) is broadcast, or ranked in one task; beyond it, joins are
#: salted, and ranks come from ranges.
BROADCAST_SOURCES = 50_000
#: Bits of a document's place, and of each digit.
BITS, DIGIT = 60, 12
CAP = 3
SALT = 64


def place(doc_id: F.Column, text: F.Column) -> F.Column:
    """The first 60 bits of the md5 of id and text."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def running(df: DataFrame, rows: int, order: list[F.Column], **sums: F.Column) -> DataFrame:
    """Adds, by name, the sums over all rows before each in an order without ties: ranges of about BROADCAST_SOURCES rows, then
    the sums of the ranges."""
    df = df.repartitionByRange(max(1, -(-rows // max(1, BROADCAST_SOURCES))), *order).withColumn("range", F.spark_partition_id())
    df = cut(df)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    totals = df.groupBy("range").agg(*(F.sum(c).alias(k) for k, c in sums.items()))
    totals = totals.select(F.col("range").alias("of"), *(F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"{k}_before") for k in sums))
    here = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.select("*", *(F.coalesce(F.sum(c).over(here), F.lit(0)).alias(k) for k, c in sums.items())).join(F.broadcast(totals), F.col("range") == F.col("of"))
    return out.select(*(c for c in df.columns if c != "range"), *((F.col(k) + F.col(f"{k}_before")).alias(k) for k in sums))


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """(source, source_size, n, target): all tokens shared by weight, no source above cap times its size.

    With t = min(cap * size, level * weight) there is one level at which the targets sum to the whole: sources in the
    order of cap * size / weight fill up one after the other, so the level follows from running sums over the sources.
    """
    per = cut(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")))
    rows, total = per.agg(F.count("*"), F.sum("source_size")).first()
    by_name = F.col("source").asc_nulls_last()
    per = running(per, rows, [by_name], rank=F.lit(1))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    ratio = F.col("source_size") / F.col("weight")
    filled = cut(running(per, rows, [ratio.asc(), by_name], full=F.col("source_size"), shut=F.col("weight")))
    whole = filled.agg(F.sum("weight")).first()[0]
    filled = filled.withColumn("level", (F.lit(total) - cap * F.col("full")).cast("double") / (F.lit(whole) - F.col("shut")))
    fits = F.col("level") * F.col("weight") <= (cap * F.col("source_size")).cast("double")
    level = filled.where(fits).agg(F.min(F.struct(ratio.alias("r"), "shut", F.col("level").alias("v")))["v"]).first()[0]
    target = F.least((cap * F.col("source_size")).cast("double"), F.lit(level).cast("double") * F.col("weight"))
    return filled.select("source", "source_size", "n", F.coalesce(target, F.lit(0.0)).alias("target"))


def thresholds(sized: DataFrame, wanted: DataFrame, join, digits: int = BITS // DIGIT) -> DataFrame:
    """(source, k, low, some, of): each document is taken k times, and once more if its place is below `low`, or if it is one of
    `some` of the `of` documents at `low` (both null if there the budget ends at a place's end). There the running sum comes
    nearest to what k times the source leaves of the target."""
    state = wanted.withColumn("k", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    state = state.withColumn("rest", F.col("target") - F.col("k") * F.col("source_size")).withColumn("low", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long"))
    state = cut(state.select("source", "k", "rest", "low", "below"))
    for d in range(digits):
        width = 1 << (BITS - DIGIT * (d + 1))
        # only documents of the bucket in which the budget ends are counted
        rows = join(sized, state, "inner")
        if d:
            rows = rows.where((F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + (width << DIGIT)))
        hist = rows.groupBy("source", "low", "rest", "below", F.expr(f"(place - low) div {width}").alias("b")).agg(F.sum("size").alias("t"), F.count(F.when(F.col("size") > 0, 1)).alias("m"))
        upto = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("upto", F.col("below") + F.sum("t").over(upto))
        over = F.when(F.col("upto") > F.col("rest"), F.struct("b", (F.col("upto") - F.col("t")).alias("below"), "t", "m"))
        found = hist.groupBy("source").agg(F.min(over).alias("x"), F.max("upto").alias("all"))
        state = state.join(found, state["source"].eqNullSafe(found["source"]), "left").drop(found["source"])
        # no bucket passes the budget: everything of this range lies below the threshold
        low = F.coalesce(F.col("low") + F.col("x.b") * F.lit(width), F.when(F.col("all").isNotNull(), F.col("low") + F.lit(width << DIGIT)).otherwise(F.col("low")))
        some = F.ceil(F.col("x.m") * (F.col("rest") - F.col("x.below")) / F.col("x.t") - F.lit(0.5))
        state = cut(state.select("source", "k", "rest", low.alias("low"), F.coalesce("x.below", "all", "below").alias("below"), some.alias("some"), F.col("x.m").alias("of")))
        if d < digits - 1:
            state = state.drop("some", "of")
    all_ = F.col("some") >= F.col("of")
    return state.select("source", "k", F.when(all_, F.col("low") + 1).otherwise(F.col("low")).alias("low"), F.when(~all_ & (F.col("some") > 0), F.col("some")).alias("some"), "of")


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Adds number, from 0 within each key, in no order that matters; the rows of one key may be any number."""
    df = cut(df.withColumn("row", F.monotonically_increasing_id())).withColumn("part", F.shiftright("row", 33))
    per = df.groupBy(key, "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(key).alias("key_"), F.col("part").alias("part_"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    mine = F.row_number().over(Window.partitionBy(key, "part").orderBy("row")) - 1
    out = df.withColumn("mine", mine).join(per, F.col(key).eqNullSafe(F.col("key_")) & (F.col("part") == F.col("part_")))
    return out.withColumn("number", F.col("start") + F.col("mine")).drop("row", "part", "key_", "part_", "start", "mine")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text, source) -> doc_id, size, source_size, target, taken, and the columns named in keep."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = base_columns(docs, doc_id="doc_id", source="source", size=size, place=place(F.col("doc_id"), F.col("text")), **{f"keep_{c}": c for c in keep})
    counted = cut(sized.select("source", "size", "place", "doc_id"))
    wanted = cut(targets(counted, weights, cap))
    few = wanted.count() <= BROADCAST_SOURCES

    def join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        names = [c for c in right.columns if c != "source"]
        right = right.select(F.col("source").alias("right_source"), *names)
        on = left["source"].eqNullSafe(F.col("right_source"))
        if few:
            return left.join(F.broadcast(right), on, how).drop("right_source")
        # more sources than a broadcast may hold: a hot one is dealt over SALT tasks
        left = left.withColumn("salt", F.pmod(F.col("place"), F.lit(SALT)))
        right = right.withColumn("right_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        return left.join(right, left["source"].eqNullSafe(F.col("right_source")) & (F.col("salt") == F.col("right_salt")), how).drop("right_source", "salt", "right_salt")

    limits = thresholds(counted, wanted, join)
    both = cut(wanted.join(limits.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).select("source", "source_size", "target", "k", "low", "some"))
    rows = join(sized if keep else counted, both, "left")
    at_end = F.coalesce((F.col("place") == F.col("low")) & (F.col("size") > 0) & F.col("some").isNotNull(), F.lit(False))
    more = (F.col("place") < F.col("low")).cast("int")
    if both.where("some IS NOT NULL").limit(1).count():
        # a source's budget ends among equal rows
        ends = numbered(rows.where(at_end), "source")
        rows = rows.where(~at_end).withColumn("more", more).unionByName(ends.withColumn("more", (F.col("number") < F.col("some")).cast("int")).drop("number"))
    else:
        rows = rows.withColumn("more", more)
    taken = F.col("size") * (F.col("k") + F.col("more"))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *(F.col(f"keep_{c}").alias(c) for c in keep))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS place
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM per),
filled AS (
  SELECT *, CAST(total - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / sum(weight) OVER (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY source_size / weight, source ASC NULLS LAST) AS turn
  FROM weighted),
lev AS (SELECT arg_min(level, turn) AS v FROM filled WHERE level * weight <= 3 * source_size),
goal AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), v * weight) AS target FROM filled, lev),
rest AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS k FROM goal),
placed AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, r.k, r.target - r.k * r.source_size AS want,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto,
         CAST(sum(s.size) OVER (PARTITION BY s.source, s.place) AS BIGINT) AS here,
         CAST(count(*) FILTER (WHERE s.size > 0) OVER (PARTITION BY s.source, s.place) AS BIGINT) AS m,
         row_number() OVER (PARTITION BY s.source, s.place ORDER BY s.size DESC) AS number
  FROM sized s JOIN rest r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (k + CASE WHEN upto <= want OR (here > 0 AND number <= ceil(m * (want - (upto - here)) / here - 0.5::DOUBLE)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""
