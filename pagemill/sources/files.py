"""Reading and writing: corpora, JSON lines, whole texts, images, fonts, split datasets, metrics."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.pytext import strip

GOLD = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("text", T.StringType())])


def corpus(spark: SparkSession, root: str, config: str = "", split: str | None = None, by: str = "split") -> DataFrame:
    """A Parquet corpus; with a split only its rows (where `by` partitions the files: its files) are read, without one all are."""
    df = spark.read.parquet(f"{root}/{config}" if config else root)
    return df if split is None else df.where(F.col(by) == split)


def json_lines(spark: SparkSession, path: str, schema: T.StructType = GOLD) -> DataFrame:
    return spark.read.schema(schema).json(path)


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, text) of the *.txt files of a folder, each whole, stripped, with \\n line ends; subfolders are not read."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt")
    return raw.select(F.col("_metadata.file_name").alias("file_name"), strip(F.replace("value", F.lit("\r\n"), F.lit("\n"))).alias("text"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """(file_name, path, bytes) of the *.jpg files of a folder."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(folder)
    return raw.select(F.substring_index("path", "/", -1).alias("file_name"), "path", F.col("content").alias("bytes"))


def fonts(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(path, content, codepoints, units_per_em, advances, line_units) of the *.ttf files under the folders that exist, whatever
    their case. An A above a g is line_units high. A broken file has no code points."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    there = [f for f in folders if (p := hadoop(f)).getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)]
    if not there:
        return spark.createDataFrame([], "path string, content binary, codepoints array<int>, units_per_em int, advances array<int>, line_units int")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.[tT][tT][fF]").option("recursiveFileLookup", "true").load(there)

    @F.pandas_udf("struct<codepoints:array<int>,units_per_em:int,advances:array<int>,line_units:int>")
    def read(contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(*font_tables(c), line_units(c)) for c in contents], columns=["codepoints", "units_per_em", "advances", "line_units"])

    return raw.select("path", "content", read("content").alias("f")).select("path", "content", "f.*")


def usable_fonts(found: DataFrame, letters: str | None = None, strict: bool = False) -> DataFrame:
    """(path) of the fonts that cover the letters; and how many there are is .count()."""
    return found.where(covers("codepoints", ICELANDIC if letters is None else letters, strict)).select("path")


def font_tables(data: bytes) -> tuple[list[int], int, list[int]]:
    """(code points, units per em, advance of each) of a TrueType font; nothing of a broken one."""
    try:
        count = struct.unpack_from(">H", data, 4)[0]
        at = {data[12 + 16 * i : 16 + 16 * i]: struct.unpack_from(">II", data, 20 + 16 * i)[0] for i in range(count)}
        cmap, units = at[b"cmap"], struct.unpack_from(">H", data, at[b"head"] + 18)[0]
        metrics = struct.unpack_from(">H", data, at[b"hhea"] + 34)[0]
        glyphs = dict(_glyphs(data, cmap))
        advance = lambda g: struct.unpack_from(">H", data, at[b"hmtx"] + 4 * min(g, metrics - 1))[0]
        points = sorted(glyphs)
        return points, units, [advance(glyphs[p]) for p in points]
    except (KeyError, struct.error, ValueError):
        return [], 0, []


def glyph_ids(data: bytes) -> dict[int, int]:
    """The glyph of each code point."""
    count = struct.unpack_from(">H", data, 4)[0]
    at = {data[12 + 16 * i : 16 + 16 * i]: struct.unpack_from(">II", data, 20 + 16 * i)[0] for i in range(count)}
    return dict(_glyphs(data, at[b"cmap"]))


def line_units(data: bytes) -> int:
    """From the top of A to the foot of g, in font units; 0 where the font has no such outlines."""
    from pagemill.sources.raster import Outlines

    try:
        outlines, ids = Outlines(data), glyph_ids(data)
        return max(0, outlines.box(ids[ord("A")])[3] - outlines.box(ids[ord("g")])[1])
    except (KeyError, struct.error, ValueError, IndexError):
        return 0


def _glyphs(data: bytes, cmap: int) -> Iterator[tuple[int, int]]:
    """(code point, glyph) of the Unicode tables of formats 4 and 12."""
    for i in range(struct.unpack_from(">H", data, cmap + 2)[0]):
        platform, _, offset = struct.unpack_from(">HHI", data, cmap + 4 + 8 * i)
        t = cmap + offset
        kind = struct.unpack_from(">H", data, t)[0]
        if platform not in (0, 3):
            continue
        if kind == 4:
            n = struct.unpack_from(">H", data, t + 6)[0] // 2
            ends, starts, deltas, ranges = (struct.unpack_from(f">{n}H", data, t + 14 + 2 * n * k + 2 * (k > 0)) for k in range(4))
            for s in range(n):
                for c in range(starts[s], min(ends[s], 0xFFFE) + 1):
                    if ranges[s]:
                        g = struct.unpack_from(">H", data, t + 16 + 6 * n + 2 * s + ranges[s] + 2 * (c - starts[s]))[0]
                        g = (g + deltas[s]) % 65536 if g else 0
                    else:
                        g = (c + deltas[s]) % 65536
                    if g:
                        yield c, g
        elif kind == 12:
            for s in range(struct.unpack_from(">I", data, t + 12)[0]):
                first, last, glyph = struct.unpack_from(">III", data, t + 16 + 12 * s)
                yield from ((c, glyph + c - first) for c in range(first, last + 1))


#: Letters that a usable font has, one of them at least.
ICELANDIC = "áðéíóúýþæöÁÐÉÍÓÚÝÞÆÖ"


def covers(codepoints: Column | str, letters: str = ICELANDIC, strict: bool = False) -> Column:
    """Whether a font has any of the letters; strict: all of them."""
    wanted = F.array(*(F.lit(ord(c)) for c in letters))
    return F.size(F.array_except(wanted, codepoints)) == 0 if strict else F.arrays_overlap(codepoints, wanted)


def save_splits(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def save_json_lines(df: DataFrame, path: str, one_file: bool = False) -> None:
    """One object a line, by as many tasks as the table has; one_file is for manifests, which are small."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Adds rows to a table of metrics; read it again with corpus()."""
    df.write.mode("append").parquet(path)


def sample(splits: DataFrame, split: str = "train", n: int = 1, text: str = "text") -> list[str]:
    """The first texts of a split, for a look at them; none of a split without rows."""
    return [r[0] for r in splits.where(F.col("split") == split).select(text).limit(n).collect()]


def copy_missing(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """Copies the files of a listing (file_name, path) that the folder lacks, whatever file systems these are on; returns
    (file_name, copied). A listing is small: names are read by the driver, and the bytes of what is missing go through it one
    file after the other, each to a name of its own first, so that a half copied file never stands under the right one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    to = path(folder)
    there = to.getFileSystem(conf)
    there.mkdirs(to)
    have = {s.getPath().getName() for s in there.listStatus(to)}
    rows = []
    for r in files.select("file_name", "path").orderBy("file_name").collect():
        if missing := r.file_name not in have:
            source, part = path(r.path), path(to, f".{r.file_name}.part")
            jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, there, part, False, True, conf)
            there.rename(part, path(to, r.file_name))
            have.add(r.file_name)
        rows.append((r.file_name, missing))
    return spark.createDataFrame(rows, "file_name string, copied boolean")


def decoded(image_bytes: Column | str) -> Column:
    """(width, height, channels) of baseline image headers: JPEG and PNG. Pixels need an imaging library, which is optional."""

    @F.pandas_udf("struct<width:int,height:int,channels:int>")
    def run(contents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_header(c or b"") for c in contents], columns=["width", "height", "channels"])

    return run(image_bytes)


def image_header(data: bytes) -> tuple[int | None, int | None, int | None]:
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 26:
        width, height = struct.unpack_from(">II", data, 16)
        return width, height, {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(data[25])
    at = 2
    while data[:2] == b"\xff\xd8" and at + 9 < len(data) and data[at] == 0xFF:
        size = struct.unpack_from(">H", data, at + 2)[0]
        if 0xC0 <= data[at + 1] <= 0xCF and data[at + 1] not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack_from(">HH", data, at + 5)
            return width, height, data[at + 9]
        at += 2 + size
    return None, None, None
