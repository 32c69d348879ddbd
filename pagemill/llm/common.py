"""What the operators of this folder share: reading, batches, checkpoints, words as arrays."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word; bytes.split() splits at exactly these.
SPACE = b" \t\n\r\x0b\x0c"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds what a Python worker holds: texts of up to some MB each come in batches of few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is set, one of our own if driver and executors are one
    process; on a cluster that is an error, as a folder of one machine would lose data."""
    sc: SparkContext = spark.sparkContext
    if (found := sc.getCheckpointDir()) is None:
        wanted = spark.conf.get("spark.checkpoint.dir", None)
        if wanted is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            wanted = tempfile.mkdtemp(prefix="pagemill-")
        sc.setCheckpointDir(wanted)
        found = sc.getCheckpointDir()
    return found


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Whether Spark deletes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and goes on from there, so that a lost executor costs no recomputation.

    The shuffle files it took are deleted then, as nothing reads them again; else they stay until the driver happens to collect
    its garbage, and an operator of many steps holds those of many steps at once.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a query of its own, as the setting holds from a query's first plan
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame) -> DataFrame:
    """The same as a compressed table in the shared checkpoint folder: for wide rows, and where later steps read few columns."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Of a key bitmap: 2**26 positions in buckets of 2**15, so at most 2,048 rows of 4 KB (8 MB), whatever the number of keys.
BITMAP_BITS, BUCKET_BITS = 26, 15


def maybe_among(df: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """Adds name (boolean): false only where the key, a hash as a long, is not in the one column of keys.

    The keys' positions are broadcast as a bitmap of bounded size; with very many keys it fills and lets more rows through,
    so what it lets through has still to be joined.
    """
    at = F.col(keys.columns[0]).bitwiseAND((1 << BITMAP_BITS) - 1)
    taken = keys.select(F.shiftright(at, BUCKET_BITS).alias("bucket"), at.bitwiseAND((1 << BUCKET_BITS) - 1).alias("bit"))
    # by bucket first: a partial bitmap of a few keys would be larger than the keys
    bitmap = taken.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    at = key.bitwiseAND((1 << BITMAP_BITS) - 1)
    byte = F.substring("bits", F.shiftright(at.bitwiseAND((1 << BUCKET_BITS) - 1), 3).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), at.bitwiseAND(7).cast("int"))
    found = df.join(F.broadcast(bitmap), F.shiftright(at, BUCKET_BITS) == F.col("bucket"), "left")
    return found.select(*df.columns, F.coalesce(bit == 1, F.lit(False)).alias(name))


def base_columns(df: DataFrame, **wanted: Column | str) -> DataFrame:
    """Only the named columns, so that extra columns of the input can't clash with the ones an operator adds."""
    return df.select(*(F.col(c).alias(k) if isinstance(c, str) else c.alias(k) for k, c in wanted.items()))


def fresh(df: DataFrame, name: str) -> str:
    """The name, or the next like it that no column of df has."""
    while name in df.columns:
        name += "_"
    return name


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array, nulls as empty texts; no copy where there are no nulls."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """Each text of an Arrow string array as UTF-8, null as empty."""
    for x in column.cast(pa.binary() if column.type == pa.string() else pa.large_binary()).to_pylist():
        yield x or b""


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which each output bit depends on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def prefix_hash(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P, I): the substring [i, j) has the hash (P[j] - P[i]) * I[i] modulo 2**64, wherever it stands."""
    n = len(raw)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=total[1:])
    return total, _powers(_INVERSE, n + 1)


#: 1 for the bytes that end words.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(raw: np.ndarray, offsets: np.ndarray, is_gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each word of a batch of texts laid end to end; a word ends at its text's end."""
    gap = is_gap[raw]
    n = len(raw)
    before = np.ones(n, bool)
    before[1:] = gap[:-1]
    edge = offsets[:-1][offsets[:-1] < n]
    before[edge] = True
    start = np.flatnonzero(~gap & before)
    after = np.ones(n, bool)
    after[:-1] = before[1:] | gap[1:]
    end = np.flatnonzero(~gap & after) + 1
    return start, end, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(start, offsets)))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    total, inverse = prefix_hash(raw)
    return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


#: Words of more bytes are hashed one by one.
LONG_WORD = 256
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def word_keys(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each word's bytes: two independent chains of a mixing bijection over blocks of 8 bytes."""
    size = (end - start).astype(np.uint64)
    a, b = mixed(size * _K1), mixed(size * _K2 + np.uint64(1))
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(raw) + 1,), "<u8", padded.data, strides=(1,))
    open_ = np.flatnonzero(end - start <= LONG_WORD)
    at = start[open_]
    while len(open_):
        left = np.minimum(end[open_] - at, 8).astype(np.uint64)
        block = blocks[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        a[open_], b[open_] = mixed(a[open_] ^ block), mixed((b[open_] + block) * _K2)
        more = end[open_] - at > 8
        open_, at = open_[more], at[more] + 8
    for i in np.flatnonzero(end - start > LONG_WORD):
        whole = np.frombuffer(xxhash.xxh3_128_digest(raw[start[i] : end[i]].tobytes()), "<u8")
        a[i], b[i] = whole
    return a, b


def distinct_keys(a: np.ndarray, b: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, edge): sorted by (more, a, b), equal keys stand together, the first of each at an edge."""
    order = np.lexsort((a, *more)) if more else np.argsort(a)
    keys = [x[order] for x in (a, *more)]
    new = np.ones(len(a), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    other = b[order]
    if ((other[1:] != other[:-1]) & ~new[1:]).any():  # two words that share the first half of their keys
        order = np.lexsort((b, a, *more))
        keys = [x[order] for x in (a, b, *more)]
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return order, np.flatnonzero(new)


def shingle_hashes(h: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of every k words that stand in one text."""
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = h[: len(h) - k + 1].copy()
    for i in range(1, k):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[i : len(h) - k + 1 + i]
    first = np.flatnonzero(text[: len(h) - k + 1] == text[k - 1 :])
    return mixed(out[first]), first
