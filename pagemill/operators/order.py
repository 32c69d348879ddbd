"""Row order as data: ranks, prefix sums, heads and splits that don't gather the table in one task. What is counted by group
before is ranked with it, so inputs are tables that give the same rows each time they are read."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.pytext import portable_hash

#: Rows that a group of ranks holds, about, and bounds of ranges that the driver holds at most.
GROUP_ROWS, BOUNDS = 1 << 18, 256


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key)).cast("binary"))


def _digits(rows: int) -> int:
    """Hexadecimal digits of the hash that make groups of about GROUP_ROWS rows."""
    return max(1, math.ceil(math.log(max(rows, 1) / GROUP_ROWS, 16))) if rows > GROUP_ROWS else 1


def _running(counts: DataFrame, group: str, n: str) -> DataFrame:
    """(group, __before): the sums of n over the groups before, of one row for each group."""
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(group, F.coalesce(F.sum(n).over(before), F.lit(0)).alias("__before"))


def hash_rank(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Adds rank (from 1) in the order of md5(seed:key), key. Rows go to groups by the first digits of the hash, as many groups as
    the rows need; only their counts meet in one task."""
    digits = _digits(df.count())
    df = df.withColumn("__h", _digest(key, seed)).withColumn("__g", F.substring("__h", 1, digits))
    before = _running(df.groupBy("__g").agg(F.count("*").alias("__n")), "__g", "__n")
    place = F.row_number().over(Window.partitionBy("__g").orderBy("__h", key))
    return df.join(F.broadcast(before), "__g").withColumn("rank", F.col("__before") + place).drop("__h", "__g", "__before")


def ordered_rank(df: DataFrame, key: str, name: str = "pos") -> DataFrame:
    """Adds the row's number (from 1) in the order of key. Rows go to ranges between bounds drawn from the keys, and are numbered
    within these; equal keys are told apart by the other columns."""
    step = max(1, df.count() // (BOUNDS * 16))
    drawn = sorted({r[0] for r in df.select(key).where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(step)) == 0)).collect()})
    bounds = drawn[:: max(1, len(drawn) // BOUNDS)]
    within = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda x: x <= F.col(key))) if bounds else F.lit(0)
    df = df.withColumn("__g", F.when(F.col(key).isNull(), -1).otherwise(within))
    before = _running(df.groupBy("__g").agg(F.count("*").alias("__n")), "__g", "__n")
    tie = F.xxhash64(*(c for c in df.columns if c != "__g"))
    place = F.row_number().over(Window.partitionBy("__g").orderBy(key, tie))
    return df.join(F.broadcast(before), "__g").withColumn(name, F.col("__before") + place).drop("__g", "__before")


def prefix_sum(df: DataFrame, key: str, value: str, name: str, width: int = 1024) -> DataFrame:
    """Adds the sum of value over all rows of smaller key, in three levels: per block of ranges, per range of keys, within a range.

    Keys are whole numbers. A range holds about `width` rows: it is as much wider as the keys are sparse. Equal keys are told
    apart by the other columns, so that a task that is run again gives the same sums.
    """
    rows, least, most = df.agg(F.count("*"), F.min(key), F.max(key)).first()
    span = max(width, -(-(most - least + 1) * width // rows)) if rows else width
    df = df.withColumn("__r", F.floor(F.col(key) / F.lit(float(span))))
    ranges = df.groupBy("__r").agg(F.sum(value).alias("__s")).withColumn("__q", F.floor(F.col("__r") / width))
    blocks = _running(ranges.groupBy("__q").agg(F.sum("__s").alias("__t")), "__q", "__t").withColumnRenamed("__before", "__a")
    second = Window.partitionBy("__q").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__b", F.coalesce(F.sum("__s").over(second), F.lit(0))).join(blocks, "__q")
    ranges = ranges.select("__r", (F.col("__a") + F.col("__b")).alias("__before"))
    tie = F.xxhash64(*(c for c in df.columns if c != "__r"))
    third = Window.partitionBy("__r").orderBy(key, tie).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn("__c", F.coalesce(F.sum(value).over(third), F.lit(0))).join(ranges, "__r")
    return out.withColumn(name, (F.col("__before") + F.col("__c")).cast("long")).drop("__r", "__before", "__c")


def head(df: DataFrame, n: int, *order: str, clamped: bool = True) -> DataFrame:
    """The first n rows in the given order, all if n is 0; unclamped, fewer rows than asked for are an error."""
    if n <= 0:
        return df
    if not clamped and (have := df.limit(n).count()) < n:
        raise IndexError(f"{n} rows asked for, {have} there")
    return df.orderBy(*order).limit(n)


def split_sizes(n: int, held: float = 0.2, inner: float = 0.5) -> tuple[int, int]:
    """(rows held out, rows of those in the first part), both rounded up."""
    out = math.ceil(n * held)
    return out, math.ceil(out * inner)


def _at_rank(df: DataFrame, key: str, seed: int, groups: list[tuple[str, int]], digits: int, rank: int):
    """(hash, key) of the row of a rank, from the groups' counts: only that group is sorted."""
    for group, n in groups:
        if rank <= n:
            mine = df.select(_digest(key, seed).alias("__h"), key).where(F.substring("__h", 1, digits) == group)
            return tuple(mine.orderBy("__h", key).offset(rank - 1).first())
        rank -= n
    return None


def three_way(df: DataFrame, key: str, names: tuple[str, str, str] = ("train", "test", "validation"), seed: int = 42) -> DataFrame:
    """Adds split: the last fifth in the order of md5(seed:key), key is held out, and halved. Keys are unique; sizes are exact at
    any partitioning. Rows are not moved: they are compared with the two rows at which the parts end."""
    total = df.count()
    held, test = split_sizes(total)
    digits = _digits(total)
    counts = df.select(F.substring(_digest(key, seed), 1, digits).alias("g")).groupBy("g").agg(F.count("*").alias("n")).collect()
    groups = sorted((r.g, r.n) for r in counts)
    split = F.lit(names[2])
    for name, last in ((names[1], total - held + test), (names[0], total - held)):
        if last > 0:
            h, k = _at_rank(df, key, seed, groups, digits, last)
            mine = _digest(key, seed)
            split = F.when((mine < h) | ((mine == h) & (F.col(key) <= F.lit(k))), name).otherwise(split)
    return df.withColumn("split", split)


def by_document(df: DataFrame, key: str, names: tuple[str, str, str] = ("train", "test", "validation"), seed: int = 42) -> DataFrame:
    """Adds split by the hash of key alone: 80/10/10 in the mean, no shuffle, and all rows of a key in one split."""
    h = portable_hash(F.lit(str(seed)), F.col(key)) % 10
    return df.withColumn("split", F.when(h < 8, names[0]).when(h == 8, names[1]).otherwise(names[2]))


def color(low: int, high: int, *parts: Column | str) -> Column:
    """A whole number from low to high that depends on the parts alone."""
    return (portable_hash(*parts) % (high - low + 1) + low).cast("int")
