"""Streams of generated tokens: what a reader sees after each token."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def growing(tokens: DataFrame, run: str, place: str, token: str, opening: str = "...") -> DataFrame:
    """run, place, shown: first the opening, then the text so far after each token, in order."""
    w = Window.partitionBy(run).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    text = tokens.select(run, F.col(place).cast("long").alias(place), F.array_join(F.collect_list(token).over(w), "").alias("shown"))
    first = tokens.select(run).distinct().select(run, F.lit(-1).cast("long").alias(place), F.lit(opening).alias("shown"))
    return first.unionByName(text)
