"""The corpus pipeline: five stages over documents, each written as Parquet and read again for the next.

Toxic documents go, one document of each group of near copies stays, documents that contain benchmark items go, personal
data is replaced in the texts, and what is left is mixed to the source weights (repeats as a count).

All stages carry the columns of documents as they are, whatever else these hold, and take nulls in any of them. An empty table
goes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import decontamination, mixing, pii, simhash, toxicity
from pagemill.llm.common import checkpoint_dir, discard, fresh, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar scores below the threshold. A null text scores as an empty one and stays, a null id is never
    learned from; a score at the threshold is rejected; equal rows share their fate."""
    grammar = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs, "toxicity")
    return toxicity.scored(docs, grammar, name=name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of least id, a null id last, of equal ids the least hash of the row. Of
    equal rows one stays; null, empty and blank texts are one group."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Null and empty texts contain none, null and empty items are in none; ids play no
    part, so equal rows share their fate; a document exactly at the threshold goes."""
    name = fresh(docs, "contaminated")
    return decontamination.flagged(docs, table(spark, sf_dir, "benchmark"), name=name).where(~F.col(name)).drop(name)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced; n_chars follows the text. A null text stays null; rows stay as many as they
    are, null and equal ids included."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (times) and how many words (taken). A null source is one of its own; a
    text without words is never taken; where a budget ends among equal rows, as many of them as come nearest to it."""
    mixed = mixing.mix(docs.select("doc_id", "text", "source", F.struct("*").alias("doc")), keep=("doc",))
    times = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(F.lit(0))
    more = {"size": F.col("size"), "target": F.col("target"), "taken": F.col("taken"), "times": times}
    return mixed.where("taken > 0").select("doc.*", *(c.alias(fresh(docs, k)) for k, c in more.items()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_personal),
    ("mixing", mix_sources),
]

#: Learned and graph stages have no SQL form; the tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents, through the shared checkpoint folder."""
    home = f"{checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
        if before:  # the next stage reads this one's table alone
            discard(spark, f"{home}/{before}")
        before = name
    return docs
