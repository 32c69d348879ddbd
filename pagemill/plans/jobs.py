"""Whole jobs, each from one configuration: page images of a corpus, packed blocks, pairs of scans and transcriptions."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.config import GoldConfig, PackConfig, PageConfig
from pagemill.operators import order, packing, pages, records
from pagemill.sources import files

log = logging.getLogger("pagemill")


def page_images(spark: SparkSession, c: PageConfig) -> DataFrame:
    """Pages with text, image, attributes and split, as `c` says. The fonts that cover the letters are counted and, where fonts
    are random, drawn from; a page is drawn with its own font."""
    docs = files.corpus(spark, c.dataset_path, c.data_directory, c.split or None)
    docs = order.head(docs, c.max_entries, c.key_column, clamped=False)
    docs = docs.select(F.col(c.key_column).alias("doc_id"), F.col(c.text_column).alias("text"))
    docs = order.head(docs, c.num_examples, "doc_id")
    found = files.fonts(spark, [f for f in c.font_dirs.split(",") if f])
    names: list[str] = []
    if c.random_fonts:
        names = sorted(r.path for r in files.usable_fonts(found).collect())
        log.info("%d usable fonts", len(names))
    size = pages.geometry(c)["font_size"]
    row = found.where(F.col("path").endswith(c.font_path)).first() if c.font_path != "default" else None
    if names:  # all pages are laid out by one font's widths, so that a page's text does not depend on the draw of the page before
        row = found.where(F.col("path") == names[0]).first()
    laid = pages.attributed(pages.laid_out(docs, c, pages.font_measure(row, size)), c, tuple(names))
    laid = laid.withColumn("page_id", F.concat_ws(":", "doc_id", "chunk_ix", "page_ix"))
    parts = [(laid.where(F.col("font_path") == n), n) for n in names] or [(laid, row["path"] if row else None)]
    drawn = [pages.rendered(part, c, found, name) for part, name in parts]
    whole = drawn[0]
    for d in drawn[1:]:
        whole = whole.unionByName(d)
    cuts = order.three_way(laid.select("page_id"), "page_id", seed=c.seed)
    return whole.join(cuts, "page_id")


def build_pages(spark: SparkSession, c: PageConfig) -> dict[str, int]:
    """Writes the pages by split; returns how many each has."""
    files.save_splits(page_images(spark, c), c.output_path)
    saved = files.corpus(spark, c.output_path)
    if c.show_sample:
        for text in files.sample(saved):
            log.info("text of the first page:\n%s", text)
    return {r.split: r.n for r in saved.groupBy("split").agg(F.count("*").alias("n")).collect()}


def build_blocks(spark: SparkSession, c: PackConfig) -> dict[str, int]:
    """Writes packed blocks of the three splits (train, eval, unused); returns how many each has. Limits are of blocks."""
    docs = files.corpus(spark, c.dataset_path, c.data_directory).select(F.col(c.key_column).alias("doc_id"), F.col(c.text_column).alias("text"))
    docs = order.three_way(docs, "doc_id", ("train", "eval", "unused"), c.seed)
    most = {"train": c.max_train, "eval": c.max_eval}
    counts = {}
    for name in most:
        mine = docs.where(F.col("split") == name).where("text IS NOT NULL")
        if c.tokenizer:
            blocks = packing.packed(mine.select("doc_id", packing.from_file("text", c.tokenizer).alias("ids")), c.max_length)
        else:
            blocks = packing.packed(mine, c.max_length, ids=packing.codepoints("text"), count=F.length("text"))
        order.head(blocks, most[name], "block").write.mode("overwrite").parquet(f"{c.output_path}/{name}")
        counts[name] = spark.read.parquet(f"{c.output_path}/{name}").count()
    return counts


def build_gold(spark: SparkSession, c: GoldConfig) -> dict[str, int]:
    """Copies the scans and writes the manifest of (file_name, text), scans and texts paired by their place."""
    scans, texts = files.images(spark, c.image_dir), files.texts(spark, c.text_dir)
    pairs = records.positional_zip(scans.select("file_name", "path"), texts.select(F.col("file_name").alias("text_name"), "text"), "file_name", "text_name")
    copied = files.copy_missing(spark, scans, c.output_dir).where("copied").count()
    files.save_json_lines(pairs.select("file_name", "text"), f"{c.output_dir}/metadata", one_file=True)
    return {"pairs": pairs.count(), "copied": copied}
