"""Pairs of scans and transcriptions, chat messages, key maps and training metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.operators.order import ordered_rank


def positional_zip(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows paired by their place in either order. Unequal counts are an error."""
    if (a := left.count()) != (b := right.count()):
        raise ValueError(f"{a} rows against {b}")
    return ordered_rank(left, left_order).join(ordered_rank(right, right_order), "pos")


def stem(path: Column | str) -> Column:
    """A path's file name without its last extension."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def stem_pairs(left: DataFrame, right: DataFrame, left_path: str, right_path: str) -> DataFrame:
    """A full join on stems, and matched: whether both sides have the stem."""
    one, two = left.withColumn("stem", stem(left_path)), right.withColumn("stem", stem(right_path))
    return one.join(two, "stem", "full").withColumn("matched", F.col(left_path).isNotNull() & F.col(right_path).isNotNull())


def content(kind: str, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), text.alias("text"))


#: What the user asks before and after the image.
BEFORE, AFTER = "Answer briefly.", "OCR this image accurately."


def ocr_messages(text: Column | str, before: str = BEFORE, after: str = AFTER) -> Column:
    """The user's turn (instruction, image, instruction) and the assistant's (the text)."""
    none = F.lit(None).cast("string")
    ask = F.array(content("text", F.lit(before)), content("image", none), content("text", F.lit(after)))
    say = F.array(content("text", F.col(text) if isinstance(text, str) else text))
    return F.array(F.struct(F.lit("user").alias("role"), ask.alias("content")), F.struct(F.lit("assistant").alias("role"), say.alias("content")))


def prompt_messages(text: Column, images: Column) -> Column:
    """One user turn: an image placeholder for each image, then the text."""
    return F.array(F.struct(F.lit("user").alias("role"), F.concat(F.array_repeat(content("image", F.lit(None).cast("string")), images), F.array(content("text", text))).alias("content")))


def render(messages: Column | str, generation: bool = False) -> Column:
    """Messages as text: role, contents (<image> for images), an end mark; optionally the assistant's opening."""
    line = lambda m: F.concat(F.initcap(m["role"]), F.lit(": "), F.array_join(F.transform(m["content"], lambda c: F.coalesce(c["text"], F.lit("<image>"))), " "), F.lit("<end_of_utterance>"))
    out = F.array_join(F.transform(messages, line), "\n")
    return F.concat(out, F.lit("\nAssistant:")) if generation else out


def add_prefix(key: Column, prefix: str = "model.") -> Column:
    return F.concat(F.lit(prefix), key)


def strip_prefix(key: Column, prefix: str = "model.") -> Column:
    """Without the prefix; other keys stay."""
    return F.when(key.startswith(prefix), F.substr(key, F.lit(len(prefix) + 1))).otherwise(key)


def known_keys(keys: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return keys.join(target.select(key), key, "left_semi")


def unknown_keys(keys: DataFrame, target: DataFrame, key: str) -> DataFrame:
    return keys.join(target.select(key), key, "left_anti")


def tokens_per_step(batch: int, accumulation: int, length: int) -> int:
    return batch * accumulation * length


def steps(rows, batch: int, accumulation: int, epochs: int):
    """Optimizer steps: whole batches only, then times epochs. rows is a number or a column."""
    each = batch * accumulation
    return F.floor(rows / each) * epochs if isinstance(rows, Column) else rows // each * epochs


def sample_key(place: Column) -> Column:
    """The name under which the sample generated for a prompt is logged."""
    return F.format_string("eval_sample_%d", place)


def running_tokens(log: DataFrame, run: str, step: str, each: int) -> DataFrame:
    """Adds tokens_this_step and total_tokens_trained for each run, in the order of steps."""
    w = Window.partitionBy(run).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("tokens_this_step", F.lit(each).cast("long")).withColumn("total_tokens_trained", F.sum(F.lit(each).cast("long")).over(w))


def rate(amount: Column, seconds: Column) -> Column:
    """Per second; null where no time has passed."""
    return F.when(seconds > 0, amount / seconds)


def average_rate(amount: Column, seconds: Column) -> Column:
    """Per second; 0 where no time has passed."""
    return F.when(seconds > 0, amount / seconds).otherwise(0.0)


def best(checkpoints: DataFrame, run: str, name: str, loss: str) -> DataFrame:
    """For each run the checkpoint of least loss."""
    return checkpoints.groupBy(run).agg(F.min_by(name, F.struct(loss, name)).alias(name), F.min(loss).alias(loss))


def latest(checkpoints: DataFrame, run: str, step: str, keep: int = 3) -> DataFrame:
    """For each run the last checkpoints."""
    return checkpoints.withColumn("__r", F.row_number().over(Window.partitionBy(run).orderBy(F.desc(step)))).where(F.col("__r") <= keep).drop("__r")


def drawn(literals: tuple[str, ...], k: int, seed: int, spark) -> DataFrame:
    """k literals drawn with replacement, by place."""
    from pagemill.functions.pytext import portable_hash

    which = portable_hash(F.lit(str(seed)), F.col("id")) % len(literals) + 1
    return spark.range(k).select("id", F.element_at(F.array(*map(F.lit, literals)), which.cast("int")).alias("text"))
