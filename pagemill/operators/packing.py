"""Tokens, and their packing into blocks of fixed length across documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.pytext import portable_hash, words
from pagemill.operators.order import prefix_sum

EOS = 0
IGNORED = -100


def codepoints(text: Column | str) -> Column:
    """One token for each character: its code point."""
    return F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c))


def word_ids(text: Column | str, vocabulary: int = 1 << 20) -> Column:
    """One token for each word: a hash of it, from 1."""
    return F.transform(words(F.col(text) if isinstance(text, str) else text), lambda w: (portable_hash(w) % vocabulary + 1).cast("int"))


def from_file(text: Column | str, path: str) -> Column:
    """Tokens of a tokenizer in JSON format, without truncation or padding. The file must be readable by the executors."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        t = _LOADED.get(path) or _LOADED.setdefault(path, Tokenizer.from_file(path))
        return pd.Series([e.ids for e in t.encode_batch([x or "" for x in texts])])

    return run(text)


_LOADED: dict = {}


def with_eos(ids: Column | str, eos: int = EOS) -> Column:
    return F.array_append(ids, F.lit(eos))


def decoded(ids: Column | str, special: tuple[int, ...] = (EOS,)) -> Column:
    """The text of code-point tokens, special ones left out."""
    return F.array_join(F.transform(F.filter(ids, lambda i: ~i.isin(*special)), lambda i: F.decode(F.unhex(F.lpad(F.hex(i), 8, "0")), "UTF-32")), "")


def packed(docs: DataFrame, length: int = 512, key: str = "doc_id", ids: Column | str = "ids", count: Column | None = None) -> DataFrame:
    """(block, input_ids): the documents' tokens, each with the end token, in the order of key, cut into blocks of `length`.

    What fills no block is left out; a document without tokens is an end token, one whose tokens are null is none. The stream is
    never put together: offsets come from prefix sums over (key, number of tokens) alone, each document is cut into pieces at
    block bounds, and pieces meet by block, at most `length` tokens in one group. Tokens are made once, after the offsets are
    known; `count`, if given, is their number without making them. Keys are unique, else it is an error.
    """
    ids = F.col(ids) if isinstance(ids, str) else ids
    sizes = docs.select(key, ((F.size(ids) if count is None else count) + 1).cast("long").alias("__n")).where(F.col("__n") > 0)
    if twice := sizes.groupBy(key).count().where("count > 1").first():
        raise ValueError(f"{twice['count']} documents of key {twice[0]}")
    offsets = prefix_sum(sizes, key, "__n", "__at")
    held = docs.join(offsets, key).select("__at", "__n", with_eos(ids).alias("__ids"))
    first, last = F.expr(f"__at div {length}"), F.expr(f"(__at + __n - 1) div {length}")

    def piece(block: Column) -> Column:
        start = F.greatest(block * length - F.col("__at"), F.lit(0).cast("long"))
        stop = F.least((block + 1) * length - F.col("__at"), F.col("__n"))
        return F.struct(block.alias("block"), (F.col("__at") + start).alias("o"), F.slice("__ids", (start + 1).cast("int"), (stop - start).cast("int")).alias("p"))

    cut = held.select(F.explode(F.transform(F.sequence(first, last), piece)).alias("x")).select("x.block", F.struct("x.o", "x.p").alias("x"))
    meet = cut.groupBy("block").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    whole = meet.select("block", F.flatten(F.transform("xs", lambda x: x["p"])).alias("input_ids"))
    return whole.where(F.size("input_ids") == length)


def masked(ids: Column | str, *hidden: int) -> Column:
    """Labels: the ids, with padding and image tokens ignored."""
    return F.transform(ids, lambda x: F.when(x.isin(*hidden), IGNORED).otherwise(x))


def padded(ids: Column | str, to: Column, pad: int) -> Column:
    return F.concat(F.col(ids) if isinstance(ids, str) else ids, F.array_repeat(F.lit(pad), F.greatest(to - F.size(ids), F.lit(0)).cast("int")))
