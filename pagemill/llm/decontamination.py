"""Finds benchmark items inside documents: size-partitioned MinHash containment search, verified on exact shingles.

An item of n distinct shingles is contained in a document at threshold t if at least ceil(t * n) of them occur there. So at
most n - ceil(t * n) are missing, and of the item's n - ceil(t * n) + 1 smallest shingle hashes (its MinHash signature; its
length depends on the item's size alone) at least one must occur in every document that matches. Items are partitioned by size (powers
of two), each partition with its own signatures; a document with fewer shingles than the partition's least item needs is not
probed against it. Probing loses no match, however long the document is. Candidates are then verified: each of the item's
shingles, as text, is looked up among the whole document's.

The items are a stated query set: they are taken in blocks of at most BLOCK_ITEMS items and about BLOCK_BYTES of text, each
broadcast and run against all documents. Documents stream through in batches; none is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import LOWER, base_columns, byte_texts, shingle_hashes, small_batches, table, utf8, word_hashes, words

#: Items and bytes of their texts in one broadcast block, about (a block takes some 20 times its bytes), and the words of a shingle.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 8 << 20
SHINGLE = 5


class Items:
    """The signatures of one block of items."""

    def __init__(self, rows: list[tuple[int, str]], k: int, num: int, den: int):
        self.shingles: list[list[bytes]] = []
        self.ids: list[int] = []
        self.num, self.den = num, den
        by_size: dict[int, list[int]] = defaultdict(list)
        for item_id, text in rows:
            w = (text or "").encode().lower().split()
            if not w:
                continue
            size = min(k, len(w))
            distinct = sorted({b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)})
            by_size[len(distinct)].append(len(self.ids))
            self.ids.append(item_id)
            self.shingles.append(distinct)
        #: by the words of a shingle and the partition of sizes: signature hashes, and the item of each
        keys: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        least: dict[tuple[int, int], int] = {}
        for n, members in sorted(by_size.items()):
            length = n - self.needed(n) + 1
            for i in members:
                size = self.shingles[i][0].count(b" ") + 1
                joined = pa.array([s.decode("utf-8", "surrogateescape") for s in self.shingles[i]])
                raw, off = utf8(joined)
                start, end, of = words(raw, off)
                h, _ = shingle_hashes(word_hashes(raw, start, end), of, size)
                part = size, n.bit_length()
                keys[part] += [(x, i) for x in np.sort(h)[:length].tolist()]
                least[part] = min(least.get(part, n), self.needed(n))
        #: by the words of a shingle: a sieve over all partitions, and for each the least shingles of a document, hashes, items
        self.probes: dict[int, tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]] = {}
        for (size, width), found in sorted(keys.items()):
            found.sort()
            h = np.array([x for x, _ in found], np.uint64)
            sieve, parts = self.probes.setdefault(size, (np.zeros(1 << 20, bool), []))
            sieve[(h >> np.uint64(44)).astype(np.int64)] = True
            parts.append((least[size, width], h, np.array([i for _, i in found], np.int64)))

    def needed(self, n: int) -> int:
        """ceil(t * n) in whole numbers."""
        return -(-n * self.num // self.den)

    def candidates(self, raw: np.ndarray, off: np.ndarray) -> dict[int, set[int]]:
        """By row of the batch, the items that share a signature hash."""
        start, end, of = words(raw, off)
        h = word_hashes(raw, start, end)
        many = np.bincount(of, minlength=len(off) - 1)
        out: dict[int, set[int]] = defaultdict(set)
        for size, (sieve, parts) in self.probes.items():
            s, first = shingle_hashes(h, of, size)
            hit = np.flatnonzero(sieve[(s >> np.uint64(44)).astype(np.int64)])
            doc = of[first[hit]]
            for least, keys, item in parts:
                able = many[doc] - size + 1 >= least
                mine, of_doc = s[hit[able]], doc[able]
                low, high = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                for j in np.flatnonzero(high > low):
                    out[int(of_doc[j])].update(item[low[j] : high[j]].tolist())
        return out

    def found(self, text: bytes, items: set[int]) -> Iterator[tuple[int, int]]:
        """(item, its shingles that stand in the text) of those that reach the threshold; the text's words are in lower case."""
        w = text.split()
        held: dict[int, set[bytes]] = {}
        for i in sorted(items):
            size = self.shingles[i][0].count(b" ") + 1
            if size not in held:
                held[size] = {b" ".join(x) for x in zip(*(w[j:] for j in range(size)), strict=False)}
            n = sum(s in held[size] for s in self.shingles[i])
            if n >= self.needed(len(self.shingles[i])):
                yield i, n


def _blocks(items: DataFrame, k: int, num: int, den: int) -> Iterator[Items]:
    """All items, in blocks that each fit a broadcast."""
    rows, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(-(-rows // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Items([tuple(r) for r in mine.collect()], k, num, den)


def contained(docs: DataFrame, items: DataFrame, k: int = SHINGLE, num: int = 4, den: int = 5, keep: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> doc_id, item_id, n_shingles, n_found for each containment of at least num / den.

    Words are lower-cased (A-Z). An item of fewer than k words is one shingle of all of them; null or empty items match
    nothing, and null or empty documents hold nothing. Equal rows each give their matches; a null id stays null.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = base_columns(items, item_id="item_id", text="text")
    docs = base_columns(docs, doc_id="doc_id", text="text")
    schema = "doc_id long, item_id long, n_shingles long, n_found long"
    found = None
    for block in _blocks(items, k, num, den):
        held = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            known = held.value
            for b in batches:
                raw, off = utf8(b.column(1))
                rows = []
                for doc, hits in sorted(known.candidates(LOWER[raw], off).items()):
                    for i, n in known.found(raw[off[doc] : off[doc + 1]].tobytes().lower(), hits):
                        rows.append((doc, known.ids[i], len(known.shingles[i]), n))
                if rows:
                    doc, *rest = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in rest)], ["doc_id", "item_id", "n_shingles", "n_found"])

        part = docs.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.where("false").select("doc_id", *(F.lit(0).cast("long").alias(c) for c in ("item_id", "n_shingles", "n_found")))


def flagged(docs: DataFrame, items: DataFrame, k: int = SHINGLE, num: int = 4, den: int = 5, name: str = "contaminated") -> DataFrame:
    """All columns of docs, and (boolean, under a name that docs must not have) whether some item is contained. No shuffle; ids
    play no part."""
    spark = docs.sparkSession
    small_batches(spark)
    items = base_columns(items, item_id="item_id", text="text")
    out = docs.withColumn(name, F.lit(False))
    at = out.columns.index("text")
    for block in _blocks(items, k, num, den):
        held = spark.sparkContext.broadcast(block)

        def mark(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            known = held.value
            for b in batches:
                raw, off = utf8(b.column(at))
                bad = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).copy()
                for doc, hits in known.candidates(LOWER[raw], off).items():
                    if not bad[doc]:
                        bad[doc] = next(known.found(raw[off[doc] : off[doc + 1]].tobytes().lower(), hits), None) is not None
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(bad)], schema=b.schema)

        out = out.mapInArrow(mark, out.schema)
    return out


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, least(5, len(w)) AS k, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
ks AS (SELECT DISTINCT k FROM bs),
ds AS (SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN bs USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(n_found AS BIGINT) AS n_found
FROM m JOIN n USING (item_id) WHERE n_found * 5 >= n_shingles * 4
"""
