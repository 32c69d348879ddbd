"""SimHash near-duplicates by anchor-point covering.

A 64-bit fingerprint is cut into two halves; two fingerprints that differ in at most t bits differ in at most t // 2 bits
in one half. For each half, the words of a covering code are the anchors: the direct sum of the perfect binary Golay code
(23 bits, radius 3), the perfect Hamming code (7 bits, radius 1) and two free bits (radius 0), 2**18 anchors. Each
fingerprint has one home anchor, within the radius. Of two fingerprints that are near, each lies within radius plus threshold
of the other's home, so they would meet at both homes; once is enough. A fingerprint is sent home and to those anchors within
radius plus threshold whose number is above its home's, so the one of lower home meets the other there. Fingerprints are
compared per anchor, homes against visitors and among themselves.

Equal fingerprints are one point from the start, so copies cost nothing. An anchor with very many points is dealt over
tasks as blocks of homes by blocks of visitors. A task returns a spanning forest of the links it finds, never all pairs.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import base_columns, byte_texts, cut, maybe_among, small_batches, table
from pagemill.llm.graph import components

SEED = 42
#: Generator of the binary Golay code, and the parity checks of the Hamming code of length 7.
GOLAY = 0b101011100011
#: An anchor with more homes or visitors than these is dealt over tasks.
HOMES, VISITORS = 2048, 16384
#: Blocks of one anchor stay below 2**BLOCK_BITS.
BLOCK_BITS = 26


def fingerprint(text: bytes, k: int) -> int:
    """Of the k-word shingles of a text, repeats included: bit i is 1 if set in over half of their XXH64."""
    w = text.lower().split()
    if not w:
        return 0
    if len(w) <= k:
        return xxhash.xxh64_intdigest(b" ".join(w), SEED)
    digest, join = xxhash.xxh64_digest, b" ".join
    h = b"".join([digest(join(x), SEED) for x in zip(*(w[i:] for i in range(k)), strict=False)])
    n, counts = len(h) // 8, np.zeros(64, np.int64)
    rows = np.frombuffer(h, np.uint8).reshape(n, 8)
    for i in range(0, n, 1 << 15):
        counts += np.unpackbits(rows[i : i + (1 << 15)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 3, text: str = "text") -> DataFrame:
    """Adds fp (long, the fingerprint as signed) to docs, in place of the text column."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != text]
    schema = docs.select(*others).withColumn("fp", F.lit(0).cast("long")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x, k) for x in byte_texts(b.column(b.schema.get_field_index(text)))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in others] + [pa.array(fp.view(np.int64))], [*others, "fp"])

    return docs.mapInArrow(add, schema)


def _golay_syndromes(x: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator."""
    x = x.astype(np.int64).copy()
    for i in range(22, 10, -1):
        x ^= np.where(x >> i & 1, GOLAY << (i - 11), 0)
    return x


def _hamming_syndromes(x: np.ndarray) -> np.ndarray:
    out = np.zeros(x.shape, np.int64)
    for i in range(7):
        out ^= np.where(x >> i & 1, i + 1, 0)
    return out


def _patterns(bits: int, radius: int, excess: int, syndromes, size: int) -> list[np.ndarray]:
    """For each e from 0 to excess, a table: by syndrome, the differences to code words at a distance of radius + e (for
    e = 0, of at most the radius), filled up with -1."""
    out = []
    for e in range(excess + 1):
        weights = range(radius + 1) if e == 0 else (radius + e,)
        all_ = np.array([sum(1 << i for i in c) for w in weights for c in itertools.combinations(range(bits), w)], np.int64)
        s = syndromes(all_)
        order = np.argsort(s, kind="stable")
        s, all_ = s[order], all_[order]
        rank = np.arange(len(s)) - np.searchsorted(s, s)
        t = np.full((size, rank.max() + 1 if len(s) else 1), -1, np.int64)
        t[s, rank] = all_
        out.append(t)
    return out


class Covering:
    """The anchors of one half; slack: by how many bits two points may differ in it."""

    def __init__(self, slack: int):
        self.slack = slack
        self.golay = _patterns(23, 3, slack, _golay_syndromes, 2048)
        self.hamming = _patterns(7, 1, slack, _hamming_syndromes, 8)
        self.free = [np.array([[sum(1 << i for i in c) for c in itertools.combinations(range(2), w)] or [-1]], np.int64) for w in range(slack + 1)]

    def anchors(self, half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the point, anchor, whether home) for all points, given as 32-bit numbers."""
        g, h, u = half >> 9, half >> 2 & 127, half & 3
        sg, sh = _golay_syndromes(g), _hamming_syndromes(h)
        found = []
        for eg, eh, eu in itertools.product(range(self.slack + 1), repeat=3):
            if eg + eh + eu > self.slack or eu > 2:
                continue
            pg, ph, pu = self.golay[eg][sg], self.hamming[eh][sh], np.broadcast_to(self.free[eu], (len(half), self.free[eu].shape[1]))
            ok = (pg >= 0)[:, :, None, None] & (ph >= 0)[:, None, :, None] & (pu >= 0)[:, None, None, :]
            i, a, b, c = np.nonzero(ok)
            anchor = (g[i] ^ pg[i, a]) << 9 | (h[i] ^ ph[i, b]) << 2 | (u[i] ^ pu[i, c])
            found.append((i, anchor, np.full(len(i), eg + eh + eu == 0)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _replicate(threshold: int):
    cover = Covering(threshold // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            family, fp = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            for half in (0, 1):
                part = fp.view(np.uint64) >> np.uint64(32) if half else fp.view(np.uint64) & np.uint64(0xFFFFFFFF)
                i, anchor, home = cover.anchors(part.astype(np.int64))
                own = np.empty(len(fp), np.int64)
                own[i[home]] = anchor[home]
                once = home | (anchor > own[i])  # the other direction would find the same pairs again
                i, anchor, home = i[once], anchor[once], home[once]
                key = (anchor | half << 32 | family[i] << 33) << 1 | ~home
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[i])], ["key", "fp"])

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the links a[i] - b[i], enough to keep together what they join."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    u, v = [], []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            u.append(x)
            v.append(y)
    return u, v


def _dense(homes: np.ndarray, guests: np.ndarray, threshold: int) -> tuple[list[int], list[int]]:
    """Spanning links between many homes and visitors: one vector comparison for each home, joined as they come."""
    label = np.arange(len(homes) + len(guests))
    u, v = [], []
    for i, x in enumerate(homes):
        near = np.flatnonzero(np.bitwise_count(guests ^ x) <= threshold)
        if len(near):
            roots, first = np.unique(label[near + len(homes)], return_index=True)
            new = roots != label[i]
            if new.any():
                for j in near[first[new]]:
                    if guests[j] != x:
                        u.append(int(x.astype(np.int64)))
                        v.append(int(guests[j].astype(np.int64)))
                least = min(roots.min(), label[i])
                label[np.isin(label, np.append(roots, label[i]))] = least
    return u, v


def _compare(threshold: int):
    """Rows (key, fp) or (key, fp, block), sorted by anchor, block, visitors after homes -> spanning links. Homes visit too."""

    def links(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> tuple[list[int], list[int], list[int]]:
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        family = key[edge] >> (33 + BLOCK_BITS)
        n = np.diff(np.append(edge, len(key)))
        homes = np.add.reduceat(home.astype(np.int64), edge)
        pairs, f, u, v = np.where(n > 1, homes * n, 0), [], [], []
        small = np.flatnonzero((pairs > 0) & (pairs <= 4096))
        for part in np.array_split(small, max(1, int(pairs[small].sum()) >> 20)):
            # all homes of a small group against all its visitors, many groups at a time
            total = pairs[part]
            of = np.repeat(np.arange(len(part)), total)
            at = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
            guests = n[part][of]
            x, y = fp[edge[part][of] + at // guests], fp[edge[part][of] + at % guests]
            near = (x != y) & (np.bitwise_count(x ^ y) <= threshold)
            near = np.flatnonzero(near)
            kind = family[part][of[near]]
            for g in np.unique(kind):
                own = near[kind == g]
                p, q = _forest(x[own].view(np.int64), y[own].view(np.int64))
                u += p
                v += q
                f += [int(g)] * len(p)
        for k in np.flatnonzero(pairs > 4096):
            s, m = edge[k], edge[k] + homes[k]
            p, q = _dense(fp[s:m], fp[s : s + n[k]], threshold)
            u += p
            v += q
            f += [int(family[k])] * len(p)
        return f, u, v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                key, fp = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                block = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64) if b.num_columns > 2 else 0
                now = [(key >> 1 << BLOCK_BITS) | block, fp.view(np.uint64), (key & 1) == 0]
                rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
            if rest is None or not len(rest[1]):
                continue
            pair = rest[0]
            # the last group may go on in the next batch
            cutoff = len(pair) if b is None else int(np.flatnonzero(pair != pair[-1])[-1] + 1) if (pair != pair[-1]).any() else 0
            if cutoff:
                found = links(pair[:cutoff], rest[1][:cutoff], rest[2][:cutoff])
                rest = [x[cutoff:] for x in rest]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["family", "u", "v"])

    return run


def near_links(points: DataFrame, threshold: int = 3) -> DataFrame:
    """points (family long < 16, fp long, distinct) -> (family, u, v): links of at most `threshold` differing bits, within a
    family, that join all that is linked."""
    spark = points.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    sent = points.select(F.col("family").cast("long"), "fp").mapInArrow(_replicate(threshold), "key long, fp long")
    anchor, home = F.shiftright("key", 1), F.col("key") % 2 == 0
    crowd = sent.groupBy(anchor.alias("anchor")).agg(F.sum(home.cast("long")).alias("h"), F.count("*").alias("c"))
    # at most a 1/2048 part of the points: anchors whose work is dealt over blocks of homes by blocks of visitors
    crowd = cut(crowd.where((F.col("h") > 0) & ((F.col("h") > HOMES) | (F.col("c") > VISITORS))).select("anchor", F.ceil(F.col("h") / HOMES).cast("int").alias("nh"), F.ceil(F.col("c") / VISITORS).cast("int").alias("nv")))
    crowds = crowd.count()
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    if not crowds:  # two numbers a row cross the network
        dealt = sent.repartition(n, anchor).sortWithinPartitions("key", "fp")
        return dealt.mapInArrow(_compare(threshold), "family long, u long, v long")
    sent = sent.join(F.broadcast(crowd) if crowds <= 100_000 else crowd, anchor == F.col("anchor"), "left").select("key", "fp", "nh", "nv")
    nh, nv = F.coalesce("nh", F.lit(1)), F.coalesce("nv", F.lit(1))
    spread = F.xxhash64("fp")
    mine = F.when(home, F.transform(F.sequence(F.lit(0), nv - 1), lambda j: F.pmod(spread, nh).cast("int") * nv + j))
    blocks = mine.otherwise(F.transform(F.sequence(F.lit(0), nh - 1), lambda i: i * nv + F.pmod(spread, nv).cast("int")))
    # homes of one block meet those of another as visitors
    visits = sent.where(home & F.col("nh").isNotNull()).withColumn("key", F.col("key") + 1)
    dealt = sent.unionByName(visits).select("key", "fp", F.explode(blocks).alias("block"))
    dealt = dealt.repartition(n, anchor, "block").sortWithinPartitions(anchor, "block", "key", "fp")
    return dealt.mapInArrow(_compare(threshold), "family long, u long, v long")


def near_components(points: DataFrame, threshold: int = 3) -> DataFrame:
    """points (fp long, distinct) -> (node, root) of the fingerprints that have a link."""
    return components(near_links(points.withColumn("family", F.lit(0)), threshold))


def simhash_classes(docs: DataFrame, k: int = 3, threshold: int = 3) -> DataFrame:
    """docs (doc_id, text) -> doc_id, fp, component_id, one row for each input row.

    A null or empty text has the fingerprint zero and links like any other. A null id takes part, but the smallest id of a
    component is taken over the others (null if there are none). Empty input gives no rows.
    """
    fps = cut(fingerprints(base_columns(docs, doc_id="doc_id", text="text"), k))
    points = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    label = near_components(points, threshold)
    rooted = points.join(label, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = cut(rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("point"), "component_id"))
    return fps.join(known, F.col("fp") == F.col("point")).select("doc_id", "fp", "component_id")


#: Of the near-duplicate stage: fingerprints for each text, words of a shingle.
FAMILIES, SHINGLE = 8, 5
#: Counters of shingles, and of these a block that crosses the network at once.
COUNT_BITS, BLOCK = 23, 1 << 13
#: Texts that one copy of another text's shingles is compared with.
COMPARED = 64
#: Members of one group that one copy of the group's verdict serves.
SPREAD = 16


def shingles(text: bytes) -> set[int]:
    """Hashes of a text's 5-word shingles (of the whole sequence, if it has fewer words)."""
    w = text.lower().split()
    if not w:
        return set()
    k = min(SHINGLE, len(w))
    return {xxhash.xxh64_intdigest(b" ".join(x), SEED) for x in zip(*(w[i:] for i in range(k)), strict=False)}


def similar(x: set[int], y: set[int]) -> bool:
    """Whether two sets have a Jaccard similarity of 0.8 or more; empty sets are equal."""
    shared = len(x & y)
    return 5 * shared >= 4 * (len(x) + len(y) - shared)


def signature(text: bytes, common: Counts | np.ndarray) -> tuple[list[int], list[int], int]:
    """Several independent fingerprints of a text's distinct words; of its 5-word shingles, the first in the order of `ranked`,
    and how many there are.

    An edited word changes one distinct word but five shingles, so the words' fingerprints stay near where the shingles'
    would not; a few families make it unlikely that a near copy is near in none.
    """
    w = text.lower().split()
    if not w:
        return [0] * FAMILIES, [], 0
    once = sorted(set(w))
    bits = np.frombuffer(b"".join([xxhash.xxh3_128_digest(x, s) for x in once for s in range(FAMILIES // 2)]), np.uint8).reshape(len(once), -1)
    counts = np.zeros(64 * FAMILIES, np.int64)
    for i in range(0, len(once), 1 << 12):
        counts += np.unpackbits(bits[i : i + (1 << 12)], axis=1).sum(0, dtype=np.int64)
    fps = np.packbits(2 * counts > len(once)).view(">i8").astype(np.int64)
    h = shingles(text)
    return fps.tolist(), ranked(h, common).view(np.int64).tolist(), len(h)


class Counts:
    """How common shingles are: the counts of all shingles of all texts by 2 ** COUNT_BITS ranges of their hashes, 16 MB at any
    corpus size. They set an order only; shingles of one range count as one, so more of them only blur it."""

    def __init__(self, total: np.ndarray):
        self.total = np.minimum(total, np.iinfo(np.uint16).max).astype(np.uint16)

    @staticmethod
    def ranges(a: np.ndarray) -> np.ndarray:
        return (a >> np.uint64(64 - COUNT_BITS)).astype(np.int64)

    def of(self, a: np.ndarray) -> np.ndarray:
        return self.total[self.ranges(a)]


def ranked(h: set[int], common: Counts | np.ndarray) -> np.ndarray:
    """Of a set of n shingles the first n - ceil(0.8 n) + 1, in one order of all shingles: the rarest first by counts, or the
    common ones (sorted) last.

    Sets of a similarity of 0.8 or more share at least 0.8 of the larger one, so they share one of these, in whatever order.
    """
    a = np.sort(np.fromiter(h, np.uint64, len(h)))
    late = common.of(a) if isinstance(common, Counts) else np.isin(a, common)
    a = a[np.argsort(late, kind="stable")]
    return a[: len(a) - (4 * len(a) + 4) // 5 + 1 if len(a) else 0]


def counted(texts: DataFrame) -> Counts:
    """The counts over every row of texts (text). A task sends its counters in packed blocks, a few MB however much it reads."""
    size = 1 << COUNT_BITS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, many = np.zeros(size, np.uint32), [], 0
        for b in itertools.chain(batches, [None]):
            for text in byte_texts(b.column(0)) if b is not None else ():
                h = shingles(text)
                held.append(Counts.ranges(np.fromiter(h, np.uint64, len(h))))
                many += len(h)
            if held and (b is None or many >= 1 << 19):
                at, n = np.unique(np.concatenate(held), return_counts=True)
                total[at] += n.astype(np.uint32)
                held, many = [], 0
        for i in np.flatnonzero(total.reshape(-1, BLOCK).any(1)):
            part = total[i * BLOCK : (i + 1) * BLOCK]
            packed = zlib.compress((part.astype(np.uint8) if part.max() < 256 else part).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([packed], pa.binary())], ["block", "counts"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for i, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = zlib.decompress(packed)
                part = np.frombuffer(raw, np.uint8 if len(raw) == BLOCK else np.uint32)
                found.setdefault(i, np.zeros(BLOCK, np.int64))[:] += part
        for i, x in found.items():
            packed = zlib.compress(np.minimum(x, np.iinfo(np.uint16).max).astype(np.uint16).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([packed], pa.binary())], ["block", "counts"])

    n = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    blocks = texts.select("text").mapInArrow(each, "block long, counts binary").repartition(n, "block").mapInArrow(sums, "block long, counts binary")
    total = np.zeros(size, np.uint16)
    for r in blocks.collect():
        total[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(r.counts), np.uint16)
    return Counts(total)


def can_be_similar(n, p, m, q):
    """Whether sets of n and m shingles may have a similarity of 0.8 if the first one they share is at place p of one and q of
    the other: they share 4/9 of n + m at least, and no more than stand from there on. Columns or arrays."""
    return (9 * (n - p) >= 4 * (n + m)) & (9 * (m - q) >= 4 * (n + m))


def _starts(signed: DataFrame) -> DataFrame:
    """signed (t, size, prefix), a row for each document -> (h, t, size, place): the first shingles of all different texts, of
    those that more than one text has."""
    each = signed.select("t", F.explode("prefix").alias("h"))
    shared = cut(each.groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("h"))
    rows = signed.select("t", "size", F.posexplode("prefix").alias("place", "h"))
    rows = maybe_among(rows, F.col("h"), shared, "asked").where("asked").groupBy("h", "t").agg(F.min("size").alias("size"), F.min("place").alias("place"))
    return cut(rows.join(shared, "h", "left_semi"))


def _stars(starts: DataFrame) -> DataFrame:
    """Pairs (u, v) that can be similar, u the text of a shingle's group in which the shingle comes first: the one with the
    fewest shingles of its own. As many as there are rows, at most."""
    lead = starts.groupBy("h").agg(F.min(F.struct("place", "size", "t")).alias("x"))
    both = starts.join(lead, "h").where((F.col("t") != F.col("x.t")) & can_be_similar(F.col("size"), F.col("place"), F.col("x.size"), F.col("x.place")))
    return both.select(F.col("x.t").alias("u"), F.col("t").alias("v"))


def _most(h: np.ndarray, root: np.ndarray) -> np.ndarray:
    """For each row, the root that stands most often in its group of equal h (groups stand together)."""
    order = np.lexsort((root, h))
    a, b = h[order], root[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    n = np.diff(np.append(first, len(h)))
    run = np.lexsort((n, a[first]))
    last = run[np.append(a[first][run][1:] != a[first][run][:-1], True)]  # the longest run of each group
    known = a[first[last]]
    return b[first[last]][np.searchsorted(known, h)]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, t, root, size, place), sorted by h and size -> pairs of texts of different roots that share h and can be similar."""

    def pairs(h: np.ndarray, t: np.ndarray, root: np.ndarray, size: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
        # of two texts of different roots, one at least is not of the root that most texts of the group have
        most = _most(h, root) == root
        for way in (1, -1):
            i, step = np.flatnonzero(~most), way
            while len(i):
                i = i[(i + step >= 0) & (i + step < len(h))]
                j = i + step
                # sizes ascend
                near = (h[i] == h[j]) & (5 * size[np.minimum(i, j)] >= 4 * size[np.maximum(i, j)])
                i, j = i[near], j[near]
                good = (root[i] != root[j]) & can_be_similar(size[i], place[i], size[j], place[j])
                if way < 0:  # the others have met it on their own way up
                    good &= most[j]
                if good.any():
                    yield pa.RecordBatch.from_arrays([pa.array(t[i[good]]), pa.array(t[j[good]])], ["u", "v"])
                step += way

    rest = None
    for b in itertools.chain(batches, [None]):
        if b is not None:
            now = [b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
            rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
        if rest is None or not len(rest[0]):
            continue
        h = rest[0]
        # the last group may go on in the next batch
        cutoff = len(h) if b is None else int(np.searchsorted(h, h[-1]))
        if cutoff:
            yield from pairs(*(x[:cutoff] for x in rest))
            rest = [x[cutoff:] for x in rest]


def _apart(starts: DataFrame, label: DataFrame) -> DataFrame:
    """starts as of _starts, label (node, root) -> the pairs (u, v) of texts of different groups that can be similar."""
    spark = starts.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    rows = cut(starts.join(label, F.col("t") == F.col("node"), "left").select("h", "t", F.coalesce("root", "t").alias("root"), "size", "place"))
    # shingles whose texts are all in one group by now are done
    open_ = rows.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("h")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = rows.join(open_, "h", "left_semi").select("h", "t", "root", "size", "place").repartition(n, "h").sortWithinPartitions("h", "size", "t")
    return dealt.mapInArrow(_meet, "u long, v long")


def _new(pairs: DataFrame, judged: DataFrame | None = None) -> DataFrame:
    """pairs (u, v) once each, whichever way round, without the judged ones."""
    a, b = F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")
    once = pairs.where("u <> v").groupBy(a, b).agg(F.min("u").alias("u"))
    if judged is not None:
        once = once.join(judged.select(a, b).distinct(), ["a", "b"], "left_anti")
    return cut(once.select("u", F.when(F.col("u") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("v")))


def fewest_shared(n, m, p, q):
    """Of sets of n and m shingles that have a similarity of 0.8, how many their first p and q shingles share at least.

    They share o = ceil(4/9 (n + m)), so n - o of the one are not in the other, m - o of the other not in the one. What the first
    shingles that end earlier in the common order share with the whole other set, they share with its first shingles.
    """
    o = F.ceil(4 * (n + m) / 9)
    return F.least(p - (n - o), q - (m - o))


def _likely(signed: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose first shingles share as many as those of similar texts do; signed (t, size, prefix)."""
    members = cut(pairs.select(F.explode(F.array("u", "v")).alias("k")).distinct())
    asked = maybe_among(signed.select("t", "size", "prefix"), F.col("t"), members, "asked").where("asked").drop("asked")
    known = cut(asked.join(members, F.col("t") == F.col("k"), "left_semi").dropDuplicates(["t"]))
    x = known.select(F.col("t").alias("u"), F.struct("size", "prefix").alias("x"))
    y = known.select(F.col("t").alias("v"), F.struct("size", "prefix").alias("y"))
    both = pairs.join(x, "u").join(y, "v")
    shared = F.size(F.array_intersect("x.prefix", "y.prefix"))
    return cut(both.where(shared >= fewest_shared(F.col("x.size"), F.col("y.size"), F.size("x.prefix"), F.size("y.prefix"))).select("u", "v"))


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) of the keys of texts (k1, text; equal texts have one key) whose whole texts are similar. The shingles of u
    are made once for up to about COMPARED texts v, so a text with very many partners is dealt over tasks."""
    spark = texts.sparkSession
    small_batches(spark)
    members = cut(pairs.select(F.explode(F.array("u", "v")).alias("k")).distinct())
    asked = maybe_among(texts, F.col("k1"), members, "asked").where("asked").select("k1", "text")
    whole = cut(asked.join(members, F.col("k1") == F.col("k"), "left_semi").groupBy("k1").agg(F.min("text").alias("text")))
    blocks = pairs.groupBy("u").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("n"))
    firsts = blocks.join(whole, F.col("u") == F.col("k1")).select("u", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"), F.lit(None).cast("long").alias("v"), "text")
    others = pairs.join(blocks, "u").select("u", F.pmod(F.xxhash64("v"), F.col("n")).cast("int").alias("block"), "v")
    others = others.join(whole, F.col("v") == F.col("k1")).select("u", "block", "v", "text")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = firsts.union(others).repartition(n, "u", "block").sortWithinPartitions("u", "block", F.col("v").asc_nulls_first())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: set[int] = set()
        for b in batches:
            good = []
            for v, text in zip(b.column(1).to_pylist(), byte_texts(b.column(2)), strict=True):
                if v is None:
                    mine = shingles(text)
                good.append(v is not None and similar(mine, shingles(text)))
            yield b.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return cut(dealt.select("u", "v", "text").mapInArrow(verify, "u long, v long"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and any more) without the near copies: of each group the row of least id stays (a null id comes last).

    Texts are near copies if their sets of 5-word shingles have a similarity of 0.8 or more. Equal texts are one from the start.
    Compared are, by their first shingles and then always by the whole texts: those whose fingerprints differ in at most 3 bits in some family, along spanning
    links; then, for each of the first shingles, its texts with the one nearest to its start; then all that share one of the
    first shingles and are not in one group by then, so that no near copy is left uncompared. Of equal rows one stays. Empty and
    null texts are copies of each other. Ties (equal ids, different texts) go to the least hash of the row; other columns are
    carried as they are, whatever their names. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    # the row as one value, so that its names can't clash with those here
    keyed = docs.select(F.struct("*").alias("doc"), "doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(text, "doc_id", F.lit(1)).alias("k2"), F.xxhash64(text).alias("t"))
    common = docs.sparkSession.sparkContext.broadcast(counted(keyed.select("text")))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [signature(x, common.value) for x in byte_texts(b.column(3))]
            lists = [pa.array([x[i] for x in found], pa.list_(pa.int64())) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *lists, pa.array([x[2] for x in found], pa.int64())], ["doc_id", "k", "t", "fps", "prefix", "size"])

    signed = cut(base_columns(keyed, doc_id=F.col("doc_id").cast("long"), k="k1", t="t", text="text").mapInArrow(sign, "doc_id long, k long, t long, fps array<long>, prefix array<long>, size long"))
    texts = keyed.select(F.col("t").alias("k1"), "text")
    each = signed.select("t", "size", F.posexplode("fps").alias("family", "fp"))
    points = cut(each.groupBy("family", "fp").agg(F.min(F.struct("t", "size")).alias("rep")))
    links = near_links(points.select("family", "fp"))
    a = points.select("family", F.col("fp").alias("u"), F.col("rep").alias("a"))
    b = points.select("family", F.col("fp").alias("v"), F.col("rep").alias("b"))
    far = links.join(a, ["family", "u"]).join(b, ["family", "v"]).select("a", "b")
    same = each.groupBy("family", "fp", "t").agg(F.min("size").alias("size")).join(points, ["family", "fp"]).select(F.col("rep").alias("a"), F.struct("t", "size").alias("b"))
    sized = (5 * F.least("a.size", "b.size") >= 4 * F.greatest("a.size", "b.size")) & (F.col("a.t") != F.col("b.t"))
    linked = far.union(same).where(sized).select(F.col("a.t").alias("u"), F.col("b.t").alias("v"))
    starts = _starts(signed)
    # the pairs of both ways are judged together: a text in pairs of both is fetched once
    pairs = _new(linked.union(_stars(starts)))
    label = cut(components(_verified(texts, _likely(signed, pairs))))
    rest = _new(_apart(starts, label), pairs)
    if not rest.isEmpty():
        # from the groups so far, which are stars by now
        more = _verified(texts, _likely(signed, rest))
        label = cut(components(label.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more)))
    ids = signed.groupBy("k", "t").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    rooted = cut(ids.join(label, F.col("t") == F.col("node"), "left").select("k", "doc_id", "n", F.coalesce("root", "t").alias("root")))
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "k")).alias("s"), F.count("*").alias("members"), F.max("n").alias("most"))
    # a group may hold very many rows: its verdict goes to them in as many copies as it needs
    best = best.where("members > 1 OR most > 1").withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    verdict = rooted.withColumn("deal", F.pmod("k", F.lit(SPREAD)).cast("int")).join(best, ["root", "deal"]).select("k", "n", (F.col("k") == F.col("s.k")).alias("stays"))
    verdict = cut(verdict.where("NOT stays OR n > 1"))
    # only texts that may have a verdict cross the network
    asked = maybe_among(keyed.select("doc", "k1", "k2"), F.col("k1"), verdict.select("k"), "asked")
    out = asked.where("asked").join(verdict, F.col("k1") == F.col("k"), "left").where("stays IS NULL OR stays")
    once = asked.where("NOT asked").select("doc").union(out.where("n IS NULL").select("doc"))
    return once.union(out.where("n > 1").dropDuplicates(["k1", "k2"]).select("doc")).select("doc.*")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
