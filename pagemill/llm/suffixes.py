"""Exact removal of repeated byte strings by a distributed merge sort of suffixes.

A string of LENGTH bytes that starts anywhere else goes, with all bytes it covers. Sorting every suffix of the corpus would
move each byte LENGTH times; instead the suffixes sorted are those that start at anchors. The anchor of a window of LENGTH
bytes is the place of its least GRAM-byte hash (the leftmost if tied). Equal windows have their anchors at equal places, so
they meet under the anchor's hash, and what is sorted there decides about every window.

1. Each task finds the anchors of its texts, with the span of the windows that share an anchor: the context. Contexts equal
   within the task are settled there (all their windows repeat), and one of them goes on; so a passage that a third of all
   documents hold crosses the network once for each task.
2. By anchor hash, what occurs once is dropped, and contexts that occur again as a whole are settled.
3. What is left has partners that agree only in part: at the borders of repeats. Each task sorts the suffixes at these anchors
   into runs, front-codes them, and exchanges them. A loser tree over the runs that keeps the length of the prefix shared
   with the last output merges them: no known prefix is ever compared again, and the shared lengths (LCP) fall out.
4. In the merged order, the anchors whose suffixes share r bytes stand side by side; a window with j bytes before its anchor
   repeats if another of those with r >= LENGTH - j has the same j bytes before.

Where contexts are settled as a whole, two hashes of different kinds, 64 bits each, have to agree: a polynomial one of the
anchor's gram, and XXH3 of the context with the anchor's place in it.

A document's key is a 96-bit hash of id and text; equal rows share it, and are copies of each other.
"""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import base_columns, byte_texts, cut, mixed, prefix_hash, small_batches, table, utf8

LENGTH, GRAM = 200, 32
#: Grams in a window.
SPAN = LENGTH - GRAM + 1
#: Anchors that a task gathers before it settles them, and bytes of contexts before it sorts a run.
GATHERED, RUN_BYTES = 1_000_000, 32 << 20
LOW = np.uint64((1 << 34) - 1)


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.uint64(0xFFFFFFFFFFFFFFFF))
    rows = np.concatenate([x, pad]).reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


def anchors(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, anchor, first window, last window, anchor hash, context hash) of the texts of a batch; places are the batch's."""
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if len(raw) < LENGTH:
        return none
    total, inverse = prefix_hash(raw)
    n = len(raw) - GRAM + 1
    gram = mixed((total[GRAM:] - total[:n]) * inverse[:n])
    packed = gram & ~LOW | np.arange(n, dtype=np.uint64)
    at = (_least(packed, SPAN) & LOW).astype(np.int64)
    # windows that lie in one text
    size = np.diff(off)
    valid = np.maximum(size - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(size)), valid)
    if not len(text):
        return none
    start = np.arange(len(text)) - np.repeat(np.cumsum(valid) - valid, valid) + off[:-1][text]
    at = at[start]
    edge = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
    first, last = start[edge], start[np.append(edge[1:], len(start)) - 1]
    a, text = at[edge], text[edge]
    stop = last + LENGTH
    data, digest = memoryview(np.ascontiguousarray(raw)), xxhash.xxh3_64_intdigest
    whole = np.fromiter((digest(data[i:j]) for i, j in zip(first.tolist(), stop.tolist(), strict=True)), np.uint64, len(first))
    context = mixed(whole ^ mixed((a - first).astype(np.uint64) << np.uint64(32) | (stop - first).astype(np.uint64)))
    return text, a, first, last, gram[a], context


#: kind 0: a span (x, y) of a document; 1: an anchor that goes on alone; 2: one whose copies in its task are settled.
SCHEMA = "g long, c long, k1 long, k2 int, kind int, x long, y long"
NAMES = ["g", "c", "k1", "k2", "kind", "x", "y"]


def _pack(a: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """An anchor's place with its windows, relative: place << 16 | bytes before << 8 | windows after the first."""
    return a << 16 | (a - first) << 8 | (last - first)


def _unpack(x):
    a = x >> 16
    first = a - (x >> 8 & 255)
    return a, first, first + (x & 255)


def _rows(g, c, k1, k2, kind, x, y) -> pa.RecordBatch:
    i64 = lambda v: pa.array(np.asarray(v).astype(np.int64))
    return pa.RecordBatch.from_arrays([i64(g), i64(c), i64(k1), pa.array(np.asarray(k2).astype(np.int32)), pa.array(np.asarray(kind).astype(np.int32)), i64(x), i64(y)], NAMES)


def _merged_spans(k1, k2, x, y) -> tuple[np.ndarray, ...]:
    """Overlapping spans of a document as one."""
    if not len(k1):
        return k1, k2, x, y
    order = np.lexsort((x, k2, k1))
    k1, k2, x, y = k1[order], k2[order], x[order], y[order]
    new = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
    group = np.cumsum(new) - 1
    # running ends within a document: offsets make documents disjoint
    wide = int(y.max()) + 1
    reach = np.maximum.accumulate(y + group * wide) - group * wide
    fresh = new | np.append(True, x[1:] > reach[:-1])
    at = np.flatnonzero(fresh)
    return k1[at], k2[at], x[at], np.maximum.reduceat(y, at)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k1, k2, text -> SCHEMA."""
    held: list[tuple[np.ndarray, ...]] = []

    def settle() -> Iterator[pa.RecordBatch]:
        k1, k2, p, g, c = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        if not len(g):
            return
        order = np.lexsort((c, g))
        k1, k2, p, g, c = (x[order] for x in (k1, k2, p, g, c))
        edge = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])))
        n = np.diff(np.append(edge, len(g)))
        many = np.repeat(n > 1, n)
        _, first, last = _unpack(p[many])
        s1, s2, x, y = _merged_spans(k1[many], k2[many], first, last + LENGTH)
        if len(x):
            yield _rows(s1, s1, s1, s2, np.zeros(len(x)), x, y)
        for i in range(0, len(edge), 100_000):
            j = edge[i : i + 100_000]
            yield _rows(g[j], c[j], k1[j], k2[j], 1 + (n[i : i + 100_000] > 1), p[j], np.zeros(len(j)))

    for b in batches:
        raw, off = utf8(b.column(2))
        text, a, first, last, g, c = anchors(raw, off)
        base = off[:-1][text]
        k1, k2 = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64)[text] for i in (0, 1))
        held.append((k1, k2, _pack(a - base, first - base, last - base), g.view(np.int64), c.view(np.int64)))
        if sum(len(x[0]) for x in held) > GATHERED:
            yield from settle()
    if held:
        yield from settle()


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by g, c -> spans (kind 0), and anchors to look at closer (kind 3: undecided, 4: settled, as a partner)."""

    def decide(r: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        spans = r[4] == 0
        if spans.any():
            s = [x[spans] for x in r]
            yield _rows(*s)
        g, c, k1, k2, kind, x, _ = (v[~spans] for v in r)
        if not len(g):
            return
        edge = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])))
        n = np.diff(np.append(edge, len(g)))
        times = np.add.reduceat(kind, edge)
        group = g[edge]
        top = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        variants = np.repeat(np.diff(np.append(top, len(group))), np.diff(np.append(top, len(group))))
        again = np.repeat(times > 1, n) & (kind == 1)
        if again.any():
            _, first, last = _unpack(x[again])
            yield _rows(k1[again], k1[again], k1[again], k2[again], np.zeros(again.sum()), first, last + LENGTH)
        j = edge[variants > 1]
        if len(j):
            yield _rows(g[j], c[j], k1[j], k2[j], 3 + (times[variants > 1] > 1), x[j], g[j])

    # batches of one anchor hash are put together once it ends, whatever their number
    held: list[list[np.ndarray]] = []
    for b in batches:
        now = [b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(7)]
        if not len(now[0]):
            continue
        cut_at = int(np.searchsorted(now[0], now[0][-1]))
        if not cut_at and held and held[-1][0][-1] != now[0][0]:
            yield from decide([np.concatenate(v) for v in zip(*held, strict=True)])
            held = []
        if cut_at:
            yield from decide([np.concatenate(v) for v in zip(*held, [v[:cut_at] for v in now], strict=True)])
            held = []
        held.append([v[cut_at:] for v in now])
    if held:
        yield from decide([np.concatenate(v) for v in zip(*held, strict=True)])


_HEAD = struct.Struct(">HHBqiqB")


def front_coded(run: list[tuple[bytes, bytes, int, int, int, int]]) -> bytes:
    """A sorted run, each key without the prefix it shares with the one before."""
    out, before = [], b""
    for key, left, k1, k2, a, open_ in run:
        n = shared(before, key, 0)
        out += (_HEAD.pack(n, len(key) - n, len(left), k1, k2, a, open_), key[n:], left)
        before = key
    return b"".join(out)


def entries(block: bytes) -> Iterator[tuple[int, bytes, tuple]]:
    """(prefix shared with the one before, key, the rest) of a front-coded run."""
    at, before = 0, b""
    while at < len(block):
        n, size, left, k1, k2, a, open_ = _HEAD.unpack_from(block, at)
        at += _HEAD.size
        key = before[:n] + block[at : at + size]
        at += size
        yield n, key, (block[at : at + left], k1, k2, a, open_)
        at += left
        before = key


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes are."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def loser_merge(runs: list[Iterator[tuple[int, bytes, tuple]]]) -> Iterator[tuple[int, bytes, tuple]]:
    """The runs merged, each key with the length of the prefix it shares with the one before it.

    Each inner node holds the loser of its game, with the prefix it shares with the winner. All losers on the path of the
    last output lost to it, so their lengths are relative to it, as is the length that the run's front code gives its next
    key: of two players, the one that shares more with the last output comes first, and only if both share as much are their
    bytes compared, from there on.
    """
    width = 1
    while width < len(runs):
        width *= 2
    key: list[bytes | None] = [None] * width
    have: list[int] = [0] * width
    rest: list[tuple] = [()] * width

    def load(i: int, known: bool) -> None:
        if i < len(runs) and (e := next(runs[i], None)) is not None:
            have[i], key[i], rest[i] = e[0] if known else 0, e[1], e[2]
        else:
            key[i] = None

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser)."""
        if key[j] is None:
            return i, j
        if key[i] is None:
            return j, i
        if have[i] != have[j]:
            return (i, j) if have[i] > have[j] else (j, i)
        a, b = key[i], key[j]
        n = shared(a, b, have[i])
        if n == len(a) or (n < len(b) and a[n] < b[n]):
            have[j] = n
            return i, j
        have[i] = n
        return j, i

    loser = [0] * (2 * width)
    winner = [0] * (2 * width)
    for i in range(width):
        load(i, known=False)
        winner[width + i] = i
    for i in range(width - 1, 0, -1):
        winner[i], loser[i] = play(winner[2 * i], winner[2 * i + 1])
    top = winner[1]
    while key[top] is not None:
        yield have[top], key[top], rest[top]
        load(top, known=True)
        node, now = (width + top) // 2, top
        while node:
            now, loser[node] = play(now, loser[node])
            node //= 2
        top = now


def _runs(parts: int):
    """k1, k2, text, wanted (place with windows, anchor hash, whether undecided) -> (part, front-coded run)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = defaultdict(list)
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for part, found in held.items():
                found.sort()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([front_coded(found)], pa.binary())], ["part", "run"])
            held.clear()

        for b in batches:
            for k1, k2, text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), byte_texts(b.column(2)), b.column(3).to_pylist(), strict=True):
                for w in wanted:
                    a, first, last = _unpack(w["x"])
                    key = struct.pack(">Q", w["y"] & 0xFFFFFFFFFFFFFFFF) + text[a : last + LENGTH]
                    held[(w["y"] >> 8) % parts].append((key, text[first:a], k1, k2, a, int(w["kind"] == 3)))
                    size += len(key) + a - first + 60
                if size > RUN_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def repeats(group: list[tuple[int, bytes, tuple]]) -> Iterator[tuple[int, int, int, int]]:
    """(k1, k2, start, end) of the windows of a group of one anchor hash, in merged order, that stand in another member too."""
    n = len(group)
    right = [len(key) - 8 for _, key, _ in group]
    near = [max(group[i][0] if i else 0, group[i + 1][0] if i + 1 < n else 0) - 8 for i in range(n)]
    lowest = [max(LENGTH - right[i], LENGTH - near[i], 0) for i in range(n)]
    top = max((len(rest[0]) for _, _, rest in group), default=0)
    found: dict[int, list[int]] = defaultdict(list)
    for j in range(min(lowest), top + 1):
        seen: dict[tuple[int, bytes], list[int]] = defaultdict(list)
        side = 0
        for i, (lcp, _, (left, *_)) in enumerate(group):
            if lcp - 8 < LENGTH - j:
                side += 1
            if lowest[i] <= j <= len(left):
                seen[side, left[len(left) - j :]].append(i)
        for members in seen.values():
            if len(members) > 1:
                for i in members:
                    found[i].append(j)
    for i, js in found.items():
        _, k1, k2, a, open_ = group[i][2]
        if open_:
            # windows side by side as one span
            js.sort(reverse=True)
            start, end = a - js[0], a - js[0] + LENGTH
            for j in js[1:]:
                if a - j > end:
                    yield k1, k2, start, end
                    start = a - j
                end = a - j + LENGTH
            yield k1, k2, start, end


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, list[bytes]] = defaultdict(list)
    for b in batches:
        for part, run in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            blocks[part].append(run)
    for part in sorted(blocks):
        out: list[tuple[int, int, int, int]] = []
        group: list[tuple[int, bytes, tuple]] = []
        for e in loser_merge([entries(x) for x in blocks.pop(part)]):
            if group and e[0] < 8:
                if len(group) > 1:
                    out += repeats(group)
                group = []
            group.append(e)
        if len(group) > 1:
            out += repeats(group)
        if out:
            k1, k2, x, y = (np.array(v, np.int64) for v in zip(*out, strict=True))
            yield _rows(k1, k1, k1, k2, np.zeros(len(x)), x, y)


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, spans -> OUT."""
    for b in batches:
        rows = []
        for text, spans in zip(byte_texts(b.column(1)), b.column(2).to_pylist(), strict=True):
            at, kept, n = 0, [], 0
            end = -1
            for s in sorted((s["x"], s["y"]) for s in spans or ()):
                if s[0] > end:
                    if end >= 0:
                        kept.append(text[at:start])
                        at, n = end, n + 1
                    start, end = s
                else:
                    end = max(end, s[1])
            if end >= 0:
                kept.append(text[at:start])
                at, n = end, n + 1
            kept.append(text[at:])
            left = b"".join(kept)
            rows.append((len(text), len(text) - len(left), n, hashlib.sha256(left).hexdigest()))
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], [x.split()[0] for x in OUT.split(", ")])


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256; a row for each row.

    A null text is empty; texts under 200 bytes lose nothing; equal rows are copies of each other, null ids or not.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce("text", F.lit(""))
    docs = base_columns(docs, k1=F.xxhash64("doc_id", text), k2=F.hash(text, F.col("doc_id")), doc_id=F.col("doc_id").cast("long"), text=text)
    found = docs.select("k1", "k2", "text").mapInArrow(_find, SCHEMA)
    settled = cut(found.repartition(parts, "g").sortWithinPartitions("g", "c").mapInArrow(_match, SCHEMA))
    # one exchange of texts serves both joins, as long as both take the same columns of it in one plan
    dealt = docs.repartition(parts, "k1", "k2")
    closer = settled.where("kind > 2").groupBy("k1", "k2").agg(F.collect_list(F.struct("x", "y", "kind")).alias("wanted"))
    runs = dealt.join(closer.hint("merge"), ["k1", "k2"]).select("k1", "k2", "text", "wanted", "doc_id").mapInArrow(_runs(parts * 4), "part int, run binary")
    partial = runs.repartition(parts, "part").mapInArrow(_merge, SCHEMA)
    spans = settled.where("kind = 0").unionByName(partial).groupBy("k1", "k2").agg(F.collect_list(F.struct("x", "y")).alias("spans"))
    return dealt.join(spans.hint("merge"), ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(_remove, OUT)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))
