"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(cell | class, history) * P(word | cell). The class is chosen by a softmax over hashed
features of the history: the word before, the word before that (a skip feature), and the pair of their classes. The most
frequent words are classes of their own; the others are classed by their endings, and endings are clustered by the frequent
words they share documents with. Such a class is parted into cells by a hash of the word, and a second softmax chooses the cell
by the class with the word before, and by the class with the word before that. A word's share of its cell is its count plus
one over the cell's.

Words are told apart by 128 bits, and Spark counts them by these. The weights are trained by distributed gradient updates: a
training document belongs to one round and one part, by hashes; the number of parts follows from the number of tokens. Each
part starts from the common weights, and the weights are averaged by the tokens seen, so neither cores nor partitions change a
score. Texts are read as words three times (counts, endings, features); the rounds and the scores read the features, 18 bits
a token.

Counts are looked up in two ways. Words that make up 2**-20 or more of all words are at most 2**20, so their counts are
broadcast; all others meet the count table in a shuffle join, in which no key can be hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import LOWER, base_columns, crc_mod, distinct_keys, mixed, small_batches, table, utf8, word_keys, words, written

#: Words whose counts are broadcast have at least this share of all words.
HEAD = 2.0**-20
#: Classes of single words, classes of endings, hashed endings, hashed rows of each feature, cells of a class.
TOP, CLUSTERS, ENDINGS, ROWS, CELLS = 31, 32, 1024, 4096, 32
CLASSES = TOP + 1 + CLUSTERS
END = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)
START_CLASS = CLASSES
ROUNDS, MINIBATCH, STEP, DAMP = 2, 4096, 2.0, 5.0
#: Training tokens of a part, about.
PART = 1 << 22
#: Rows of the weight table of classes: two hashed words, pairs of classes (the text's start included).
PAIR = 2 * ROWS
WEIGHTS = PAIR + (CLASSES + 1) ** 2
#: Rows of the weight table of cells: two hashed pairs of a word and a class, and the class.
CELL_WEIGHTS = 2 * ROWS + CLASSES
#: Sums over texts are of whole numbers, so that their order plays no role.
UNIT = 1 << 20


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, its second half, ending, text) of all tokens of a batch of texts, each text's end included."""
    raw, off = utf8(column)
    raw = LOWER[raw]
    start, end, of = words(raw, off)
    a, b = word_keys(raw, start, end)
    tail = np.zeros(len(a), np.uint64)
    for k in (1, 2, 3):
        at = end - k
        tail = tail * np.uint64(257) + np.where(at >= start, raw[np.maximum(at, 0)], 0).astype(np.uint64)
    ending = (mixed(tail) >> np.uint64(54)).astype(np.int64)
    n = len(off) - 1
    size = np.bincount(of, minlength=n)
    place = np.arange(len(a)) + of
    out_a, out_b, out_e = np.full(len(a) + n, END[0]), np.full(len(a) + n, END[1]), np.zeros(len(a) + n, np.int64)
    out_a[place], out_b[place], out_e[place] = a, b, ending
    return out_a, out_b, out_e, np.repeat(np.arange(n), size + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> (a, b, e, n): tokens by key, with their ending and, times ENDINGS, their cell."""
    kinds = (np.uint64, np.uint64, np.int64, np.int64)
    known = [np.zeros(0, t) for t in kinds]
    held: list[tuple[np.ndarray, ...]] = []

    def fold() -> None:
        nonlocal known
        a, b, e, n = (np.concatenate(x) for x in zip(known, *held, strict=True))
        order, edge = distinct_keys(a, b)
        first = order[edge]
        known = [a[first], b[first], e[first], np.add.reduceat(n[order], edge) if len(edge) else n]
        held.clear()

    def rows() -> pa.RecordBatch:
        a, b, e, n = known
        e = e + hashed_row(a) % CELLS * ENDINGS
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(e.astype(np.int32)), pa.array(n)], ["a", "b", "e", "n"])

    for batch in batches:
        a, b, e, _ = tokens(batch.column(0))
        held.append((a, b, e, np.ones(len(a), np.int64)))
        if sum(len(x[0]) for x in held) > 1_000_000:
            fold()
            if len(known[0]) > 2_000_000:  # what a task holds stays bounded
                yield rows()
                known = [np.zeros(0, t) for t in kinds]
    if held:
        fold()
    yield rows()


class Classes:
    """Classes of words: of their own (sorted keys), or by the cluster of their ending."""

    def __init__(self, top: np.ndarray, cluster: np.ndarray):
        self.top, self.cluster = np.sort(top), cluster

    def of(self, a: np.ndarray, ending: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.top, a), len(self.top) - 1)
        return np.where(self.top[at] == a, at, TOP + 1 + self.cluster[ending])


def _shared(top: np.ndarray):
    """By ending: how often its words stand in a text with each frequent word, in units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ENDINGS, len(top)), np.int64)
        for b in batches:
            h, _, e, of = tokens(b.column(0))
            at = np.minimum(np.searchsorted(top, h), len(top) - 1)
            hit = top[at] == h
            n = b.num_rows
            share = np.bincount(of[hit] * len(top) + at[hit], minlength=n * len(top)).reshape(n, -1).astype(float)
            share = np.rint(share / np.maximum(share.sum(1, keepdims=True), 1) * UNIT).astype(np.int64)
            count = np.bincount(of[~hit] * ENDINGS + e[~hit], minlength=n * ENDINGS).reshape(n, ENDINGS)
            total += (count.T.astype(float) @ share.astype(float)).astype(np.int64)  # whole numbers below 2**53: exact
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(list(total[some]), pa.list_(pa.int64()))], ["e", "v"])

    return run


def clustered(x: np.ndarray, k: int, rounds: int = 25) -> np.ndarray:
    """k-means of the rows of x, from evenly spread first centers."""
    norm = np.sqrt((x**2).sum(1, keepdims=True))
    x = x / np.maximum(norm, 1e-9)
    order = np.argsort(x @ np.linspace(1, 2, x.shape[1]) + x.argmax(1), kind="stable")
    centers = x[order[np.linspace(0, len(x) - 1, k).astype(int)]]
    label = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        label = (x @ centers.T).argmax(1)
        for j in range(k):
            if (label == j).any():
                c = x[label == j].sum(0)
                centers[j] = c / max(np.sqrt((c**2).sum()), 1e-9)
    return label


def hashed_row(a: np.ndarray) -> np.ndarray:
    return (mixed(a) >> np.uint64(52)).astype(np.int64)


def packed(classes: Classes, a: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """A token's features as one number: its hashed row (the cell are the last bits of it), and its class."""
    return (hashed_row(a) | classes.of(a, ending) << 12).astype(np.uint32)


def narrow(x: np.ndarray) -> bytes:
    """Packed tokens in 18 bits each: 16 of each, then the last two."""
    high = np.zeros(-(-len(x) // 4) * 4, np.uint8)
    high[: len(x)] = x >> np.uint32(16)
    return x.astype(np.uint16).tobytes() + (high.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8).tobytes()


def widened(data, n: int) -> np.ndarray:
    """The n packed tokens again."""
    low, high = np.frombuffer(data, np.uint16, n), np.frombuffer(data, np.uint8, offset=2 * n)
    return low | (high[:, None] >> np.array([0, 2, 4, 6], np.uint8) & np.uint8(3)).ravel()[:n].astype(np.uint32) << np.uint32(16)


def history(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of packed tokens, given which of them begin a text: (class, its rows of weights, tokens of classes with cells, cells of
    these, their rows of weights)."""
    c, row = (x >> np.uint32(12)).astype(np.int32), (x & np.uint32(4095)).astype(np.int32)
    n = len(x)
    one, two, c1, c2 = (np.full(n, v, np.int32) for v in (1, 2, START_CLASS, START_CLASS))
    one[1:], c1[1:] = row[:-1], c[:-1]
    one[first], c1[first] = 1, START_CLASS
    two[2:], c2[2:] = row[:-2], c[:-2]
    for at in (first, first + 1):
        at = at[at < n]
        two[at], c2[at] = 2, START_CLASS
    rows = np.stack([one, ROWS + two, PAIR + c1 * (CLASSES + 1) + c2])
    inner = np.flatnonzero(c > TOP)
    k = c[inner]
    both = lambda w, salt: ((w[inner].astype(np.uint64) << np.uint64(8) | k.astype(np.uint64)) * np.uint64(salt) >> np.uint64(52)).astype(np.int32)
    cells = np.stack([both(one, 0x9E3779B97F4A7C15), ROWS + both(two, 0xD6E8FEB86659FD93), 2 * ROWS + k])
    return c, rows, inner, row[inner] % CELLS, cells


def _exps(w: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summed weights of each token's rows, as exponentials; their sums. Only where these pass what the numbers hold, the
    weights are taken below their greatest."""
    z = w.take(rows[0], axis=0, mode="clip")
    for r in rows[1:]:
        z += w.take(r, axis=0, mode="clip")
    with np.errstate(over="ignore", under="ignore"):
        e = np.exp(z)
        total = e @ np.ones(e.shape[1], e.dtype)
    if not (np.isfinite(total) & (total > 1e-30)).all():
        e = np.exp(z - z.max(1, keepdims=True))
        total = e @ np.ones(e.shape[1], e.dtype)
    return e, total


def _row_sums(g: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, how often each stands in f, the sum of its rows of g). Rows that stand equally often are summed at once."""
    by_row = np.argsort(f.astype(np.uint16), kind="stable")
    times = np.bincount(f)[f[by_row]]
    by_times = np.argsort(times.astype(np.uint16), kind="stable")
    order, times = by_row[by_times], times[by_times]
    g = g.take(order, axis=0)
    edge = np.flatnonzero(np.append(True, times[1:] != times[:-1])).tolist()
    rows, n, sums = [], [], []
    for a, b in zip(edge, [*edge[1:], len(f)], strict=True):
        k = int(times[a])
        rows.append(order[a:b:k])
        n.append(times[a:b:k])
        sums.append(g[a:b] if k == 1 else g[a:b].reshape(-1, k, g.shape[1]).sum(1))
    return f[np.concatenate(rows)], np.concatenate(n), np.concatenate(sums)


def _steps(w: np.ndarray, rows: np.ndarray, y: np.ndarray) -> None:
    """Gradient updates of w over minibatches of tokens, in place: each row moves by its mean gradient, damped where it is rare."""
    for i in range(0, len(y), MINIBATCH):
        r, t = rows[:, i : i + MINIBATCH], y[i : i + MINIBATCH]
        g, total = _exps(w, r)
        g *= (-1 / total)[:, None]
        g[np.arange(len(t)), t] += 1
        for f in r:
            own, n, move = _row_sums(g, f)
            move *= (STEP / (n + DAMP)).astype(np.float32)[:, None]
            move += w.take(own, axis=0, mode="clip")
            w[own] = move


def _learn(w: np.ndarray, v: np.ndarray):
    """(part, n_tokens, x) of one round, sorted by part -> (part, table, row, move): how far each part moves each row of weights, times the
    tokens it saw. Row -1: those tokens."""

    def moves(part: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = np.fromiter(map(len, held), np.int64, len(held))
        c, rows, _, cell, cells = history(np.concatenate(held), (np.cumsum(size) - size)[size > 0])
        for number, (old, f, y) in enumerate(((w, rows, c), (v, cells, cell))):
            mine = old.copy()
            _steps(mine, f, y)
            changed = np.flatnonzero((mine != old).any(1))
            for i in range(0, len(changed), 4096):
                k = changed[i : i + 4096]
                move = (mine[k] - old[k]) * np.float32(len(c))
                yield row_batch([part] * len(k), [number] * len(k), k, [m.tobytes() for m in move])
        yield row_batch([part], [0], [-1], [np.array([len(c)], np.float64).tobytes()])

    def row_batch(part, number, row, move) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(number, pa.int32()), pa.array(row, pa.int32()), pa.array(move, pa.binary())], ["part", "number", "row", "move"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            for part, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if part != now and held:
                    yield from moves(now, held)
                    held = []
                now = part
                held.append(widened(x.as_buffer(), n))
        if held:
            yield from moves(now, held)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the moves by table and row, in the order of parts; a task holds each row once."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for number, row, move in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            x = np.frombuffer(move, np.float64 if row < 0 else np.float32).astype(np.float64)
            total[number, row] = total[number, row] + x if (number, row) in total else x
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.int32()), pa.array([k for _, k in total], pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["number", "row", "move"])


class Counts:
    """The counts of frequent words, by key; `odd` are first halves of keys that two of them share: left to the join."""

    def __init__(self, a: np.ndarray, b: np.ndarray, c: np.ndarray):
        order = np.argsort(a)
        a, b, c = a[order], b[order], c[order]
        twice = np.zeros(len(a), bool)
        twice[1:] = a[1:] == a[:-1]
        self.odd = np.unique(a[twice])
        good = ~np.isin(a, self.odd)
        self.a, self.b, self.c = a[good], b[good], c[good]

    def of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether known here, count)."""
        if not len(self.a):
            return np.zeros(len(a), bool), np.zeros(len(a), np.int64)
        at = np.minimum(np.searchsorted(self.a, a), len(self.a) - 1)
        hit = (self.a[at] == a) & (self.b[at] == b)
        return hit, np.where(hit, self.c[at], 0)


class Model:
    """Classes, the summed counts of each class and cell (one for each word and one for unknown words included), frequent words."""

    def __init__(self, classes: Classes, sizes: np.ndarray, counts: Counts):
        self.classes, self.sizes, self.counts = classes, sizes, counts


def shape(texts: DataFrame) -> tuple[Model, DataFrame, int, int]:
    """texts (text) -> the model without its weights, the count table (a, b, e, c), all tokens and distinct ones."""
    counts = written(texts.mapInArrow(_count, "a long, b long, e int, n long").groupBy("a", "b").agg(F.min(F.col("e") % ENDINGS).alias("e"), F.min(F.expr(f"e div {ENDINGS}")).cast("int").alias("cell"), F.sum("n").alias("c")))
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    total = total or 0
    head = counts.where(F.col("c") >= max(1.0, total * HEAD)).select("a", "b", "c").toPandas()
    a, b = (head[x].to_numpy(np.int64).view(np.uint64) for x in "ab")
    known = Counts(a, b, head["c"].to_numpy(np.int64))
    best = known.a[np.lexsort((known.a, -known.c))][:TOP]
    top = np.sort(np.unique(np.append(best[best != END[0]], END[0]))[: TOP + 1])
    x = np.zeros((ENDINGS, len(top)))
    pairs = texts.mapInArrow(_shared(top), "e int, v array<bigint>").select("e", F.posexplode("v").alias("i", "x"))
    for r in pairs.groupBy("e", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        x[r.e, r.i] = float(r.x)
    classes = Classes(top, clustered(np.sqrt(x), CLUSTERS))
    single = F.col("a").isin([int(k) for k in top.view(np.int64)])
    sizes = np.ones((CLASSES, CELLS))
    for r in counts.where(~single).groupBy("e", "cell").agg(F.sum(F.col("c") + 1).alias("s")).collect():
        sizes[TOP + 1 + classes.cluster[r.e], r.cell] += r.s
    sizes[: TOP + 1] = 0
    for r in counts.where(single).groupBy("a").agg(F.sum("c").alias("s")).collect():
        sizes[np.searchsorted(top, np.array([r.a], np.int64).view(np.uint64)[0]), 0] = r.s
    sizes[: len(top), 0] += 1
    return Model(classes, sizes, known), counts, total, distinct


def _features(held, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, held_out, round, h, text -> the first four, tokens, known ones, log10 counts of these, packed tokens, and the rest."""
    m = held.value
    for batch in batches:
        a, b, e, of = tokens(batch.column(4))
        n = batch.num_rows
        x = packed(m.classes, a, e)
        hit, c = m.counts.of(a, b)
        logs = np.where(hit, np.log10(c + 1.0), 0.0)
        a, b, rare = a[~hit], b[~hit], of[~hit]
        order, edge = distinct_keys(a, b, rare)
        times = np.diff(np.append(edge, len(order)))
        at = order[edge]
        bounds = np.searchsorted(rare[at], np.arange(n + 1)).astype(np.int32)
        words_ = pa.StructArray.from_arrays([pa.array(a[at].view(np.int64)), pa.array(b[at].view(np.int64)), pa.array(times.astype(np.int64))], ["a", "b", "n"])
        size = np.bincount(of, minlength=n)
        edges = np.append(0, np.cumsum(size)).tolist()
        binary = pa.array([narrow(x[i:j]) for i, j in zip(edges, edges[1:], strict=False)], pa.binary())
        arrays = [pa.array(size.astype(np.int64)), pa.array(np.bincount(of, hit, n).astype(np.int64)), pa.array(np.bincount(of, logs, n)), binary, pa.ListArray.from_arrays(pa.array(bounds), words_)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *arrays], ["doc_id", "held_out", "round", "h", "n_tokens", "known", "logs", "x", "rare"])


SCHEMA = "doc_id long, held_out boolean, round int, h long, n_tokens long, known long, logs double, x binary, rare array<struct<a:bigint,b:bigint,n:bigint>>"


def weights(rows: DataFrame, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """rows (held_out, round, h, n_tokens, x), training ones -> the weight tables of classes and of cells."""
    spark = rows.sparkSession
    w, v = np.zeros((WEIGHTS, CLASSES), np.float32), np.zeros((CELL_WEIGHTS, CELLS), np.float32)
    per = sizes.sum(1)
    w[PAIR:] = np.log(np.maximum(per, 1e-9) / per.sum())
    v[2 * ROWS :] = np.log(np.maximum(sizes, 1e-9) / np.maximum(per, 1e-9)[:, None])
    shuffles = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = {r["round"]: r.n for r in rows.groupBy("round").agg(F.sum("n_tokens").alias("n")).collect()}
    for r in sorted(found):
        parts = -(-found[r] // PART)
        dealt = rows.where(F.col("round") == r).select(F.pmod("h", F.lit(parts)).cast("int").alias("part"), "h", "n_tokens", "x")
        dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "h", "x")
        moves = dealt.select("part", "n_tokens", "x").mapInArrow(_learn(w, v), "part int, number int, row int, move binary")
        summed = moves.repartition(max(shuffles, parts), "number", "row").sortWithinPartitions("part").mapInArrow(_added, "number int, row int, move binary").collect()
        seen = sum(np.frombuffer(bytes(x.move))[0] for x in summed if x.row < 0)
        for x in summed:
            if x.row >= 0:
                (v if x.number else w)[x.row] += (np.frombuffer(bytes(x.move)) / seen).astype(np.float32)
    return w, v


def _score(held, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """x, n_tokens and any more -> those, and log10 of the classes, the cells and the cells' sizes of all its tokens."""
    w, v, sizes = held.value
    with np.errstate(divide="ignore"):
        size = np.log10(sizes)
    for b in batches:
        texts = [widened(x.as_buffer(), n) for x, n in zip(b.column(0), b.column(1).to_pylist(), strict=True)]
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        if not len(texts):
            continue
        of = np.repeat(np.arange(len(texts)), n)
        c, rows, inner, cell, cells = history(np.concatenate(texts), np.cumsum(n) - n)
        part = np.zeros(len(c))
        for table_, r, y, at in ((w, rows, c, slice(None)), (v, cells, cell, inner)):
            logs = np.empty(len(y))
            for i in range(0, len(y), MINIBATCH):
                j = slice(i, i + MINIBATCH)
                e, total = _exps(table_, r[:, j])
                logs[j] = np.log10(np.maximum(e[np.arange(len(e)), y[j]] / total, 1e-30))
            part[at] += logs
        place = np.zeros(len(c), np.int32)
        place[inner] = cell
        part -= size[c, place]
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(np.bincount(of, part, len(texts)))], [*b.schema.names[1:], "classes"])


def scored(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row.

    A null text is empty: its end is its only token. A null id counts as the empty text in the split. Equal rows train as often
    as they stand and score alike. With no training rows all counts are zero; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    h = F.xxhash64("doc_id", "text")
    docs = base_columns(docs, doc_id=F.col("doc_id").cast("long"), held_out=crc_mod(F.col("doc_id"), 7) == 2, round=F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)).cast("int"), h=h, text="text")
    model, counts, total, distinct = shape(docs.where(~F.col("held_out")).select("text"))
    held = spark.sparkContext.broadcast(model)
    rows = written(docs.mapInArrow(lambda batches: _features(held, batches), SCHEMA).withColumn("row", F.monotonically_increasing_id()))
    learned = spark.sparkContext.broadcast((*weights(rows.where(~F.col("held_out")), model.sizes), model.sizes))
    schema = "n_tokens long, row long, doc_id long, held_out boolean, known long, logs double, classes double"
    judged = rows.select("x", *(c.split()[0] for c in schema.split(", ")[:-1])).mapInArrow(lambda batches: _score(learned, batches), schema)
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.a", "r.b", "r.n")
    odd = F.col("a").isin([int(k) for k in model.counts.odd.view(np.int64)])
    table_ = counts.where((F.col("c") < max(1.0, total * HEAD)) | odd).select("a", "b", "c")
    more, also = F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"), F.sum("n").alias("also")
    met = rare.join(table_, ["a", "b"]).groupBy("row").agg(more, also)
    out = judged.join(met, "row", "left")
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    known = (F.col("known") + F.coalesce("also", F.lit(0))).cast("long")
    base = logs - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1)))
    return out.select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("classes") + logs).alias("score"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
