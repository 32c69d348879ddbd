"""Toxicity by a weighted finite-state pattern grammar.

Words are read by transducers: an insult transducer, whose weighted paths (whole words and beginnings of words) are learned
from labelled documents, and transducers for threats, targets, negation and reported speech with short fixed word lists.
Their composition reads one clause at a time and gives each insult or threat a role: aimed at a target, plain, negated or
reported. A document's score is the logistic function of the weights gathered by role; the role weights are learned from
other labelled documents than the insult paths, so that chance paths get no credit.

Learning uses at most `SAMPLE` labelled documents (the bound that keeps the fit small): those of least hash of the id, minus
the held-out ids. Near copies among these (texts that share their least shingle hash) weigh as one together, so that their chance words do not
count as often as they stand; none is left out. A path has to stand in several toxic documents of the sample, so the sample
bounds the paths too. Scoring streams over all documents without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import LOWER, base_columns, byte_texts, crc_mod, cut, shingle_hashes, small_batches, table, utf8, word_hashes, words

SAMPLE = 20_000
#: What a text of the sample weighs, shared with its copies: in whole numbers, so that the order of sums plays no role.
UNIT = 1 << 20
#: Lengths in bytes of the beginnings of words that may become paths.
HEADS = (3, 4, 5, 6, 7, 8)
THRESHOLD = 0.3
#: Least log-likelihood ratio of a path: chance reaches it once in about 160,000 paths.
SURPRISE = 12.0

#: Word classes besides insults; a word of no class is 0.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
LEXICON = {
    THREAT: "kill hurt destroy murder burn hang shoot beat die töten umbringen sterben tuer mourir matar morir",
    TARGET: "you your you're he she they them him her these those du dich dir ihr euch tu te toi vous usted ustedes ti",
    NEGATION: "not never no isn't aren't don't nicht kein keine nie pas jamais nunca jamás",
    REPORT: "said says told wrote quoted called reported claimed sagte schrieb nannte dit écrit dijo escribió llamó",
}
WORD_CLASS = {w.encode(): c for c, text in LEXICON.items() for w in text.split()}
#: Anything that is no letter, digit, apostrophe or UTF-8 byte above 127 parts words.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 or 48 <= c <= 57 or c == 39 else 32 for c in range(256))
#: The same, but ends of clauses stay as line feeds.
_TO_CLAUSES = bytes(10 if c in b".!?;:\n\r" else _TO_WORDS[c] for c in range(256))

ROLES = ("aimed", "plain", "negated", "reported", "threat")


def _machine(trigger: int, lasting: int) -> dict[tuple[int, int], int]:
    """A transducer that is on (state > 0) for `lasting` words after a word of class `trigger`, or to the clause's end if 0."""
    top = lasting or 1
    return {(s, c): top if c == trigger else max(0, s - 1) if lasting else s for s in range(top + 1) for c in range(6)}


def _compose(*machines: dict[tuple[int, int], int]) -> tuple[dict[tuple[int, int], int], list[tuple[int, ...]]]:
    """Machines that read the same words, as one; also what each of its states is in each machine."""
    states = [(0,) * len(machines)]
    number = {states[0]: 0}
    arcs: dict[tuple[int, int], int] = {}
    for s in states:
        for c in range(6):
            t = tuple(m[x, c] for m, x in zip(machines, s, strict=True))
            if t not in number:
                number[t] = len(states)
                states.append(t)
            arcs[number[s], c] = number[t]
    return arcs, states


#: Targets and negation last for some words, reported speech for the rest of the clause.
ARCS, STATES = _compose(_machine(TARGET, 4), _machine(NEGATION, 3), _machine(REPORT, 0))


def _role(state: int, kind: int, aimed_later: bool) -> int:
    target, negation, report = STATES[state]
    if report:
        return 3
    if negation:
        return 2
    if kind == THREAT:
        return 4
    return 0 if target or aimed_later else 1


class Grammar:
    """The learned insult paths, and the weights by role."""

    def __init__(self, paths: dict[bytes, float]):
        self.words = {k[1:]: v for k, v in paths.items() if k[:1] == b"="}
        self.heads = {n: {k[1:]: v for k, v in paths.items() if k[:1] == b"^" and len(k) == n + 1} for n in HEADS}
        self.heads = {n: x for n, x in self.heads.items() if x}
        self.bias, self.weights = 0.0, np.zeros(len(ROLES) + 1)

    def weight(self, word: bytes) -> float:
        """Of the best path that reads the word; 0 if there is none."""
        best = self.words.get(word, 0.0)
        for n, found in self.heads.items():
            if len(word) > n and (w := found.get(word[:n], 0.0)) > best:
                best = w
        return best

    def features(self, text: bytes) -> np.ndarray:
        """For each role the log of 1 + the gathered weight; last, the best single weight."""
        out = np.zeros(len(ROLES) + 1)
        seen = set(text.translate(_TO_WORDS).split())
        weights = {w: v for w in seen if (v := self.weight(w)) > 0}
        if not weights and not any(WORD_CLASS.get(w) == THREAT for w in seen):
            return out
        for clause in text.translate(_TO_CLAUSES).split(b"\n"):
            w = clause.split()
            kinds = [INSULT if x in weights else WORD_CLASS.get(x, OTHER) for x in w]
            if INSULT not in kinds and not (THREAT in kinds and TARGET in kinds):
                continue
            state, last_target = 0, max((i for i, c in enumerate(kinds) if c == TARGET), default=-1)
            for i, c in enumerate(kinds):
                if c in (INSULT, THREAT):
                    out[_role(state, c, i < last_target <= i + 4)] += weights.get(w[i], 2.0)
                state = ARCS[state, c]
        return np.append(np.log1p(out[:-1]), max(weights.values(), default=0.0))

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.features(text) @ self.weights))))


def _path_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic, weight -> by path: the weight of the rows with and without the label that hold it."""
    counts = (Counter(), Counter())
    for b in batches:
        for text, toxic, weight in zip(byte_texts(b.column(0)), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            mine = counts[toxic]
            for w in set(text.translate(_TO_WORDS).split()):
                mine[b"=" + w] += weight
            for h in {b"^" + w[:n] for w in set(text.translate(_TO_WORDS).split()) for n in HEADS if len(w) > n}:
                mine[h] += weight
    keys = list(counts[0].keys() | counts[1].keys())
    for i in range(0, len(keys), 50_000):
        part = keys[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), *(pa.array([c[k] for k in part], pa.int64()) for c in counts)], ["path", "clean", "toxic"])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least hash of a text's 5-word shingles, which most near copies of a text share."""
    for b in batches:
        raw, off = utf8(b.column(2))
        raw = LOWER[raw]
        start, end, of = words(raw, off)
        h, first = shingle_hashes(word_hashes(raw, start, end), of, 5)
        least = np.zeros(b.num_rows, np.uint64)
        doc = of[first]
        edge = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
        if len(edge):
            least[doc[edge]] = np.minimum.reduceat(h, edge)
        own = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(2), b.column(1), pa.array(np.where(least > 0, least.view(np.int64), own))], ["text", "toxic", "copies"])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> tuple[float, np.ndarray]:
    """Bias and weights by Newton's method over weighed rows, with a squared penalty on the weights."""
    z = np.column_stack([np.ones(len(x)), x])
    w, fine = np.zeros(z.shape[1]), np.diag([1e-3] + [penalty] * x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + fine, z.T @ (weight * (y - p)) - fine @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """A grammar from the labelled documents whose crc32 modulo 4 is not 2.

    Of several texts of one id the greatest counts, of several labels toxic; a null label or id is none. Without labels of both
    kinds any threat counts. Other columns of both tables play no part.
    """
    small_batches(docs.sparkSession)
    known = base_columns(labels, doc_id="doc_id", toxic="toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.where(crc_mod(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = base_columns(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id")
    # one text for each id, at most `sample`
    rows = rows.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).mapInArrow(_grouped, "text string, toxic int, copies long")
    rows = cut(rows)
    alike = rows.groupBy("copies", "toxic").agg((F.expr(f"{UNIT}L") / F.count("*")).cast("long").alias("weight"))
    rows = rows.join(F.broadcast(alike), ["copies", "toxic"]).select("text", "toxic", F.pmod(F.xxhash64("copies"), F.lit(2)).alias("fold"), "weight")
    sizes = {(r.fold, r.toxic): r.n / UNIT for r in rows.groupBy("fold", "toxic").agg(F.sum("weight").alias("n")).collect()}

    def paths(fold: int | None) -> dict[bytes, float]:
        """Those that speak for the label by more than chance does in as many paths as there may be, weighed by log-odds."""
        n = [sum(v for (f, t), v in sizes.items() if t == toxic and fold in (f, None)) for toxic in (0, 1)]
        if not n[0] or not n[1]:
            return {}
        of = rows if fold is None else rows.where(F.col("fold") == fold)
        counts = of.select("text", "toxic", "weight").mapInArrow(_path_counts, "path binary, clean long, toxic long").groupBy("path").agg((F.sum("clean") / UNIT).alias("clean"), (F.sum("toxic") / UNIT).alias("toxic"))
        share = n[1] / (n[0] + n[1])
        both = F.col("toxic") + F.col("clean")
        # log-likelihood ratio of the path's own share against the overall one
        ratio = F.col("toxic") * F.log(F.col("toxic") / (both * share)) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * (1 - share)))).otherwise(0.0)
        odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (n[0] + 1.0))
        best = counts.where((F.col("toxic") > both * share) & (ratio >= SURPRISE)).withColumn("w", odds).where("w >= 2.5")
        return {bytes(r.path): r.w for r in best.select("path", "w").collect()}

    first = Grammar(paths(0))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([first.features(t) for t in byte_texts(b.column(0))]).reshape(-1, len(ROLES) + 1)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), *(pa.array(c) for c in x.T)], ["toxic", "weight", *(f"x{i}" for i in range(x.shape[1]))])

    schema = "toxic int, weight long, " + ", ".join(f"x{i} double" for i in range(len(ROLES) + 1))
    data = np.array([tuple(r) for r in rows.where("fold = 1").select("text", "toxic", "weight").mapInArrow(describe, schema).collect()], float).reshape(-1, len(ROLES) + 3)
    data = data[np.lexsort(data.T)]
    grammar = Grammar(paths(None))
    if len(data) and 0 < data[:, 0].sum() < len(data):
        grammar.bias, grammar.weights = fit_logistic(data[:, 2:], data[:, 0], data[:, 1] / UNIT)
    else:  # nothing to learn from: any threat or path counts
        grammar.bias, grammar.weights = -3.0, np.ones(len(ROLES) + 1)
    return grammar


def scored(docs: DataFrame, grammar: Grammar, text: str = "text", name: str = "toxicity") -> DataFrame:
    """All columns of docs, and the score (double) under a name that docs must not have."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)
    held = docs.sparkSession.sparkContext.broadcast(grammar)
    schema = docs.withColumn(name, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = held.value
        for b in batches:
            s = [g.score(t) for t in byte_texts(b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema)


def _scores_only(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """docs (doc_id, text) -> doc_id, toxicity: texts go into Python, but not back."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = held.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g.score(t) for t in byte_texts(b.column(1))], pa.float64())], names=["doc_id", "toxicity"])

    return docs.mapInArrow(run, docs.select("doc_id", F.lit(0.0).alias("toxicity")).schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null text scores as an empty one; a null id is never held out. Rows stay as many as they are."""
    docs = base_columns(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    rows = _scores_only(docs, learn(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
