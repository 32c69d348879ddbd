"""Personal data: typed patterns, and bootstrapped contextual extraction. DataFrame functions only.

Four typed kinds (email, ip, card, phone) are read with linear regular expressions and checked by rules. What they find are
the seeds, with long hexadecimal keys as a fifth. Seeds induce lexical patterns: the one or two words before an entity, with
its shape. All words that look like identifiers are instances; patterns and instances form a graph, on which Spark scores
patterns by the mean score of their distinct instances, and instances by their patterns, in turn. Instances that
high-confidence patterns discover become spans of the kind `id`.

Positions are code points, the end exclusive. A match's place follows from the lengths of the pieces between matches; the
running sums are taken in blocks, so that a text with very many matches costs little more than one with few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import base_columns, cut, table

#: The four typed kinds. The look-behinds and possessive quantifiers change no match; they keep long runs linear.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these holds no match of the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"\+[0-9]"}
#: A word with a digit in it.
WORD_WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
HEX_KEY = "^[0-9a-f]{32,}$"
#: Rounds of scoring, the score from which an instance is reported, and the distinct instances a pattern must have.
ROUNDS, ACCEPT, SUPPORT = 3, 0.75, 4
BLOCK = 256


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def _matches(df: DataFrame, name: str, pattern: str, needs: str | None) -> DataFrame:
    """Adds {name}: array<struct<s, e, m, before>> of the leftmost non-overlapping matches; before: the piece before each."""
    m, p, n, b = (f"__{name}_{x}" for x in "mpnb")
    has = F.lit(True) if needs is None else F.contains("text", F.lit(needs)) if needs == "@" else F.col("text").rlike(needs)
    df = df.withColumn(m, F.when(has, F.regexp_extract_all("text", F.lit(pattern), 0)).otherwise(_empty("array<string>")))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split("text", pattern, -1)).otherwise(_empty("array<string>")))
    df = df.withColumn(n, F.transform(m, lambda x, i: (F.length(F.get(F.col(p), i)) + F.length(x)).cast("long")))
    total = lambda start, count: F.aggregate(F.slice(n, start, count), F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumn(b, F.when(F.size(m) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / BLOCK).cast("int")), lambda i: total(F.lit(1), i * BLOCK))).otherwise(_empty("array<bigint>")))

    def place(x: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        end = F.get(F.col(b), block) + total(block * BLOCK + 1, i - block * BLOCK + 1)
        return F.struct((end - F.length(x)).alias("s"), end.alias("e"), x.alias("m"), F.get(F.col(p), i).alias("before"))

    return df.withColumn(name, F.transform(m, place)).drop(m, n, b, p)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(F.split(m, r"\."), lambda p: p.cast("double") <= 255),
    "card": lambda m: F.length(_digits(m)).between(13, 19) & F.when(F.length(_digits(m)).between(13, 19), _luhn(_digits(m))).otherwise(False),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _valid(kind: str):
    return lambda x: VALID[kind](x["m"])


def typed(df: DataFrame) -> DataFrame:
    """df with text -> also email, ip, card, phone: the valid matches of each kind, in order."""
    for kind, pattern in PATTERNS.items():
        df = _matches(df, kind, pattern, NEEDS[kind])
        df = df.withColumn(kind, F.filter(kind, _valid(kind)))
    return df


def _candidates(df: DataFrame) -> DataFrame:
    """Adds cand: the words that look like identifiers, with their core's place, the patterns before them, and whether a seed."""
    df = _matches(df, "cand", WORD_WITH_DIGIT, "[0-9]")

    def describe(x: Column) -> Column:
        lead = F.regexp_extract(x["m"], r"^[^A-Za-z0-9+(]*", 0)
        core = F.regexp_replace(F.substr(x["m"], F.length(lead) + 1), r"[^A-Za-z0-9)]+$", "")
        start = x["s"] + F.length(lead)
        left = F.rtrim(F.translate(F.lower(F.coalesce(x["before"], F.lit(""))), "\t\n\x0b\x0c\r", "     "))
        shape = F.regexp_replace(F.regexp_replace(core, "[A-Za-z]+", "a"), "[0-9]+", "9")
        one, two = F.substring_index(left, " ", -1), F.substring_index(left, " ", -2)
        return F.struct(start.alias("s"), (start + F.length(core)).alias("e"), core.alias("value"), F.concat(one, F.lit("\t"), shape).alias("p1"), F.concat(two, F.lit("\t"), shape).alias("p2"))

    df = df.withColumn("cand", F.filter(F.transform("cand", describe), lambda c: (F.length(c["value"]) >= 7) & (F.length(_digits(c["value"])) >= 4)))
    bases = F.concat(*PATTERNS)
    overlaps = lambda c: F.exists(bases, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
    seed = lambda c: F.when(overlaps(c), "typed").when(c["value"].rlike(HEX_KEY), "key")
    return df.withColumn("cand", F.transform("cand", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["value"].alias("value"), c["p1"].alias("p1"), c["p2"].alias("p2"), seed(c).alias("seed"))))


def discovered(found: DataFrame, rounds: int = ROUNDS, accept: float = ACCEPT, support: int = SUPPORT) -> DataFrame:
    """found (value, p1, p2, seed), a row for each occurrence -> (value): the instances that no rule knows and high-confidence
    patterns find. A pattern's confidence is the sum of its distinct instances' scores over their number plus one; an
    instance's score is the chance that one of its patterns is right, if each is with its confidence. Seeds keep 1."""
    seeds = found.groupBy("value").agg(F.max(F.col("seed").isNotNull().cast("int")).alias("seed"))
    edges = found.select("value", F.explode(F.array("p1", "p2")).alias("pattern")).distinct().join(seeds, "value")
    edges = cut(edges.select("pattern", "value", F.col("seed").cast("double").alias("score"), "seed"))
    for _ in range(rounds):
        weight = edges.groupBy("pattern").agg((F.sum("score") / (F.count("*") + 1)).alias("c"), F.count("*").alias("n"))
        weight = weight.where((F.col("n") >= support) & (F.col("c") > 0))
        lifted = edges.join(weight.select(F.col("pattern").alias("p"), "c"), F.col("pattern") == F.col("p"), "left")
        per = lifted.groupBy("value", "seed").agg(F.sum(F.log1p(-F.least(F.coalesce("c", F.lit(0.0)), F.lit(0.999999)))).alias("miss"))
        per = per.select("value", F.when(F.col("seed") == 1, 1.0).otherwise(1 - F.exp("miss")).alias("score"))
        edges = cut(edges.drop("score").join(per, "value").select("pattern", "value", "score", "seed"))
    return edges.where((F.col("seed") == 0) & (F.col("score") >= accept)).select("value").distinct()


def _spans(kind: str, array: str) -> Column:
    return F.transform(array, lambda x: F.concat(F.lit(f"{kind}:"), x["s"], F.lit(":"), x["e"]))


def find(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans; one row for each input row.

    A null text is empty; a null id is carried along; equal rows give equal rows. spans lists the typed kinds first, then
    `key` and `id`, by kind, then start. No Python runs on the executors.
    """
    docs = base_columns(docs, doc_id="doc_id", text=F.coalesce(F.col("text"), F.lit("")))
    rows = _candidates(typed(docs))
    base = F.concat(*(_spans(k, k) for k in PATTERNS))
    # texts end here: counts, places and candidates go on
    rows = cut(rows.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS), F.array_join(base, ",").alias("base"), "cand"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    found = rows.where(F.size("cand") > 0).select("row", F.explode("cand").alias("c")).select("row", "c.*")
    new = discovered(found)
    hits = found.join(new, "value", "left_semi").withColumn("seed", F.lit("id")).unionByName(found.where("seed = 'key'"))
    hits = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(F.when(F.col("seed") == "key", 0).otherwise(1).alias("k"), "s", "e", "seed"))).alias("more"))
    more = F.transform(F.coalesce("more", _empty("array<struct<k:int,s:bigint,e:bigint,seed:string>>")), lambda x: F.concat(x["seed"], F.lit(":"), x["s"], F.lit(":"), x["e"]))
    spans = F.array_join(F.concat(F.when(F.col("base") != "", F.array("base")).otherwise(_empty("array<string>")), more), ",")
    return rows.join(hits, "row", "left").select("doc_id", *(f"n_{k}" for k in PATTERNS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def _replaced(df: DataFrame, pattern: str, needs: str, new) -> DataFrame:
    """text with each match m replaced by new(m)."""
    has = F.contains("text", F.lit(needs)) if needs == "@" else F.col("text").rlike(needs)
    df = df.withColumn("__m", F.when(has, F.regexp_extract_all("text", F.lit(pattern), 0)).otherwise(_empty("array<string>")))
    df = df.withColumn("__p", F.when(F.size("__m") > 0, F.split("text", pattern, -1)).otherwise(_empty("array<string>")))
    whole = F.array_join(F.transform("__p", lambda p, i: F.concat(p, F.coalesce(new(F.get(F.col("__m"), i)), F.lit("")))), "")
    return df.withColumn("text", F.when(F.size("__m") > 0, whole).otherwise(F.col("text"))).drop("__m", "__p")


def redact(docs: DataFrame) -> DataFrame:
    """docs with each typed entity, key and discovered identifier in text replaced by its kind in brackets.

    Only texts that hold candidates are shuffled, to meet what was discovered in them; a null text stays null.
    """
    # the row as one value, so that its names can't clash with those here
    text = F.coalesce("text", F.lit(""))
    held = docs.select(F.struct("*").alias("doc"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(7)).alias("k2"))
    likely = F.col("text").rlike("[0-9]")
    found = _candidates(typed(held.where(likely).select("text", "k1", "k2")))
    # written before it is exploded: a filter on the size of cand must not repeat the work that makes it
    found = cut(found.select("k1", "k2", "cand")).select("k1", "k2", F.explode("cand").alias("c")).select("k1", "k2", "c.*").distinct()
    found = cut(found)
    hits = found.join(discovered(found), "value", "left_semi").groupBy("k1", "k2").agg(F.collect_set("value").alias("ids"))
    none = _empty("array<string>")
    some = held.where(likely).join(hits, ["k1", "k2"], "left").select("doc", "text", F.coalesce("ids", none).alias("ids"))
    core = lambda m: F.regexp_replace(F.regexp_replace(m, r"^[^A-Za-z0-9+(]*", ""), r"[^A-Za-z0-9)]+$", "")
    # discovered identifiers and keys first, while the words are whole
    swap = lambda m: F.when(core(m).rlike(HEX_KEY) | F.array_contains("ids", core(m)), F.concat(F.regexp_extract(m, r"^[^A-Za-z0-9+(]*", 0), F.lit("[ID]"), F.regexp_extract(m, r"[^A-Za-z0-9)]+$", 0))).otherwise(m)
    out = _replaced(some, WORD_WITH_DIGIT, "[0-9]", swap)
    for kind, pattern in PATTERNS.items():
        out = _replaced(out, pattern, NEEDS[kind], lambda m, kind=kind: F.when(VALID[kind](m), F.lit(f"[{kind.upper()}]")).otherwise(m))
    new = F.when(F.col("doc.text").isNotNull(), F.col("text"))
    columns = [new.alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns]
    # a text without a digit can still hold an address
    plain = _replaced(held.where(~likely), PATTERNS["email"], NEEDS["email"], lambda m: F.lit("[EMAIL]"))
    return out.select(*columns).union(plain.select(*columns))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
