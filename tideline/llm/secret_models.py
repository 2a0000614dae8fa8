"""Secrets: base patterns, and character Markov models of random strings and ordinary identifiers.

Everything here is column expressions. Positions come from splitting a text at a pattern: what
stands between the matches and the matches themselves, in turn, add up to where each begins.

Two first-order Markov chains over classes of characters, one of random strings and one of
ordinary identifiers, are counted from labelled samples by ``groupBy``. A token that is long
enough and has a letter and a digit gets the log-likelihood ratio of the two chains, a sum over
its pairs of neighbouring characters, and is a secret if that reaches a threshold for the whole
token and on average. The chains are ``ALPHABET`` squared numbers whatever the corpus, so they
are literals in the expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import hashed_sample

KINDS = ("assign", "access", "hex")
ADDED = "random"

# The patterns of the contract. Shorter runs of the last two are dropped whole, which
# the least lengths say at once; the value of an assignment has to be measured apart.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

#: What the models read: runs of the characters secrets are written in.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
WORD = r"[A-Za-z0-9+/_=-]{6,}"
#: Symbols of the chains; anything else in a token is the last one.
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
ALPHABET = len(SYMBOLS) + 1
#: Labelled rows the chains are counted from, at most, of each label, and documents read for them.
SAMPLE, DOCUMENTS = 8_000, 2_000
#: Least ratio of a whole token in nats, and for each of its pairs.
THRESHOLD, PER_PAIR = 12.0, 0.9
#: Added to every count of a pair.
SMOOTHING = 0.5


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratios of pairs of symbols, ``ratios[a * ALPHABET + b]``."""

    ratios: tuple[float, ...]


def matches(text: Column, pattern: str, value: int = 0) -> Column:
    """``start, end, value`` of the leftmost matches that do not overlap, in code points.

    ``value`` is a group of the pattern. Null and empty texts have none.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = found if value == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    pairs = F.zip_with(
        F.arrays_zip(between.alias("gap"), found.alias("whole")), kept,
        lambda p, v: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["whole"]).alias("size"), v.alias("value")),
    )
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def further(so_far: Column, one: Column) -> Column:
        start = so_far["at"] + one["gap"]
        end = start + one["size"]
        row = F.struct(start.alias("start"), end.alias("end"), one["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(so_far["rows"], row).alias("rows"))

    first = F.struct(F.lit(0).alias("at"), none.alias("rows"))
    rows = F.aggregate(pairs, first, further, lambda x: x["rows"])
    # Most texts have no match and are read once.
    return F.when(text.rlike(pattern), rows).otherwise(none)


def base_matches(text: Column) -> dict[str, Column]:
    """Matches of each kind of base span; the span is the whole match."""
    assigned = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= LEAST_VALUE)
    return {"assign": assigned, "access": matches(text, ACCESS), "hex": matches(text, HEX)}


def _pairs(token: Column) -> Column:
    """Numbers of the pairs of neighbouring symbols of a token."""
    codes = F.transform(F.split(token, ""), lambda c: F.coalesce(F.nullif(F.instr(F.lit(SYMBOLS), c), F.lit(0)), F.lit(ALPHABET)) - 1)
    return F.transform(
        F.slice(F.arrays_zip(codes.alias("a"), F.slice(codes, F.lit(2), F.size(codes)).alias("b")), F.lit(1), F.greatest(F.length(token) - 1, F.lit(0))),
        lambda p: p["a"] * ALPHABET + p["b"],
    )


def ratio(token: Column, models: Models) -> Column:
    """Log-likelihood ratio of a token: positive where it rather is a random string."""
    table = F.array(*[F.lit(x) for x in models.ratios])
    return F.aggregate(_pairs(token), F.lit(0.0), lambda total, p: total + F.get(table, p))


def labelled(docs: DataFrame, text: str = "text", sample: int = SAMPLE, documents: int = DOCUMENTS) -> DataFrame:
    """Labelled samples, ``value, random``, of at most ``sample`` different rows of each kind.

    Random: the values of base spans, and digests of them in base 64 and capital base 16, as random
    as secrets and in the characters of those of other kinds. Ordinary: words outside base spans of at
    most ``documents`` texts, on their own, joined as identifiers are, and numbers. Rows are
    chosen by hash, whatever the partitions.
    """
    texts = docs.select(F.col(text).alias("t")).where("t IS NOT NULL")
    spans = base_matches(F.col("t"))
    secret = texts.where(F.col("t").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")).select(
        F.explode(F.flatten(F.array(*[F.transform(spans[k], lambda m: m["value"]) for k in KINDS]))).alias("value")
    )
    values = hashed_sample(secret.distinct(), sample, ["value"])
    digest = F.base64(F.unhex(F.sha2(F.concat(F.lit("digest "), "value"), 256)))
    written = values.select(F.explode(F.array("value", F.upper(F.sha2("value", 224)), digest, F.translate(digest, "+/=", ""))).alias("value"))
    read = hashed_sample(texts, documents, ["t"])
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("t", ASSIGN, " "), ACCESS, " "), HEX, " ")
    found = read.select(F.explode(F.array_distinct(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)))).alias("w"))
    word = hashed_sample(found.distinct(), sample, ["w"])
    number = F.pmod(F.xxhash64("w"), F.lit(10_000)).cast("string")
    halves = [F.substring("w", 1, 5), F.expr("substring(w, 6)")]
    forms = [
        F.col("w"), F.concat_ws("_", *halves, number), F.concat(F.lower(halves[0]), F.initcap(halves[1]), number),
        F.concat_ws("-", *halves), F.upper(F.concat_ws("_", *halves)), F.concat_ws("/", F.lit("v1"), *halves, number),
    ]
    ordinary = word.select(F.explode(F.array(*forms)).alias("value"))
    return written.select("value", F.lit(True).alias("random")).unionByName(
        ordinary.select("value", F.lit(False).alias("random"))
    ).distinct()


def fit(samples: DataFrame) -> Models | None:
    """Chains of both labels, from rows ``value, random``; none if a label is missing.

    Rows are counted once each, so a repeated one weighs more; null and short values have no
    pairs. At most twice ``ALPHABET`` squared counts reach the driver.
    """
    pairs = samples.where("value IS NOT NULL AND random IS NOT NULL").select("random", F.explode(_pairs(F.col("value"))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n")).collect()}
    if {label for label, _ in counts} != {True, False}:
        return None
    # The logarithms are Spark's, so that nothing depends on the driver's.
    totals = {
        (label, a): sum(counts.get((label, a * ALPHABET + b), 0) for b in range(ALPHABET))
        for label in (True, False) for a in range(ALPHABET)
    }
    cells = [
        (p, *[(counts.get((label, p), 0) + SMOOTHING) / (totals[label, p // ALPHABET] + SMOOTHING * ALPHABET) for label in (True, False)])
        for p in range(ALPHABET * ALPHABET)
    ]
    table = samples.sparkSession.createDataFrame(cells, "pair int, random double, ordinary double")
    rows = table.select("pair", F.round(F.log(F.col("random") / F.col("ordinary")), 6).alias("ratio")).collect()
    return Models(tuple(r["ratio"] for r in sorted(rows)))


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, documents: int = DOCUMENTS) -> Models | None:
    return fit(labelled(docs, text, sample, documents))


def is_random(token: Column, models: Models) -> Column:
    """Whether a token is judged a random string; it must have a letter and a digit."""
    score = ratio(token, models)
    least = F.greatest(F.lit(THRESHOLD), PER_PAIR * (F.length(token) - 1))
    return token.rlike("[0-9]") & token.rlike("[A-Za-z]") & (score >= least)


def _spans(found: Column, kind: str, order: int) -> Column:
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def with_spans(docs: DataFrame, models: Models | None, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of spans ``start, order, end, kind``.

    An added span touches no base span. Null and empty texts have none of either.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = {k: F.col(f"_{k}") for k in KINDS}
    rows = docs.withColumns({f"_{k}": m for k, m in base_matches(whole).items()})
    rows = rows.withColumn("base", F.concat(*[_spans(found[k], k, i) for i, k in enumerate(KINDS)]))
    if models is None:
        return rows.withColumn("added", F.filter("base", lambda s: F.lit(False)))
    rows = rows.withColumn("_tokens", matches(whole, TOKEN))
    free = F.filter(
        "_tokens",
        lambda m: is_random(m["value"], models)
        & ~F.exists("base", lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"])),
    )
    return rows.withColumn("added", _spans(free, ADDED, len(KINDS)))


def detect(docs: DataFrame, models: Models | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``, ``n_added``.

    One row per row of ``docs``. ``n_*`` and ``base_sha256`` are of base spans, ``spans`` has the
    added ones as well, of kind ``random``. Other columns are ignored.
    """
    rows = with_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), models)
    return rows.select(
        "doc_id",
        *[F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )
