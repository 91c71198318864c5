"""Secrets: fixed patterns, and character Markov models for random strings.

Two first-order models over character classes are counted on labelled samples:
values that the fixed patterns found (random strings) and ordinary words and
identifiers from a bounded sample of texts.  A token is a secret where the
log-likelihood ratio of its character pairs exceeds a threshold in sum and for
each pair: a short token has to be the more random, and none is too long.  Texts
are read once; what the patterns found is written and both models learn from it.
Only SQL functions run on the executors.

Defined results: a null or empty text has no spans; repeated rows are scanned
one by one; an empty table gives an empty result; without any labelled secret
the random model is its uniform prior.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, sampled, written
from .spans import MARK, joined, markable, matches, of_value, ranked, with_apart

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
KINDS = ("assign", "access", "hex")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
_RUN = rf"[A-Za-z0-9+/_=.{MARK}-]"
#: Tokens that are scored: of so many characters and more.
SHORTEST = 12
TOKEN = rf"(?<!{_RUN}){_RUN}{{{SHORTEST},}}+"
WORDLIKE = r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{4,}+"
#: Labelled samples: all values of the fixed patterns, and words of at most this many texts.
ORDINARY_TEXTS = 4_000
#: Pseudo-counts of a pair: the uniform prior of random strings weighs more than that of ordinary text.
RANDOM_PRIOR, ORDINARY_PRIOR = 20.0, 0.5
#: Natural-log ratio of a pair and of a token at least.
THRESHOLD, SUM = 0.4, 7.0
SIZE = len(ALPHABET)
_CLASS = [ALPHABET.find(chr(c)) for c in range(128)]


def _classes(value: Column) -> Column:
    """Class numbers of the characters of a string over ALPHABET."""
    table = F.lit(_CLASS)
    return F.transform(F.split(value, ""), lambda c: F.element_at(table, F.ascii(c) + 1))


def _pairs(classes: Column) -> Column:
    n = F.greatest(F.size(classes) - 1, F.lit(0))
    return F.zip_with(F.slice(classes, 1, n), F.slice(classes, 2, n), lambda a, b: a * SIZE + b)


def pair_counts(values: DataFrame) -> dict[int, int]:
    """How often each pair of classes stands in column value; at most SIZE squared rows come to the driver."""
    held = values.select(_classes("value").alias("classes")).select(F.explode(_pairs(F.col("classes"))).alias("pair"))
    return {r.pair: r.n for r in held.groupBy("pair").agg(F.count("*").alias("n")).collect()}


def log_ratio(random: dict[int, int], ordinary: dict[int, int]) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary) for every pair a, b."""
    out = []
    for a in range(SIZE):
        row = range(a * SIZE, (a + 1) * SIZE)
        n_random = sum(random.get(k, 0) for k in row) or 0
        # A random value's counts are scaled to the weight of its prior, so that one alphabet (hex) doesn't rule out the others.
        scale = min(1.0, SIZE * RANDOM_PRIOR / n_random) if n_random else 1.0
        n_random = n_random * scale + SIZE * RANDOM_PRIOR
        n_ordinary = sum(ordinary.get(k, 0) for k in row) + SIZE * ORDINARY_PRIOR
        out += [round(math.log((random.get(k, 0) * scale + RANDOM_PRIOR) / n_random) - math.log((ordinary.get(k, 0) + ORDINARY_PRIOR) / n_ordinary), 5) for k in row]
    return out


def is_random(value: Column, ratios: list[float], threshold: float = THRESHOLD, least: float = SUM) -> Column:
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")  # one literal after constant folding
    pairs = _pairs(_classes(value))
    total = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.element_at(table, p + 1))
    return total >= F.greatest(F.lit(least), threshold * (F.char_length(value) - 1))


def _secret(value: Column) -> Column:
    """What an assignment gives its name."""
    return F.regexp_extract(value, ASSIGN, 1)


_BASE = (
    ("assign", ASSIGN, lambda v: F.char_length(_secret(v)) >= 8),
    ("access", ACCESS, lambda v: F.char_length(v) >= 16),
    ("hex", HEX, lambda v: F.char_length(v) >= 32),
)


def base_spans(rows: DataFrame) -> DataFrame:
    """rows with a markable text and arrays assign, access and hex."""
    held = rows.withColumn("text", markable(F.col("text")))
    return held.select("*", *(F.filter(matches(F.col("text"), pattern), of_value(valid)).alias(kind) for kind, pattern, valid in _BASE))


def read(docs: DataFrame) -> DataFrame:
    """One row a document: row, doc_id, the base spans, and the tokens apart from them that could be random; written."""
    held = base_spans(id_text(docs).withColumn("row", F.monotonically_increasing_id()))
    held = with_apart(held, "token", TOKEN, list(_BASE), WORDLIKE)
    return written(held.select("row", "doc_id", *KINDS, "token"), "secret-rows")


def fitted(held: DataFrame, docs: DataFrame, ordinary_texts: int = ORDINARY_TEXTS) -> list[float]:
    """The log-ratio table, trained on the labelled samples: all values found, and the other words of some texts."""
    found = held.where("size(assign) > 0 or size(access) > 0 or size(hex) > 0")
    values = F.concat(F.transform("assign", lambda s: _secret(s["value"])), F.transform("access", lambda s: s["value"]), F.transform("hex", lambda s: s["value"]))
    secrets = found.select(F.explode(values).alias("value")).where(F.col("value").rlike(r"^[A-Za-z0-9+/_=.-]+$"))
    some = base_spans(sampled(id_text(docs), ordinary_texts))
    words = some.select(F.explode(F.array_except(F.regexp_extract_all("text", F.lit(WORDLIKE), F.lit(0)), values)).alias("value"))
    return log_ratio(pair_counts(secrets), pair_counts(words))


def scanned(docs: DataFrame, ratios: list[float] | None = None, threshold: float = THRESHOLD, least: float = SUM) -> DataFrame:
    """doc_id and the span arrays assign, access, hex and markov (start, end, value) for every row of docs."""
    held = read(docs)
    ratios = fitted(held, docs) if ratios is None else ratios
    return held.select("doc_id", *KINDS, F.filter("token", lambda s: is_random(s["value"], ratios, threshold, least)).alias("markov"))


def digest(found: DataFrame) -> DataFrame:
    base = F.concat(*(ranked(k, i, F.col(k)) for i, k in enumerate(KINDS)))
    held = found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), base.alias("base"), F.concat(base, ranked("markov", len(KINDS), F.col("markov"))).alias("all"))
    return held.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))
