"""Personal data: fixed patterns, and contextual patterns bootstrapped from them.

Matches of the fixed patterns are the first seeds.  Every identifier-like mention
(a seed, a token with an @ or enough digits, or neighbouring groups of digits) is
linked to its lexical patterns: the words before it and the word after it, each
with its rough shape.  Scores go round the graph: a pattern's confidence is the
mean score of its distinct instances, an instance's score is the best confidence
among patterns with enough seeds; what comes above the threshold is a seed of the
next round, so that an identifier found in a known context makes the other
contexts known in which it stands.  Only SQL functions run on the executors; the
graph holds mentions, not words.

Defined results: a null or empty text has no spans; repeated rows are scanned
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, lower_az, small, written
from .spans import joined, markable, matches, of_value, ranked, with_apart

# The base patterns, in forms that never try a run twice.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

MIN_DIGITS = 5
#: A token that may identify someone: it holds an @ or a digit and no white space; groups of digits may follow, each after one space.
_SPACE = r"\x20\x09-\x0D"
TOKEN = rf"(?:\G|(?<![^{_SPACE}]))(?=[^{_SPACE}@]*+@|[^{_SPACE}0-9]*+[0-9])[^{_SPACE}]++(?:\x20[(]?[0-9]{{2,}}+[)]?(?:-[0-9]++)*+(?![^{_SPACE}.,;:!?\x01]))*+"
#: Rounds over the graph, seeds a pattern needs, and the score from which a mention is added.
ROUNDS, SUPPORT, THRESHOLD = 4, 3, 0.8
#: Characters on each side of a mention that can belong to its lexical patterns.
CONTEXT = 80


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _octet(part: Column) -> Column:
    kept = F.regexp_replace(part, "^0+", "")
    return (F.char_length(kept) <= 3) & ((F.when(kept == "", F.lit(0)).when(F.char_length(kept) <= 3, kept.cast("int")).otherwise(256)) <= 255)


def _luhn(value: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(value), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10 == 0


def _card(value: Column) -> Column:
    d = _digits(value)
    return F.char_length(d).between(14, 19) & F.when(F.char_length(d).between(14, 19), _luhn(d)).otherwise(False)


#: Each kind with what its text must hold, its pattern and what a match must fulfil.
_BASE = (
    ("email", "@", EMAIL, lambda v: F.lit(True)),
    ("ip", r"[0-9]\.[0-9]", IP, lambda v: F.forall(F.split(v, r"\."), _octet)),
    ("card", "[0-9]", CARD, _card),
    ("phone", r"\+", PHONE, lambda v: F.char_length(_digits(v)).between(10, 15)),
)


def base_spans(rows: DataFrame) -> DataFrame:
    """rows with a markable text and arrays email, ip, card and phone."""
    text = F.col("text")
    held = rows.withColumn("text", markable(text))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return held.select("*", *(F.filter(F.when(text.rlike(needs), matches(text, pattern)).otherwise(none), of_value(valid)).alias(kind) for kind, needs, pattern, valid in _BASE))


def _shape(value: Column) -> Column:
    """The mention with runs of digits and letters reduced to one sign each, 12 signs at most."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.substring(value, 1, CONTEXT), "[0-9]+", "9"), r"\p{L}+", "a"), 1, 12)


def _trimmed(span: Column) -> Column:
    """The span without marks of punctuation at its end."""
    value = F.regexp_replace(span["value"], r"[.,;:!?]+$", "")
    return F.struct(span["start"].alias("start"), (span["start"] + F.char_length(value)).alias("end"), value.alias("value"))


#: Code points of the blocks that a mention's surroundings are cut from; from a whole text each cut would be counted from its beginning.
BLOCK = 4_096


def _blocks(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor(F.char_length(text) / BLOCK).cast("int")), lambda k: F.substring(text, k * BLOCK + 1, F.lit(BLOCK)))


def _mentions(blocks: Column, base: Column, token: Column) -> Column:
    """Array of mentions (start, end, value, seed, patterns) of one text."""
    block = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    held = F.transform(F.filter(token, lambda s: F.contains(s["value"], F.lit("@")) | (F.char_length(_digits(s["value"])) >= MIN_DIGITS)), _trimmed)
    keep = lambda w: F.regexp_replace(w, r"[^\p{L}0-9]", "") != ""

    def mention(s: Column, seed: bool) -> Column:
        first, last_ = F.floor(s["start"] / BLOCK).cast("int"), F.floor(s["end"] / BLOCK).cast("int")
        at = s["start"] - F.greatest(first - 1, F.lit(0)) * BLOCK  # code points before it in its block and the one before
        before = lower_az(F.substring(F.concat(F.when(first > 0, block(first - 1)).otherwise(""), block(first)), F.greatest(at - CONTEXT + 1, F.lit(1)), F.least(at, F.lit(CONTEXT))))
        after = lower_az(F.substring(F.concat(block(last_), block(last_ + 1)), s["end"] - last_ * BLOCK + 1, F.lit(CONTEXT)))
        left = F.filter(F.split(before, r"[\x20\x09-\x0D]+"), keep)
        right = F.filter(F.split(after, r"[\x20\x09-\x0D]+"), keep)
        last = lambda k: F.coalesce(F.try_element_at(left, F.lit(-k)), F.lit(""))
        patterns = F.array(
            F.concat_ws("\u0003", F.lit("left"), last(1), _shape(s["value"])),
            F.concat_ws("\u0003", F.lit("two"), last(2), last(1)),
            F.concat_ws("\u0003", F.lit("right"), F.coalesce(F.try_element_at(right, F.lit(1)), F.lit("")), _shape(s["value"])),
        )
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.lit(seed).alias("seed"), patterns.alias("patterns"))

    return F.concat(F.transform(base, lambda s: mention(s, True)), F.transform(held, lambda s: mention(s, False)))


def _scores(mentions: DataFrame, rounds: int, support: int, threshold: float) -> DataFrame:
    """value -> score of every mention that is no match of a fixed pattern.

    Edges are distinct (pattern, instance) pairs, so one instance repeated in
    thousands of copies weighs once; both aggregations combine before they shuffle.
    """
    edges = mentions.select("value", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(F.max("seed").alias("seed"))
    edges = written(edges.withColumn("score", F.col("seed").cast("double")), "pii-edges")
    for _ in range(rounds):
        seeds = F.count_if(F.col("score") >= threshold).alias("seeds")
        patterns = written(edges.groupBy("pattern").agg(F.avg("score").alias("confidence"), seeds).where(F.col("seeds") >= support).select("pattern", "confidence"), "pii-patterns")
        reached = edges.where(~F.col("seed")).join(small(patterns), "pattern").groupBy("value").agg(F.max("confidence").alias("reached"))
        edges = edges.join(small(written(reached, "pii-reached")), "value", "left")
        edges = written(edges.select("pattern", "value", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("reached", F.lit(0.0))).alias("score")), "pii-edges")
    return edges.where(~F.col("seed")).groupBy("value").agg(F.max("score").alias("score"))


def found_in(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and the span arrays email, ip, card, phone and context for every row of docs."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    held = base_spans(id_text(docs).withColumn("row", F.monotonically_increasing_id()))
    text = F.col("text")
    held = with_apart(held.withColumn("base", F.concat(*KINDS)), "token", TOKEN, [(kind, pattern, valid) for kind, _, pattern, valid in _BASE], "[0-9@]")
    held = held.withColumn("blocks", F.when((F.size("base") > 0) | (F.size("token") > 0), _blocks(text)).otherwise(F.array().cast("array<string>")))
    kept = written(held.select("row", "doc_id", *KINDS, _mentions(F.col("blocks"), F.col("base"), F.col("token")).alias("mentions")), "pii-rows")
    mentions = kept.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    scores = small(written(_scores(mentions, rounds, support, threshold).where(F.col("score") >= threshold), "pii-scores"))
    new = mentions.where(~F.col("seed")).join(scores, "value").groupBy("row").agg(F.collect_list(F.struct("start", "end", "value")).alias("context"))
    return kept.join(small(written(new, "pii-context"), F.size("context")), "row", "left").select("doc_id", *KINDS, F.coalesce("context", none).alias("context"))


def digest(found: DataFrame) -> DataFrame:
    base = F.concat(*(ranked(k, i, F.col(k)) for i, k in enumerate(KINDS)))
    held = found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), base.alias("base"), F.concat(base, ranked("context", len(KINDS), F.col("context"))).alias("all"))
    return held.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))
