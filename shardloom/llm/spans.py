"""Spans of regular-expression matches in code points, with SQL functions only.

A match is wrapped in a mark that the text cannot hold, the text is split at the
mark, and the lengths of the parts give the offsets.  Offsets are summed within
blocks of about the square root of their number and then over the blocks, so that
no array grows element by element over a whole text.  Patterns are written so
that Java matches them without recursion over long runs: possessive loops, and
a look-behind instead of a new attempt at every place of a run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK, OTHER = "\u0001", "\u0002"
SPAN = "array<struct<start:int,end:int,value:string>>"


def markable(text: Column) -> Column:
    """The text with its own marks replaced by another control character; lengths stay."""
    return F.translate(text, MARK, OTHER)


def parted(text: Column, pattern: str) -> Column:
    """The text in parts, every second one a leftmost non-overlapping match."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)


def _before(numbers: Column) -> tuple[Column, Column]:
    """Sums of what stands before each number, and the sum of all."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))
    step = lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["found"], F.array(s["at"])).alias("found"))
    state = F.aggregate(numbers, start, step)
    return state["found"], state["at"]


def offsets(lengths: Column) -> Column:
    """Where each of so long parts begins."""
    n = F.size(lengths)
    block = F.ceil(F.sqrt(n)).cast("int") + 1
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")), lambda k: F.slice(lengths, k * block + 1, block))

    def within(x: Column) -> Column:
        found, total = _before(x)
        return F.struct(found.alias("found"), total.alias("total"))

    def whole(held: Column) -> Column:
        firsts, _ = _before(F.transform(held, lambda x: x["total"]))
        return F.flatten(F.zip_with(held, firsts, lambda x, at: F.transform(x["found"], lambda y: y + at)))

    return _let(F.transform(blocks, within), whole)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value); the end is exclusive."""
    return F.when(text.rlike(pattern), _let(parted(text, pattern), _spans)).otherwise(F.array().cast(SPAN))


def _spans(parts: Column) -> Column:
    def numbered(starts: Column) -> Column:
        held = F.zip_with(parts, starts, lambda p, at: F.struct(at.alias("start"), (at + F.char_length(p)).alias("end"), p.alias("value")))
        return F.filter(held, lambda _, i: i % 2 == 1)

    return _let(offsets(F.transform(parts, F.char_length)), numbered)


def of_value(check: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """check, asked of a span."""
    return lambda span: check(span["value"])


def covered(text: Column, pattern: str, valid: Callable[[Column], Column]) -> Column:
    """The text with each character of a match whose value is valid replaced by the mark; lengths stay."""
    hidden = F.transform(parted(text, pattern), lambda p, i: F.when((i % 2 == 1) & valid(p), F.repeat(F.lit(MARK), F.char_length(p))).otherwise(p))
    return F.array_join(hidden, "")


def ranked(kind: str, order: int, spans: Column) -> Column:
    """Spans as sortable (start, order, end, kind)."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then by order of kinds, joined by commas."""
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def with_apart(rows: DataFrame, name: str, token: str, base: list[tuple[str, str, Callable[[Column], Column]]], needs: str) -> DataFrame:
    """rows with a column of the matches of ``token`` in text that share no character with the spans of any kind, each (column, pattern, valid).

    ``token`` must match the mark as one of its characters: a text in which the
    spans of one kind are covered gives the tokens that are apart from these.
    Those apart from every kind are found by hashes, not by pairs of spans.
    Texts that don't match ``needs`` have none.
    """
    sep, text = "\u0003", F.col("text")
    coded = lambda found: F.transform(found, lambda s: F.concat_ws(sep, s["start"].cast("string"), s["end"].cast("string"), s["value"]))
    held = rows.withColumn("__free", F.when(text.rlike(needs), coded(matches(text, token))).otherwise(F.array().cast("array<string>")))
    for kind, pattern, valid in base:
        clear = coded(matches(covered(text, pattern, valid), token))
        met = (F.size(kind) > 0) & (F.size("__free") > 0)
        held = held.withColumn("__clear", F.when(met, clear)).withColumn("__free", F.when(F.col("__clear").isNull(), F.col("__free")).otherwise(F.array_intersect("__free", "__clear")))

    def read(x: Column) -> Column:
        y = F.split(x, sep, 3)
        return F.struct(y[0].cast("int").alias("start"), y[1].cast("int").alias("end"), y[2].alias("value"))

    return held.withColumn(name, F.transform("__free", read)).drop("__free", "__clear")
