"""Quality rules as a short-circuit cascade.

Each rule says whether a text fails.  On a bounded sample the driver measures
what each rule costs and how much it rejects; rules then run in order of
rejection per cost and stop at the first failure.  Since a text is kept only if
no rule fails, the order changes the time and never the verdict.

Defined results: a null or empty text has no words and fails ``too_few_words``;
repeated rows are judged one by one; an empty table gives an empty result; other
columns are ignored.  Without labels the toxic rule knows no words and passes all.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_AZ, WORD, id_text, lower_az, sampled, tidy

SYMBOLS = b"#*$%&|<>"
#: Bounds of what is fitted: labelled rows read, and texts timed by the driver.
LABEL_SAMPLE = 20_000
TIMING_SAMPLE = 200
#: A lexicon word is in this share of the toxic sample at least, and this share of the sampled texts that hold it are toxic.
LEXICON_SHARE, LEXICON_PRECISION, LEXICON_LEAST = 0.02, 0.9, 5


class Text:
    """A text whose features are computed when a rule first asks for them."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def word_chars(self) -> int:
        white = len(self.raw) - len(self.raw.translate(None, b" \t\n\r\x0b\x0c"))
        return len(self.text) - white

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        n = len(self.words)
        if n < 4:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, n)
        v = len(number)
        window = (ids[:-2] * v + ids[1:-1]) * v + ids[2:] if v < 2_000_000 else np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]]), axis=1, return_inverse=True)[1].ravel()
        _, where, count = np.unique(window, return_inverse=True, return_counts=True)
        again = count[where] >= 2
        if not again.any():
            return 0
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k : k + n - 2] |= again
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Text], bool]


def toxic_rule(lexicon: frozenset[bytes], least: int) -> Rule:
    strip = b".,;:!?\"'()"
    return Rule("toxic_words", lambda t: bool(lexicon) and sum(w.translate(LOWER_AZ).strip(strip) in lexicon for w in t.words) >= least)


def default_rules(lexicon: frozenset[bytes] = frozenset(), *, min_words: int = 50, max_repeat: float = 0.5, max_symbols: float = 0.3, max_shouts: float = 0.3, max_dup_lines: float = 0.4, word_length: tuple[float, float] = (2.0, 20.0), least_toxic: int = 1) -> list[Rule]:
    return [
        Rule("too_few_words", lambda t: len(t.words) < min_words),
        Rule("repeated_words", lambda t: t.n_repeat_words > max_repeat * len(t.words)),
        Rule("symbols", lambda t: t.n_symbols > max_symbols * len(t.words)),
        Rule("shouting", lambda t: t.raw.count(b"!") > max_shouts * len(t.words)),
        Rule("repeated_lines", lambda t: t.n_dup_lines > max_dup_lines * len(t.lines)),
        Rule("word_length", lambda t: bool(t.words) and not word_length[0] <= t.word_chars / len(t.words) <= word_length[1]),
        toxic_rule(lexicon, least_toxic),
    ]


def toxic_lexicon(docs: DataFrame, labels: DataFrame, sample: int = LABEL_SAMPLE) -> frozenset[bytes]:
    """Words that mark toxic texts, from at most ``sample`` labelled rows.

    A word counts once per text.  As it is in a share of the toxic texts, there are
    no more words than the longest texts of that share have.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().dropDuplicates(["doc_id"])
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    held = id_text(docs).join(F.broadcast(rows), "doc_id")
    words = F.array_distinct(F.transform(F.regexp_extract_all(lower_az(F.col("text")), F.lit(WORD), F.lit(0)), lambda w: F.regexp_replace(w, r"^[.,;:!?\"'()]+|[.,;:!?\"'()]+$", "")))
    seen = held.select("toxic", F.explode(words).alias("word")).groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    n_toxic = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0))).first()[0]
    least = max(LEXICON_LEAST, LEXICON_SHARE * n_toxic)
    best = seen.where((F.col("word") != "") & (F.col("toxic") >= least) & (F.col("toxic") >= LEXICON_PRECISION * F.col("n")))
    return frozenset(r.word.encode() for r in best.select("word").collect())


def cascade_order(rules: list[Rule], texts: list[str]) -> list[Rule]:
    """Rules by rejection per second on the sample, the best first; ties keep the given order."""
    gain = {}
    for rule in rules:
        began = time.perf_counter()
        rejected = sum(rule.fails(Text(x)) for x in texts)
        gain[rule.name] = rejected / max(time.perf_counter() - began, 1e-9)
    return sorted(rules, key=lambda r: -gain[r.name])


def judged(docs: DataFrame, labels: DataFrame | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, the measured features, base_failed and kept for every row of docs.

    kept is false if the base fails or any rule of the cascade does.
    """
    rows = id_text(docs)
    rules = rules or default_rules(toxic_lexicon(docs, labels) if labels is not None else frozenset())
    sample = [r.text for r in sampled(rows, TIMING_SAMPLE).limit(TIMING_SAMPLE).collect()]
    order = cascade_order(rules, sample)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                t = Text(text)
                n = len(t.words)
                failed = n < 50 or 100 * t.n_repeat_words > 50 * n
                out.append((doc_id, n, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, not failed and not any(r.fails(t) for r in order)))
            frame = pd.DataFrame(out, columns=NAMES)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return rows.mapInPandas(tidy(judge), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def kept_rows(docs: DataFrame, labels: DataFrame | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """The rows of docs, all columns, that neither the base nor the cascade rejects."""
    rows = id_text(docs)
    rules = rules or default_rules(toxic_lexicon(docs, labels) if labels is not None else frozenset())
    order = cascade_order(rules, [r.text for r in sampled(rows, TIMING_SAMPLE).limit(TIMING_SAMPLE).collect()])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = map(Text, batch.column("text").to_pylist())
            stays = [len(t.words) >= 50 and 100 * t.n_repeat_words <= 50 * len(t.words) and not any(r.fails(t) for r in order) for t in texts]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(tidy(keep), docs.schema)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
