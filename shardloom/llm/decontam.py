"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items come in blocks of a bounded number of words; each block is sent to
all executors and every document is read against it.  A seed is, from each word
of an item, the shortest n-gram that chance would not produce in a corpus of
this size: its expected count under the corpus's own word frequencies is below
``chance``.  Frequencies are counted over all documents, for the items' words
only.  A seed hit places the item on the document; the passage there is aligned
with the item word by word, so edited and paraphrased copies score by what they
keep.  Rarity is that of the words, not of the passage: a passage leaked into a
third of all documents is found in each.

Defined results: null or empty texts and items match nothing; repeated rows are
matched one by one; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, id_text, ngram_sums, small, tidy, written

#: Words of items in one block, lengths of seeds, and the expected count below which an n-gram is rare.
BLOCK_WORDS = 400_000
SEEDS = range(3, 9)
CHANCE = 0.01
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
#: Share of a perfect alignment's score from which a passage is a copy.
LEAST = 0.5
_MARKS = string.punctuation.encode()
_BITS = np.uint64(44)  # a seed's high 20 bits address a table of a million flags


def plain(texts) -> Words:
    """Words without ASCII punctuation, A-Z in lower case."""
    return Words(texts, lower=True, without=_MARKS)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment: its score, and the first word and the end of it in the passage."""
    m, n = len(item), len(passage)
    slope = -GAP * np.arange(n + 1)
    above, best, at = np.zeros(n + 1), 0.0, (0, 0)
    rows = [above]
    for i in range(m):
        cell = np.zeros(n + 1)
        cell[1:] = np.maximum(0, np.maximum(above[:-1] + np.where(passage == item[i], MATCH, MISMATCH), above[1:] + GAP))
        cell = np.maximum.accumulate(cell + slope) - slope  # gaps along the row at once
        j = int(cell.argmax())
        if cell[j] > best:
            best, at = float(cell[j]), (i + 1, j)
        rows.append(cell)
        above = cell
    i, j = at
    end = j
    while i and j and rows[i][j] > 0:  # back to where the alignment starts
        if rows[i][j] == rows[i - 1][j - 1] + (MATCH if passage[j - 1] == item[i - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif rows[i][j] == rows[i - 1][j] + GAP:
            i -= 1
        else:
            j -= 1
    return best, j, end


def _flags(hashes: np.ndarray) -> np.ndarray:
    """A table over the high bits of hashes: whether one of these has them."""
    flags = np.zeros(1 << 20, bool)
    flags[hashes >> _BITS] = True
    return flags


def _blocks(items: DataFrame, words: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of about that many words; the driver holds one block at a time."""
    held, n = [], 0
    for r in items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        held.append((r.item_id, r.text))
        n += len(r.text) // 4
        if n >= words:
            yield held
            held, n = [], 0
    if held:
        yield held


def _word_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Counts of the given word hashes over all documents, and the number of all words; one small row comes from each task's batch."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(len(vocabulary), np.int64), 0
        flags = _flags(vocabulary)
        for batch in batches:
            h = plain(batch["text"]).hashes
            n += len(h)
            h = h[flags[h >> _BITS]]
            at = np.searchsorted(vocabulary, h)
            at[at == len(vocabulary)] = 0
            total += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        k = np.flatnonzero(total)
        yield pd.DataFrame({"word": np.append(k, -1), "n": np.append(total[k], n)})

    found = docs.select("text").mapInPandas(tidy(scan), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(vocabulary), np.int64)
    words = found[found.word >= 0]
    counts[words.word.to_numpy(np.int64)] = words.n.to_numpy(np.int64)
    return counts, int(found[found.word < 0].n.sum())


def rare_seeds(items: list[np.ndarray], chance_of: dict[int, float], total: int, chance: float = CHANCE) -> dict[int, dict[int, list[tuple[int, int]]]]:
    """length -> hash -> (item, offset) of the shortest rare n-gram from each word on; an item too short or too common for any gives its longest one."""
    seeds: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for k, words in enumerate(items):
        grams = dict(ngram_sums(words, sorted({*SEEDS, min(len(words), SEEDS[-1])} - {0})))
        logs = np.log([chance_of.get(int(w), 0.5 / max(total, 1)) for w in words]) if len(words) else np.zeros(0)
        sums = np.concatenate([[0.0], np.cumsum(logs)])
        found = False
        for at in range(len(words)):
            n = next((n for n in SEEDS if at + n <= len(words) and np.log(max(total, 1)) + sums[at + n] - sums[at] < np.log(chance)), 0)
            if n:
                seeds[n][int(grams[n][at])].append((k, at))
                found = True
        if not found and len(words):
            n = min(len(words), SEEDS[-1])
            for at, h in enumerate(grams[n]):
                seeds[n][int(h)].append((k, at))
    return {n: dict(v) for n, v in seeds.items()}


def matched(docs: DataFrame, items: DataFrame, least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, score (share of a perfect alignment), first_word and end_word of the best passage, for every document and item that score ``least`` or more.

    ``row`` tells repeated documents apart.
    """
    spark = docs.sparkSession
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    schema = "row long, doc_id long, item_id long, score double, first_word int, end_word int"
    found = spark.createDataFrame([], schema)
    for block in _blocks(items, block_words):
        read = plain([text for _, text in block])
        words = [read.of(k) for k in range(len(block))]
        vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        if not len(vocabulary):
            continue
        counts, total = _word_counts(rows, vocabulary)
        chance_of = {int(w): max(int(c), 0.5) / max(total, 1) for w, c in zip(vocabulary, counts)}
        seeds = rare_seeds(words, chance_of, total)
        tables = {n: (np.sort(np.fromiter(v, np.uint64, len(v))), v) for n, v in seeds.items()}
        shared = spark.sparkContext.broadcast(([i for i, _ in block], words, tables))  # bounded by block_words
        found = found.union(_matched_block(rows, shared, least, schema))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs, all columns, that hold no copy of an item."""
    leaks = written(matched(docs, items, least).select(F.col("row").alias("__row")).distinct(), "leaks")
    return docs.withColumn("__row", F.monotonically_increasing_id()).join(small(leaks), "__row", "left_anti").drop("__row")


def _matched_block(rows: DataFrame, shared, least: float, schema: str) -> DataFrame:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, items, tables = shared.value
        flags = {n: _flags(hashes) for n, (hashes, _) in tables.items()}
        for batch in batches:
            out = []
            words = plain(batch["text"])
            of = np.repeat(np.arange(len(batch)), words.counts)
            ends = (words.at + words.counts)[of]
            hits: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # text -> item -> places
            for n, h in ngram_sums(words.hashes, sorted(tables)):
                found = np.flatnonzero(flags[n][h >> _BITS])
                for at in found[found + n <= ends[found]].tolist():
                    for item, offset in tables[n][1].get(int(h[at]), ()):
                        hits[int(of[at])][item].append(at - int(words.at[of[at]]) - offset)
            for k, starts in sorted(hits.items()):
                row, doc_id, read = batch["row"].iloc[k], batch["doc_id"].iloc[k], words.of(k)
                for item, places in starts.items():
                    want = items[item]
                    pad = max(4, len(want) // 4)
                    best = (0.0, 0, 0)
                    last = None
                    for place in sorted(places):
                        if last is not None and place <= last + pad // 2:
                            continue  # the passage around the last place holds this one
                        last = place
                        lo = max(0, place - pad)
                        score, a, b = align(want, read[lo : place + len(want) + 2 * pad])
                        best = max(best, (score / (MATCH * len(want)), lo + a, lo + b))
                    if best[0] >= least:
                        out.append((row, doc_id, ids[item], best[0], best[1], best[2]))
            frame = pd.DataFrame(out, columns=["row", "doc_id", "item_id", "score", "first_word", "end_word"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            frame["item_id"] = frame["item_id"].astype("Int64")
            yield frame

    return rows.mapInPandas(tidy(scan), schema)
