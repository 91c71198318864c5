"""Exact substring deduplication by level-wise doubling.

A window of ``width`` words that stands earlier too (smaller doc_id, or earlier
in the same document) is removed with all words it covers.  Windows grow by
doubling: width / 2**doublings words at the first level, width at the last.  The
first level keeps only the windows of least hash among all that one window of
full width holds; every window of full width then holds one, the same one
wherever it stands, so nothing is lost.  At each level only windows repeated at
that length alone are extended to twice that length.

Windows are aggregated by hash, which combines before it shuffles, and what a
document needs to know comes back by document: below the last level the windows
that stand alone, at the last the windows that are the first of their kind.  No
window's occurrences are gathered anywhere.

Texts that are copies of an earlier text as a whole go first: each of their
windows stands in the earlier text, so they are decided without any window.

Defined results: a null, empty or short text keeps all its words; of repeated
rows the first one stays; null ids come last; an empty table gives an empty
result.  ``docs`` must be a scan or another input whose rows come in the same
partitions each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Words, discard, id_text, in_order, mix64, ngram_hashes, small, tidy, words_of, written, written_at

WIDTH = 20
DOUBLINGS = 1


def numbered(docs: DataFrame) -> DataFrame:
    return id_text(docs).withColumn("row", F.monotonically_increasing_id())


def anchors(hashes: np.ndarray, width: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of windows of ``base`` words such that every window of ``width`` words holds one."""
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    level = ngram_hashes(hashes, base)
    near = np.lib.stride_tricks.sliding_window_view(level, width - base + 1)
    at = np.unique(np.arange(len(near)) + near.argmin(axis=1))
    return at, level[at]


def extended(places: np.ndarray, length: int, width: int, n_words: int) -> np.ndarray:
    """Starts of windows twice as long around windows of ``length`` words: all of them at the last level, else enough for one to lie in each full window."""
    back = np.arange(length + 1) if 2 * length == width else np.asarray([0, length])
    at = np.unique((np.asarray(places, np.int64)[:, None] - back).ravel())
    return at[(at >= 0) & (at + 2 * length <= n_words)]


def _first_level(rows: DataFrame, width: int, base: int) -> DataFrame:
    """One row a document: its length, digest, and first-level windows (none for copies)."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            words = Words(batch["text"])
            for k, (row, doc_id, text, copy, n) in enumerate(zip(batch["row"], batch["doc_id"], batch["text"], batch["copy"], words.counts.tolist())):
                if copy and n >= width:
                    out.append((row, doc_id, n, True, "", [], []))
                    continue
                at, h = anchors(words.of(k), width, base)
                out.append((row, doc_id, n, False, hashlib.sha256(b" ".join(words_of(text))).hexdigest(), h.astype(np.int64), at.astype(np.int32)))
            frame = pd.DataFrame(out, columns=["row", "doc_id", "n_words", "copy", "sha", "hashes", "places"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return rows.mapInPandas(tidy(scan), "row long, doc_id long, n_words long, copy boolean, sha string, hashes array<long>, places array<int>")


def _live(held: DataFrame, windows: DataFrame) -> DataFrame:
    """(row, places) of held without the windows (row, h, place) whose hash stands alone."""
    alone = windows.groupBy("h").agg(F.min("row").alias("row"), F.min("place").alias("place"), F.count("*").alias("n")).where("n = 1")
    alone = alone.groupBy("row").agg(F.collect_list("place").alias("alone"))
    left = F.when(F.col("alone").isNull(), F.col("places")).otherwise(F.array_except("places", "alone"))
    return held.join(alone, "row", "left").select("row", left.alias("places")).where(F.size("places") > 0)


def _with_text(rows: DataFrame, live: DataFrame) -> DataFrame:
    """Texts of the documents of live; where these are few, others don't get as far as the shuffle."""
    ids = small(live.select("row"))
    return rows.join(ids, "row", "left_semi").join(live, "row")


def removable(docs: DataFrame, width: int = WIDTH, doublings: int = DOUBLINGS) -> tuple[DataFrame, DataFrame]:
    """Every document (row, doc_id, n_words, copy, sha of all words), and those around repeated windows (row, n_removed, kept text)."""
    spark, length = docs.sparkSession, width >> doublings
    if length << doublings != width or not length or not doublings:
        raise ValueError("width must be doublings (at least one) times divisible by 2")
    rows = numbered(docs)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    digests = rows.select("row", "doc_id", F.md5("text").alias("digest"))
    first = digests.groupBy("digest").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    copies = written(digests.select("row").join(first, "row", "left_anti").withColumn("copy", F.lit(True)), "copies")  # by row: no group of copies meets
    level, path = written_at(_first_level(rows.join(small(copies), "row", "left").withColumn("copy", F.coalesce("copy", F.lit(False))), width, length), "level")
    every = written(level.drop("hashes", "places"), "documents")
    windows = level.select("row", F.explode(F.arrays_zip("hashes", "places")).alias("w")).select("row", F.col("w.hashes").alias("h"), F.col("w.places").alias("place"))
    live = written(_live(level.select("row", "places"), windows), "live")
    discard(spark, path)

    def hashed(length: int):
        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for lo in range(0, len(batch), 500):
                    out = []
                    part = batch.iloc[lo : lo + 500]
                    read = Words(part["text"])
                    for k, (row, number, places) in enumerate(zip(part["row"], part["number"], part["places"])):
                        words = read.of(k)
                        h = ngram_hashes(words, length)
                        at = extended(places, length, width, len(words))
                        a, b = h[at], h[at + length]  # two halves make a hash of 96 bits
                        whole = mix64(a + mix64(b))
                        _, once = np.unique(whole, return_index=True)  # of repeats within the document only the first can be the first of all
                        at, a, b, whole = at[once], a[once], b[once], whole[once]
                        g = (a ^ (b << np.uint64(1))) >> np.uint64(33)
                        out.append(pd.DataFrame({"row": row, "number": number, "h": whole.astype(np.int64), "g": g.astype(np.int32), "place": at.astype(np.int32)}))
                    yield pd.concat(out)

        return scan

    schema = "row long, number long, h long, g int, place int"
    while 2 * length < width:
        # Repeats within a document count as repeats here.
        texts = written(_with_text(rows, live), "texts")

        def spread(batches: Iterator[pd.DataFrame], length: int = length) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                read = Words(batch["text"])
                for k, (row, places) in enumerate(zip(batch["row"], batch["places"])):
                    words = read.of(k)
                    at = extended(places, length, width, len(words))
                    out.append((row, ngram_hashes(words, 2 * length)[at].astype(np.int64), at.astype(np.int32)))
                yield pd.DataFrame(out, columns=["row", "hashes", "places"])

        level = written(texts.mapInPandas(tidy(spread), "row long, hashes array<long>, places array<int>"), "level")
        windows = level.select("row", F.explode(F.arrays_zip("hashes", "places")).alias("w")).select("row", F.col("w.hashes").alias("h"), F.col("w.places").alias("place"))
        live = written(_live(level.select("row", "places"), windows), "live")
        length *= 2

    # Documents around live windows, with their number in the order of removal.
    numbers = in_order(every.join(live.select("row"), "row", "left_semi").select("row", "doc_id", F.col("doc_id").isNull().alias("no_id")), "no_id", "doc_id", "row")
    numbers = written(numbers.select("row", F.col("place").alias("number")), "numbers")
    texts = _with_text(rows, live.join(small(numbers), "row"))
    windows = texts.select("row", "number", "text", "places").mapInPandas(tidy(hashed(length)), schema)
    firsts = windows.groupBy("h", "g").agg(F.min_by("row", "number").alias("row"), F.min_by("place", "number").alias("place"))
    firsts = firsts.groupBy("row").agg(F.collect_list("place").alias("firsts"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, text, places, stay in zip(batch["row"], batch["text"], batch["places"], batch["firsts"]):
                words = words_of(text)
                at = extended(places, length, width, len(words))
                if stay is not None:
                    at = np.setdiff1d(at, np.asarray(stay, np.int64), assume_unique=True)
                gone = np.zeros(len(words) + 1, np.int64)
                gone[at] += 1
                gone[at + width] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                out.append((row, int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["row", "n_removed", "kept"])

    changed = texts.join(firsts, "row", "left").select("row", "text", "places", "firsts").mapInPandas(tidy(cut), "row long, n_removed long, kept string")
    return every, changed


def digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words for every document."""
    every, changed = removable(docs, width)
    changed = changed.select("row", "n_removed", F.sha2("kept", 256).alias("cut_sha"))
    return every.join(changed, "row", "left").select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and the kept words, joined by one space, of every document."""
    every, changed = removable(docs, width)
    rows = numbered(docs).select("row", "text")
    whole = F.concat_ws(" ", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return every.join(rows, "row").join(changed, "row", "left").select("doc_id", F.when(F.col("copy"), "").otherwise(F.coalesce("kept", whole)).alias("text"))
