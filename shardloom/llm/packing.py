"""Best-fit packing of tokenised documents into sequences of bounded length.

Lengths are at most ``capacity``, so their histogram is small at any input size.
The driver plans on that histogram alone: an index over single, pair and triple
length sums finds combinations that fill a gap exactly, as many copies at once
as the counts allow; what is left goes best-fit.  The plan is a list of sequence
kinds with multiplicities.  Pieces are numbered within their length in parallel
(counts by bucket, prefix sums over those counts, row numbers within a bucket)
and look their place up in the plan.

Defined results: a null or empty text is one piece holding its end id alone;
repeated rows are packed one by one; an empty table gives no sequence.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, shuffle_partitions, tidy, written

CAPACITY = 2048


def byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary file writes for each byte: itself if printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts for a byte-level BPE file of ``tokenizers``.

    The file's vocabulary, where ids are merge ranks, is run by tiktoken, which
    takes about a fifth of the time; tests hold the ids against ``tokenizers``.
    The file's special tokens count as such where they stand in a text, as they
    do there.
    """

    def __init__(self, path: str, pattern: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        special = {t["content"]: t["id"] for t in held["added_tokens"]}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): rank for token, rank in held["model"]["vocab"].items() if token not in special}
        #: For each id, whether it spells a leading space.
        self.spaced = np.zeros(max(held["model"]["vocab"].values()) + 1, bool)
        self.spaced[[rank for token, rank in ranks.items() if token.startswith(b" ")]] = True
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


def tokenised(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit) for every piece of every document.

    Only documents over ``capacity`` are cut; their first piece takes the remainder.
    """
    end = np.asarray([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_text = Encoder(tokenizer, pattern)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode_text(text) + end
                n = len(ids) // 4
                first = n if n <= capacity else (n - 1) % capacity + 1
                at = 0
                for piece, length in enumerate([first] + [capacity] * ((n - first) // capacity)):
                    out.append((doc_id, piece, at, length, ids[4 * at : 4 * (at + length)]))
                    at += length
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return id_text(docs).mapInPandas(tidy(encode), "doc_id long, piece int, start long, length long, ids binary")


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit for counts by length, longest first, many equal bins at a time: sequence kinds and how many of each; a kind may come twice."""
    open_bins: dict[int, list[list]] = defaultdict(list)  # gap -> [kind, copies]
    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            gap = next((g for g in sorted(open_bins) if g >= length and open_bins[g]), None)
            if gap is None:
                per = capacity // length
                full, rest = divmod(n, per)
                if full:
                    open_bins[capacity - per * length].append([(length,) * per, full])
                if rest:
                    open_bins[capacity - rest * length].append([(length,) * rest, 1])
                n = 0
            else:
                kind, copies = open_bins[gap].pop()
                k = min(copies, n)
                if copies > k:
                    open_bins[gap].append([kind, copies - k])
                open_bins[gap - length].append([(*kind, length), k])
                n -= k
            if gap is not None and not open_bins[gap]:
                del open_bins[gap]
    return [(kind, copies) for bins in open_bins.values() for kind, copies in bins]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequence kinds (lengths in place order) with how many sequences of each kind; uses every counted piece exactly once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    every = left.copy()
    kinds: dict[tuple[int, ...], int] = defaultdict(int)

    def take(*lengths: int) -> int:
        """Consume as many copies of the combination as the counts allow."""
        need = defaultdict(int)
        for x in lengths:
            need[x] += 1
        k = min(int(left[x]) // n for x, n in need.items())
        if k:
            for x, n in need.items():
                left[x] -= k * n
            kinds[lengths] += k
        return k

    def pairs(total: int, most: int) -> tuple[int, int] | None:
        """Two available lengths with the given sum, the larger one as long as possible and at most ``most``."""
        hi = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        if not len(hi):
            return None
        lo = total - hi
        fits = (left[hi] > 0) & (left[lo] > 0) & ((hi != lo) | (left[hi] > 1))
        at = int(np.argmax(fits)) if fits.any() else -1
        return (int(hi[at]), int(lo[at])) if at >= 0 else None

    if left[capacity]:
        take(capacity)
    for big in range(capacity - 1, 0, -1):
        while left[big]:
            left[big] -= 1  # the combination's first piece is set aside while its complement is sought
            gap, found = capacity - big, None
            if left[gap]:
                found = (gap,)
            elif (two := pairs(gap, min(big, gap - 1))) is not None:
                found = two
            else:
                for a in range(min(big, gap - 2), (gap - 1) // 3, -1):
                    if left[a]:
                        left[a] -= 1
                        three = pairs(gap - a, min(a, gap - a - 1))
                        left[a] += 1
                        if three is not None:
                            found = (a, *three)
                            break
            left[big] += 1
            if found is None or not take(big, *found):
                break
    for kind, copies in best_fit(left, capacity):
        kinds[kind] += copies
    # Exact combinations may use up the short pieces that long ones need.
    plain: dict[tuple[int, ...], int] = defaultdict(int)
    for kind, copies in best_fit(every, capacity):
        plain[kind] += copies
    kinds = min(kinds, plain, key=lambda found: sum(found.values()))
    return sorted(kinds.items(), reverse=True)


def places(kinds: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the runs (first rank, first sequence, offset) in rank order: rank r of a run sits in sequence first + r - first rank."""
    runs: dict[int, list] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for kind, copies in kinds:
        at = 0
        for length in kind:
            runs[length].append((used[length], sequence, at))
            used[length] += copies
            at += length
        sequence += copies
    return {k: np.asarray(v, np.int64) for k, v in runs.items()}


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length and any payload), gapless from 0 in every sequence."""
    spark = pieces.sparkSession
    pieces = written(pieces, "pieces")
    buckets = max(64, 8 * shuffle_partitions(spark))
    pieces = pieces.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs = places(plan(counts, capacity))
    shared = spark.sparkContext.broadcast(runs)  # bounded by the number of distinct lengths, not by the input
    by_bucket = pieces.groupBy("length", "__bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_bucket = by_bucket.select("length", "__bucket", before.alias("__before"))
    within = F.row_number().over(Window.partitionBy("__bucket", "length").orderBy("doc_id", "piece", "start"))
    ranked = pieces.withColumn("__within", within - 1).join(by_bucket, ["length", "__bucket"]).withColumn("__rank", F.col("__before") + F.col("__within"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["__rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                run = table[int(x)]
                k = np.searchsorted(run[:, 0], rank[at], side="right") - 1
                sequence[at] = run[k, 1] + rank[at] - run[k, 0]
                offset[at] = run[k, 2]
            yield batch.drop(columns=["__rank"]).assign(sequence_id=sequence, offset=offset)

    ranked = ranked.drop("__bucket", "__before", "__within")
    kept = [f for f in ranked.schema if f.name != "__rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, `offset` long"
    return ranked.mapInPandas(tidy(place), schema)
