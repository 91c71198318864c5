"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import HOT_ROWS, discard, in_order, joined_by_key, shared_dir, shuffle_partitions, small, table, written, written_at  # noqa: F401

#: Java spelling of the contract's word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z only.
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Rows that one Arrow batch takes to a Python worker; texts are long, and the session's default of 10,000 fills its memory.
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows``; a lower one stays."""
    now = int(spark.conf.get(_BATCH_CONF))
    if now <= 0 or now > rows:
        spark.conf.set(_BATCH_CONF, str(rows))


def release_memory() -> None:
    """Give back to the system what a worker process, which lives on after its task, no longer uses."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(scan):
    """scan, a generator over batches, that releases its worker's memory at the end."""

    def run(batches):
        yield from scan(batches)
        release_memory()

    return run


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and text only, a null text as the empty one; other columns cannot clash afterwards.

    Batches to Python workers become small from here on.
    """
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def lower_az(col):
    """Lower-case A-Z and nothing else (SQL's lower() would change other alphabets too)."""
    return F.translate(col, UPPER, LOWER)


def sampled(rows: DataFrame, n: int) -> DataFrame:
    """The rows of about n documents (at most n ids), the same ones each time; only ids are sorted, and only n of them are broadcast."""
    ids = rows.select("doc_id").dropna().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).distinct()
    return rows.join(F.broadcast(ids), "doc_id", "left_semi")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; bytes.split() cuts at exactly \\x20 and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of hashes spread over all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ngram_sums(word_hashes: np.ndarray, lengths) -> Iterator[tuple[int, np.ndarray]]:
    """For each length in ascending order, the sum of each run's word hashes, each times a power for its place: one product a word and length."""
    total, n, power = np.zeros(len(word_hashes), np.uint64), 0, 1
    for want in lengths:
        while n < want:
            m = max(0, len(word_hashes) - n)
            total = total[:m] + word_hashes[n:] * np.uint64(power)
            n, power = n + 1, power * int(_MIX) % 2**64
        yield n, total


def ngram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash for each run of n words; shorter texts have none."""
    if len(word_hashes) < n or n <= 0:
        return np.zeros(0, np.uint64)
    return mix64(next(ngram_sums(word_hashes, [n]))[1] + np.uint64(n))


#: Bytes hashed at a time; what is computed for each of them stays in a processor's cache.
SLICE = 1 << 16
#: Stands between texts: no byte of UTF-8.
BETWEEN = b"\xff"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32, 255]] = True
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * _MIX)
_POWER = np.cumprod(np.full(SLICE + 1, int(_MIX) | 1, np.uint64))


class Words:
    """The words of many texts, laid out one after the other.

    ``hashes`` has a 64-bit hash for each word, ``starts`` and ``ends`` its bytes in
    ``raw``, ``counts`` the number of words of each text and ``at`` where each
    text's words begin.  A word's hash is a polynomial in its bytes, taken from
    prefix sums, so that no word becomes an object of its own.
    """

    def __init__(self, texts: Iterable[str | None], lower: bool = False, without: bytes = b""):
        raw = BETWEEN.join([t.encode("utf-8", "surrogatepass") if t else b"" for t in texts] + [b""])
        self.raw = raw.translate(LOWER_AZ if lower else None, without) if lower or without else raw
        letters = np.frombuffer(self.raw, np.uint8)
        inside = ~_SPACE[letters]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.starts, self.ends = edge[::2], edge[1::2]
        between = np.flatnonzero(letters == BETWEEN[0])
        upto = np.searchsorted(self.starts, between)
        self.counts = np.diff(upto, prepend=0)
        self.at = upto - self.counts
        self.hashes = np.empty(len(self.starts), np.uint64)
        lo = 0
        while lo < len(self.starts):
            base = int(self.starts[lo])
            hi = int(np.searchsorted(self.ends, base + SLICE, side="right"))
            if hi == lo:  # a word longer than a slice
                self.hashes[lo] = self._long(self.raw[base : int(self.ends[lo])])
                lo += 1
                continue
            n = int(self.ends[hi - 1]) - base
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_LETTER[letters[base : base + n]] * _POWER[:n], out=sums[1:])
            a, b = self.starts[lo:hi] - base, self.ends[lo:hi] - base
            self.hashes[lo:hi] = mix64((sums[b] - sums[a]) * _POWER[SLICE - a] + (b - a).astype(np.uint64))
            lo = hi

    @staticmethod
    def _long(word: bytes) -> int:
        import xxhash

        return xxhash.xxh3_64_intdigest(word)

    def __len__(self) -> int:
        return len(self.counts)

    def of(self, k: int) -> np.ndarray:
        """Hashes of the words of text k."""
        return self.hashes[self.at[k] : self.at[k] + self.counts[k]]

    def spelled(self, k: int) -> bytes:
        """Word k of all."""
        return self.raw[self.starts[k] : self.ends[k]]
