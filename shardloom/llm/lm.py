"""Language-model scores: a word unigram base over the whole corpus, and a causal
self-attention model over subword ids.

The base counts the words of all training documents exactly.  Each chunk of
documents lists its distinct words once and writes its texts as numbers; counts
are aggregated over all chunks and joined back to the chunks, so a word that every
document holds costs one row a chunk, and no vocabulary is broadcast.  The subword ids of all training
documents are counted in the same scan.  The attention model is begun on the
driver with pieces drawn from anywhere in them; from there it learns from every
block of every training document: the chunks' texts descend in parts, each block
once, and the weights are averaged.  Every document is scored as a whole, in
overlapping windows that score each token once.  Its tokens are the subword ids
of each word with a space before it, and one end id.  A word's probability is the
mean of what attention gives its subwords and of its share in the counts, so the
score, too, rests on all words of the training documents.

Defined results: a null or empty text has one token, its end; repeated rows are
counted and scored one by one; a null id is a training document's; an empty
table gives an empty result.  ``docs`` must be a scan or another input whose
rows come in the same partitions each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import attention
from .common import Words, id_text, mix64, release_memory, tidy, written
from .packing import Encoder

#: Documents of a chunk, by the bytes of their texts: (below, documents), so that a chunk has about 100 MB at most; of longer texts each is one.
CHUNKS = ((1 << 14, 6_000), (1 << 18, 400), (1 << 22, 24))
#: Words that are scored or learned from at a time, or one text if it has more.
PART_WORDS = 300_000
#: The share of the attention model in a word's probability; the corpus's word counts have the rest.
ATTENDED = 0.5
#: Words of a piece, and the share of all pieces drawn for the beginning at least; a corpus of up to ALL_DOCS documents gives all.
PIECE_WORDS, SHARE, ALL_DOCS = 96, 1 / 64, 2_000
#: Pieces that the model is begun with on the driver.
BEGIN_PIECES = 8_000
END = 0
#: What a row of the first scan holds: a word of a chunk, a count of a subword id, a piece, or a chunk's texts as numbers.
WORD, ID, PIECE, TEXTS = range(4)
SCAN = "kind byte, chunk long, word long, k int, n long, ids binary, length binary, place binary, sizes binary, docs array<long>, held_out array<boolean>"


def subwords(encoder: Encoder, words: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, each with a space before it, one after the other, and how many each word has.

    The words are encoded in one go: a word's first id, and no other, spells a
    leading space, since the splitting pattern never puts a space inside a piece
    that begins with something else and words hold none.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.frombuffer(encoder(words.decode("utf-8", "replace")), "<u4").astype(np.int64)
    first = np.flatnonzero(encoder.spaced[ids])
    if len(first) != words.count(b" "):  # white space of other alphabets at a word's edge
        each = [np.frombuffer(encoder(" " + w.decode("utf-8", "replace")), "<u4") for w in words[1:].split(b" ")]
        return np.concatenate(each).astype(np.int64), np.fromiter(map(len, each), np.int64, len(each))
    return ids, np.diff(np.append(first, len(ids)))


def chunked(docs: DataFrame, chunks: tuple[tuple[int, int], ...] = CHUNKS) -> DataFrame:
    """doc_id, text, row, held_out, and the chunk: so many rows of a partition, one after the other, by how long their texts are."""
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    at, kind, size = F.col("row").bitwiseAND(2**33 - 1), F.lit(len(chunks)), F.lit(1)
    for k, (below, n) in reversed(list(enumerate(chunks))):
        fits = F.octet_length("text") < below
        kind, size = F.when(fits, k).otherwise(kind), F.when(fits, n).otherwise(size)
    return rows.withColumn("held_out", F.coalesce(held_out, F.lit(False))).withColumn("chunk", (F.col("row") - at % size) * 4 + kind)


def drawn(digest: int, n_words: int, share: float) -> list[int]:
    """Places of the pieces drawn from a text."""
    return all_drawn(np.asarray([digest % 2**64], np.uint64), np.asarray([n_words]), share)[1].tolist()


def all_drawn(digests: np.ndarray, n_words: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The text and the place of each piece drawn from texts."""
    n = np.maximum(1, -(-n_words // PIECE_WORDS))
    text = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    pick = np.flatnonzero(mix64(at.astype(np.uint64) + digests[text]) < np.uint64(min(share * 2**64, 2**64 - 1025)))
    return text[pick], at[pick] * PIECE_WORDS


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed; their bytes are parted by weight, since most numbers are small."""
    import zstandard

    held = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.ascontiguousarray(held[:, k]) for k in range(4)]))


def unpacked(raw: bytes) -> np.ndarray:
    import zstandard

    held = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(held.T).view("<u4").ravel()


class Chunk:
    """Documents read so far of one chunk."""

    def __init__(self, number: int):
        self.number, self.words, self.docs, self.held_out = number, [], [], []

    def add(self, part: pd.DataFrame) -> None:
        self.words.append(Words(part["text"], lower=True))
        self.docs += [None if pd.isna(x) else int(x) for x in part["doc_id"]]
        self.held_out += part["held_out"].tolist()

    def spelled(self, places: np.ndarray) -> bytes:
        """The words at the given ascending places among all words, each with a space before it."""
        out, lo = [], 0
        for w in self.words:
            k = places[np.searchsorted(places, lo) : np.searchsorted(places, lo + len(w.hashes))] - lo
            size = w.ends[k] - w.starts[k] + 1
            to = np.cumsum(size) - size
            raw = np.frombuffer(w.raw, np.uint8)[np.repeat(w.starts[k] - 1 - to, size) + np.arange(int(size.sum()))]
            raw[to] = 32
            out.append(raw.tobytes())
            lo += len(w.hashes)
        return b"".join(out)

    def listed(self, encoder: Encoder, met: np.ndarray, share: float) -> Iterator[pd.DataFrame]:
        """The rows of chunk_words(); counts of subword ids are added to ``met``."""
        hashes, sizes = np.concatenate([w.hashes for w in self.words]), np.concatenate([w.counts for w in self.words])
        place, word = pd.factorize(hashes)  # numbered as they first come
        first = np.empty(len(word), np.int64)
        first[place[::-1]] = np.arange(len(place))[::-1]
        n = np.bincount(place, weights=np.repeat(~np.asarray(self.held_out), sizes), minlength=len(word)).astype(np.int64)
        ids, length = subwords(encoder, self.spelled(first))
        start = np.cumsum(length) - length
        np.add.at(met, ids, np.repeat(n, length))
        ids_of = lambda a, b: [ids[start[w] : start[w] + length[w]] for w in place[a:b]]
        end, pieces = np.asarray([END]), []
        upto, summed = np.cumsum(np.append(0, sizes)), np.append(np.uint64(0), np.cumsum(hashes))
        lo, hi = upto[:-1], upto[1:]
        texts = np.flatnonzero(~np.asarray(self.held_out))
        for k, a in zip(*(x.tolist() for x in all_drawn((summed[hi] - summed[lo])[texts], sizes[texts], share))):
            first_word, size = int(lo[texts[k]]), int(sizes[texts[k]])
            b = min(a + PIECE_WORDS, size)
            before = ids_of(first_word + a - 1, first_word + a)[0][-1:] if a else end
            pieces.append(np.concatenate([before, *ids_of(first_word + a, first_word + b), *([end] if b == size else [])]).astype("<u4").tobytes())
        yield _rows(kind=WORD, chunk=self.number, word=word.view(np.int64), k=np.arange(len(word)), n=n)
        if pieces:
            yield _rows(kind=PIECE, ids=pieces)
        numbers = {"ids": ids, "length": length, "place": place, "sizes": sizes}
        yield _rows(kind=TEXTS, chunk=self.number, docs=[self.docs], held_out=[self.held_out], **{k: [packed(v)] for k, v in numbers.items()})


def _rows(**columns) -> pd.DataFrame:
    """Rows of SCAN with the given columns."""
    given = pd.DataFrame(columns)
    return given.assign(**{c: None for c in (x.split()[0] for x in SCAN.split(", ")) if c not in given})


def chunk_words(rows: DataFrame, path: str, pattern: str, share: float) -> DataFrame:
    """One scan of all texts: for each chunk its distinct words (hash, number k, count n in its training documents) and its texts as numbers of words and subword ids of each word.

    Besides, of the training documents, how often a task met each subword id
    (word), without ends, and the subword ids of the pieces drawn, each led by
    the id before it.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, pattern)
        met = np.zeros(encoder.encoding.n_vocab, np.int64)
        chunks: dict[int, Chunk] = {}  # the one that is being read, by the kind of its texts' length
        for batch in batches:
            for number, part in batch.groupby("chunk", sort=False):
                if (now := chunks.get(number % 4)) is None or now.number != number:
                    if now is not None:
                        yield from now.listed(encoder, met, share)
                    now = chunks[number % 4] = Chunk(number)
                now.add(part)
        for now in chunks.values():
            yield from now.listed(encoder, met, share)
        some = np.flatnonzero(met)
        if len(some):
            yield _rows(kind=ID, word=some, n=met[some])

    return rows.select("chunk", "doc_id", "text", "held_out").mapInPandas(tidy(scan), SCAN)


def fitted(listed: DataFrame, n_ids: int, ends: int) -> attention.Model:
    """The attention model, with the counts, begun with pieces and fitted on all training texts that chunk_words() lists; ``ends`` training documents."""
    counts = np.zeros(n_ids, np.int64)
    for r in listed.where(F.col("kind") == ID).groupBy("word").agg(F.sum("n").alias("n")).collect():  # a row for each id at most
        counts[r.word] = r.n
    counts[END] += ends
    pieces = written(listed.where(F.col("kind") == PIECE).select("ids", F.xxhash64("ids").alias("h")), "pieces")
    array = lambda ids: np.frombuffer(ids, "<u4").astype(np.int64)
    n_pieces = pieces.count()
    few = pieces.where(F.pmod("h", F.lit(2**20)) < int(2**20 * min(1.0, 1.1 * BEGIN_PIECES / max(1, n_pieces))))  # else each task sends so many
    begin = [array(r.ids) for r in few.orderBy("h", "ids").limit(BEGIN_PIECES).collect()]
    model = attention.trained(begin, n_ids, END, counts=counts)
    names = sorted(model.weights)
    shared = listed.sparkSession.sparkContext.broadcast((model.weights, model.known))  # of fixed size

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, known = shared.value
        total, blocks, first = {k: np.zeros(v.size) for k, v in weights.items()}, 0, None
        for batch in batches:
            for held in batch.itertuples(index=False):
                first = held.chunk if first is None else first
                for texts in training(held, known):
                    found, n = attention.refined(weights, texts)
                    blocks += n
                    for k in names:
                        total[k] += found[k].ravel().astype(np.float64) * n
        if blocks:
            yield pd.DataFrame({"part": first, "name": names, "blocks": blocks, "weights": [total[k] for k in names]})

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        total = 0.0
        for w in frame.sort_values("part")["weights"]:
            total = total + w
        return pd.DataFrame({"name": [frame["name"].iloc[0]], "weights": [total / frame["blocks"].sum()]})

    texts = listed.where(F.col("kind") == TEXTS).select("chunk", "ids", "length", "place", "sizes", "held_out")
    found = texts.mapInPandas(tidy(descend), "part long, name string, blocks long, weights array<double>")
    averaged = found.groupBy("name").applyInPandas(mean, "name string, weights array<double>").collect()  # of fixed size
    if not averaged:
        return model
    weights = {r.name: np.asarray(r.weights, np.float32).reshape(model.weights[r.name].shape) for r in averaged}
    return attention.Model(weights, model.known, model.rare)


def training(held, known: np.ndarray) -> Iterator[list[np.ndarray]]:
    """All training documents of a chunk as model ids, led and closed by the end id, in parts of about PART_WORDS words."""
    ids, length, place, sizes = (unpacked(x) for x in (held.ids, held.length, held.place, held.sizes))
    ids, length = known[ids], length.astype(np.int64)
    start, end = np.cumsum(length) - length, known[END : END + 1]
    part, words, hi = [], 0, 0
    for size, held_out in zip(sizes.tolist(), held.held_out):
        lo, hi = hi, hi + size
        if held_out:
            continue
        n = length[place[lo:hi]]
        at = np.repeat(start[place[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        part.append(np.concatenate([end, ids[at], end]))
        words += size
        if words >= PART_WORDS:
            yield part
            part, words = [], 0
    if part:
        yield part


class Scorer:
    """Scores the documents of a chunk, given as numbers, and the counts of the chunk's words."""

    def __init__(self, model: attention.Model, share: float = ATTENDED):
        self.model, self.tables, self.share = model, model.tables(), share

    def __call__(self, ids: np.ndarray, length: np.ndarray, place: np.ndarray, sizes: np.ndarray, count: np.ndarray, end_count: int, total: int, distinct: int) -> dict[str, np.ndarray]:
        of_all = np.log10(total + distinct + 1)
        logs = np.log10(count + 1)
        of_end = np.log10(end_count + 1) - of_all
        found = {"n_tokens": sizes + 1, "n_known": np.zeros(len(sizes), np.int64), "base_score": np.zeros(len(sizes)), "score": np.zeros(len(sizes))}
        upto = np.cumsum(sizes)
        lo = 0
        while lo < len(sizes):
            start = int(upto[lo] - sizes[lo])
            hi = max(lo + 1, int(np.searchsorted(upto, start + PART_WORDS, side="right")))
            here, n, now = place[start : upto[hi - 1]].astype(np.int64), sizes[lo:hi], slice(lo, hi)
            text = np.repeat(np.arange(hi - lo), n)
            summed = lambda of_word: np.bincount(text, weights=of_word, minlength=hi - lo)  # noqa: B023, E731
            found["base_score"][now] = summed(logs[here]) + np.log10(end_count + 1) - (n + 1) * of_all
            found["n_known"][now] = summed((count > 0)[here]) + (end_count > 0)
            attended, ends = self.attended(ids, length, here, text, n)
            found["score"][now] = summed(self.mixed(attended, logs[here] - of_all)) + self.mixed(ends, np.full(hi - lo, of_end))
            lo = hi
        return found

    def mixed(self, attended: np.ndarray, counted: np.ndarray) -> np.ndarray:
        """log10 probability of a word that is drawn by the attention model with probability ``share``, else by its count."""
        e = np.log(10)
        return np.logaddexp(attended * e + np.log(self.share), counted * e + np.log(1 - self.share)) / e

    def attended(self, raw: np.ndarray, length: np.ndarray, place: np.ndarray, text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The attention model's log10 probability of each word, and of each text's end."""
        model = self.model
        start = np.cumsum(length) - length
        ids = model.known[raw]
        # Words' ids one after the other, each text led and closed by the end id.
        n = length[place]
        per_text = np.bincount(text, weights=n, minlength=len(sizes)).astype(np.int64)
        starts = np.cumsum(per_text + 2) - (per_text + 2)
        out = np.full(int((per_text + 2).sum()), model.known[END], np.int32)
        before = np.cumsum(n) - n
        inner = np.ones(len(out), bool)
        inner[starts] = inner[starts + per_text + 1] = False
        out[inner] = ids.take(np.repeat(start[place] - before, n) + np.arange(int(n.sum())))
        found = attention.token_scores(model, self.tables, out, starts, per_text + 1)
        of_word = np.add.reduceat(found[inner].astype(np.float64), before) if len(before) else np.zeros(0)
        if len(length):
            of_word += np.add.reduceat(np.where(ids == attention.RARE, model.rare[raw], 0.0), start)[place]
        return of_word, found[starts + per_text + 1].astype(np.float64) + (model.rare[END] if model.known[END] == attention.RARE else 0.0)


def scored(docs: DataFrame, path: str, pattern: str, chunks: tuple[tuple[int, int], ...] = CHUNKS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row of docs."""
    spark = docs.sparkSession
    rows = chunked(docs, chunks)
    ends = rows.where(~F.col("held_out")).count()
    every = written(chunk_words(rows, path, pattern, min(1.0, max(SHARE, ALL_DOCS / max(1, ends)))), "chunk-words", "zstd")
    listed = every.where(F.col("kind") == WORD).select("chunk", "word", "k", "n")
    # One shuffle: a word has a row a chunk at most, and a window over more of them than memory holds is spilled.
    by_word = Window.partitionBy("word")
    counted = listed.select("chunk", "k", "n", F.sum("n").over(by_word).alias("c"), (F.min("chunk").over(by_word) == F.col("chunk")).alias("first"))
    counts = written(counted.where("c > 0"), "counts", "zstd")
    words = counts.agg(F.count_if("first").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    total, distinct = words.total + ends, words.distinct + (ends > 0)
    model = fitted(every, Encoder(path, pattern).encoding.n_vocab, ends)
    shared = spark.sparkContext.broadcast((model.weights, model.known, model.rare))  # of fixed size
    made: list[Scorer] = []  # one for each task
    vocabulary = counts.select(F.col("chunk").alias("of_chunk"), "k", "c")

    def score(texts: pd.DataFrame, vocabulary: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(Scorer(attention.Model(*shared.value)))
        held = texts.iloc[0]  # a chunk is one row
        ids, place = (unpacked(held[c]) for c in ("ids", "place"))
        length, sizes = (unpacked(held[c]).astype(np.int64) for c in ("length", "sizes"))
        count = np.zeros(len(length))
        count[vocabulary["k"].to_numpy()] = vocabulary["c"].to_numpy()
        found = made[0](ids, length, place, sizes, count, ends, total, distinct)
        release_memory()
        return pd.DataFrame({"doc_id": pd.array(list(held["docs"]), dtype="Int64"), "held_out": held["held_out"], **found})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    texts = every.where(F.col("kind") == TEXTS).select("chunk", "ids", "length", "place", "sizes", "docs", "held_out")
    out = texts.groupBy("chunk").cogroup(vocabulary.groupBy("of_chunk")).applyInPandas(score, schema)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
