"""N-gram Jaccard join by T-occurrence search.

Two documents link when their shingle sets have a Jaccard similarity of
``percent`` hundredths or more.  The result is the connected components of all
such links.

1. Documents with equal sets are one class; only its first document goes on.
2. Prefix filter: of each set in hash order a prefix is listed that is long
   enough for a linked pair to share ``slack`` times its size in tokens.
   Documents that share fewer with all others are done: they have no link.
3. The others fall into blocks, the components of "shares a prefix token".  As a
   linked pair shares ``slack`` tokens, each of the two can do without somewhat
   less than half as many: its most frequent ones, so that passages which many
   documents have do not draw unrelated ones into one block.
4. In a block, each document asks the inverted lists for all earlier ones that
   reach the overlap T its size demands: short lists are merged and counted,
   what reaches T less the number of long lists is probed in those by binary
   search (DivideSkip).  Documents already known to be connected are not probed.
   Blocks over ``block_tokens`` are split into chunks.  Each chunk is searched by
   itself and against the block's first one; that mostly leaves one large
   component, its core, since a block forms around a text that has many near
   copies.  Documents of the core need no more comparison with each other: what
   isn't in the core is dealt into chunks of its own, which are searched against
   each other and against the core's.
5. Links join classes; each gets its smallest doc_id.  What many rows have in
   common (a class of copies, a token) is joined by a broadcast of the few values
   that are so frequent, or in salted parts.

Defined results: null, empty and blank texts have an empty set and are linked
with nothing; repeated rows are a class; null ids come last; an empty table
gives an empty result.  ``docs`` must be a scan or another input whose rows come
in the same partitions each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_ROWS, Words, discard, id_text, joined_by_key, ngram_hashes, release_memory, small, tidy, written, written_at
from .components import components

SHINGLE, PERCENT = 4, 85
SLACK = 10  # hundredths of a set that a linked pair shares within the prefixes at least
BLOCK_TOKENS = 500_000


def shingles(texts, n: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes in ascending order; a text under n words is one shingle as a whole."""
    words = Words(texts, lower=True)
    for k, m in enumerate(words.counts.tolist()):
        yield np.unique(ngram_hashes(words.of(k), min(n, m))) if m else np.zeros(0, np.uint64)


def least_partner(n: int, percent: int) -> int:
    """The least size of a set that can link with one of size n, which is also the least overlap of the two."""
    return -(-percent * n // 100)


def slack_of(n: int) -> int:
    return max(1, SLACK * n // 100)


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - least_partner(n, percent) + slack_of(n))


def _profiles(rows: DataFrame, n: int, percent: int) -> DataFrame:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for batch in batches:
            out = []
            for row, doc_id, s in zip(batch["row"], batch["doc_id"], shingles(batch["text"], n)):
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                out.append((row, doc_id, len(s), (d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63, s[: prefix_length(len(s), percent)].astype(np.int64)))
            frame = pd.DataFrame(out, columns=["row", "doc_id", "n", "d1", "d2", "prefix"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return rows.mapInPandas(tidy(scan), "row long, doc_id long, n long, d1 long, d2 long, prefix array<long>")


class Connected:
    """Union-find over the places of a block."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def divide_skip(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what the similarity connects: a spanning forest over places of ``sets``.

    With ``side`` only pairs from different sides are compared.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    order = np.argsort(size, kind="stable")  # partners of a set come before it and are not too small
    rank_size = size[order]
    _, token = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(rank_size)])
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), rank_size)
    by_token = np.argsort(token, kind="stable")
    count = np.bincount(token)
    begin = np.concatenate([[0], np.cumsum(count)])
    lists = owner[by_token]
    known, links = Connected(len(sets)), []
    for x in range(1, len(sets)):
        n = int(rank_size[x])
        mine = token[starts[x] : starts[x + 1]]
        mine = mine[count[mine] > 1]
        need = least_partner(n, percent)
        if len(mine) < need:
            continue
        low = int(np.searchsorted(rank_size, need))
        mine = mine[np.argsort(count[mine], kind="stable")]
        longest = int(count[mine[-1]])
        n_long = min(need - 1, int(need / (0.05 * np.log2(longest + 1) + 1)))
        short, long = mine[: len(mine) - n_long], mine[len(mine) - n_long :]
        merged = np.concatenate([lists[begin[t] : begin[t + 1]] for t in short])
        merged = merged[(merged < x) & (merged >= low)]
        found, times = np.unique(merged, return_counts=True)
        enough = times >= max(1, need - n_long)
        found, times = found[enough], times[enough]
        if side is not None:
            apart = side[order[found]] != side[order[x]]
            found, times = found[apart], times[apart]
        long = np.sort(long)
        for k in np.argsort(-times, kind="stable"):
            y = int(found[k])
            m = int(rank_size[y])
            demand = -(-percent * (n + m) // (100 + percent))
            if times[k] + n_long < demand or known.root(x) == known.root(y):
                continue
            theirs = token[starts[y] : starts[y + 1]]  # ascending: sets are
            at = np.searchsorted(theirs, long)
            overlap = int(times[k]) + int((theirs[np.minimum(at, m - 1)] == long).sum())
            if 100 * overlap >= percent * (n + m - overlap):
                known.join(x, y)
                links.append((int(order[x]), int(order[y])))
    return links


def blocked(tokens: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """row, n and block of the rows that share enough of their tokens (row, token), each a prefix of its set, with others; n as in sizes."""
    often = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = written(tokens.join(often, "token"), "shared")
    least = F.ceil(F.col("n") * percent / 100)
    enough = F.greatest(F.lit(1), F.floor(least * SLACK / 100))
    active = shared.groupBy("row").agg(F.count("*").alias("shared")).join(sizes, "row").where(F.col("shared") >= enough)
    active = written(active.select("row", "n"), "active")
    held = shared.join(small(active.withColumn("spare", F.floor((enough - 1) / 2)).select("row", "spare")), "row")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("df"), "token"))  # within a document
    salt = F.when(F.col("df") > HOT_ROWS, F.pmod(F.xxhash64("row"), F.ceil(F.col("df") / HOT_ROWS))).otherwise(0).alias("salt")
    held = written(held.withColumn("rank", rank).where("rank > spare").select("row", "token", salt), "held")
    # Each row to the least of its token and salt, and these to the least of the token.
    part = held.groupBy("token", "salt").agg(F.min("row").alias("b"), F.count("*").alias("m"))
    least = part.groupBy("token").agg(F.min("b").alias("least"), F.sum("m").alias("df")).where("df > 1").select("token", "least")
    pivot = written(part.join(least, "token").select("token", "salt", "b", "least"), "pivot")
    edges = held.join(pivot, ["token", "salt"]).select(F.col("row").alias("a"), "b").union(pivot.select(F.col("b").alias("a"), F.col("least").alias("b"))).distinct()
    return written(active.join(components(edges), F.col("row") == F.col("node")).select("row", "n", F.col("root").alias("block")), "blocks")


def rarest(listed: DataFrame, percent: int) -> DataFrame:
    """(row, token): of each set (row, n, shingles) the prefix in order of how many of these sets hold a shingle, the rarest first."""
    tokens = listed.select("row", "n", F.explode("shingles").alias("token"))
    held_by = written(tokens.groupBy("token").agg(F.count("*").alias("sets")), "held-by")
    counted = joined_by_key(tokens, held_by.withColumn("rows", F.col("sets")), ["token"], "rows")
    rank = F.row_number().over(Window.partitionBy("row").orderBy("sets", "token"))  # within a document
    length = F.least(F.col("n"), F.col("n") - F.ceil(F.col("n") * percent / 100) + F.greatest(F.lit(1), F.floor(F.col("n") * SLACK / 100)))
    return written(counted.withColumn("rank", rank).where(F.col("rank") <= length).select("row", "token"), "rarest")


def planned(blocks: DataFrame, block_tokens: int) -> DataFrame:
    """row, n, block, chunks of the block, and the row's own chunk, for rows of blocks that have others."""
    total = written(blocks.groupBy("block").agg(F.sum("n").alias("total"), F.count("*").alias("members")).where("members > 1"), "totals")
    plan = joined_by_key(blocks, total, ["block"], "members")
    plan = plan.withColumn("chunks", F.when(F.col("total") <= block_tokens, 1).otherwise(F.ceil(F.col("total") / max(1, block_tokens // 2))).cast("int"))
    return written(plan.withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int")).select("row", "n", "block", "chunks", "chunk"), "plan")


def linked(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """row, doc_id, n_shingles, component_id (smallest doc_id reachable by links) and component_row (its row) for every row of docs.

    Rows are numbered by monotonically_increasing_id().
    """
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    level = written(_profiles(rows, n, percent), "profiles")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    classes = level.where("n > 0").groupBy("d1", "d2").agg(F.min(order).alias("first"), F.count("*").alias("members"))
    classes = written(classes.select("d1", "d2", "members", F.col("first.row").alias("first_row"), F.col("first.doc_id").alias("first_id")), "classes")
    # Rows that aren't the first of their class; few of many, so that this join can be small.
    more = level.where("n > 0").select("row").join(classes.select(F.col("first_row").alias("row")), "row", "left_anti")
    firsts = level.where("n > 0").select("row", "n", "prefix").join(small(written(more, "copies")), "row", "left_anti")

    blocks = blocked(firsts.select("row", F.explode("prefix").alias("token")), level.select("row", "n"), percent)
    plan = planned(blocks, block_tokens)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns=["text"]).assign(shingles=[s.astype(np.int64) for s in shingles(batch["text"], n)])

    def sets_of(dealt: DataFrame) -> DataFrame:
        wanted = rows.select("row", "text").join(small(dealt), "row").select("row", "text", "n", "block", "chunks", "chunk")
        return wanted.mapInPandas(tidy(sets), "row long, n long, block long, chunks int, chunk int, shingles array<long>")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row")
        held = [np.asarray(x, np.int64).view(np.uint64) for x in frame["shingles"]]
        side = frame["chunk"].to_numpy() if frame["i"].iloc[0] != frame["j"].iloc[0] else None
        row = frame["row"].to_numpy()
        links = divide_skip(held, percent, side)
        del held
        release_memory()
        return pd.DataFrame({"a": [row[x] for x, _ in links], "b": [row[y] for _, y in links]}, columns=["a", "b"])

    def searched(dealt: DataFrame) -> DataFrame:
        """Links within (block, i, i) and across (block, i, j)."""
        return dealt.select("row", "block", "chunk", "pair.i", "pair.j", "shingles").groupBy("block", "i", "j").applyInPandas(search, "a long, b long")

    half = max(1, block_tokens // 2)
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    large = plan.where("chunks > 1")
    if not large.isEmpty():
        listed, path = written_at(sets_of(large).select("row", "n", "shingles"), "large")
        parts = planned(blocked(rarest(listed, percent), listed.select("row", "n"), percent), block_tokens)
        discard(docs.sparkSession, path)
        plan = written(plan.where("chunks = 1").unionByName(parts), "plan")
        large = plan.where("chunks > 1")
    full = sets_of(plan)
    if large.isEmpty():
        links = searched(full.withColumn("pair", pair(F.lit(0), F.lit(0))))
    else:
        full = written(full, "sets")
        own, zero = F.col("chunk"), F.lit(0)
        first = F.array_distinct(F.when(own == 0, F.transform(F.sequence(zero, F.col("chunks") - 1), lambda j: pair(zero, j))).otherwise(F.array(pair(own, own), pair(zero, own))))
        links = written(searched(full.withColumn("pair", F.explode(first))), "links")
        label = components(links).select(F.col("node").alias("row"), "root")
        parts = written(large.join(label, "row", "left").withColumn("root", F.coalesce("root", "row")), "parts")
        core = parts.groupBy("block", "root").agg(F.count("*").alias("m")).groupBy("block").agg(F.max(F.struct("m", "root")).alias("core")).select("block", F.col("core.root").alias("core"))
        rest = written(parts.join(small(written(core, "cores")), "block").where("root <> core").select("row", "block", "n", "chunks"), "rest")
        shares = rest.groupBy("block").agg(F.ceil(F.sum("n") / half).cast("int").alias("others"))  # only blocks that have others than the core
        dealt = full.join(small(written(shares, "shares")), "block").join(small(rest.select("row", F.lit(True).alias("other"))), "row", "left")
        # Chunks from ``chunks`` on are of others than the core.
        dealt = dealt.withColumn("chunk", F.when(F.col("other"), F.col("chunks") + F.pmod(F.xxhash64("row", F.lit(1)), F.col("others"))).otherwise(F.col("chunk")).cast("int"))
        others = F.sequence(F.col("chunks"), F.col("chunks") + F.col("others") - 1)
        every = F.sequence(zero, F.col("chunks") + F.col("others") - 1)
        pairs = F.when(F.col("other"), F.transform(every, lambda j: pair(F.least(j, own), F.greatest(j, own)))).otherwise(F.transform(others, lambda j: pair(own, j)))
        links = links.union(searched(dealt.withColumn("pair", F.explode(pairs))))

    links = written(links, "links")
    joined = components(links).join(classes.select(F.col("first_row").alias("node"), "first_id"), "node")
    least = joined.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull().alias("no_id"), F.col("first_id").alias("doc_id"), F.col("node").alias("row"))).alias("least"))
    of = written(joined.join(least, "root").select(F.col("node").alias("first_row"), F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("component_row")), "components")
    named = classes.join(small(of), "first_row", "left").select("d1", "d2", "members", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("component_row", "first_row").alias("component_row"))
    held = level.select("row", "doc_id", "n", "d1", "d2")
    of_class = joined_by_key(held.where("n > 0"), written(named, "named"), ["d1", "d2"], "members")
    columns = ["row", "doc_id", F.col("n").alias("n_shingles"), "component_id", "component_row"]
    alone = held.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("component_row", F.col("row"))
    return of_class.select(*columns).union(alone.select(*columns))


def one_of_each(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns, that come first in their component (smallest doc_id)."""
    stays = written(linked(docs, n, percent).where("row = component_row").select(F.col("row").alias("__row")), "stays")
    return docs.withColumn("__row", F.monotonically_increasing_id()).join(small(stays), "__row", "left_semi").drop("__row")
