"""train/val/test assignment with largest-remainder allocation.

The order within a split is that of md5(seed:id): the same in any engine and at
any parallelism, with the counts and proportions of a seeded shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import in_order, small, written

RATIOS = {"train": 0.8, "val": 0.15, "test": 0.05}


#: Splits with a place of their own; others follow in the order given.
FIRST = {"train": 0, "val": 1, "test": 2}


def ordered(ratios: Mapping[str, float]) -> list[str]:
    """Names of the splits by place."""
    return sorted(ratios, key=lambda name: FIRST.get(name, len(FIRST)))


def shuffle_key(identity: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), identity.cast("string")))


def allocate(n: int, ratios: Mapping[str, float], credits: Sequence[float] | None = None) -> tuple[list[int], list[float]]:
    """Counts by largest remainder, and what each split is owed afterwards.

    Whole shares come first.  Items that remain go round by descending remainder,
    ties to the earlier split.  Where credit makes the whole shares too many, the
    split of least remainder gives back all it can, then the next one.
    """
    weight = np.asarray([ratios[name] for name in ordered(ratios)], float)
    due = n * weight / weight.sum() + (0.0 if credits is None else np.asarray(credits, float))
    whole = np.maximum(np.floor(due), 0).astype(int)
    remainder, left = due - whole, n - int(whole.sum())
    if left >= 0:
        rank = np.empty(len(due), int)
        rank[np.argsort(-remainder, kind="stable")] = np.arange(len(due))
        counts = whole + left // len(due) + (rank < left % len(due))
    else:
        order = np.argsort(remainder, kind="stable")
        before = np.cumsum(whole[order]) - whole[order]  # what those of less remainder can give
        counts = whole.copy()
        counts[order] -= np.clip(-left - before, 0, whole[order])
    return counts.tolist(), (due - counts).tolist()


def apportioned(sizes: DataFrame, group: str, n: str, ratios: Mapping[str, float] = RATIOS) -> DataFrame:
    """(group, split, count) by largest remainder, each group by itself: ranks over the few splits of a group, without the driver."""
    names, total = ordered(ratios), sum(ratios.values())
    splits = F.array(*(F.struct(F.lit(k).alias("place"), F.lit(name).alias("split"), (F.col(n) * F.lit(float(ratios[name])) / F.lit(float(total))).alias("due")) for k, name in enumerate(names)))
    held = sizes.select(group, n, F.inline(splits)).withColumn("whole", F.floor("due"))
    left = F.col(n) - F.sum("whole").over(Window.partitionBy(group))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(F.col("due") - F.col("whole")), "place"))
    return held.select(group, "split", (F.col("whole") + (rank <= left).cast("long")).cast("long").alias("count"))


def allocations(classes: list[tuple[int, int]], ratios: Mapping[str, float]) -> list[tuple[int, str, int, int]]:
    """(class, split, first rank, count) over classes in ascending order; what a class owes a split is carried to the next class."""
    out, owed = [], None
    for cls, n in sorted(classes):
        counts, owed = allocate(n, ratios, owed)
        out += [(cls, name, upto - c, c) for name, c, upto in zip(ordered(ratios), counts, accumulate(counts))]
    return out


def primary_class(labels: DataFrame, key: str, cls: str, order: str) -> DataFrame:
    """Mode of cls for each key, ties to the class seen first."""
    counted = labels.groupBy(key, cls).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counted.groupBy(key).agg(F.max_by(cls, F.struct("n", (-F.col("first")).alias("early"))).alias("primary"))


def assigned(files: DataFrame, identity: str, ratios: Mapping[str, float] = RATIOS, seed: int = 42, stratum: str | None = None) -> DataFrame:
    """files with a column split.

    Ranks are taken over all rows by range partitioning, never in one task; with
    a stratum the rank within it is the global rank less that of its first row.
    """
    spark = files.sparkSession
    held = files.withColumn("__class", F.col(stratum).cast("int") if stratum else F.lit(0)).withColumn("__key", shuffle_key(F.col(identity), seed))
    held = written(in_order(held, "__class", "__key", identity, name="__rank"), "ranked")
    sizes = held.groupBy("__class").agg(F.count("*").alias("n"), F.min("__rank").alias("first")).collect()  # a row a class
    first = {r["__class"]: r["first"] for r in sizes}
    plan = [(c, s, first[c] + at, first[c] + at + n) for c, s, at, n in allocations([(r["__class"], r.n) for r in sizes], ratios) if n]
    quota = spark.createDataFrame(plan, "__class int, split string, __from long, __to long")
    inside = (held["__class"] == quota["__class"]) & (held["__rank"] >= quota["__from"]) & (held["__rank"] < quota["__to"])
    return held.join(small(quota), inside).drop(quota["__class"]).drop("__class", "__key", "__rank", "__from", "__to")
