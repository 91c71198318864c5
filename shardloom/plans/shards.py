"""Records of shards, their verification, merge and comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType

RECORD = StructType([StructField("index", IntegerType()), StructField("queuePosition", IntegerType()), StructField("filename", StringType()), StructField("phash", StringType()), StructField("resized", BooleanType()), StructField("status", StringType()), StructField("droppedBy", StringType())])
PARTIAL = StructType([StructField("mean", ArrayType(DoubleType())), StructField("std", ArrayType(DoubleType())), StructField("total_pixels", LongType()), StructField("images_processed", IntegerType())])
RESULT = StructType([StructField("batchId", StringType()), StructField("worker", StringType()), StructField("backend", StringType()), StructField("inputCount", IntegerType()), StructField("outputCount", IntegerType()), StructField("durationMillis", LongType()), StructField("throughputPerSec", DoubleType()), StructField("outputFile", StringType()), StructField("partial", PARTIAL), StructField("stepTimingsMillis", MapType(StringType(), LongType()))])


def dropped_by(files: DataFrame, key: str, steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """files with dropped_by: the first step whose output lacks the key, null if it came through all."""
    out, lost = files, F.lit(None).cast("string")
    for i, (_, left) in enumerate(steps):
        out = out.join(left.select(F.col(key).alias(f"__k{i}")).distinct(), F.col(key) == F.col(f"__k{i}"), "left")
    for i, (name, _) in reversed(list(enumerate(steps))):
        lost = F.when(F.col(f"__k{i}").isNull(), name).otherwise(lost)
    return out.withColumn("dropped_by", lost).drop(*(f"__k{i}" for i in range(len(steps))))


def mock_records(start: int, end: int, step: int | None = None) -> Column:
    """Indexes from start to end, both inclusive (Q11), upwards or downwards, as an array."""
    return F.sequence(F.lit(start), F.lit(end), F.lit(step if step is not None else (1 if end >= start else -1)))


def violations(records: DataFrame, batch: str, index: str, text: str, role: str, roles: tuple[str, ...]) -> DataFrame:
    """Each batch with what is wrong in it: (batch, n, duplicate_ids, empty_values, unknown_roles, gaps)."""
    by_index = records.groupBy(batch, index).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.length(text), F.lit(0)) == 0).alias("empty"), F.count_if(~F.coalesce(F.col(role).isin(*roles), F.lit(False))).alias("unknown"))
    held = by_index.groupBy(batch).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("duplicate_ids"), F.sum("empty").alias("empty_values"), F.sum("unknown").alias("unknown_roles"), (F.max(index) - F.min(index) + 1 - F.count("*")).alias("gaps"))
    return held


def merged(batches: list[DataFrame]) -> DataFrame:
    """Batches one after the other, none dropped: rows carry batch_no, and keep line_no as their order within."""
    out = None
    for i, batch in enumerate(batches):
        held = batch.withColumn("batch_no", F.lit(i))
        out = held if out is None else out.unionByName(held)
    return out


def tree_diff(a: DataFrame, b: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys that one side lacks or whose digests differ: (key, state)."""
    x, y = a.select(F.col(key).alias("ka"), F.col(digest).alias("da")), b.select(F.col(key).alias("kb"), F.col(digest).alias("db"))
    held = x.join(y, F.col("ka") == F.col("kb"), "full")
    state = F.when(F.col("kb").isNull(), "missing_right").when(F.col("ka").isNull(), "missing_left").when(F.col("da") != F.col("db"), "differs")
    return held.select(F.coalesce("ka", "kb").alias(key), state.alias("state")).where("state is not null")
