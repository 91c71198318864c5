"""Normalisation, summary and last state of telemetry, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WARNING = 30


def normalised(events: DataFrame, key: str, value: str) -> DataFrame:
    """(x - min) / (max - min, or 1) within each key; the ranges are one row a key."""
    ranges = events.groupBy(key).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    span = F.when(F.col("__hi") == F.col("__lo"), F.lit(1.0)).otherwise(F.col("__hi") - F.col("__lo"))
    return events.join(ranges, key).withColumn(f"{value}_norm", (F.col(value) - F.col("__lo")) / span).drop("__lo", "__hi")


def summary(events: DataFrame, key: str, value: str, warning: float = WARNING) -> DataFrame:
    return events.groupBy(key).agg(F.count("*").alias("n"), F.bround(F.min(value), 2).alias("low"), F.bround(F.max(value), 2).alias("high"), F.bround(F.avg(value), 2).alias("mean"), F.count_if(F.col(value) >= warning).alias("warnings"))


def last_state(events: DataFrame, key: str, order: list[str], value: str, warning: float = WARNING) -> DataFrame:
    """The latest row of each key, with its state; combines before it shuffles."""
    others = [c for c in events.columns if c != key]
    held = events.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("last")).select(key, "last.*")
    return held.withColumn("state", F.when(F.col(value) >= warning, "warning").otherwise("normal"))


def twin_stream(events: DataFrame, device: str = "device", at: str = "sequence", value: str = "temperature", warning: float = WARNING) -> DataFrame:
    """Last reported state of each device over a stream; write it in update or complete mode."""
    held = events.groupBy(device).agg(F.max_by(F.struct(at, value), at).alias("last")).select(device, "last.*")
    return held.withColumn("state", F.when(F.col(value) >= warning, "warning").otherwise("normal"))
