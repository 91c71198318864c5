"""Global mean and standard deviation from moments, in two phases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pooled(df: DataFrame, weight: Column, mean: Column, std: Column, digits: int = 6) -> DataFrame:
    """Mean and population deviation of the union of samples given by (weight, mean, std)."""
    w = weight.cast("double")
    held = df.agg(F.sum(w).alias("n"), F.sum(w * mean).alias("s"), F.sum(w * (std * std + mean * mean)).alias("q"), F.count("*").alias("parts"))
    mu = F.col("s") / F.col("n")
    var = F.greatest(F.col("q") / F.col("n") - mu * mu, F.lit(0.0))
    return held.select(F.bround(mu, digits).alias("mean"), F.bround(F.sqrt(var), digits).alias("std"), F.col("n").cast("long").alias("total"), F.col("parts"))
