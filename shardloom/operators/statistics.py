"""Dataset statistics as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of the image area below which a box is small or medium.
SMALL, MEDIUM = 0.001, 0.01


def class_distribution(labels: DataFrame, cls: str = "class_id") -> DataFrame:
    return labels.groupBy(cls).agg(F.count("*").alias("n"))


def coverage(images: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Boxes, images with and without any, and boxes for each image that has some."""
    held = images.join(counts, key, "left").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_bboxes"), F.count_if(F.col("n") > 0).alias("with_annotations"), F.count_if(F.coalesce("n", F.lit(0)) == 0).alias("without_annotations"))
    return held.withColumn("avg_per_image", F.bround(F.col("total_bboxes") / F.greatest("with_annotations", F.lit(1)).cast("double"), 2))


def box_statistics(boxes: DataFrame, w: Column, h: Column) -> DataFrame:
    area = w * h
    held = boxes.select(w.alias("w"), h.alias("h"), area.alias("area"))
    out = [F.bround(f(c), 4).alias(f"{c}_{n}") for c in ("w", "h") for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]
    out += [F.bround(F.avg("area"), 6).alias("area_mean"), F.count_if(F.col("area") < SMALL).alias("small"), F.count_if((F.col("area") >= SMALL) & (F.col("area") < MEDIUM)).alias("medium"), F.count_if(F.col("area") >= MEDIUM).alias("large")]
    out += [F.bround(F.avg(F.when(F.col("h") > 0, F.col("w") / F.col("h"))), 4).alias("aspect_mean")]
    return held.agg(*out)


def resolutions(files: DataFrame, position: str, n: int = 100) -> DataFrame:
    """Histogram of width x height over the first n files."""
    return files.orderBy(position).limit(n).groupBy(F.concat_ws("x", F.col("w").cast("string"), F.col("h").cast("string")).alias("resolution")).agg(F.count("*").alias("n"))
