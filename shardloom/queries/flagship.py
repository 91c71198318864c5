"""The flagship: stage 1 over the embeddings as 8 x 8 images.

Scan, ordered validation, exact and near deduplication, quality filter, and
pooled mean and deviation, in one result row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import deduplicate, normalize, quality
from ..storage import table, written
from .base import PX, dhash_bits, kernel
from .images import QUALITY, THRESHOLD, _walk


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, hash, and brightness, contrast and blur of the quantised pixels, from one scan."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    pixel = lambda e: F.bround((e.cast("double") + F.lit(0.55)) * F.lit(220.0), 0).cast("int")
    rows = table(spark, sf_dir, "embeddings").where(F.size("embedding") == 64)
    rows = rows.select("vec_id", F.expr(dhash_bits(lambda i: f"embedding[{i}]")).alias("h"), F.transform("embedding", pixel).alias("p"))
    rows = rows.withColumn("d", F.zip_with(F.slice("p", 2, 63), F.slice("p", 1, 63), lambda a, b: a - b))
    rows = rows.select("vec_id", "h", total("p").alias("s"), total(F.transform("p", lambda v: v * v)).alias("q"), total("d").alias("ds"), total(F.transform("d", lambda v: v * v)).alias("dq"))
    s, q, ds, dq = (F.col(c) for c in ("s", "q", "ds", "dq"))
    return rows.select("vec_id", "h", (s.cast("double") / 64).alias("brightness"), F.sqrt((64 * q - s * s).cast("double") / 4096).alias("contrast"), ((63 * dq - ds * ds).cast("double") / 3969).alias("blur"))


SQL = f"""{_walk("vec_id").rpartition("SELECT k.v AS vec_id")[0]}, kept AS (SELECT k.v AS vec_id FROM (SELECT unnest(kept) AS k FROM walk WHERE p = (SELECT max(p) FROM s)) u),
{PX}, m AS (SELECT vec_id, list_sum(p) AS s, list_sum(list_transform(p, lambda v: v * v)) AS q, list_sum(list_transform(range(1, 64), lambda i: p[i + 1] - p[i])) AS ds, list_sum(list_transform(range(1, 64), lambda i: (p[i + 1] - p[i]) * (p[i + 1] - p[i]))) AS dq FROM px JOIN kept USING (vec_id)),
f AS (SELECT CAST(s AS DOUBLE) / 64 AS b, CAST(64 * q - s * s AS DOUBLE) / 4096 AS v, CAST(63 * dq - ds * ds AS DOUBLE) / 3969 AS blur FROM m),
g AS (SELECT * FROM f WHERE blur >= {QUALITY.min_blur_score} AND b >= {QUALITY.min_brightness} AND b <= {QUALITY.max_brightness} AND sqrt(v) >= {QUALITY.min_contrast})
SELECT (SELECT count(*) FROM embeddings) AS scanned, (SELECT count(*) FROM kept) AS unique_images, count(*) AS passed, 64 * count(*) AS total_pixels, round_even(avg(b) / 255, 6) AS mean, round_even(sqrt(avg(v + b * b) - avg(b) * avg(b)) / 255, 6) AS std FROM g"""


@kernel(SQL)
def stage1_flagship(spark, sf_dir):
    rows = written(measured(spark, sf_dir), "measured")
    kept = written(deduplicate.near_kept(rows, "vec_id", ["h"], [56], THRESHOLD), "kept")
    good = kept.where(quality.reasons(F.col("blur"), F.col("brightness"), F.col("contrast"), QUALITY) == "")
    pooled = normalize.pooled(good, F.lit(64), F.col("brightness") / 255, F.col("contrast") / 255)
    counts = rows.agg(F.count("*").alias("scanned")).join(F.broadcast(kept.agg(F.count("*").alias("unique_images"))))  # one row each
    return counts.join(F.broadcast(pooled)).select("scanned", "unique_images", F.col("parts").alias("passed"), F.col("total").alias("total_pixels"), "mean", "std")


