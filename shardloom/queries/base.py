"""Registry of kernel queries, and the views they share in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import in_order, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def kernel(sql: str | None = None):
    """Register a query under its function's name, with the SQL it is held against."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# Each view is one SQL text for DuckDB and one DataFrame for Spark.
IMG = "img AS (SELECT o_orderkey AS image_id, 'img_' || o_orderkey AS stem, CAST(64 + o_orderkey % 1217 AS INTEGER) AS w, CAST(48 + o_orderkey % 971 AS INTEGER) AS h, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)"
ANN = "ann AS (SELECT l_orderkey AS image_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS ord, CAST(l_suppkey % 7 * 3 + 1 AS INTEGER) AS cat, CAST(l_linenumber * 5 AS DOUBLE) AS x, CAST(l_suppkey % 40 AS DOUBLE) AS y, CAST(l_quantity AS DOUBLE) AS bw, l_quantity * (1 + l_discount) AS bh, (l_linestatus = 'O' AND l_linenumber = 7) AS iscrowd FROM lineitem)"
PX = "px AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(round_even((CAST(e AS DOUBLE) + CAST(0.55 AS DOUBLE)) * CAST(220 AS DOUBLE), 0) AS INTEGER)) AS p FROM embeddings)"
SHARD = "shard AS (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'CPU' ELSE 'CSD' END AS target, value, CAST(ts AS DATE) AS day FROM events)"


def img(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(key.alias("image_id"), F.concat(F.lit("img_"), key.cast("string")).alias("stem"), (64 + key % 1217).cast("int").alias("w"), (48 + key % 971).cast("int").alias("h"))


def img_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """img with its position in key order, numbered without a single task."""
    return in_order(img(spark, sf_dir), "image_id", name="pos")


def ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    q = F.col("l_quantity").cast("double")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image_id"), F.row_number().over(order).cast("long").alias("ord"), (F.col("l_suppkey") % 7 * 3 + 1).cast("int").alias("cat"),
        (F.col("l_linenumber") * 5).cast("double").alias("x"), (F.col("l_suppkey") % 40).cast("double").alias("y"), q.alias("bw"), (q * (1 + F.col("l_discount"))).alias("bh"),
        ((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7)).alias("iscrowd"),
    )


def ann_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ann without its order within an image, which costs a shuffle."""
    return ann(spark, sf_dir).drop("ord")


def px(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixel = lambda e: F.bround((e.cast("double") + F.lit(0.55)) * F.lit(220.0), 0).cast("int")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", pixel).alias("p"))


def shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.when(F.col("user_id") % 2 == 0, "CPU").otherwise("CSD").alias("target"), "value", F.to_date("ts").alias("day"))


def dhash_bits(at: Callable[[int], str]) -> str:
    """SQL text of the 56 row-major comparisons of an 8 x 8 image as one number; the first is the lowest bit.

    ``at`` spells the element of a place from 0, which differs between dialects.
    """
    places = [8 * r + c for r in range(8) for c in range(7)]
    return " + ".join(f"(CASE WHEN {at(i + 1)} > {at(i)} THEN CAST({1 << k} AS BIGINT) ELSE CAST(0 AS BIGINT) END)" for k, i in enumerate(places))


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.expr(dhash_bits(lambda i: f"embedding[{i}]")).alias("h"))


HASH = f"hashes AS (SELECT vec_id, {dhash_bits(lambda i: f'embedding[{i + 1}]')} AS h FROM embeddings)"
