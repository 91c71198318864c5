"""Kernels of the relational operators that the pipelines are made of (section C of the inventory)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..storage import table
from .base import kernel


@kernel("SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def k_join_left(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


@kernel("SELECT n_name, c_mktsegment, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey <> 2 GROUP BY n_name, c_mktsegment")
def k_join_inner(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select("n_nationkey", "n_name")
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return counts.join(nations, F.col("n_nationkey") == F.col("c_nationkey")).groupBy("n_name", "c_mktsegment").agg(F.sum("n").alias("n"))


@kernel("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def k_join_semi(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(good, "doc_id", "left_semi")


@kernel("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def k_join_anti(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@kernel("""SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier) UNION ALL
SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL
SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT s_suppkey FROM supplier) UNION ALL
SELECT 'distinct', count(*) FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)""")
def k_setops(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    nations, keys = (c.select("c_nationkey"), s.select("s_nationkey")), (c.select("c_custkey"), s.select("s_suppkey"))
    parts = {"union": nations[0].unionAll(nations[1]), "intersect": nations[0].intersect(nations[1]), "except": keys[0].subtract(keys[1]), "distinct": c.select("c_nationkey", "c_mktsegment").distinct()}
    out = None
    for op, df in parts.items():
        held = df.agg(F.lit(op).alias("op"), F.count("*").alias("n"))
        out = held if out is None else out.unionAll(held)
    return out


@kernel("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def k_topk(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@kernel("SELECT l_returnflag, l_linestatus, count(*) AS n, round_even(sum(l_quantity), 2) AS qty, round_even(avg(l_extendedprice), 2) AS avg_price, round_even(stddev_pop(l_quantity), 4) AS std_qty, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) FILTER (WHERE l_discount > 0.05) AS discounted FROM lineitem GROUP BY l_returnflag, l_linestatus")
def k_aggregate(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.bround(F.sum("l_quantity"), 2).alias("qty"), F.bround(F.avg("l_extendedprice"), 2).alias("avg_price"), F.bround(F.stddev_pop("l_quantity"), 4).alias("std_qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.count_if(F.col("l_discount") > F.lit(0.05)).alias("discounted"))


@kernel("SELECT o_orderkey, row_number() OVER w AS k, first_value(o_orderkey) OVER w AS first_key, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def k_window(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w).cast("long").alias("k"), F.first("o_orderkey").over(w).alias("first_key"), F.count("*").over(Window.partitionBy("o_custkey")).alias("n"))


@kernel(r"SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS host, lower(regexp_extract(url, '\.([A-Za-z]+)$', 1)) AS suffix, starts_with(url, 'https') AS secure, concat_ws('/', 'raw', 'img_' || page_id) AS path, printf('%05d', page_id) AS padded, regexp_replace(url, '[^A-Za-z0-9-]', '-', 'g') AS clean FROM pages")
def k_string_fns(spark, sf_dir):
    url, n = F.col("url"), F.col("page_id")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(url, "://([^/]+)", 1).alias("host"), F.lower(F.regexp_extract(url, r"\.([A-Za-z]+)$", 1)).alias("suffix"), url.startswith("https").alias("secure"), F.concat_ws("/", F.lit("raw"), F.concat(F.lit("img_"), n.cast("string"))).alias("path"), F.format_string("%05d", n).alias("padded"), F.regexp_replace(url, "[^A-Za-z0-9-]", "-").alias("clean"))


@kernel("SELECT o_orderkey, round_even(sqrt(o_totalprice), 4) AS root, CAST(floor(o_totalprice / 7) AS BIGINT) AS floored, round_even(o_totalprice / 3, 2) AS rounded, greatest(0, least(1, o_totalprice / 100000)) AS clamped, gcd(o_orderkey, o_custkey) AS g, CAST(bit_count(xor(o_orderkey, o_custkey)) AS INTEGER) AS bits, round_even(pow(o_totalprice, 0.5), 4) AS powered FROM orders")
def k_math_fns(spark, sf_dir):
    p, a, b = F.col("o_totalprice"), F.col("o_orderkey"), F.col("o_custkey")
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % F.when(s["b"] == 0, 1).otherwise(s["b"])).alias("b")))
    gcd = F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step, lambda s: s["a"])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.bround(F.sqrt(p), 4).alias("root"), F.floor(p / 7).cast("long").alias("floored"), F.bround(p / 3, 2).alias("rounded"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), p / 100000)).alias("clamped"), gcd.alias("g"), F.bit_count(a.bitwiseXOR(b)).cast("int").alias("bits"), F.bround(F.pow(p, F.lit(0.5)), 4).alias("powered"))


@kernel("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, list_reverse([event_id % 3, event_id % 5, event_id % 7])[1] AS last, len([event_id % 3, event_id % 5, event_id % 7][2:3]) AS n, CAST((event_id % 7) AS BIGINT) AS merged FROM events")
def k_json_fns(spark, sf_dir):
    e = F.col("event_id")
    parts = F.array(e % 3, e % 5, e % 7)
    both = F.map_concat(F.map_from_arrays(F.array(F.lit("a")), F.array(e % 5)), F.map_from_arrays(F.array(F.lit("b")), F.array(e % 7)))
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long").getField("k").alias("k"), F.reverse(parts)[0].alias("last"), F.size(F.slice(parts, 2, 2)).cast("long").alias("n"), F.element_at(both, "b").alias("merged"))


@kernel("SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def k_hash_fns(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"))
