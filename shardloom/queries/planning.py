"""Kernels of partition planning, throughput, shard records and telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import normalize
from ..plans import partition, shards, throughput
from ..storage import table
from ..streaming import telemetry
from .base import IMG, SHARD, img, img_pos, kernel, shard


@kernel(f"WITH {IMG}, n AS (SELECT CAST(round_even(count(*) * CAST(0.8 AS DOUBLE), 0) AS BIGINT) AS s FROM img) SELECT stem, CASE WHEN pos < s THEN 'CPU' ELSE 'CSD' END AS target, CASE WHEN pos < s THEN pos ELSE pos - s END AS queue_position FROM img, n")
def k_part_static(spark, sf_dir):
    files, n = img_pos(spark, sf_dir), table(spark, sf_dir, "orders").count()
    return partition.planned(files, "pos", n, "STATIC", split=partition.static_split(n, 0.8)).select("stem", "target", "queue_position")


@kernel(f"WITH {IMG}, n AS (SELECT count(*) AS n, CAST(round_even(count(*) * CAST(41.1 AS DOUBLE) / CAST(47.31 AS DOUBLE), 0) AS BIGINT) AS s FROM img) SELECT stem, CASE WHEN pos < s THEN 'CPU' ELSE 'CSD' END AS target, CASE WHEN pos < s THEN pos ELSE n - 1 - pos END AS queue_position FROM img, n")
def k_part_mte(spark, sf_dir):
    files, n = img_pos(spark, sf_dir), table(spark, sf_dir, "orders").count()
    return partition.planned(files, "pos", n, "MTE", split=partition.meeting_split(n, 41.1, 6.21)).select("stem", "target", "queue_position")


@kernel(f"WITH {IMG} SELECT stem, CASE WHEN pos % 5 < 4 THEN 'CPU' ELSE 'CSD' END AS target, CASE WHEN pos % 5 < 4 THEN pos // 5 * 4 + pos % 5 ELSE pos // 5 END AS queue_position FROM img")
def k_part_wrr(spark, sf_dir):
    n = table(spark, sf_dir, "orders").count()
    return partition.planned(img_pos(spark, sf_dir), "pos", n, "WRR", weights=partition.weights_of(4.0)).select("stem", "target", "queue_position")


RATIOS = "ratios AS (SELECT event_type, avg(value) FILTER (WHERE user_id % 2 = 0) / avg(value) FILTER (WHERE user_id % 2 = 1) * (length(event_type) - 2) AS ratio FROM events GROUP BY event_type)"


@kernel(f"""WITH {RATIOS}, pairs AS (SELECT c, s FROM range(1, 20) a(c), range(1, 20) b(s) WHERE c + s <= 20), best AS (SELECT event_type, ratio, c, s, row_number() OVER (PARTITION BY event_type ORDER BY abs(c / s - ratio) / ratio, c + s, c) AS k FROM ratios, pairs)
SELECT event_type, c AS cpu, s AS csd FROM best WHERE k = 1""")
def k_wrr_weights(spark, sf_dir):
    mean = lambda side: F.avg(F.when(F.col("user_id") % 2 == side, F.col("value")))
    held = table(spark, sf_dir, "events").groupBy("event_type").agg((mean(0) / mean(1) * (F.length("event_type") - 2)).alias("ratio"))
    grid = F.filter(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(19)), lambda c: F.transform(F.sequence(F.lit(1), F.lit(19)), lambda s: F.struct((F.abs(c / s - F.col("ratio")) / F.col("ratio")).alias("e"), (c + s).alias("n"), c.alias("c"), s.alias("s"))))), lambda x: x["n"] <= partition.WRR_MAX_CYCLE)
    return held.withColumn("best", F.array_min(grid)).select("event_type", F.col("best.c").cast("long").alias("cpu"), F.col("best.s").cast("long").alias("csd"))


@kernel("""WITH g AS (SELECT user_id, count(*) * 10 AS n, sum(value) FILTER (WHERE event_id % 2 = 0) AS cpu, sum(value) FILTER (WHERE event_id % 2 = 1) AS csd FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN n <= 100 THEN 'MTE' WHEN cpu IS NULL OR csd IS NULL OR cpu <= 0 OR csd <= 0 THEN 'MTE' WHEN greatest(cpu, csd) / least(cpu, csd) <= 3 THEN 'MTE' ELSE 'WRR' END AS algorithm FROM g""")
def k_algo_select(spark, sf_dir):
    side = lambda k: F.sum(F.when(F.col("event_id") % 2 == k, F.col("value")))
    held = table(spark, sf_dir, "events").groupBy("user_id").agg((F.count("*") * 10).alias("n"), side(0).alias("cpu"), side(1).alias("csd"))
    return held.select("user_id", partition.choose_column(F.col("n"), F.col("cpu"), F.col("csd")).alias("algorithm"))


@kernel(f"WITH {SHARD} SELECT round_even(avg(value), 6) AS mean, round_even(stddev_pop(value), 6) AS std, count(*) AS total FROM shard")
def k_pooled_stats(spark, sf_dir):
    parts = shard(spark, sf_dir).groupBy("target", "day").agg(F.count("*").alias("n"), F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    return normalize.pooled(parts, F.col("n"), F.col("m"), F.col("s")).select("mean", "std", "total")


@kernel(f"""WITH {SHARD}, p AS (SELECT target, count(*) AS n, count(DISTINCT event_id) AS ids FROM shard GROUP BY target) SELECT CAST(sum(n) AS BIGINT) AS observed, (SELECT count(*) FROM events) AS expected, bool_and(n = ids) AND sum(n) = (SELECT count(*) FROM events) AS consistent FROM p""")
def k_consistency(spark, sf_dir):
    parts = shard(spark, sf_dir).groupBy("target").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))
    held = parts.agg(F.sum("n").alias("observed"), F.bool_and(F.col("n") == F.col("ids")).alias("unique"))
    total = table(spark, sf_dir, "events").agg(F.count("*").alias("expected"))
    return held.join(F.broadcast(total)).select("observed", "expected", (F.col("unique") & (F.col("observed") == F.col("expected"))).alias("consistent"))  # one row each


JOB = f"{SHARD}, job AS (SELECT target, day, count(*) AS n, sum(value) AS ms, CASE WHEN day_of_month(day) % 3 = 0 THEN NULL ELSE sum(value) * 2 END AS exec_ms, count(*) * 3 AS push_ms FROM (SELECT target, day, value FROM shard) GROUP BY target, day)".replace("day_of_month(day)", "extract(day FROM day)")


def _jobs(spark, sf_dir):
    held = shard(spark, sf_dir).groupBy("target", "day").agg(F.count("*").alias("n"), F.sum("value").alias("ms"))
    return held.withColumn("exec_ms", F.when(F.dayofmonth("day") % 3 != 0, F.col("ms") * 2)).withColumn("push_ms", F.col("n") * 3)


RATES = "rate AS (SELECT target, day, n, CASE WHEN ms > 0 THEN n * 1000.0::DOUBLE / ms END AS compute, CASE WHEN exec_ms IS NULL OR push_ms + exec_ms <= 0 THEN CASE WHEN ms > 0 THEN n * 1000.0::DOUBLE / ms END ELSE n * 1000.0::DOUBLE / (push_ms + exec_ms) END AS effective FROM job)"


def _rates(spark, sf_dir):
    n, ms = F.col("n"), F.col("ms")
    return _jobs(spark, sf_dir).select("target", "day", "n", throughput.compute_rate(n, ms).alias("compute"), throughput.effective_rate(n, F.col("push_ms"), F.col("exec_ms"), F.lit(0), ms).alias("effective"))


@kernel(f"WITH {JOB}, {RATES} SELECT target, CAST(day AS VARCHAR) AS day, round_even(compute, 4) AS compute, round_even(effective, 4) AS effective FROM rate")
def k_throughput(spark, sf_dir):
    return _rates(spark, sf_dir).select("target", F.col("day").cast("string").alias("day"), F.bround("compute", 4).alias("compute"), F.bround("effective", 4).alias("effective"))


@kernel(f"WITH {JOB}, {RATES} SELECT target, CASE WHEN n < 14 THEN 'too_few_samples' WHEN effective IS NULL OR effective <= 0 THEN 'no_throughput' ELSE 'accepted' END AS verdict, count(*) AS n FROM rate GROUP BY 1, 2")
def k_throughput_accept(spark, sf_dir):
    why = throughput.verdict(F.col("n"), F.col("effective"), 14).alias("verdict")
    return _rates(spark, sf_dir).groupBy("target", why).agg(F.count("*").alias("n"))


@kernel(f"WITH {JOB}, {RATES} SELECT target, CAST(day AS VARCHAR) AS day, CASE WHEN n % 2 = 0 THEN 'measured' WHEN n % 3 = 0 THEN 'spec' ELSE 'none' END AS source FROM rate")
def k_throughput_source(spark, sf_dir):
    n = F.col("n")
    return _rates(spark, sf_dir).select("target", F.col("day").cast("string").alias("day"), throughput.source_of(F.when(n % 2 == 0, F.col("effective")), F.when(n % 3 == 0, F.lit(1.0))).alias("source"))


@kernel(f"WITH {IMG}, d AS (SELECT pos % 7 AS shard, avg(CAST(w AS DOUBLE) * h) AS px, count(*) AS n FROM img GROUP BY 1) SELECT round_even(sum(px * n) / sum(n), 4) AS avg_pixels, CAST(sum(n) AS BIGINT) AS n FROM d")
def k_weighted_avg(spark, sf_dir):
    parts = img_pos(spark, sf_dir).groupBy((F.col("pos") % 7).alias("shard")).agg(F.avg(F.col("w").cast("double") * F.col("h")).alias("px"), F.count("*").alias("n"))
    return parts.agg(F.bround(F.sum(F.col("px") * F.col("n")) / F.sum("n"), 4).alias("avg_pixels"), F.sum("n").alias("n"))


@kernel(f"WITH {IMG} SELECT image_id, round_even(greatest(w, h) / CAST(least(w, h) AS DOUBLE), 6) AS drift, greatest(w, h) / CAST(least(w, h) AS DOUBLE) > 1.5 AS mismatch FROM img")
def k_pixel_drift(spark, sf_dir):
    w, h = F.col("w").cast("double"), F.col("h").cast("double")
    return img(spark, sf_dir).select("image_id", F.bround(throughput.drift(w, h), 6).alias("drift"), throughput.mismatch(w, h).alias("mismatch"))


@kernel(f"WITH {IMG}, n AS (SELECT greatest(1, count(*) // 16) AS step FROM img) SELECT stem, CAST(w AS BIGINT) * h AS pixels FROM img, n WHERE pos % step = 0 ORDER BY pos LIMIT 16")
def k_systematic_sample(spark, sf_dir):
    n = table(spark, sf_dir, "orders").count()
    return throughput.systematic_sample(img_pos(spark, sf_dir), "pos", n).select("stem", (F.col("w").cast("long") * F.col("h")).alias("pixels"))


CLEAN = "substr(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9-]', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40)"


@kernel(f"SELECT c_custkey, concat_ws('.', {CLEAN.format('c_name')}, {CLEAN.format(chr(39) + '_CSD/0_' + chr(39))}, {CLEAN.format('c_mktsegment')}, 'copy') AS key FROM customer")
def k_profile_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", throughput.profile_key(F.col("c_name"), F.lit("_CSD/0_"), F.col("c_mktsegment"), F.lit("copy")).alias("key"))


@kernel(f"""WITH RECURSIVE {SHARD}, m AS (SELECT target, day, CASE WHEN count(*) % 4 <> 0 THEN avg(value) END AS cpu, CASE WHEN count(*) % 5 <> 0 THEN max(value) END AS csd, CAST(count(*) % 3 + 2 AS DOUBLE) AS mp FROM shard GROUP BY target, day),
o AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY day) AS k FROM m),
f AS (SELECT DISTINCT target, CAST(0 AS BIGINT) AS k, CAST(NULL AS DOUBLE) AS cpu, CAST(NULL AS DOUBLE) AS csd, CAST(NULL AS DOUBLE) AS mp, CAST(0 AS BIGINT) AS samples, CAST(0 AS BIGINT) AS resets FROM o
UNION ALL SELECT r.target, r.k, CASE WHEN r.ncpu IS NULL THEN CASE WHEN r.reset THEN NULL ELSE r.cpu END WHEN r.cpu IS NULL OR r.reset THEN r.ncpu ELSE CAST(0.5 AS DOUBLE) * r.ncpu + CAST(0.5 AS DOUBLE) * r.cpu END,
CASE WHEN r.ncsd IS NULL THEN CASE WHEN r.reset THEN NULL ELSE r.csd END WHEN r.csd IS NULL OR r.reset THEN r.ncsd ELSE CAST(0.5 AS DOUBLE) * r.ncsd + CAST(0.5 AS DOUBLE) * r.csd END,
coalesce(r.nmp, r.mp), CASE WHEN r.reset THEN 1 ELSE r.samples + 1 END, r.resets + CASE WHEN r.reset THEN 1 ELSE 0 END
FROM (SELECT f.target, o.k, f.cpu, f.csd, f.mp, f.samples, f.resets, o.cpu AS ncpu, o.csd AS ncsd, o.mp AS nmp, coalesce(greatest(f.mp, o.mp) / least(f.mp, o.mp) > 1.5 AND f.mp IS NOT NULL, FALSE) AS reset FROM f JOIN o ON o.target = f.target AND o.k = f.k + 1) r)
SELECT target, round_even(cpu, 6) AS cpu, round_even(csd, 6) AS csd, samples, resets FROM f WHERE k = (SELECT max(k) FROM o WHERE o.target = f.target)""")
def k_ewma(spark, sf_dir):
    n = F.count("*")
    m = shard(spark, sf_dir).groupBy("target", "day").agg(F.when(n % 4 != 0, F.avg("value")).alias("cpu"), F.when(n % 5 != 0, F.max("value")).alias("csd"), (n % 3 + 2).cast("double").alias("mp"))
    return throughput.ewma(m, "target", ["day"], "cpu", "csd", "mp").select("target", F.bround("cpu", 6).alias("cpu"), F.bround("csd", 6).alias("csd"), F.col("samples").cast("long").alias("samples"), F.col("resets").cast("long").alias("resets"))


@kernel("""WITH i AS (SELECT conv_id, turn, count(*) AS n, count(*) FILTER (WHERE coalesce(length(text), 0) = 0) AS empty, count(*) FILTER (WHERE coalesce(role NOT IN ('user', 'assistant'), TRUE)) AS unknown FROM conversations GROUP BY conv_id, turn)
SELECT conv_id, CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (WHERE n > 1) AS duplicate_ids, CAST(sum(empty) AS BIGINT) AS empty_values, CAST(sum(unknown) AS BIGINT) AS unknown_roles, CAST(max(turn) - min(turn) + 1 - count(*) AS BIGINT) AS gaps FROM i GROUP BY conv_id""")
def k_batch_verify(spark, sf_dir):
    return shards.violations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", "role", ("user", "assistant"))


@kernel("SELECT CAST(conv_id % 3 AS INTEGER) AS batch_no, conv_id, turn, role, length(text) AS chars FROM conversations")
def k_batch_merge(spark, sf_dir):
    held = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.char_length("text").cast("long").alias("chars"))
    return shards.merged([held.where(F.col("conv_id") % 3 == k) for k in range(3)])


@kernel("SELECT user_id, i AS index, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN user_id % 2 = 0 THEN i ELSE -i END) - 1 AS queue_position FROM (SELECT user_id, unnest(range(0, n)) AS i FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id))")
def k_mock_records(spark, sf_dir):
    held = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    up = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    return held.select("user_id", F.posexplode(F.when(F.col("user_id") % 2 == 0, up).otherwise(F.reverse(up))).alias("queue_position", "index")).select("user_id", "index", F.col("queue_position").cast("long").alias("queue_position"))


@kernel("""WITH r AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type)
SELECT event_id, round_even((value - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END, 4) AS value_norm FROM events JOIN r USING (event_type)""")
def k_telemetry_norm(spark, sf_dir):
    return telemetry.normalised(table(spark, sf_dir, "events"), "event_type", "value").select("event_id", F.bround("value_norm", 4).alias("value_norm"))


@kernel("SELECT event_type, count(*) AS n, round_even(min(value), 2) AS low, round_even(max(value), 2) AS high, round_even(avg(value), 2) AS mean, count(*) FILTER (WHERE value >= 75) AS warnings FROM events GROUP BY event_type")
def k_telemetry_summary(spark, sf_dir):
    return telemetry.summary(table(spark, sf_dir, "events"), "event_type", "value", 75)


@kernel("SELECT user_id, event_id, value, CASE WHEN value >= 75 THEN 'warning' ELSE 'normal' END AS state FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def k_twin_state(spark, sf_dir):
    return telemetry.last_state(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], "value", 75).select("user_id", "event_id", "value", "state")


@kernel("SELECT user_id, round_even(extract(epoch FROM max(ts)) - extract(epoch FROM min(ts)), 3) AS elapsed, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS began FROM events GROUP BY user_id")
def k_elapsed(spark, sf_dir):
    ts = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    gap = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6
    return ts.groupBy("user_id").agg(F.bround(gap, 3).alias("elapsed"), F.date_format(F.min("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("began"))


@kernel("SELECT doc_id, CASE WHEN n_chars <= 200 THEN 'validate' WHEN doc_id <> (SELECT min(e.doc_id) FROM documents e WHERE e.n_chars > 200 AND md5(e.text) = md5(d.text)) THEN 'deduplicate' WHEN lang = 'de' THEN 'filter_quality' END AS dropped_by FROM documents d")
def k_dropped_by(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", F.md5("text").alias("hash"))
    valid = docs.where("n_chars > 200")
    unique = valid.groupBy("hash").agg(F.min("doc_id").alias("doc_id"), F.min_by("lang", "doc_id").alias("lang"))
    good = unique.where("lang <> 'de'")
    return shards.dropped_by(docs.select("doc_id"), "doc_id", [("validate", valid), ("deduplicate", unique), ("filter_quality", good)])


@kernel("SELECT k AS key, CASE WHEN b IS NULL THEN 'missing_right' WHEN a IS NULL THEN 'missing_left' ELSE 'differs' END AS state FROM (SELECT coalesce(x.c_custkey, y.s_suppkey) AS k, x.c_nationkey AS a, y.s_nationkey AS b FROM customer x FULL JOIN supplier y ON x.c_custkey = y.s_suppkey) WHERE a IS NULL OR b IS NULL OR a <> b")
def k_tree_diff(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("digest"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("digest"))
    return shards.tree_diff(a, b, "key", "digest")
