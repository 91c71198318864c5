"""A sharded stage 1 with its records, summary and global deduplication, then stage 2.

Shards are parts of one DataFrame: each runs the same operators over its own
files, distributed as anything else; records, moments and hashes of all shards
then meet in aggregations.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import deduplicate, normalize, stages
from ..registry import OPERATORS, PipelineState, resolved
from ..sinks import write_json
from ..storage import small, written
from . import partition, shards
from .throughput import MIN_SAMPLES


@dataclass
class Workload:
    input_path: str
    output_path: str
    label_path: str | None = None
    steps: list[dict[str, Any]] = field(default_factory=list)
    algorithm: str = "AUTO"
    cpu_ratio: float = 0.5
    split_index: int = 0
    weights: tuple[int, int] | None = None
    throughput: tuple[float, float] | None = None
    measured: tuple[float, float] | None = None
    throughput_source: str = "auto"
    calibration_ratio: float = 0.5
    targets: tuple[str, ...] = (partition.CPU, partition.CSD)


def selected(files: DataFrame, manifest: dict[str, Any], position: str = "pos", name: str = "name") -> DataFrame:
    """The files that a manifest names: by name, by index, by a range whose end is exclusive (Q11), or all."""
    if manifest.get("files"):
        wanted = files.sparkSession.createDataFrame([(f,) for f in manifest["files"]], "__name string")
        return files.join(small(wanted), F.col(name) == F.col("__name"), "left_semi")
    if manifest.get("indexes") is not None:
        wanted = files.sparkSession.createDataFrame([(int(i),) for i in manifest["indexes"]], "__at long")
        return files.join(small(wanted), F.col(position) == F.col("__at"), "left_semi")
    if manifest.get("startIndex") is not None or manifest.get("endIndex") is not None:
        held = files.where(F.col(position) >= (manifest.get("startIndex") or 0))
        return held.where(F.col(position) < manifest["endIndex"]) if manifest.get("endIndex") is not None else held
    return files


def known_throughput(work: Workload) -> tuple[tuple[float, float] | None, str]:
    """Measured throughput if the source is auto, else what the workload gives, else none; and which it was."""
    if work.throughput_source == "auto" and work.measured and min(work.measured) > 0:
        return work.measured, "measured"
    if work.throughput and min(work.throughput) > 0:
        return work.throughput, "spec"
    return None, "none"


def plan(work: Workload, files: DataFrame, n: int) -> tuple[DataFrame, dict[str, Any]]:
    """files with target and queue_position, and how that was decided."""
    targets = partition.check_targets(list(work.targets))
    rates, source = known_throughput(work)
    if len(targets) == 1:
        only = files.withColumn("target", F.lit(targets[0])).withColumn("queue_position", F.col("pos"))
        return only, {"algorithm": "SINGLE", "reason": "one target", "throughput_source": source}
    algorithm, reason = work.algorithm, "as given"
    if algorithm == "AUTO":
        choice = partition.choose(n, *(rates or (None, None)))
        algorithm, reason = choice.algorithm, choice.reason
    options: dict[str, Any] = {}
    if algorithm == "STATIC":
        options["split"] = partition.static_split(n, work.cpu_ratio, work.split_index)
    elif algorithm == "MTE":  # without any throughput this run measures it, at the calibration share
        options["split"] = partition.meeting_split(n, *(rates or (work.calibration_ratio, 1 - work.calibration_ratio)))
    else:
        options["weights"] = partition.resolved_weights(work.weights, rates, work.cpu_ratio)
    return partition.PLANNERS[algorithm](files, "pos", n, **options), {"algorithm": algorithm, "reason": reason, "throughput_source": source, **options}


def dedup_threshold(steps: list[dict[str, Any]]) -> int | None:
    """Threshold of the first deduplicate step; none without one."""
    return next((resolved("deduplicate", s.get("params") or {})["threshold"] for s in steps if s["op"] == "deduplicate"), None)


def run_shard(state: PipelineState, steps: list[dict[str, Any]]) -> tuple[PipelineState, list[tuple[str, DataFrame]], dict[str, Any]]:
    """Run the steps over a shard's files: the state, what each step left (by name), and metrics and times of the steps."""
    left, metrics = [], {}
    for step in steps:
        began = time.time()
        state, metrics[step["op"]] = OPERATORS[step["op"]](state, resolved(step["op"], step.get("params") or {}))
        metrics[step["op"]] = metrics[step["op"]] | {"millis": int(1000 * (time.time() - began))}
        left.append((step["op"], state.files.select("name")))
    return state, left, metrics


def run(spark: SparkSession, work: Workload) -> dict[str, Any]:
    """Stage 1 by shards; writes _shards/records and _shards/shard_summary.json and returns the summary."""
    whole = stages.scanned(PipelineState(spark, work.input_path, work.output_path))
    n = whole.count()
    planned, how = plan(work, whole, n)
    planned = written(planned, "planned")
    records, parts, results = None, [], {}
    for target in work.targets:
        mine = planned.where(F.col("target") == target)
        began = time.time()
        state = PipelineState(spark, work.input_path, f"{work.output_path}/_shards/{target}", work.label_path, files=mine.drop("target", "queue_position"))
        state, left, metrics = run_shard(state, work.steps)
        millis = max(1, int(1000 * (time.time() - began)))
        held = shards.dropped_by(mine, "name", left)
        if state.images is not None:
            held = held.join(state.images.select(F.col("stem").alias("__s")).distinct(), F.col("stem") == F.col("__s"), "left").withColumn("resized", F.col("__s").isNotNull() & F.col("dropped_by").isNull()).drop("__s")
        else:
            held = held.withColumn("resized", F.lit(False))
        status = F.when(F.col("dropped_by").isNotNull(), "dropped").when(~F.col("resized") & F.lit(state.images is not None), "resize_failed").otherwise("ok")
        bits = F.concat_ws("", F.transform("words", lambda w: F.reverse(F.lpad(F.bin(w), 64, "0"))))
        held = held.select(F.col("pos").cast("int").alias("index"), F.col("queue_position").cast("int").alias("queuePosition"), F.col("name").alias("filename"), F.when(F.col("words").isNotNull(), bits).alias("phash"), "resized", status.alias("status"), F.col("dropped_by").alias("droppedBy"), "target", "words")
        records = held if records is None else records.unionByName(held)
        size = mine.count()
        moments = metrics.get("normalize")
        if moments and moments["images_processed"]:
            parts.append((float(moments["total_pixels"]), *moments["mean"], *moments["std"]))
        results[target] = {"inputCount": size, "durationMillis": millis, "throughputPerSec": round(1000 * size / millis, 3), "stepMetrics": metrics}
    records = written(records, "records")
    records.drop("words").write.mode("overwrite").partitionBy("target").json(f"{work.output_path}/_shards/records")
    counts = {r.target: r.n for r in records.groupBy("target").agg(F.count("*").alias("n")).collect()}
    for target in work.targets:
        results[target]["outputCount"] = records.where((F.col("target") == target) & (F.col("status") == "ok")).count()
    summary: dict[str, Any] = {"algorithm": how, "shards": results, "consistency": {"planned": n, "observed": sum(counts.values()), "consistent": n == sum(counts.values())}}
    if parts:
        held = spark.createDataFrame(parts, "n double, m0 double, m1 double, m2 double, s0 double, s1 double, s2 double")
        pooled = [normalize.pooled(held, F.col("n"), F.col(f"m{i}"), F.col(f"s{i}")).first() for i in range(3)]
        summary |= {"global_mean": [r["mean"] for r in pooled], "global_std": [r["std"] for r in pooled], "total_pixels": pooled[0].total}
    summary["measured_throughput"] = {t: r["throughputPerSec"] if r["inputCount"] >= MIN_SAMPLES else None for t, r in results.items()}
    threshold = dedup_threshold(work.steps)
    if threshold is not None:
        summary["global_dedup"] = global_dedup(records, threshold)
        summary["global_mean_includes_duplicates"] = summary["global_dedup"]["duplicates"] > 0
    summary["observed_counts"] = {r.status: r.n for r in records.groupBy("status").agg(F.count("*").alias("n")).collect()}
    write_json(spark, f"{work.output_path}/_shards/shard_summary.json", summary)
    return summary


def global_dedup(records: DataFrame, threshold: int, listed: int = 50) -> dict[str, Any]:
    """Near duplicates among the good records of all shards, by file name; the report lists some, the count is of all."""
    good = written(records.where("status = 'ok' and words is not null").select("filename", *(F.col("words")[i].alias(f"h{i}") for i in range(4))), "good")
    kept = written(deduplicate.near_kept(good, "filename", [f"h{i}" for i in range(4)], [64] * 4, threshold).select("filename"), "kept")
    gone = good.join(kept, "filename", "left_anti").select("filename")
    return {"total": good.count(), "unique": kept.count(), "duplicates": gone.count(), "removed": [r.filename for r in gone.orderBy("filename").limit(listed).collect()]}
