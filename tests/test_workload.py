"""Sharded runs on generated images."""

import json

import pytest
from pyspark.sql import functions as F

from shardloom import pipeline
from shardloom.functions import pixels
from shardloom.plans import workload
from tests.fixtures import coco_dataset, picture


@pytest.mark.parametrize("algorithm", ["AUTO", "WRR"])
def test_shards_sum_to_the_whole(spark, tmp_path, algorithm):
    coco_dataset(tmp_path, 8)
    images = tmp_path / "raw" / "images"
    (images / "img_900.png").write_bytes(pixels.png(picture(0)))  # a copy that another shard holds
    (images / "broken.png").write_bytes(b"no image")
    work = workload.Workload(str(images), str(tmp_path / "out"), steps=pipeline.template("stage1_raw_ingestion"), algorithm=algorithm, throughput=(4.0, 4.0))
    out = workload.run(spark, work)
    assert out["consistency"] == {"planned": 10, "observed": 10, "consistent": True}
    assert out["algorithm"]["algorithm"] == ("MTE" if algorithm == "AUTO" else "WRR") and out["algorithm"]["throughput_source"] == "spec"
    assert [s["inputCount"] for s in out["shards"].values()] == [5, 5]
    records = spark.read.json(f"{tmp_path}/out/_shards/records").collect()
    by = {r.filename: r for r in records}
    assert len(by) == 10 and by["broken.png"].droppedBy == "validate" and by["broken.png"].status == "dropped"
    assert all(len(r.phash) == 256 for r in records if r.filename != "broken.png")
    assert by["img_000.png"].status == "ok" and by["img_000.png"].resized
    if by["img_900.png"].target != by["img_000.png"].target:
        assert out["global_dedup"]["removed"] == ["img_900.png"] and out["global_mean_includes_duplicates"]
    saved = json.loads((tmp_path / "out" / "_shards" / "shard_summary.json").read_text())
    assert saved["observed_counts"] == out["observed_counts"]
    one = workload.Workload(str(images), str(tmp_path / "one"), steps=work.steps, targets=("CPU",))
    single = workload.run(spark, one)
    assert single["algorithm"]["algorithm"] == "SINGLE"
    if "img_900.png" in out["global_dedup"]["removed"]:
        return  # the pooled moments include the copy, those of one shard don't
    assert single["global_mean"] == pytest.approx(out["global_mean"], abs=1e-5) and single["global_std"] == pytest.approx(out["global_std"], abs=1e-5)


def test_manifests_select_files(spark):
    files = spark.range(10).select(F.col("id").alias("pos"), F.format_string("f%d", "id").alias("name"))
    names = lambda m: sorted(r.pos for r in workload.selected(files, m).collect())
    assert names({"files": ["f3", "f1", "none"]}) == [1, 3]
    assert names({"indexes": [0, 9, 99]}) == [0, 9]
    assert names({"startIndex": 2, "endIndex": 5}) == [2, 3, 4] and names({"startIndex": 8}) == [8, 9] and names({"endIndex": 1}) == [0]
    assert names({}) == list(range(10))


def test_throughput_precedence_and_calibration(spark):
    files = spark.range(200).select(F.col("id").alias("pos"))
    base = {"input_path": "", "output_path": ""}
    assert workload.known_throughput(workload.Workload(**base, throughput=(1, 2), measured=(3, 4))) == ((3, 4), "measured")
    assert workload.known_throughput(workload.Workload(**base, throughput=(1, 2), measured=(3, 4), throughput_source="spec")) == ((1, 2), "spec")
    held, how = workload.plan(workload.Workload(**base, algorithm="MTE", calibration_ratio=0.25), files, 200)
    assert how["split"] == 50 and held.where("target = 'CPU'").count() == 50
    held, how = workload.plan(workload.Workload(**base, measured=(40, 2)), files, 200)
    assert how["algorithm"] == "WRR" and held.where("target = 'CPU'").count() == 191  # twenty to one: nine cycles of 21, and 11 more
    assert workload.dedup_threshold([{"op": "deduplicate", "params": {"threshold": 9}}]) == 9 and workload.dedup_threshold([{"op": "validate"}]) is None
