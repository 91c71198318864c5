"""Device state and debounce as streams."""

import json

from pyspark.sql import functions as F

from shardloom.streaming import ingest, telemetry

SCHEMA = "device string, sequence long, temperature double"


def test_last_state_of_each_device(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    rows = [("a", 1, 25.0), ("a", 3, 31.0), ("a", 2, 28.0), ("b", 1, 20.0)]
    (root / "1.json").write_text("".join(json.dumps(dict(zip(("device", "sequence", "temperature"), r))) + "\n" for r in rows))

    def drain():
        stream = telemetry.twin_stream(spark.readStream.schema(SCHEMA).json(str(root)))
        stream.writeStream.outputMode("complete").format("memory").queryName("twins").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        return {r.device: (r.sequence, r.state) for r in spark.table("twins").collect()}

    assert drain() == {"a": (3, "warning"), "b": (1, "normal")}
    (root / "2.json").write_text(json.dumps({"device": "b", "sequence": 2, "temperature": 40.0}) + "\n")
    assert drain() == {"a": (3, "warning"), "b": (2, "warning")}  # the state came from the checkpoint


def test_bursts_are_one_batch(spark, tmp_path):
    files = spark.createDataFrame([("x", 0), ("y", 2), ("z", 60)], "path string, at long").select("path", F.timestamp_seconds(1_700_000_000 + F.col("at")).alias("modificationTime"))
    got = sorted((r.n, sorted(r.paths)) for r in ingest.debounced(files).collect())
    assert got == [(1, ["z"]), (2, ["x", "y"])]
