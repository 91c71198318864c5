"""The image pipeline end to end on generated images."""

import json

import numpy as np
import pytest

from shardloom import cli, pipeline
from shardloom.functions import pixels
from shardloom.registry import OPERATORS, PipelineState, resolved
from shardloom.streaming.ingest import Ingest, label_gate, new_files, read_trigger
from tests.fixtures import coco_dataset, picture


@pytest.fixture
def dataset(tmp_path):
    coco_dataset(tmp_path)
    images = tmp_path / "raw" / "images"
    (images / "empty.png").write_bytes(b"")
    (images / "broken.png").write_bytes(b"not an image")
    (images / "tiny.png").write_bytes(pixels.png(picture(3)[:16, :16]))
    (images / "img_900.png").write_bytes(pixels.png(picture(0)))  # an exact copy
    near = picture(1).copy()
    near[0, 0] ^= 1
    (images / "img_901.png").write_bytes(pixels.png(near))
    (images / "dark.png").write_bytes(pixels.png(np.zeros((64, 64, 3), np.uint8)))
    return tmp_path


def job(root, steps, **more):
    return pipeline.Job(steps, str(root / "raw" / "images"), str(root / "out"), str(root / "raw" / "annotations"), **more)


def test_both_stages_end_to_end(spark, dataset):
    steps = pipeline.template("stage1_raw_ingestion") + pipeline.template("stage2_training_preparation")
    out = pipeline.run(spark, job(dataset, steps))
    assert out["status"] == "completed", out
    by = {r["op"]: r["metrics"] for r in out["results"]}
    assert by["validate"] == {"total_scanned": 16, "valid": 13, "invalid": 3}
    assert tuple(by["deduplicate"][k] for k in ("unique", "duplicates", "duplicate_groups")) == (11, 2, 2)
    listed = [json.loads(x)["file"] for p in (dataset / "out" / "_reports" / "validation_invalid").glob("part*") for x in p.read_text().splitlines()]
    assert sorted(listed) == ["broken.png", "empty.png", "tiny.png"]
    assert by["filter_quality"] == {"total": 11, "passed": 10, "filtered": 1}
    assert by["resize"]["resized"] == 10 and by["normalize"]["images_processed"] == 10
    assert by["convert_annotation"]["class_names"] == ["object", "thing"] and by["convert_annotation"]["converted"] == 10
    assert by["augment"]["requested"] == 2
    assert by["split"]["total"] == 10 and sum(by["split"]["splits"].values()) == 10 + by["augment"]["augmented"]
    files = {s: (sorted(p.stem for p in (dataset / "out" / s / "images").glob("*.png")), sorted(p.stem for p in (dataset / "out" / s / "labels").glob("*.txt"))) for s in ("train", "val", "test")}
    assert all(a == b for a, b in files.values()) and sum(len(a) for a, _ in files.values()) == 10 + by["augment"]["augmented"]
    line = (dataset / "out" / next(s for s in files if "img_000" in files[s][0]) / "labels" / "img_000.txt").read_text().split()
    scale = 640 / 96
    assert line[0] == "1" and abs(float(line[1]) - (8 + 32 / 2) * scale / 640) < 1e-6
    yaml = (dataset / "out" / "data.yaml").read_text()
    assert "nc: 2" in yaml and "train: train/images" in yaml
    stats = json.loads((dataset / "out" / "statistics.json").read_text())
    assert stats["class_distribution"]["counts"]["object"] >= 5
    assert (dataset / "out" / "_status" / "COMPLETED").exists() and not (dataset / "out" / "_status" / "FAILED").exists()


def test_missing_labels_fail_the_job_but_not_the_later_stages(spark, tmp_path):
    coco_dataset(tmp_path, 4, labels=False)
    out = pipeline.run(spark, job(tmp_path, pipeline.template("stage2_training_preparation")))
    assert out["status"] == "failed" and "COCO" in out["error"]
    assert [r["status"] for r in out["results"]][0] == "failed" and out["results"][2]["status"] == "completed"
    assert (tmp_path / "out" / "_status" / "FAILED").exists()


def test_wrong_names_fail_before_anything_runs(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown template"):
        pipeline.template("no_such_template")
    with pytest.raises(ValueError, match="unknown operator"):
        pipeline.run(spark, job(tmp_path, [{"op": "nope", "params": {}}]))
    with pytest.raises(ValueError, match="unknown parameters"):
        resolved("resize", {"sise": 1})
    with pytest.raises(ValueError, match="unknown step"):
        pipeline.parse_steps("validate,nope")
    assert not (tmp_path / "out").exists()


def test_voc_and_tiles(spark, tmp_path):
    images, labels = tmp_path / "raw" / "images", tmp_path / "raw" / "annotations"
    images.mkdir(parents=True)
    labels.mkdir()
    for i in range(2):
        a = picture(i)
        (images / f"v{i}.png").write_bytes(pixels.png(a))
        box = f"<object><name>cat</name><difficult>0</difficult><bndbox><xmin>10</xmin><ymin>10</ymin><xmax>40</xmax><ymax>30</ymax></bndbox></object>" * i
        (labels / f"v{i}.xml").write_text(f"<annotation><filename>v{i}.png</filename><size><width>{a.shape[1]}</width><height>{a.shape[0]}</height></size>{box}</annotation>")
    steps = [{"op": "validate"}, {"op": "convert_annotation", "params": {"source_format": "voc"}}, {"op": "tile", "params": {"tile_size": [64, 64], "min_resolution_to_tile": [64, 64]}}]
    out = pipeline.run(spark, job(tmp_path, steps))
    assert out["status"] == "completed", out
    assert out["results"][1]["metrics"]["class_names"] == ["cat"]
    made = list((tmp_path / "out" / "tiled_images").glob("*.png"))
    assert len(made) == out["results"][2]["metrics"]["tiles_created"] > 4


def test_md5_and_center_crop_template(spark, dataset):
    steps = [{"op": "validate"}, {"op": "deduplicate", "params": {"method": "md5"}}, {"op": "resize", "params": {"target_size": [32, 32], "method": "center_crop"}}]
    out = pipeline.run(spark, job(dataset, steps))
    assert out["results"][1]["metrics"]["duplicates"] == out["results"][1]["metrics"]["duplicate_groups"] == 1 and out["results"][2]["metrics"]["resized"] == 12


def test_of_files_with_one_stem_the_last_is_resized(spark, tmp_path):
    for folder, i in (("a", 0), ("b", 1), ("c", 2)):
        (tmp_path / "raw" / "images" / folder).mkdir(parents=True)
        (tmp_path / "raw" / "images" / folder / "same.png").write_bytes(pixels.png(picture(i)))
    state = PipelineState(spark, str(tmp_path / "raw" / "images"), str(tmp_path / "out"))
    state, m = OPERATORS["resize"](state, resolved("resize", {"target_size": [64, 64]}))
    assert (m["total"], m["resized"], m["errors"]) == (3, 3, 0)
    assert [(r.stem, r.orig_w) for r in state.transforms.collect()] == [("same", picture(2).shape[1])]
    assert state.images.count() == 1


def test_manifest_round_trip(tmp_path):
    a = job(tmp_path, [{"op": "validate", "params": {}}])
    assert pipeline.from_manifest(json.loads(json.dumps(a.to_manifest()))) == a


def test_ingest_sees_only_new_files_and_queues_triggers(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    seen, second = [], []
    ingest = Ingest(lambda files, n: seen.append(sorted(r.path.rpartition("/")[2] for r in files.collect())), second.append)
    assert ingest.on_trigger({"stage": "stage2"}) is False  # before stage 1: queued
    (root / "a.png").write_bytes(pixels.png(picture(0)))
    ingest.start(new_files(spark, str(root)), str(tmp_path / "state"), once=True).awaitTermination()
    assert seen == [["a.png"]] and second == [{"stage": "stage2"}]
    (root / "b.png").write_bytes(pixels.png(picture(1)))
    ingest.start(new_files(spark, str(root)), str(tmp_path / "state"), once=True).awaitTermination()
    assert seen == [["a.png"], ["b.png"]]
    assert ingest.on_trigger({"stage": "again"}) is True


def test_failed_stage_and_unready_trigger_stay(spark):
    files, done, ready = spark.range(1), [], []
    ingest = Ingest(lambda *_: bool(done), lambda _: bool(ready))
    ingest.on_trigger({"stage": "stage2"})
    ingest.on_batch(files, 0)  # stage 1 fails
    assert not ingest.done and len(ingest.queue) == 1
    done.append(1)
    ingest.on_batch(files, 1)  # stage 2 waits for labels
    assert ingest.done and len(ingest.queue) == 1
    ready.append(1)
    assert ingest.drain() == 1 and not ingest.queue


def test_triggers_are_read_once(spark, tmp_path):
    assert read_trigger(spark, str(tmp_path / "none")) is None
    path = tmp_path / "trigger.json"
    for text in ("", '{"stage": "st', "[1]"):
        path.write_text(text)
        assert read_trigger(spark, str(tmp_path)) is None and path.exists()
    path.write_text('{"stage": "stage2"}')
    assert read_trigger(spark, str(tmp_path)) == {"stage": "stage2"}
    assert read_trigger(spark, str(tmp_path)) is None and len(list((tmp_path / "archive").iterdir())) == 1


@pytest.mark.parametrize("labels", [True, False])
def test_watch_runs_stage_2_after_stage_1(spark, tmp_path, capsys, labels):
    coco_dataset(tmp_path, 4, labels=labels)
    raw, out = tmp_path / "raw", tmp_path / "out"
    (raw / "images" / "_watcher").mkdir()
    (raw / "images" / "_watcher" / "trigger.json").write_text(json.dumps({"stage": "stage2", "label_path": str(raw / "annotations")}))
    assert cli.main(["watch", "--input", str(raw / "images"), "--output", str(out), "--once", "--placeholder"]) == 0
    said = capsys.readouterr().out
    assert said.index("4 new files, stage 1 completed") < said.index("stage 2 completed")
    yaml = (out / "data.yaml").read_text()
    assert ("placeholder" in said, "placeholder" in yaml) == (not labels, not labels)
    lines = [p.read_text().split() for s in ("train", "val", "test") for p in (out / s / "labels").glob("img_*.txt")]
    assert len(lines) == 4 and all(len(x) == 5 for x in lines)
    if not labels:  # letterboxed: as wide as half of the picture, less high by the padding
        assert all(float(x[1]) == float(x[2]) == 0.5 and max(float(x[3]), float(x[4])) == 0.5 for x in lines)


@pytest.mark.parametrize("present,wait,timeout,waited,placeholder,want", [(True, False, 0, 0, False, "go"), (False, True, 0, 9e9, False, "wait"), (False, True, 5, 6, True, "placeholder"), (False, False, 0, 0, False, "error")])
def test_label_gate(present, wait, timeout, waited, placeholder, want):
    assert label_gate(present, waited, wait=wait, timeout=timeout, placeholder=placeholder) == want


def test_cli_lists_operators_and_verifies_batches(spark, tmp_path, capsys):
    assert cli.main(["ops"]) == 0 and "deduplicate" in capsys.readouterr().out
    for name, ids in (("a", [0, 1]), ("b", [2, 3]), ("c", [4, 4])):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"index": i, "queuePosition": i, "filename": f"f{i}", "status": "ok"}) + "\n" for i in ids))
    a, b, c = (str(tmp_path / f"{x}.jsonl") for x in "abc")
    assert cli.main(["verify", a, b, "--merged", str(tmp_path / "m")]) == 0
    assert [json.loads(x)["index"] for p in (tmp_path / "m").glob("part*") for x in p.read_text().splitlines()] == [0, 1, 2, 3]
    assert cli.main(["verify", a, c]) == 1


def test_pixel_kernels():
    a = picture(2)
    assert pixels.header_size(pixels.png(a)) == (a.shape[1], a.shape[0])
    flat = np.full((50, 70, 3), 9, np.uint8)
    for kind in ("nearest", "bilinear", "area", "cubic", "lanczos", "unknown"):
        assert (pixels.resized(flat, 33, 21, kind) == 9).all()
    halves = np.zeros((4, 4, 3), np.uint8)
    halves[:, 2:] = 200
    assert pixels.resized(halves, 2, 2)[:, :, 0].tolist() == [[0, 200], [0, 200]]
    out, t = pixels.letterbox(np.zeros((50, 100, 3), np.uint8), 64, 64)
    assert (t["pad_x"], t["pad_y"]) == (0, 16) and (out[0] == pixels.PAD).all() and (out[32] == 0).all()
    g = np.tile(np.arange(0, 170, 10, dtype=np.uint8), (16, 1))
    assert pixels.difference_hash(g).tolist() == [-1] * 4
    assert pixels.blur_score(np.full((9, 9), 7, np.uint8)) == 0.0
    assert (pixels.cutout(a, 0.5, 0.5) != a).any() and pixels.tile(a, a.shape[1] - 10, 0, 64, 64)[0, 20, 0] == pixels.PAD
