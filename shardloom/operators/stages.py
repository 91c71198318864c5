"""The ten operators of the image pipeline, over PipelineState."""

from __future__ import annotations

import json
import math
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixels
from ..registry import PipelineState, operator
from ..sinks import write_files, write_json
from ..sources import files as sources
from ..sources import labels as annotations
from ..storage import in_order, small, written
from . import annotate, augment, deduplicate, normalize, quality, split, statistics, tile, validate

IMAGE = "stem string, height int, width int, nChannels int, data binary"
PLACEHOLDER = "placeholder"  # the class of labels that stand for missing ones
REPORTED = 100  # rejects that a report lists; _reports has all


def _report(state: PipelineState, name: str, value: dict[str, Any]) -> None:
    write_json(state.spark, f"{state.output_path}/_work/{name}", value)


def _listed(state: PipelineState, name: str, rows: DataFrame) -> None:
    """All rows that a report lists the first of, as lines of JSON in name order."""
    rows.orderBy("pos").drop("pos").write.mode("overwrite").json(f"{state.output_path}/_reports/{name}")


def scanned(state: PipelineState) -> DataFrame:
    """All files with what one decode of each tells, written once."""
    files = sources.list_files(state.spark, state.input_path)
    measures = sources.measured(sources.decoded(state.spark, state.input_path))
    path = F.regexp_replace(F.col("path"), "^file:/+", "/")
    origin = F.regexp_replace(F.col("origin"), "^file:/+", "/")
    held = files.withColumn("__p", path).join(measures.withColumn("__p", origin), "__p", "left").drop("__p", "origin")
    return written(held, "files")


@operator("validate", check_integrity=True, min_resolution=[32, 32], max_file_size_mb=100, allowed_formats=["jpg", "jpeg", "png", "bmp"])
def run_validate(state, params):
    files = state.files if state.files is not None else scanned(state)
    limits = validate.Limits(params["check_integrity"], tuple(params["min_resolution"]), params["max_file_size_mb"], tuple(params["allowed_formats"]))
    checked = written(files.withColumn("reason", validate.reason(*(F.col(c) for c in ("extension", "size", "width", "height")), limits)), "checked")
    counts = validate.report(checked).first().asDict()
    _listed(state, "validation_invalid", checked.where("reason is not null").select("pos", F.col("name").alias("file"), "reason"))
    invalid = [{"file": r.name, "reason": r.reason} for r in checked.where("reason is not null").orderBy("pos").limit(REPORTED).collect()]
    _report(state, "validation_report.json", counts | {"invalid_files": invalid})
    return state.having(files=checked.where("reason is null").drop("reason")), counts


@operator("deduplicate", method="phash", hash_size=16, threshold=5)
def run_deduplicate(state, params):
    """Unreadable images have no hash and are left out (Q2); they are counted apart from duplicates as well."""
    state = state if state.files is not None else state.having(files=scanned(state))
    files = state.files
    total = files.count()
    if not total:
        return state, {"total": 0, "unique": 0, "duplicates": 0}
    if params["method"] == "md5":
        hashes = sources.file_hashes(state.spark, state.input_path).select(F.regexp_replace("path", "^file:/+", "/").alias("__p"), "md5")
        held = files.withColumn("__p", F.regexp_replace("path", "^file:/+", "/")).join(hashes, "__p").drop("__p")
        firsts = written(deduplicate.exact_firsts(held, "md5", "pos"), "firsts")
        kept, leaders = files.join(firsts.select("pos"), "pos", "left_semi"), firsts.where("copies > 1")
        unhashable = 0
    else:
        n = math.ceil(params["hash_size"] ** 2 / 64)
        if params["hash_size"] != 16:
            words = sources.measured(sources.decoded(state.spark, state.input_path), params["hash_size"]).select(F.regexp_replace("origin", "^file:/+", "/").alias("__p"), F.col("words").alias("__w"))
            files = files.withColumn("__p", F.regexp_replace("path", "^file:/+", "/")).join(words, "__p", "left").withColumn("words", F.col("__w")).drop("__p", "__w")
        bits = [min(64, params["hash_size"] ** 2 - 64 * i) for i in range(n)]
        held = written(files.select("*", *(F.col("words")[i].alias(f"h{i}") for i in range(n))), "hashes")
        unhashable = held.where("h0 is null").count()
        kept, leaders = deduplicate.near_walk(held, "pos", [f"h{i}" for i in range(n)], bits, params["threshold"])
        kept = kept.select(*state.files.columns)
    kept = written(kept, "unique")
    unique = kept.count()
    out = {"total": total, "unique": unique, "duplicates": total - unique, "duplicate_groups": leaders.count(), "unhashable": unhashable}
    _report(state, "dedup_report.json", {"method": params["method"], "threshold": params["threshold"], "total_files": total, "unique_files": unique, "duplicates_removed": total - unique, "duplicate_groups": out["duplicate_groups"]})
    return state.having(files=kept), out


@operator("filter_quality", min_blur_score=100, min_brightness=20, max_brightness=235, min_contrast=10)
def run_filter_quality(state, params):
    state = state if state.files is not None else state.having(files=scanned(state))
    why = quality.reasons(F.col("blur"), F.col("brightness"), F.col("contrast"), quality.Thresholds(**params))
    judged = written(state.files.withColumn("reasons", F.when(F.col("blur").isNull(), "unreadable").otherwise(why)), "judged")
    counts = judged.agg(F.count("*").alias("total"), F.count_if(F.col("reasons") == "").alias("passed"), F.count_if(F.col("reasons") != "").alias("filtered")).first().asDict()
    _listed(state, "quality_rejected", judged.where("reasons <> ''").select("pos", "name", "reasons", "blur", "brightness", "contrast"))
    rejects = [r.asDict() for r in judged.where("reasons <> ''").orderBy("pos").select("name", "reasons", "blur", "brightness", "contrast").limit(REPORTED).collect()]
    _report(state, "quality_report.json", counts | {"rejected": rejects})
    return state.having(files=judged.where("reasons = ''").drop("reasons")), counts


@operator("resize", target_size=[640, 640], method="letterbox", padding_color=114, interpolation="area")
def run_resize(state, params):
    state = _having_files(state)
    (tw, th), method, kind, fill = params["target_size"], params["method"], params["interpolation"], params["padding_color"]
    raw = sources.decoded(state.spark, state.input_path).withColumn("__p", F.regexp_replace("origin", "^file:/+", "/"))
    wanted = state.files.select(F.regexp_replace("path", "^file:/+", "/").alias("__p"), "stem", "pos")

    def scale(batches):
        for batch in batches:
            out = []
            for stem, pos, h, w, n, data in zip(*(batch[c] for c in ("stem", "pos", "height", "width", "nChannels", "data"))):
                a = pixels.from_row(bytes(data), h, w, n)
                if method == "letterbox":
                    b, t = pixels.letterbox(a, tw, th, kind, fill)
                elif method == "center_crop":
                    b, t = pixels.center_crop(a, tw, th, kind)
                else:
                    b, t = pixels.stretch(a, tw, th, kind)
                out.append((stem, th, tw, 3, b.tobytes(), t["scale_x"], t["scale_y"], t["pad_x"], t["pad_y"], w, h, pos))
            yield pd.DataFrame(out, columns=["stem", "height", "width", "nChannels", "data", "scale_x", "scale_y", "pad_x", "pad_y", "orig_w", "orig_h", "pos"])

    schema = f"{IMAGE}, scale_x double, scale_y double, pad_x double, pad_y double, orig_w int, orig_h int, pos long"
    done = written(raw.join(small(wanted), "__p").select("stem", "pos", "height", "width", "nChannels", "data").mapInPandas(scale, schema), "resized")
    sizes = done.agg(F.count("*").alias("n"), F.avg("orig_w").alias("w"), F.avg("orig_h").alias("h")).first()
    last = written(done.groupBy("stem").agg(F.max("pos").alias("pos")), "stems")  # files of one stem have one output, the last one's
    done = done.join(small(last), ["stem", "pos"], "left_semi")
    total = state.files.count()
    transforms = done.select("stem", F.lit(method).alias("mode"), "scale_x", "scale_y", "pad_x", "pad_y", "orig_w", "orig_h", F.lit(tw).alias("out_w"), F.lit(th).alias("out_h"))
    transforms.write.mode("overwrite").parquet(f"{state.output_path}/_work/transforms")
    out = {"total": total, "resized": sizes.n, "errors": total - sizes.n, "target_size": [tw, th], "method": method, "avg_original_size": [int(sizes.w or 0), int(sizes.h or 0)]}
    write_json(state.spark, f"{state.output_path}/resize_transform.json", {"method": method, "target_size": [tw, th], "images": sizes.n, "table": "_work/transforms"})
    images = done.select("stem", "height", "width", "nChannels", "data")
    return state.having(images=images, transforms=state.spark.read.parquet(f"{state.output_path}/_work/transforms")), out


@operator("normalize", per_channel_mean=True, per_channel_std=True)
def run_normalize(state, params):
    state = state if state.files is not None else state.having(files=scanned(state))
    held = state.files.where("mean is not null").withColumn("n", F.col("height").cast("long") * F.col("width"))
    if held.isEmpty():
        out = {"mean": [0.0] * 3, "std": [1.0] * 3, "images_processed": 0, "total_pixels": 0}
    else:
        rows = [normalize.pooled(held, F.col("n"), F.col("mean")[i], F.col("std")[i]).first() for i in range(3)]
        out = {"mean": [r["mean"] for r in rows], "std": [r["std"] for r in rows], "images_processed": rows[0].parts, "total_pixels": rows[0].total}
    return state.having(statistics=state.statistics | {"normalization": out}), out


def _transforms(state: PipelineState) -> DataFrame | None:
    """The resize transform: of this run, else persisted near the input or output; a centre crop cannot be mapped."""
    if state.transforms is not None:
        held = state.transforms
    else:
        from ..sinks import exists

        near = [f"{p}/_work/transforms" for p in (state.input_path, f"{state.input_path}/..", state.output_path)]
        found = next((p for p in near if exists(state.spark, p)), None)
        if found is None:
            return None
        held = state.spark.read.parquet(found)
    return held.where("mode <> 'center_crop'")


def _having_files(state: PipelineState) -> PipelineState:
    """With all files of the input as the working set, if no stage has made one."""
    return state if state.files is not None else state.having(files=sources.list_files(state.spark, state.input_path))


def _stems(state: PipelineState) -> DataFrame:
    if state.images is not None:
        return state.images.select("stem").distinct()
    return _having_files(state).files.select("stem").distinct()


def _placeholders(state: PipelineState) -> tuple[PipelineState, dict[str, Any]]:
    """The central half of each picture as a box of one class; not to be trained on."""
    stems, transforms = _stems(state), _transforms(state)
    half = {"w": F.lit(0.5), "h": F.lit(0.5)}
    held = stems
    if transforms is not None:  # half of the picture within its padding
        held = stems.join(transforms.select("stem", "pad_x", "pad_y", "out_w", "out_h"), "stem", "left")
        half = {s: F.round(F.coalesce(0.5 - F.col(f"pad_{a}") / F.col(f"out_{s}"), F.lit(0.5)), 6) for s, a in (("w", "x"), ("h", "y"))}
    middle = (F.lit(0.5).alias(c) for c in ("cx", "cy"))
    labels = written(held.select("stem", F.lit(0).alias("ord"), F.lit(0).alias("class_id"), *middle, *(v.alias(k) for k, v in half.items())), "labels")
    out = {"source_format": "placeholder", "classes": 1, "class_names": [PLACEHOLDER], "warning": "placeholder labels, not to be trained on", "converted": labels.count()}
    return state.having(labels=labels, annotated=written(stems, "annotated"), classes=(PLACEHOLDER,)), out


@operator("convert_annotation", source_format=None, target_format="yolo")
def run_convert_annotation(state, params):
    if state.label_format == "placeholder":
        return _placeholders(state)
    root = state.label_path or f"{state.input_path}/../annotations"
    kind = params["source_format"] or state.label_format
    found, document = annotations.detect(state.spark, root)
    kind = found if kind in (None, "auto") else kind
    stems = _stems(state)
    if kind == "coco":
        if document is None:
            raise FileNotFoundError(f"no COCO annotations below {root}")
        images, boxes, categories = annotations.coco(state.spark, document)
        classes = annotate.class_remap(categories, "id")
        names = tuple(r.name for r in classes.orderBy("class_id").collect())
        known = images.withColumn("stem", annotations.stem_of(F.col("file_name"))).groupBy("stem").agg(F.max_by("id", "id").alias("image_id"), F.max_by("width", "id").alias("iw"), F.max_by("height", "id").alias("ih"))
        held = stems.join(known, "stem").join(boxes.where("coalesce(iscrowd, 0) = 0"), "image_id").join(small(classes.select(F.col("id").alias("category_id"), "class_id")), "category_id")
        transforms = _transforms(state)
        if transforms is not None:
            held = held.join(transforms.select("stem", "scale_x", "scale_y", "pad_x", "pad_y", "out_w", "out_h"), "stem", "left")
            t = {k: F.coalesce(k, F.lit(v)) for k, v in (("scale_x", 1.0), ("scale_y", 1.0), ("pad_x", 0.0), ("pad_y", 0.0))}
            width, height = F.coalesce("out_w", "iw"), F.coalesce("out_h", "ih")
        else:
            t, width, height = None, F.col("iw"), F.col("ih")
        box = annotate.coco_box(*(F.col("bbox")[i] for i in range(4)), width.cast("double"), height.cast("double"), t)
        labels = held.select("stem", "ord", "class_id", *(v.alias(k) for k, v in box.items()))
        out = {"source_format": "coco", "classes": len(names), "class_names": list(names), "resize_transform_applied": transforms is not None}
    elif kind == "voc":
        docs, objects = annotations.voc(state.spark, f"{root}/*.xml")
        names = tuple(r.name for r in objects.select("name").where("name is not null").distinct().orderBy("name").collect())  # a class list
        classes = state.spark.createDataFrame(list(enumerate(names)), "class_id int, name string")
        box = annotate.voc_box(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), F.col("width"), F.col("height"))
        labels = objects.join(stems, "stem", "left_semi").join(F.broadcast(classes), "name").select("stem", "ord", "class_id", *(v.alias(k) for k, v in box.items()))
        out = {"source_format": "voc", "classes": len(names), "class_names": list(names)}
    elif kind == "yolo":
        return state, {"status": "skipped", "reason": "annotations are in YOLO format already"}
    else:
        raise ValueError(f"unsupported or missing annotations below {root}: {kind}")
    labels = written(labels, "labels")
    return state.having(labels=labels, annotated=written(stems, "annotated"), classes=names), out | {"converted": labels.select("stem").distinct().count()}


def _pixels_of(state: PipelineState) -> DataFrame:
    """stem and pixels of the working set, resized ones if there are any."""
    if state.images is not None:
        return state.images
    state = _having_files(state)
    raw = sources.decoded(state.spark, state.input_path).withColumn("__p", F.regexp_replace("origin", "^file:/+", "/"))
    wanted = state.files.select(F.regexp_replace("path", "^file:/+", "/").alias("__p"), "stem")
    return raw.join(small(wanted), "__p").select("stem", "height", "width", "nChannels", "data")


@operator("augment", methods=["mosaic", "cutout"], num_augmented=0, target_size=[640, 640], seed=42)
def run_augment(state, params):
    spark, (tw, th), seed = state.spark, params["target_size"], params["seed"]
    images = _pixels_of(state)
    numbered = in_order(images.select("stem"), "stem", name="pos")
    total = numbered.count()
    n = augment.count_of(total, params["num_augmented"])
    if not total:
        return state, {"methods": params["methods"], "requested": n, "augmented": 0}
    recipes = augment.recipes(spark.range(n).withColumnRenamed("id", "item"), "item", tuple(params["methods"]), total, seed)
    parts = recipes.where("method <> 'skip'").select("item", "method", F.posexplode("sources").alias("slot", "pos")).join(numbered, "pos").join(images, "stem")
    none = state.labels if state.labels is not None else spark.createDataFrame([], "stem string, ord int, class_id int, cx double, cy double, w double, h double")
    boxes = none.groupBy("stem").agg(F.collect_list(F.struct("ord", "class_id", "cx", "cy", "w", "h")).alias("boxes"))
    parts = parts.join(boxes, "stem", "left").select("item", "method", "slot", "height", "width", "nChannels", "data", "boxes")

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("slot")
        item, method = int(frame["item"].iloc[0]), frame["method"].iloc[0]
        rng = np.random.default_rng(seed * 1000003 + item)
        arrays = [pixels.from_row(bytes(d), h, w, c) for d, h, w, c in zip(frame["data"], frame["height"], frame["width"], frame["nChannels"])]
        held = [sorted(b, key=lambda x: x["ord"]) if b is not None else [] for b in frame["boxes"]]
        labels = []
        if method == "mosaic":
            xc, yc = int(rng.integers(tw // 4, 3 * tw // 4 + 1)), int(rng.integers(th // 4, 3 * th // 4 + 1))
            a, at = pixels.mosaic(arrays, tw, th, xc, yc)
            for bs, (left, top, nw, nh) in zip(held, at):
                for b in bs:
                    cx, cy, w, h = (b["cx"] * nw + left) / tw, (b["cy"] * nh + top) / th, min(1.0, b["w"] * nw / tw), min(1.0, b["h"] * nh / th)
                    if 0 < cx < 1 and 0 < cy < 1 and w > 0.001 and h > 0.001:
                        labels.append((b["class_id"], cx, cy, w, h))
        else:
            a = pixels.mixup(arrays[0], arrays[1], float(rng.beta(0.5, 0.5))) if method == "mixup" else pixels.cutout(arrays[0], rng.random(), rng.random())
            labels = [(b["class_id"], b["cx"], b["cy"], b["w"], b["h"]) for bs in held for b in bs]
        spelled = json.dumps(labels)
        return pd.DataFrame({"stem": [f"{method}_{item:05d}"], "height": [a.shape[0]], "width": [a.shape[1]], "nChannels": [3], "data": [a.tobytes()], "labels": [spelled]})

    done = written(parts.groupBy("item").applyInPandas(make, f"{IMAGE}, labels string"), "augmented")
    boxes = done.select("stem", F.posexplode(F.from_json("labels", "array<array<double>>")).alias("ord", "b")).select("stem", "ord", F.col("b")[0].cast("int").alias("class_id"), *(F.col("b")[i + 1].alias(c) for i, c in enumerate(("cx", "cy", "w", "h"))))
    out = {"methods": params["methods"], "requested": n, "augmented": done.count()}
    changed = state.having(augmented=done.drop("labels"))
    if state.labels is not None:
        columns = ["stem", "ord", "class_id", "cx", "cy", "w", "h"]
        changed = changed.having(labels=state.labels.select(*columns).unionByName(boxes), annotated=state.annotated.unionByName(done.select("stem")))
    return changed, out


@operator("split", method="random", ratios={"train": 0.8, "val": 0.15, "test": 0.05}, seed=42)
def run_split(state, params):
    """Augmented images always train; total counts the others only."""
    stems = _stems(state)
    total = stems.count()
    stratified = params["method"] == "stratified" and state.labels is not None and not state.labels.isEmpty()
    held, stratum = stems, None
    if stratified:
        held, stratum = stems.join(split.primary_class(state.labels, "stem", "class_id", "ord"), "stem", "left").withColumn("primary", F.coalesce("primary", F.lit(-1))), "primary"
    assigned = split.assigned(held, "stem", params["ratios"], params["seed"], stratum).select("stem", "split") if total else stems.withColumn("split", F.lit("train"))
    if state.augmented is not None:
        assigned = assigned.unionByName(state.augmented.select("stem", F.lit("train").alias("split")))
    assigned = written(assigned, "assignments")
    counts = {r.split: r.n for r in assigned.groupBy("split").agg(F.count("*").alias("n")).collect()}
    splits = {s: counts.get(s, 0) for s in split.ordered(params["ratios"])}
    images = _pixels_of(state)
    if state.augmented is not None:
        images = images.unionByName(state.augmented)
    _export(state, images.join(assigned, "stem"))
    out = {"total": total, "method": "stratified" if stratified else "random", "splits": splits}
    _report(state, "split_report.json", out)
    return state.having(assignments=assigned), out


def _export(state: PipelineState, images: DataFrame) -> None:
    """<split>/images/<stem>.png and <split>/labels/<stem>.txt, the latter empty where there are no boxes."""

    def encode(batches):
        for batch in batches:
            yield pd.DataFrame({"path": batch["split"] + "/images/" + batch["stem"] + ".png", "content": [pixels.png(pixels.from_row(bytes(d), h, w, c)) for d, h, w, c in zip(batch["data"], batch["height"], batch["width"], batch["nChannels"])]})

    write_files(images.select("split", "stem", "height", "width", "nChannels", "data").mapInPandas(encode, "path string, content binary"), state.output_path)
    texts = images.select("stem", "split")
    if state.labels is not None:
        line = annotate.yolo_line(*(F.col(c) for c in ("class_id", "cx", "cy", "w", "h")))
        lines = state.labels.select("stem", F.struct("ord", line.alias("line")).alias("l")).groupBy("stem").agg(F.array_sort(F.collect_list("l")).alias("l"))
        texts = texts.join(lines.select("stem", F.concat(F.concat_ws("\n", "l.line"), F.lit("\n")).alias("text")), "stem", "left")
    else:
        texts = texts.withColumn("text", F.lit(None).cast("string"))
    write_files(texts.select(F.concat("split", F.lit("/labels/"), "stem", F.lit(".txt")).alias("path"), F.coalesce("text", F.lit("")).cast("binary").alias("content")), state.output_path)


@operator("statistics", per_channel_mean=True, per_channel_std=True, class_distribution=True, bbox_statistics=True)
def run_statistics(state, params):
    out: dict[str, Any] = {"dataset_summary": {"total_images": _stems(state).count()}}
    if state.assignments is not None:
        out["dataset_summary"]["splits"] = {r.split: r.n for r in state.assignments.groupBy("split").agg(F.count("*").alias("n")).collect()}
    if state.labels is not None:
        if params["class_distribution"]:
            counts = {state.classes[r.class_id] if r.class_id < len(state.classes) else str(r.class_id): r.n for r in statistics.class_distribution(state.labels).orderBy("class_id").collect()}
            cover = statistics.coverage(state.annotated.distinct(), state.labels.groupBy("stem").agg(F.count("*").alias("n")), "stem").first().asDict()
            out["class_distribution"] = {"counts": counts, **cover}
        if params["bbox_statistics"]:
            out["bbox_statistics"] = statistics.box_statistics(state.labels, F.col("w"), F.col("h")).first().asDict()
    held = _having_files(state).files
    if "width" in held.columns:
        first = statistics.resolutions(held.select("pos", F.col("width").alias("w"), F.col("height").alias("h")), "pos")
        out["resolution_distribution"] = {r.resolution: r.n for r in first.collect()}
    out |= {k: v for k, v in state.statistics.items() if k == "normalization"}
    write_json(state.spark, f"{state.output_path}/statistics.json", out)
    return state.having(statistics=state.statistics | out), out


@operator("tile", tile_size=[640, 640], overlap=0.2, min_visibility=0.3, min_resolution_to_tile=[1280, 1280])
def run_tile(state, params):
    size = tuple(params["tile_size"])
    images = _pixels_of(state)
    cells = written(tile.grid(images.select("stem", "width", "height"), "width", "height", size, params["overlap"], tuple(params["min_resolution_to_tile"])), "tiles")
    name = F.format_string("%s_tile%03d", F.col("stem"), F.col("tile_no"))

    def cut(batches):
        for batch in batches:
            out = [pixels.png(pixels.tile(pixels.from_row(bytes(d), h, w, c), x, y, *size)) for d, h, w, c, x, y in zip(*(batch[k] for k in ("data", "height", "width", "nChannels", "tile_x", "tile_y")))]
            yield pd.DataFrame({"path": "tiled_images/" + batch["name"] + ".png", "content": out})

    held = images.join(cells.select("stem", "tile_x", "tile_y", name.alias("name")), "stem")
    write_files(held.select("name", "height", "width", "nChannels", "data", "tile_x", "tile_y").mapInPandas(cut, "path string, content binary"), state.output_path)
    out = {"total_images": images.count(), "tiled_images": cells.select("stem").distinct().count(), "tiles_created": cells.count(), "tile_size": list(size), "overlap": params["overlap"]}
    if state.labels is not None:
        boxes = state.labels.join(images.select("stem", "width", "height"), "stem").select("stem", "ord", "class_id", ((F.col("cx") - F.col("w") / 2) * F.col("width")).alias("x"), ((F.col("cy") - F.col("h") / 2) * F.col("height")).alias("y"), (F.col("w") * F.col("width")).alias("bw"), (F.col("h") * F.col("height")).alias("bh"))
        parts = tile.tile_labels(boxes, cells.select("stem", "tile_x", "tile_y", name.alias("name")), "stem", size, params["min_visibility"])
        labels = parts.select(F.col("name").alias("stem"), "ord", "class_id", F.col("t_cx").alias("cx"), F.col("t_cy").alias("cy"), F.col("t_bw").alias("w"), F.col("t_bh").alias("h"))
        columns = ["stem", "ord", "class_id", "cx", "cy", "w", "h"]
        state = state.having(labels=written(state.labels.select(*columns).unionByName(labels), "labels"), annotated=state.annotated.unionByName(cells.select(name.alias("stem"))))
    return state, out
