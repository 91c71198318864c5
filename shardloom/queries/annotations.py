"""Kernels of annotation conversion, augmentation, splitting and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate, augment, resize, split, statistics
from ..storage import table
from .base import ANN, IMG, ann, ann_plain, img, img_pos, kernel

MAP = "classes AS (SELECT cat, CAST(dense_rank() OVER (ORDER BY cat) - 1 AS INTEGER) AS class_id FROM (SELECT DISTINCT cat FROM ann))"
COCO = f"""{IMG}, {ANN}, {MAP}, t AS (SELECT image_id, least(CAST(640 AS DOUBLE) / w, CAST(640 AS DOUBLE) / h) AS scale, w, h FROM img),
p AS (SELECT image_id, scale, floor((640 - floor(w * scale)) / 2) AS px, floor((640 - floor(h * scale)) / 2) AS py FROM t),
yolo AS (SELECT ann.image_id, ord, class_id, greatest(0, least(1, ((x * scale + px) + bw * scale / 2.0) / 640)) AS cx, greatest(0, least(1, ((y * scale + py) + bh * scale / 2.0) / 640)) AS cy, greatest(0, least(1, bw * scale / 640)) AS w, greatest(0, least(1, bh * scale / 640)) AS h
FROM ann JOIN p ON p.image_id = ann.image_id JOIN classes ON classes.cat = ann.cat WHERE NOT iscrowd)"""


FIX = "floor({0} * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1000000 AS DOUBLE)"
FIXED = ", ".join(f"{FIX.format(c)} AS {c}" for c in ("cx", "cy", "w", "h"))
LINE = f"printf('%d %.6f %.6f %.6f %.6f', class_id, {', '.join(FIX.format(c) for c in ('cx', 'cy', 'w', 'h'))})"


def _classes(labels):
    return annotate.class_remap(labels.select("cat").distinct(), "cat").withColumn("class_id", F.col("class_id").cast("int"))


def yolo(spark, sf_dir, ordered: bool = True):
    """Boxes of all images as YOLO labels after letterboxing to 640 x 640."""
    images = img(spark, sf_dir)
    t = resize.letterbox(F.col("iw"), F.col("ih"), 640, 640)
    labels = (ann if ordered else ann_plain)(spark, sf_dir).where(~F.col("iscrowd"))
    held = labels.join(images.select("image_id", F.col("w").alias("iw"), F.col("h").alias("ih")), "image_id").join(F.broadcast(_classes(ann_plain(spark, sf_dir))), "cat")  # seven classes at most
    box = annotate.coco_box(F.col("x"), F.col("y"), F.col("bw"), F.col("bh"), F.lit(640.0), F.lit(640.0), {"scale_x": t["scale_x"], "scale_y": t["scale_y"], "pad_x": t["pad_x"], "pad_y": t["pad_y"]})
    return held.select("image_id", *(["ord"] if ordered else []), "class_id", *(v.alias(k) for k, v in box.items()))


@kernel(f"WITH {COCO} SELECT image_id, ord, class_id, {FIXED} FROM yolo")
def k_coco_to_yolo(spark, sf_dir):
    return yolo(spark, sf_dir).select("image_id", "ord", "class_id", *(annotate.fixed6(F.col(c)).alias(c) for c in ("cx", "cy", "w", "h")))


@kernel(f"WITH {ANN}, {MAP} SELECT cat, class_id FROM classes")
def k_class_remap(spark, sf_dir):
    return _classes(ann_plain(spark, sf_dir))


@kernel(f"""WITH {IMG}, {ANN}, c AS (SELECT cat, count(*) AS n FROM ann GROUP BY cat), names AS (SELECT unnest([1, 4, 7, 10, 13, 16]) AS cat)
SELECT CASE WHEN names.cat IS NULL THEN 'unknown' ELSE 'class_' || c.cat END AS category, sum(n)::BIGINT AS annotations, (SELECT count(DISTINCT image_id) FROM ann)::BIGINT AS images_with, (SELECT count(*) FROM img WHERE image_id NOT IN (SELECT image_id FROM ann))::BIGINT AS images_without
FROM c LEFT JOIN names ON names.cat = c.cat GROUP BY 1""")
def k_coco_stats(spark, sf_dir):
    labels = ann_plain(spark, sf_dir)
    counts = labels.groupBy("image_id").agg(F.count("*").alias("n"))
    cover = statistics.coverage(img(spark, sf_dir), counts, "image_id").select(F.col("with_annotations").alias("images_with"), F.col("without_annotations").alias("images_without"))
    names = spark.createDataFrame([(c,) for c in (1, 4, 7, 10, 13, 16)], "known int")
    held = labels.groupBy("cat").agg(F.count("*").alias("n")).join(F.broadcast(names), F.col("cat") == F.col("known"), "left")
    category = F.when(F.col("known").isNull(), "unknown").otherwise(F.concat(F.lit("class_"), F.col("cat").cast("string")))
    return held.groupBy(category.alias("category")).agg(F.sum("n").alias("annotations")).join(F.broadcast(cover))  # one row


@kernel(f"""WITH {IMG}, {ANN}, names AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) - 1 AS INTEGER) AS class_id FROM (SELECT DISTINCT cat FROM ann WHERE cat <> 10))
SELECT ann.image_id, ord, class_id, {FIX.format('((x + (x + bw)) / 2.0 / w)')} AS cx, {FIX.format('((y + (y + bh)) / 2.0 / h)')} AS cy, {FIX.format('(((x + bw) - x) / w)')} AS bw, {FIX.format('(((y + bh) - y) / h)')} AS bh FROM ann JOIN img ON img.image_id = ann.image_id JOIN names ON names.cat = ann.cat""")
def k_voc_to_yolo(spark, sf_dir):
    labels = ann(spark, sf_dir)
    names = _classes(ann_plain(spark, sf_dir).where("cat <> 10"))
    x, y = F.col("x"), F.col("y")
    box = annotate.voc_box(x, y, x + F.col("bw"), y + F.col("bh"), F.col("iw"), F.col("ih"))
    held = labels.join(img(spark, sf_dir).select("image_id", F.col("w").alias("iw"), F.col("h").alias("ih")), "image_id").join(F.broadcast(names), "cat")
    return held.select("image_id", "ord", "class_id", annotate.fixed6(box["cx"]).alias("cx"), annotate.fixed6(box["cy"]).alias("cy"), annotate.fixed6(box["w"]).alias("bw"), annotate.fixed6(box["h"]).alias("bh"))


@kernel(f"WITH {COCO} SELECT image_id, ord, {LINE} AS line FROM yolo")
def k_yolo_format(spark, sf_dir):
    return yolo(spark, sf_dir).select("image_id", "ord", annotate.yolo_line(*(F.col(c) for c in ("class_id", "cx", "cy", "w", "h"))).alias("line"))


@kernel(f"""WITH {COCO}, lines AS (SELECT image_id, ord, {LINE} || CASE WHEN ord % 3 = 0 THEN ' extra' ELSE '' END AS line FROM yolo WHERE ord % 5 <> 0)
SELECT image_id, ord, CAST(split_part(line, ' ', 1) AS INTEGER) AS class_id, CAST(split_part(line, ' ', 2) AS DOUBLE) AS cx, CAST(split_part(line, ' ', 3) AS DOUBLE) AS cy, CAST(split_part(line, ' ', 4) AS DOUBLE) AS w, CAST(split_part(line, ' ', 5) AS DOUBLE) AS h FROM lines""")
def k_yolo_parse(spark, sf_dir):
    line = annotate.yolo_line(*(F.col(c) for c in ("class_id", "cx", "cy", "w", "h")))
    line = F.when(F.col("ord") % 5 == 0, "1 0.5").when(F.col("ord") % 3 == 0, F.concat(line, F.lit(" extra"))).otherwise(line)
    return annotate.yolo_parse(yolo(spark, sf_dir).select("image_id", "ord", line.alias("value")))


@kernel(f"WITH {IMG} SELECT stem, 0 AS class_id, CAST(0.5 AS DOUBLE) AS cx, CAST(0.5 AS DOUBLE) AS cy, CAST(0.5 AS DOUBLE) AS w, CAST(0.5 AS DOUBLE) AS h, 'placeholder' AS label_source FROM img")
def k_placeholder_labels(spark, sf_dir):
    half = [F.lit(0.5).alias(c) for c in ("cx", "cy", "w", "h")]
    return img(spark, sf_dir).select("stem", F.lit(0).alias("class_id"), *half, F.lit("placeholder").alias("label_source"))


@kernel(f"WITH {IMG}, {ANN}, s AS (SELECT image_id FROM img ORDER BY image_id LIMIT 200) SELECT ann.image_id, ord, cat, x, y, bw, round_even(bh, 6) AS bh FROM ann WHERE image_id IN (SELECT image_id FROM s)")
def k_coco_subset(spark, sf_dir):
    first = img(spark, sf_dir).select("image_id").orderBy("image_id").limit(200)
    return ann(spark, sf_dir).join(F.broadcast(first), "image_id", "left_semi").select("image_id", "ord", "cat", "x", "y", "bw", F.bround("bh", 6).alias("bh"))


# Augmentation: a recipe for each fifth image, sources by hash.
PICK = "CAST(concat('0x', substr(md5('42:' || item || ':{0}'), 1, 8)) AS BIGINT)"
PLAN = f"""n AS (SELECT count(*) AS n FROM orders), items AS (SELECT unnest(range(0, greatest(1, n // 5))) AS item, n FROM n),
r AS (SELECT item, ['mosaic', 'cutout', 'mixup', 'skip'][{PICK.format(99)} % 4 + 1] AS method, {', '.join(f'{PICK.format(k)} % n AS s{k}' for k in range(4))} FROM items)"""
METHODS = ("mosaic", "cutout", "mixup", "cutmix")


def _recipes(spark, sf_dir):
    n = table(spark, sf_dir, "orders").count()
    return augment.recipes(spark.range(augment.count_of(n)).withColumnRenamed("id", "item"), "item", METHODS, n, 42)


@kernel(f"WITH {PLAN} SELECT item, method, CASE method WHEN 'mosaic' THEN s0 || ',' || s1 || ',' || s2 || ',' || s3 WHEN 'mixup' THEN s0 || ',' || s1 WHEN 'cutout' THEN CAST(s0 AS VARCHAR) ELSE '' END AS sources FROM r")
def k_augment_plan(spark, sf_dir):
    return _recipes(spark, sf_dir).select("item", "method", F.concat_ws(",", F.transform("sources", lambda s: s.cast("string"))).alias("sources"))


@kernel(f"""WITH {PLAN}, {COCO}, u AS (SELECT item, unnest([s0, s1]) AS pos, unnest([0, 1]) AS slot FROM r WHERE method = 'mixup')
SELECT item, slot, ord, class_id, {FIX.format('cx')} AS cx, {FIX.format('cy')} AS cy, {FIX.format('yolo.w')} AS w, {FIX.format('yolo.h')} AS h FROM u JOIN img ON img.pos = u.pos JOIN yolo ON yolo.image_id = img.image_id""")
def k_mixup_labels(spark, sf_dir):
    sources = _recipes(spark, sf_dir).where("method = 'mixup'").select("item", F.posexplode("sources").alias("slot", "pos"))
    held = sources.join(img_pos(spark, sf_dir).select("pos", "image_id"), "pos").join(yolo(spark, sf_dir), "image_id")
    return held.select("item", "slot", "ord", "class_id", *(annotate.fixed6(F.col(c)).alias(c) for c in ("cx", "cy", "w", "h")))


REGION = "CASE slot WHEN 0 THEN 0 WHEN 1 THEN xc WHEN 2 THEN 0 ELSE xc END AS x0, CASE slot WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE yc END AS y0, CASE slot WHEN 0 THEN xc WHEN 2 THEN xc ELSE 640 END AS x1, CASE slot WHEN 0 THEN yc WHEN 1 THEN yc ELSE 640 END AS y1"


@kernel(f"""WITH {PLAN}, {COCO}, u AS (SELECT item, unnest([s0, s1, s2, s3]) AS pos, unnest([0, 1, 2, 3]) AS slot, 160 + item % 320 AS xc, 160 + item * 7 % 320 AS yc FROM r WHERE method = 'mosaic'),
g AS (SELECT item, pos, slot, {REGION} FROM u),
j AS (SELECT item, slot, ord, class_id, cx, cy, yolo.w AS bw, yolo.h AS bh, x0, y0, x1, y1, least((x1 - x0) / CAST(img.w AS DOUBLE), (y1 - y0) / CAST(img.h AS DOUBLE)) AS s, img.w AS iw, img.h AS ih FROM g JOIN img ON img.pos = g.pos JOIN yolo ON yolo.image_id = img.image_id),
m AS (SELECT *, floor(iw * s) AS nw, floor(ih * s) AS nh FROM j),
o AS (SELECT item, slot, ord, class_id, (cx * nw + (x0 + floor((x1 - x0 - nw) / 2))) / 640 AS cx, (cy * nh + (y0 + floor((y1 - y0 - nh) / 2))) / 640 AS cy, least(bw * nw / 640, 1) AS w, least(bh * nh / 640, 1) AS h FROM m)
SELECT item, slot, ord, class_id, {FIXED} FROM o WHERE cx > 0 AND cx < 1 AND cy > 0 AND cy < 1 AND w > 0.001 AND h > 0.001""")
def k_mosaic_labels(spark, sf_dir):
    sources = _recipes(spark, sf_dir).where("method = 'mosaic'").select("item", (160 + F.col("item") % 320).alias("xc"), (160 + F.col("item") * 7 % 320).alias("yc"), F.posexplode("sources").alias("slot", "pos"))
    images = img_pos(spark, sf_dir).select("pos", "image_id", F.col("w").cast("double").alias("iw"), F.col("h").cast("double").alias("ih"))
    held = sources.join(images, "pos").join(yolo(spark, sf_dir), "image_id")
    slot, xc, yc = F.col("slot"), F.col("xc"), F.col("yc")
    region = {"x0": F.when(slot.isin(1, 3), xc).otherwise(0), "y0": F.when(slot >= 2, yc).otherwise(0), "x1": F.when(slot.isin(0, 2), xc).otherwise(640), "y1": F.when(slot < 2, yc).otherwise(640)}
    box = augment.mosaic_label(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), region, (640, 640), (F.col("iw"), F.col("ih")))
    held = held.select("item", "slot", "ord", "class_id", *(v.alias(k) for k, v in box.items())).where(augment.mosaic_kept(F.col("cx"), F.col("cy"), F.col("w"), F.col("h")))
    return held.select("item", "slot", "ord", "class_id", *(annotate.fixed6(F.col(c)).alias(c) for c in ("cx", "cy", "w", "h")))


# Splits. Shares are whole numbers of twentieths, so that both engines floor the same numbers.
SPLITS = "splits AS (SELECT unnest(['train', 'val', 'test']) AS split, unnest([0, 1, 2]) AS i, unnest([CAST(0.8 AS DOUBLE), CAST(0.15 AS DOUBLE), CAST(0.05 AS DOUBLE)]) AS r)"
QUOTA = f"""{SPLITS}, want AS (SELECT g, n, split, i, n * r AS want, CAST(floor(n * r) AS BIGINT) AS base FROM sizes, splits),
need AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY want - base DESC, i) AS k, n - sum(base) OVER (PARTITION BY g) AS rest FROM want),
quota AS (SELECT g, split, i, base + CASE WHEN k <= rest THEN 1 ELSE 0 END AS c FROM need),
spans AS (SELECT g, split, c, coalesce(sum(c) OVER (PARTITION BY g ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM quota)"""


@kernel(f"""WITH {IMG}, o AS (SELECT image_id, row_number() OVER (ORDER BY md5('42:' || image_id), image_id) - 1 AS k FROM img), sizes AS (SELECT 0 AS g, count(*) AS n FROM img), {QUOTA}
SELECT image_id, split FROM o JOIN spans ON k >= a AND k < a + c""")
def k_split_random(spark, sf_dir):
    return split.assigned(img(spark, sf_dir).select("image_id"), "image_id").select("image_id", "split")


CARRY = f"""{SPLITS}, ordered AS (SELECT g, n, row_number() OVER (ORDER BY g) AS k FROM sizes),
fold(k, g, counts, credits) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST([0, 0, 0] AS BIGINT[]), CAST([0, 0, 0] AS DOUBLE[]) UNION ALL
SELECT k, g, c, list_transform([1, 2, 3], lambda j: want[j] - c[j]) FROM (
SELECT k, g, want, list_transform([1, 2, 3], lambda j: base[j] + CASE WHEN len(list_filter([1, 2, 3], lambda m: want[m] - base[m] > want[j] - base[j] OR (want[m] - base[m] = want[j] - base[j] AND m < j))) < n - list_sum(base) THEN 1 ELSE 0 END) AS c FROM (
SELECT k, g, n, want, list_transform(want, lambda x: CAST(greatest(0, floor(x)) AS BIGINT)) AS base FROM (
SELECT o.k, o.g, o.n, [o.n * CAST(0.8 AS DOUBLE) + credits[1], o.n * CAST(0.15 AS DOUBLE) + credits[2], o.n * CAST(0.05 AS DOUBLE) + credits[3]] AS want FROM fold JOIN ordered o ON o.k = fold.k + 1) a) b) c),
spans AS (SELECT g, unnest(['train', 'val', 'test']) AS split, unnest(counts) AS c, unnest([0, counts[1], counts[1] + counts[2]]) AS a FROM fold WHERE k > 0)"""
PRIMARY = "byclass AS (SELECT image_id, cat, count(*) AS n, min(ord) AS first FROM ann GROUP BY image_id, cat), prim AS (SELECT img.image_id, coalesce(p.cat, -1) AS g FROM img LEFT JOIN (SELECT image_id, cat FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY n DESC, first) AS k FROM byclass) WHERE k = 1) p ON p.image_id = img.image_id), sizes AS (SELECT g, count(*) AS n FROM prim GROUP BY g)"


def _primary(spark, sf_dir):
    held = img(spark, sf_dir).select("image_id").join(split.primary_class(ann(spark, sf_dir), "image_id", "cat", "ord"), "image_id", "left")
    return held.withColumn("primary", F.coalesce("primary", F.lit(-1)).cast("int"))


def _stratified(spark, sf_dir):
    return split.assigned(_primary(spark, sf_dir), "image_id", stratum="primary")


@kernel(f"""WITH RECURSIVE {IMG}, {ANN}, {PRIMARY}, {CARRY}, o AS (SELECT image_id, g, row_number() OVER (PARTITION BY g ORDER BY md5('42:' || image_id), image_id) - 1 AS k FROM prim)
SELECT image_id, o.g AS "primary", split FROM o JOIN spans ON spans.g = o.g AND o.k >= a AND o.k < a + c""")
def k_split_stratified(spark, sf_dir):
    return _stratified(spark, sf_dir).select("image_id", "primary", "split")


@kernel(f"WITH RECURSIVE {IMG}, {ANN}, {PRIMARY}, {CARRY} SELECT split, sum(c)::BIGINT AS n FROM spans GROUP BY split")
def k_split_counts(spark, sf_dir):
    return _stratified(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


@kernel(f"WITH {ANN}, sizes AS (SELECT cat AS g, count(*) AS n FROM ann GROUP BY cat), {QUOTA} SELECT g AS cat, split, CAST(c AS BIGINT) AS n FROM spans")
def k_allocate(spark, sf_dir):
    sizes = ann_plain(spark, sf_dir).groupBy("cat").agg(F.count("*").alias("n"))
    return split.apportioned(sizes, "cat", "n").withColumnRenamed("count", "n")


@kernel(f"WITH RECURSIVE {ANN}, sizes AS (SELECT cat AS g, count(*) AS n FROM ann GROUP BY cat), {CARRY} SELECT g AS cat, split, CAST(c AS BIGINT) AS n FROM spans")
def k_allocate_carry(spark, sf_dir):
    sizes = [(r.cat, r.n) for r in ann_plain(spark, sf_dir).groupBy("cat").agg(F.count("*").alias("n")).collect()]
    return spark.createDataFrame([(c, s, n) for c, s, _, n in split.allocations(sizes, split.RATIOS)], "cat int, split string, n long")


@kernel(f"""WITH {COCO}, c AS (SELECT image_id, count(*) AS n FROM yolo GROUP BY image_id)
SELECT count(*) FILTER (WHERE coalesce(n, 0) > 0) AS with_annotations, count(*) FILTER (WHERE coalesce(n, 0) = 0) AS without_annotations, sum(n)::BIGINT AS total_bboxes, round_even(CAST(sum(n) AS DOUBLE) / greatest(count(n), 1), 2) AS avg_per_image FROM img LEFT JOIN c ON c.image_id = img.image_id""")
def k_stats_coverage(spark, sf_dir):
    counts = yolo(spark, sf_dir, False).groupBy("image_id").agg(F.count("*").alias("n"))
    return statistics.coverage(img(spark, sf_dir), counts, "image_id")


@kernel(f"WITH {COCO} SELECT class_id, count(*) AS n FROM yolo GROUP BY class_id")
def k_stats_class(spark, sf_dir):
    return statistics.class_distribution(yolo(spark, sf_dir, False))


@kernel(f"""WITH {COCO} SELECT {', '.join(f'round_even({f}({c}), 4) AS {c}_{n}' for c in 'wh' for n, f in (('mean', 'avg'), ('std', 'stddev_pop'), ('min', 'min'), ('max', 'max')))}, round_even(avg(w * h), 6) AS area_mean,
count(*) FILTER (WHERE w * h < 0.001) AS small, count(*) FILTER (WHERE w * h >= 0.001 AND w * h < 0.01) AS medium, count(*) FILTER (WHERE w * h >= 0.01) AS large, round_even(avg(CASE WHEN h > 0 THEN w / h END), 4) AS aspect_mean FROM yolo""")
def k_stats_bbox(spark, sf_dir):
    return statistics.box_statistics(yolo(spark, sf_dir, False), F.col("w"), F.col("h"))


@kernel(f"WITH {IMG} SELECT w || 'x' || h AS resolution, count(*) AS n FROM (SELECT * FROM img ORDER BY image_id LIMIT 100) GROUP BY 1")
def k_stats_resolution(spark, sf_dir):
    return statistics.resolutions(img(spark, sf_dir), "image_id")
