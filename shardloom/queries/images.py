"""Kernels of validation, deduplication, quality, resizing, normalisation and tiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import deduplicate, normalize, quality, resize, tile, validate
from ..storage import table, written
from .base import ANN, HASH, IMG, PX, ann_plain, hashes, img, kernel, px

LIMITS = validate.Limits(allowed_formats=("en", "fr", "de"), max_file_size_mb=0.01)


@kernel("""WITH d AS (SELECT documents.*, n_chars % 1000 + 1 AS w, n_chars % 777 + 1 AS h, labels.doc_id IS NOT NULL AS labelled FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id),
r AS (SELECT *, CASE WHEN lang NOT IN ('en', 'fr', 'de') THEN 'unsupported_format' WHEN n_chars = 0 THEN 'empty_file' WHEN n_chars > 10485 THEN 'file_too_large' WHEN w < 32 OR h < 32 THEN 'resolution_too_low' ELSE 'ok' END AS reason FROM d)
SELECT reason, count(*) AS n, count(*) FILTER (WHERE labelled) AS n_labelled FROM r GROUP BY reason""")
def k_validate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled"))
    why = validate.reason(F.col("lang"), F.col("n_chars"), F.col("n_chars") % 1000 + 1, F.col("n_chars") % 777 + 1, LIMITS)
    held = docs.join(labels, docs.doc_id == labels.labelled, "left").withColumn("reason", F.coalesce(why, F.lit("ok")))
    return held.groupBy("reason").agg(F.count("*").alias("n"), F.count("labelled").alias("n_labelled"))


@kernel("SELECT md5(text) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5(text)")
def k_dedup_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("hash"))
    return deduplicate.exact_firsts(docs, "hash", "doc_id")


@kernel(f"WITH {HASH} SELECT vec_id, h FROM hashes")
def k_dhash_bits(spark, sf_dir):
    return hashes(spark, sf_dir)


@kernel(f"WITH {HASH} SELECT a.vec_id, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM hashes a JOIN hashes b ON b.vec_id = a.vec_id + 1")
def k_hamming(spark, sf_dir):
    a = hashes(spark, sf_dir)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("h").alias("g"))
    return a.join(b, "vec_id").select("vec_id", deduplicate.hamming([F.col("h")], [F.col("g")]).cast("int").alias("distance"))


@kernel(f"WITH {HASH} SELECT a.vec_id, a.vec_id % 3 AS cut, CAST(CASE WHEN a.vec_id % 3 = 0 THEN 1000000 ELSE length(replace(bin(xor(a.h, b.h) & 255), '0', '')) END AS INTEGER) AS distance FROM hashes a JOIN hashes b ON b.vec_id = a.vec_id + 1")
def k_hamming_text(spark, sf_dir):
    bits = lambda c: F.reverse(F.lpad(F.bin(F.col(c)), 56, "0"))
    a = hashes(spark, sf_dir)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("h").alias("g"))
    held = a.join(b, "vec_id").select("vec_id", (F.col("vec_id") % 3).alias("cut"), F.substring(bits("h"), 1, 8).alias("x"), bits("g").alias("y"))
    y = F.when(F.col("cut") == 0, F.col("y")).otherwise(F.substring("y", 1, 8))
    return held.select("vec_id", "cut", deduplicate.hamming_text(F.col("x"), y, False).cast("int").alias("distance"))


THRESHOLD = 14


@kernel(f"WITH {HASH} SELECT a.vec_id AS a, b.vec_id AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM hashes a JOIN hashes b ON a.vec_id < b.vec_id WHERE bit_count(xor(a.h, b.h)) <= {THRESHOLD}")
def k_dedup_near_pairs(spark, sf_dir):
    return deduplicate.near_pairs(written(hashes(spark, sf_dir), "hashes"), "vec_id", ["h"], [56], THRESHOLD).select("a", "b", F.col("distance").cast("int").alias("distance"))


def _walk(order: str) -> str:
    return f"""WITH RECURSIVE {HASH}, s AS (SELECT vec_id, h, row_number() OVER (ORDER BY {order}) AS p FROM hashes),
walk(p, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS STRUCT(v BIGINT, h BIGINT)[]) UNION ALL
SELECT s.p, CASE WHEN len(list_filter(walk.kept, lambda k: bit_count(xor(k.h, s.h)) <= {THRESHOLD})) = 0 THEN list_append(walk.kept, {{'v': s.vec_id, 'h': s.h}}) ELSE walk.kept END FROM walk JOIN s ON s.p = walk.p + 1)
SELECT k.v AS vec_id FROM (SELECT unnest(kept) AS k FROM walk WHERE p = (SELECT max(p) FROM s)) u"""


@kernel(_walk("vec_id"))
def k_dedup_near(spark, sf_dir):
    return deduplicate.near_kept(written(hashes(spark, sf_dir), "hashes"), "vec_id", ["h"], [56], THRESHOLD).select("vec_id")


@kernel(_walk("'f' || vec_id"))
def k_global_dedup(spark, sf_dir):
    held = written(hashes(spark, sf_dir).withColumn("filename", F.concat(F.lit("f"), F.col("vec_id").cast("string"))), "records")
    return deduplicate.near_kept(held, "filename", ["h"], [56], THRESHOLD).select("vec_id")


QUALITY = quality.Thresholds(min_blur_score=1150, min_brightness=117, max_brightness=125, min_contrast=26)


@kernel(f"""WITH {PX}, m AS (SELECT vec_id, list_sum(p) AS s, list_sum(list_transform(p, lambda v: v * v)) AS q,
list_sum(list_transform(range(1, 64), lambda i: p[i + 1] - p[i])) AS ds, list_sum(list_transform(range(1, 64), lambda i: (p[i + 1] - p[i]) * (p[i + 1] - p[i]))) AS dq FROM px),
f AS (SELECT vec_id, CAST(s AS DOUBLE) / 64 AS brightness, sqrt(CAST(64 * q - s * s AS DOUBLE) / 4096) AS contrast, CAST(63 * dq - ds * ds AS DOUBLE) / 3969 AS blur FROM m)
SELECT vec_id, round_even(brightness, 4) AS brightness, round_even(contrast, 4) AS contrast, round_even(blur, 4) AS blur,
concat_ws('; ', CASE WHEN blur < 1150 THEN 'blurry' END, CASE WHEN brightness < 117 THEN 'too_dark' END, CASE WHEN brightness > 125 THEN 'too_bright' END, CASE WHEN contrast < 26 THEN 'low_contrast' END) AS reasons FROM f""")
def k_filter_quality(spark, sf_dir):
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    p = px(spark, sf_dir).withColumn("d", F.zip_with(F.slice("p", 2, 63), F.slice("p", 1, 63), lambda a, b: a - b))
    held = p.select("vec_id", total("p").alias("s"), total(F.transform("p", lambda v: v * v)).alias("q"), total("d").alias("ds"), total(F.transform("d", lambda v: v * v)).alias("dq"))
    s, q, ds, dq = (F.col(c) for c in ("s", "q", "ds", "dq"))
    held = held.select("vec_id", (s.cast("double") / 64).alias("brightness"), F.sqrt((64 * q - s * s).cast("double") / 4096).alias("contrast"), ((63 * dq - ds * ds).cast("double") / 3969).alias("blur"))
    why = quality.reasons(F.col("blur"), F.col("brightness"), F.col("contrast"), QUALITY)
    return held.select("vec_id", *(F.bround(c, 4).alias(c) for c in ("brightness", "contrast", "blur")), why.alias("reasons"))


@kernel(f"""WITH {IMG}, s AS (SELECT *, least(CAST(640 AS DOUBLE) / w, CAST(640 AS DOUBLE) / h) AS scale FROM img),
n AS (SELECT *, CAST(floor(w * scale) AS INTEGER) AS new_w, CAST(floor(h * scale) AS INTEGER) AS new_h FROM s)
SELECT image_id, round_even(scale, 8) AS scale, new_w, new_h, CAST(floor((640 - new_w) / 2.0) AS INTEGER) AS pad_x, CAST(floor((640 - new_h) / 2.0) AS INTEGER) AS pad_y FROM n""")
def k_letterbox(spark, sf_dir):
    t = resize.letterbox(F.col("w"), F.col("h"), 640, 640)
    return img(spark, sf_dir).select("image_id", F.bround(t["scale_x"], 8).alias("scale"), *(t[k].alias(k) for k in ("new_w", "new_h", "pad_x", "pad_y")))


@kernel(f"WITH {IMG} SELECT image_id, CAST(floor((w - least(w, h)) / 2.0) AS INTEGER) AS crop_x, CAST(floor((h - least(w, h)) / 2.0) AS INTEGER) AS crop_y, least(w, h) AS side FROM img")
def k_center_crop(spark, sf_dir):
    return img(spark, sf_dir).select("image_id", *(v.alias(k) for k, v in resize.center_crop(F.col("w"), F.col("h")).items()))


@kernel(f"WITH {IMG} SELECT image_id, round_even(CAST(640 AS DOUBLE) / w, 8) AS scale_x, round_even(CAST(480 AS DOUBLE) / h, 8) AS scale_y FROM img")
def k_stretch(spark, sf_dir):
    t = resize.stretch(F.col("w"), F.col("h"), 640, 480)
    return img(spark, sf_dir).select("image_id", F.bround(t["scale_x"], 8).alias("scale_x"), F.bround(t["scale_y"], 8).alias("scale_y"))


@kernel(f"WITH {IMG} SELECT CAST(floor(avg(w)) AS INTEGER) AS avg_w, CAST(floor(avg(h)) AS INTEGER) AS avg_h, count(*) AS total FROM img")
def k_resize_report(spark, sf_dir):
    return img(spark, sf_dir).agg(F.floor(F.avg("w")).cast("int").alias("avg_w"), F.floor(F.avg("h")).cast("int").alias("avg_h"), F.count("*").alias("total"))


@kernel(f"""WITH {PX}, m AS (SELECT list_sum(p) AS s, list_sum(list_transform(p, lambda v: v * v)) AS q FROM px),
t AS (SELECT CAST(sum(s) AS DOUBLE) / (64 * count(*)) AS mu, CAST(sum(q) AS DOUBLE) / (64 * count(*)) AS e, count(*) AS n FROM m)
SELECT round_even(mu / 255, 6) AS mean, round_even(sqrt(greatest(e - mu * mu, 0)) / 255, 6) AS std, n AS images_processed, 64 * n AS total_pixels FROM t""")
def k_normalize(spark, sf_dir):
    p = px(spark, sf_dir)
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    held = p.select(total("p").alias("s"), total(F.transform("p", lambda v: v * v)).alias("q"))
    mean = F.col("s").cast("double") / 64
    std = F.sqrt(F.greatest(F.col("q").cast("double") / 64 - mean * mean, F.lit(0.0)))
    out = normalize.pooled(held, F.lit(64), mean / 255, std / 255)
    return out.select("mean", "std", F.col("parts").alias("images_processed"), F.col("total").alias("total_pixels"))


@kernel(f"""WITH {IMG}, big AS (SELECT * FROM img WHERE w >= 1000), c AS (SELECT image_id, w, h, unnest(range(0, w, 512)) AS x0 FROM big), r AS (SELECT *, unnest(range(0, h, 512)) AS y0 FROM c)
SELECT image_id, CAST(greatest(0, least(x0, w - 640)) AS INTEGER) AS tile_x, CAST(greatest(0, least(y0, h - 640)) AS INTEGER) AS tile_y, CAST(y0 // 512 * ((w + 511) // 512) + x0 // 512 AS INTEGER) AS tile_no FROM r""")
def k_tile_grid(spark, sf_dir):
    return tile.grid(img(spark, sf_dir).where("w >= 1000"), "w", "h", (640, 640), 0.2).select("image_id", F.col("tile_x").cast("int").alias("tile_x"), F.col("tile_y").cast("int").alias("tile_y"), "tile_no")


@kernel(f"""WITH {IMG}, {ANN}, big AS (SELECT * FROM img WHERE w >= 1000), c AS (SELECT image_id, w, h, unnest(range(0, w, 512)) AS x0 FROM big), r AS (SELECT *, unnest(range(0, h, 512)) AS y0 FROM c),
t AS (SELECT image_id, greatest(0, least(x0, w - 640)) AS tx, greatest(0, least(y0, h - 640)) AS ty FROM r),
j AS (SELECT image_id, tx, ty, x, y, bw, bh, cat, greatest(least(x + bw, tx + 640) - greatest(x, tx), 0) AS iw, greatest(least(y + bh, ty + 640) - greatest(y, ty), 0) AS ih FROM ann JOIN t USING (image_id)),
k AS (SELECT * FROM j WHERE iw > 0 AND ih > 0 AND iw * ih / (bw * bh) >= 0.3)
SELECT image_id, cat, count(*) AS n, round_even(sum(iw / 640), 9) AS sum_w, round_even(sum(ih / 640), 9) AS sum_h, round_even(sum((greatest(x, tx) + least(x + bw, tx + 640)) / 2 - tx) / 640, 9) AS sum_cx FROM k GROUP BY image_id, cat""")
def k_tile_labels(spark, sf_dir):
    tiles = tile.grid(img(spark, sf_dir).where("w >= 1000"), "w", "h", (640, 640), 0.2).select("image_id", "tile_x", "tile_y")
    held = tile.tile_labels(ann_plain(spark, sf_dir), tiles, "image_id", (640, 640), 0.3)
    return held.groupBy("image_id", "cat").agg(F.count("*").alias("n"), F.bround(F.sum("t_bw"), 9).alias("sum_w"), F.bround(F.sum("t_bh"), 9).alias("sum_h"), F.bround(F.sum("t_cx"), 9).alias("sum_cx"))
