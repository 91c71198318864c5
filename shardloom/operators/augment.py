"""Augmentation recipes and their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEEDS = {"mosaic": 4, "mixup": 2, "cutout": 1}


def count_of(n_files: int, requested: int = 0) -> int:
    return requested if requested > 0 else max(1, n_files // 5)


def pick(item: Column, slot: int, seed: int, n: int) -> Column:
    """A source position for a slot of a recipe, by hash: the first 8 hex digits of md5 modulo n."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), item.cast("string"), F.lit(f":{slot}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % n


def recipes(items: DataFrame, item: str, methods: tuple[str, ...], n_files: int, seed: int) -> DataFrame:
    """Method and source positions for each item; an unknown method, or one with too few files, is a skip (Q3)."""
    which = pick(F.col(item), 99, seed, len(methods))
    usable = [m if NEEDS.get(m, n_files + 1) <= n_files else "skip" for m in methods]
    method = F.element_at(F.array(*map(F.lit, usable)), (which + 1).cast("int"))
    sources = F.array(*(pick(F.col(item), k, seed, n_files) for k in range(4)))
    need = F.when(F.col("method") == "mosaic", 4).when(F.col("method") == "mixup", 2).when(F.col("method") == "cutout", 1).otherwise(0)
    return items.withColumn("method", method).withColumn("sources", F.slice(sources, F.lit(1), need))


def mosaic_label(cx: Column, cy: Column, w: Column, h: Column, region: dict[str, Column], canvas: tuple[int, int], size: tuple[Column, Column]) -> dict[str, Column]:
    """A label of a source image, fitted and centred into a region (x0, y0, x1, y1) of the canvas; size is the source's."""
    rw, rh = region["x1"] - region["x0"], region["y1"] - region["y0"]
    scale = F.least(rw / size[0], rh / size[1])
    nw, nh = F.floor(size[0] * scale), F.floor(size[1] * scale)
    left, top = region["x0"] + F.floor((rw - nw) / 2), region["y0"] + F.floor((rh - nh) / 2)
    return {"cx": (cx * nw + left) / canvas[0], "cy": (cy * nh + top) / canvas[1], "w": F.least(w * nw / canvas[0], F.lit(1.0)), "h": F.least(h * nh / canvas[1], F.lit(1.0))}


def mosaic_kept(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return (cx > 0) & (cx < 1) & (cy > 0) & (cy < 1) & (w > 0.001) & (h > 0.001)
