"""Annotation conversion as column arithmetic and joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def class_remap(categories: DataFrame, key: str = "id") -> DataFrame:
    """Each category with class_id 0..k-1 by ascending id; a category table is small by nature."""
    return categories.withColumn("class_id", F.dense_rank().over(Window.orderBy(key)) - 1)


def coco_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, transform: dict[str, Column] | None = None) -> dict[str, Column]:
    """A COCO box (corner and size) as normalised centre and size; each of the four is clamped on its own (Q6)."""
    if transform:
        x, y = x * transform["scale_x"] + transform["pad_x"], y * transform["scale_y"] + transform["pad_y"]
        w, h = w * transform["scale_x"], h * transform["scale_y"]
    return {"cx": clamp((x + w / 2.0) / width), "cy": clamp((y + h / 2.0) / height), "w": clamp(w / width), "h": clamp(h / height)}


def voc_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> dict[str, Column]:
    return {"cx": (x0 + x1) / 2.0 / width, "cy": (y0 + y1) / 2.0 / height, "w": (x1 - x0) / width, "h": (y1 - y0) / height}


def fixed6(x: Column) -> Column:
    """x at six decimals, by arithmetic that any engine repeats to the bit (formats and rounding functions differ on ties)."""
    return F.floor(x * 1000000.0 + 0.5) / 1000000.0


def yolo_line(class_id: Column, cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return F.format_string("%d %.6f %.6f %.6f %.6f", class_id.cast("int"), *map(fixed6, (cx, cy, w, h)))


def yolo_parse(lines: DataFrame, line: str = "value") -> DataFrame:
    """class_id and box of each line with five tokens or more; further tokens are ignored, shorter lines dropped."""
    t = F.filter(F.split(F.trim(line), r"\s+"), lambda x: x != "")
    held = lines.withColumn("__t", t).where(F.size("__t") >= 5)
    names = ("class_id", "cx", "cy", "w", "h")
    return held.withColumns({n: F.col("__t")[i].cast("int" if i == 0 else "double") for i, n in enumerate(names)}).drop("__t", line)
