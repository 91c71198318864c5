"""A7-A10 geometry of resizing: scale, size and padding as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def letterbox(w: Column, h: Column, tw: int, th: int) -> dict[str, Column]:
    """Fit into tw x th keeping the aspect; the rest is padded evenly, the odd pixel at right and bottom."""
    scale = F.least(F.lit(float(tw)) / w, F.lit(float(th)) / h)
    nw, nh = F.floor(w * scale).cast("int"), F.floor(h * scale).cast("int")
    left, top = F.floor((F.lit(tw) - nw) / 2).cast("int"), F.floor((F.lit(th) - nh) / 2).cast("int")
    return {"scale_x": scale, "scale_y": scale, "new_w": nw, "new_h": nh, "pad_x": left, "pad_y": top}


def center_crop(w: Column, h: Column) -> dict[str, Column]:
    """The centred square, which is then scaled; boxes cannot be mapped from the transform alone."""
    side = F.least(w, h)
    return {"crop_x": F.floor((w - side) / 2).cast("int"), "crop_y": F.floor((h - side) / 2).cast("int"), "side": side.cast("int")}


def stretch(w: Column, h: Column, tw: int, th: int) -> dict[str, Column]:
    return {"scale_x": F.lit(float(tw)) / w, "scale_y": F.lit(float(th)) / h, "new_w": F.lit(tw), "new_h": F.lit(th), "pad_x": F.lit(0), "pad_y": F.lit(0)}
