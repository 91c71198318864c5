"""Tile grids, and boxes clipped to tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def starts(length: Column, tile: int, overlap: float) -> Column:
    """Start points along an axis; those beyond the border are moved back to it and may repeat."""
    stride = max(1, int(tile * (1 - overlap)))
    return F.transform(F.sequence(F.lit(0), F.greatest(length - 1, F.lit(0)), F.lit(stride)), lambda s: F.greatest(F.lit(0), F.least(s, length - tile)))


def grid(images: DataFrame, w: str, h: str, tile: tuple[int, int], overlap: float, least: tuple[int, int] = (0, 0)) -> DataFrame:
    """images with one row for each tile (tile_y, tile_x, tile_no); an image below ``least`` on both axes has none."""
    tw, th = tile
    big = images.where(~((F.col(w) < least[0]) & (F.col(h) < least[1])))
    rows = big.select("*", F.posexplode(starts(F.col(h), th, overlap)).alias("__r", "tile_y"))
    cells = rows.select("*", F.posexplode(starts(F.col(w), tw, overlap)).alias("__c", "tile_x"))
    return cells.withColumn("tile_no", (F.col("__r") * F.size(starts(F.col(w), tw, overlap)) + F.col("__c")).cast("int")).drop("__r", "__c")


def clipped(x: Column, y: Column, w: Column, h: Column, tx: Column, ty: Column, tile: tuple[int, int]) -> dict[str, Column]:
    """Part of a pixel box inside a tile: its share of the box, and centre and size normalised by the unpadded tile (Q13)."""
    tw, th = tile
    x0, y0, x1, y1 = F.greatest(x, tx), F.greatest(y, ty), F.least(x + w, tx + tw), F.least(y + h, ty + th)
    iw, ih = F.greatest(x1 - x0, F.lit(0.0)), F.greatest(y1 - y0, F.lit(0.0))
    return {"visible": iw * ih / (w * h), "cx": ((x0 + x1) / 2 - tx) / tw, "cy": ((y0 + y1) / 2 - ty) / th, "bw": iw / tw, "bh": ih / th}


def tile_labels(boxes: DataFrame, tiles: DataFrame, key: str, tile: tuple[int, int], visibility: float) -> DataFrame:
    """Boxes (key, x, y, bw, bh) in the tiles (key, tile_x, tile_y) that show enough of them; an equi-join by image, tiles of one image being few."""
    part = clipped(F.col("x"), F.col("y"), F.col("bw"), F.col("bh"), F.col("tile_x"), F.col("tile_y"), tile)
    held = boxes.join(tiles, key).where((F.col("tile_x") < F.col("x") + F.col("bw")) & (F.col("x") < F.col("tile_x") + tile[0]) & (F.col("tile_y") < F.col("y") + F.col("bh")) & (F.col("y") < F.col("tile_y") + tile[1]))
    return held.withColumns({f"t_{k}": v for k, v in part.items()}).where(F.col("t_visible") >= visibility)
