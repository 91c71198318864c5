"""A1 validation: an ordered list of checks; the first that fails is the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    check_integrity: bool = True
    min_resolution: tuple[int, int] = (32, 32)
    max_file_size_mb: float = 100
    allowed_formats: tuple[str, ...] = ("jpg", "jpeg", "png", "bmp")


def reason(extension: Column, size: Column, width: Column, height: Column, limits: Limits = Limits()) -> Column:
    """Null for a valid file.  Width and height are null where the image can't be decoded.

    The resolution is looked at only with check_integrity, as the pixels are (Q7).
    """
    most = int(limits.max_file_size_mb * 1024 * 1024)
    out = F.when(extension.isNull() | ~F.lower(extension).isin(*limits.allowed_formats), "unsupported_format").when(size.isNull(), "unreadable").when(size == 0, "empty_file").when(size > most, "file_too_large")
    if limits.check_integrity:
        w, h = limits.min_resolution
        out = out.when(width.isNull() | height.isNull() | (width <= 0) | (height <= 0), "decode_failed").when((width < w) | (height < h), "resolution_too_low")
    return out


def report(checked: DataFrame) -> DataFrame:
    """total_scanned, valid and invalid of a table with column reason."""
    return checked.agg(F.count("*").alias("total_scanned"), F.count_if(F.col("reason").isNull()).alias("valid"), F.count_if(F.col("reason").isNotNull()).alias("invalid"))
