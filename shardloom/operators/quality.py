"""A6 quality filter: blur, brightness and contrast against thresholds; every failing test is named."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    min_blur_score: float = 100
    min_brightness: float = 20
    max_brightness: float = 235
    min_contrast: float = 10


def reasons(blur: Column, brightness: Column, contrast: Column, t: Thresholds = Thresholds()) -> Column:
    """Failing tests joined by "; ", empty if none fails; comparisons are strict."""
    return F.concat_ws(
        "; ",
        F.when(blur < F.lit(float(t.min_blur_score)), "blurry"),
        F.when(brightness < F.lit(float(t.min_brightness)), "too_dark"),
        F.when(brightness > F.lit(float(t.max_brightness)), "too_bright"),
        F.when(contrast < F.lit(float(t.min_contrast)), "low_contrast"),
    )
