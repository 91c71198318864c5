"""Measured throughput, its acceptance, and the profile that carries it from job to job."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHA, MIN_SAMPLES, HISTORY, PIXEL_DRIFT, SAMPLE_FILES = 0.5, 5, 10, 1.5, 16


def compute_rate(n: Column, duration_ms: Column) -> Column:
    return F.when(duration_ms > 0, n * 1000.0 / duration_ms)


def effective_rate(n: Column, push_ms: Column, exec_ms: Column, pull_ms: Column, duration_ms: Column) -> Column:
    """By the whole way there and back; the compute time alone where that isn't known."""
    wall = F.coalesce(push_ms, F.lit(0)) + exec_ms + F.coalesce(pull_ms, F.lit(0))
    return F.when(exec_ms.isNull() | (wall <= 0), compute_rate(n, duration_ms)).otherwise(n * 1000.0 / wall)


def verdict(samples: Column, rate: Column, least: int = MIN_SAMPLES) -> Column:
    return F.when(samples < least, "too_few_samples").when(rate.isNull() | (rate <= 0), "no_throughput").otherwise("accepted")


def source_of(measured: Column, given: Column, policy: str = "auto") -> Column:
    """Measured throughput if the policy is auto, then what the spec gives, then none."""
    return F.when(F.lit(policy == "auto") & measured.isNotNull(), "measured").when(given.isNotNull(), "spec").otherwise("none")


def drift(a: Column, b: Column) -> Column:
    """max/min of two positive numbers; null if one is unknown."""
    return F.when((a > 0) & (b > 0), F.greatest(a, b) / F.least(a, b))


def mismatch(a: Column, b: Column, limit: float = PIXEL_DRIFT) -> Column:
    return F.coalesce(drift(a, b) > limit, F.lit(False))


def systematic_sample(files: DataFrame, position: str, n: int, most: int = SAMPLE_FILES) -> DataFrame:
    """Every step-th file, ``most`` at the most."""
    step = max(1, n // most)
    return files.where(F.pmod(F.col(position), F.lit(step)) == 0).orderBy(position).limit(most)


def ewma(measures: DataFrame, key: str, order: list[str], cpu: str, csd: str, pixels: str | None = None, alpha: float = ALPHA) -> DataFrame:
    """Profile of each key after all its measurements in order: an ordered fold.

    A side that wasn't measured keeps its value; a drift of the input's pixels
    over the limit starts the profile anew.  The measurements of one key (jobs of
    one node and template) are few.
    """
    item = F.struct(*order, F.col(cpu).cast("double").alias("cpu"), F.col(csd).cast("double").alias("csd"), (F.col(pixels).cast("double") if pixels else F.lit(None).cast("double")).alias("mp"))
    none = F.lit(None).cast("double")
    start = F.struct(none.alias("cpu"), none.alias("csd"), none.alias("mp"), F.lit(0).alias("samples"), F.lit(0).alias("resets"))

    def step(s: Column, x: Column) -> Column:
        reset = mismatch(s["mp"], x["mp"])
        mix = lambda old, new: F.when(new.isNull(), F.when(reset, none).otherwise(old)).when(old.isNull() | reset, new).otherwise(F.lit(alpha) * new + F.lit(1 - alpha) * old)
        return F.struct(mix(s["cpu"], x["cpu"]).alias("cpu"), mix(s["csd"], x["csd"]).alias("csd"), F.coalesce(x["mp"], s["mp"]).alias("mp"), F.when(reset, 1).otherwise(s["samples"] + 1).alias("samples"), (s["resets"] + reset.cast("int")).alias("resets"))

    return df_fold(measures, key, item, start, step)


def df_fold(df: DataFrame, key: str, item: Column, start: Column, step) -> DataFrame:
    folded = df.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("items")).select(key, F.aggregate("items", start, step).alias("s"))
    return folded.select(key, "s.*")


def profile_key(node: Column, device: Column, template: Column, mode: Column) -> Column:
    return F.concat_ws(".", *map(sanitised, (node, device, template, mode)))


def sanitised(x: Column, most: int = 40) -> Column:
    """Lower case, other signs than a-z, 0-9 and - as -, none at the ends, 40 characters at most."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9-]", "-"), "^-+|-+$", ""), 1, most)


def offload_mode(paths: list[str], shared_root: str) -> str:
    root = shared_root.rstrip("/")
    return "shared-volume" if root and all(p == root or p.startswith(root + "/") for p in paths) else "copy"


@dataclass
class Profile:
    """The profile of one key, as kept between jobs."""

    metric: str = "effective"
    samples: int = 0
    cpu_throughput: float | None = None
    csd_throughput: float | None = None
    avg_input_pixels: float | None = None
    reset_reason: str | None = None
    history: tuple[dict, ...] = ()

    def updated(self, job: str, at: str, cpu: float | None, csd: float | None, pixels: float | None = None, alpha: float = ALPHA) -> Profile:
        old, reset = self, None
        if self.avg_input_pixels and pixels and max(self.avg_input_pixels, pixels) / min(self.avg_input_pixels, pixels) > PIXEL_DRIFT:
            old, reset = Profile(self.metric), f"input pixels changed from {self.avg_input_pixels:.0f} to {pixels:.0f}"
        mix = lambda a, b: b if a is None else a if b is None else alpha * b + (1 - alpha) * a
        entry = {"job": job, "at": at, "cpu": cpu, "csd": csd, "mp": pixels, "reset": bool(reset)}
        return Profile(self.metric, old.samples + 1, mix(old.cpu_throughput, cpu), mix(old.csd_throughput, csd), pixels or old.avg_input_pixels, reset, (*self.history, entry)[-HISTORY:])

    def to_json(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True, default=list)


def key_of(node: str, device: str, template: str, mode: str) -> str:
    clean = lambda x: re.sub(r"[^a-z0-9-]", "-", x.lower()).strip("-")[:40]
    return ".".join(map(clean, (node, device, template, mode)))
