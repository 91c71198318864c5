"""Operators by name. An operator takes (state, params) and returns (state, metrics)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class PipelineState:
    """What one operator hands to the next; tables are lazy."""

    spark: SparkSession
    input_path: str
    output_path: str
    label_path: str | None = None
    label_format: str = "auto"
    files: DataFrame | None = None  # name, stem, path, pos, height, width and the measures
    images: DataFrame | None = None  # stem, height, width, nChannels, data: pixels after resizing
    annotated: DataFrame | None = None  # stems that have annotations, maybe none
    labels: DataFrame | None = None  # stem, ord, class_id, cx, cy, w, h
    classes: tuple[str, ...] = ()
    transforms: DataFrame | None = None
    assignments: DataFrame | None = None  # stem, split
    augmented: DataFrame | None = None
    statistics: dict[str, Any] = field(default_factory=dict)

    def having(self, **changes: Any) -> PipelineState:
        return replace(self, **changes)


Operator = Callable[[PipelineState, dict[str, Any]], tuple[PipelineState, dict[str, Any]]]
OPERATORS: dict[str, Operator] = {}
PARAMS: dict[str, dict[str, Any]] = {}


def operator(name: str, **defaults: Any) -> Callable[[Operator], Operator]:
    """Register an operator with its parameters' defaults; unknown parameters are an error before anything runs."""

    def add(f: Operator) -> Operator:
        OPERATORS[name], PARAMS[name] = f, defaults
        return f

    return add


def resolved(name: str, params: dict[str, Any]) -> dict[str, Any]:
    if name not in OPERATORS:
        raise ValueError(f"unknown operator {name!r}; known: {', '.join(sorted(OPERATORS))}")
    unknown = set(params) - set(PARAMS[name])
    if unknown:
        raise ValueError(f"{name}: unknown parameters {sorted(unknown)}")
    return PARAMS[name] | params
