"""Jobs: an ordered list of operators, run over one dataset.

A failed stage doesn't stop the later ones; the job fails at the end (Q8).
Results are kept by the stage's place, so a repeated operator overwrites nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from .operators import stages  # noqa: F401  registers the operators
from .registry import OPERATORS, PipelineState, resolved
from .sinks import data_yaml, delete, write_json, write_text

TEMPLATES = Path(__file__).parent / "templates"


@dataclass
class Job:
    operations: list[dict[str, Any]]
    input_path: str
    output_path: str
    label_path: str | None = None
    label_format: str = "auto"
    job_id: str = field(default_factory=lambda: f"job-{uuid.uuid4().hex[:12]}")
    job_type: str = "preprocess"
    generate_data_yaml: bool = True
    created_at: str = field(default_factory=lambda: datetime.now(UTC).isoformat())
    metadata: dict[str, str] = field(default_factory=dict)

    def to_manifest(self) -> dict[str, Any]:
        """The nested form that manifests have."""
        return {"job_id": self.job_id, "job_type": self.job_type, "operations": self.operations, "input": {"data_path": self.input_path, "label_path": self.label_path, "format": self.label_format}, "output": {"data_path": self.output_path, "structure": "yolo", "generate_data_yaml": self.generate_data_yaml}, "created_at": self.created_at, "metadata": self.metadata}


def from_manifest(held: dict[str, Any]) -> Job:
    given, to = held.get("input", {}), held.get("output", {})
    extra = {k: held[k] for k in ("job_id", "job_type", "created_at", "metadata") if k in held}
    return Job([{"op": o["op"], "params": o.get("params") or {}} for o in held["operations"]], given["data_path"], to["data_path"], given.get("label_path"), given.get("format") or "auto", generate_data_yaml=to.get("generate_data_yaml", True), **extra)


def template(name: str) -> list[dict[str, Any]]:
    """Stages of a template: a file's path, or the name of one that comes with the package; stages stand at the top or below pipeline."""
    import yaml

    path = Path(name) if name.endswith((".yaml", ".yml")) else TEMPLATES / f"{name}.yaml"
    if not path.exists():
        raise ValueError(f"unknown template {name!r}; known: {', '.join(sorted(p.stem for p in TEMPLATES.glob('*.yaml')))}")
    held = yaml.safe_load(path.read_text())
    found = held.get("stages") or held.get("pipeline", {}).get("stages") or []
    return [{"op": s["op"], "params": s.get("params") or {}} for s in found]


def parse_steps(text: str) -> list[dict[str, Any]]:
    """Steps as a JSON list of objects or names, or as names between commas; an unknown step is an error."""
    held = json.loads(text) if text.lstrip().startswith("[") else [x.strip() for x in text.split(",") if x.strip()]
    out = [{"op": s, "params": {}} if isinstance(s, str) else {"op": s["op"], "params": s.get("params") or {}} for s in held]
    for s in out:
        if s["op"] not in OPERATORS:
            raise ValueError(f"unknown step {s['op']!r}")
    return out


class Status:
    """progress.json and the COMPLETED or FAILED flag below _status."""

    def __init__(self, spark: SparkSession, job: Job):
        self.spark, self.root = spark, f"{job.output_path}/_status"
        self.held = {"job_id": job.job_id, "status": "pending", "stages": [{"index": i, "op": o["op"], "status": "pending"} for i, o in enumerate(job.operations)], "started_at": datetime.now(UTC).isoformat()}
        for flag in ("COMPLETED", "FAILED"):
            delete(spark, f"{self.root}/{flag}")

    def stage(self, index: int, status: str, **more: Any) -> None:
        self.held["status"] = "in_progress"
        self.held["stages"][index] |= {"status": status, **more}
        self.save()

    def finish(self, failed: bool) -> None:
        self.held |= {"status": "failed" if failed else "completed", "ended_at": datetime.now(UTC).isoformat()}
        self.save()
        write_text(self.spark, f"{self.root}/{'FAILED' if failed else 'COMPLETED'}", self.held["ended_at"])

    def save(self) -> None:
        write_json(self.spark, f"{self.root}/progress.json", self.held)


def run(spark: SparkSession, job: Job) -> dict[str, Any]:
    """Run all stages; parameters are resolved before the first, so a wrong name fails at once."""
    plan = [(o["op"], resolved(o["op"], o.get("params") or {})) for o in job.operations]
    began, status = time.time(), Status(spark, job)
    state = PipelineState(spark, job.input_path, job.output_path, job.label_path, job.label_format)
    results, errors = [], []
    for i, (name, params) in enumerate(plan):
        status.stage(i, "in_progress")
        try:
            state, metrics = OPERATORS[name](state, params)
            results.append({"op": name, "status": "completed", "metrics": metrics})
            status.stage(i, "completed", metrics=metrics)
        except Exception as error:  # the next stages still run, on the state before this one
            errors.append(f"{name}: {error}")
            results.append({"op": name, "status": "failed", "error": str(error)})
            status.stage(i, "failed", error=str(error))
    if job.generate_data_yaml and state.assignments is not None:
        splits = [r.split for r in state.assignments.select("split").distinct().orderBy("split").collect()]
        flag = "# placeholder labels, not to be trained on\n" if job.label_format == "placeholder" else ""
        write_text(spark, f"{job.output_path}/data.yaml", flag + data_yaml(state.classes, splits))
    if not errors:
        delete(spark, f"{job.output_path}/_work")
    status.finish(bool(errors))
    out = {"job_id": job.job_id, "status": "failed" if errors else "completed", "elapsed_seconds": round(time.time() - began, 3), "results": results}
    if job.label_format == "placeholder":
        out["label_source"] = "placeholder"
    return out | ({"error": "; ".join(errors)} if errors else {})
