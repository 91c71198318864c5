"""Command line: run, status, ops, watch, verify."""

from __future__ import annotations

import argparse
import json
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def session() -> SparkSession:
    return SparkSession.builder.appName("shardloom").getOrCreate()


def run(args: argparse.Namespace) -> int:
    from .pipeline import Job, from_manifest, parse_steps, run, template

    if args.manifest:
        job = from_manifest(json.loads(Path(args.manifest).read_text()))
    else:
        steps = parse_steps(args.steps) if args.steps else template(args.template)
        job = Job(steps, args.input, args.output, args.labels)
    out = run(session(), job)
    print(json.dumps(out, indent=2, default=str))
    return int(out["status"] != "completed")


def status(args: argparse.Namespace) -> int:
    held = session().read.option("wholetext", "true").text(f"{args.output}/_status/progress.json").first()
    print(held.value)
    return 0


def ops(_: argparse.Namespace) -> int:
    from .pipeline import OPERATORS
    from .registry import PARAMS

    for name in sorted(OPERATORS):
        print(name, json.dumps(PARAMS[name]))
    return 0


def watch(args: argparse.Namespace) -> int:
    """Run stage 1 when files arrive, and stage 2 when a trigger does and its labels are there.

    Both stages run over the whole input, since duplicates, moments and splits
    concern all of it; stage 2 starts from stage 1's state.
    """
    from .pipeline import Job, run, template
    from .sinks import exists
    from .streaming.ingest import Ingest, label_gate, labels_found, new_files, read_trigger

    spark = session()
    first = template(args.template)
    both = first + template(args.stage2_template)
    asked: dict[int, float] = {}

    def stage1(files, batch):
        out = run(spark, Job(first, args.input, args.output, args.labels))
        print(f"batch {batch}: {files.count()} new files, stage 1 {out['status']}")
        return out["status"] == "completed"

    def stage2(trigger):
        if trigger.get("stage") != "stage2":
            print(f"trigger ignored: {json.dumps(trigger)}")
            return True
        labels = trigger.get("label_path") or args.labels or f"{args.input}/../annotations"
        since = asked.setdefault(id(trigger), time.monotonic())
        choice = label_gate(labels_found(spark, labels), time.monotonic() - since, wait=args.wait is not None, timeout=args.wait or 0, placeholder=args.placeholder)
        if choice == "wait":
            return False
        asked.pop(id(trigger))
        if choice == "error":
            print(f"stage 2 failed: no annotations in {labels}")
            return True
        out = run(spark, Job(both, args.input, args.output, labels, "placeholder" if choice == "placeholder" else "auto"))
        print(f"stage 2 {out['status']}" + (", with placeholder labels" if choice == "placeholder" else ""))
        return True

    ingest = Ingest(stage1, stage2, exists(spark, f"{args.output}/_status/COMPLETED"))

    def poll():
        trigger = read_trigger(spark, args.triggers or f"{args.input}/_watcher")
        if trigger is not None:
            ingest.on_trigger(trigger)
        else:
            ingest.drain()

    poll()
    query = ingest.start(new_files(spark, args.input), f"{args.output}/_watch", args.once, "3 seconds")
    if args.once:
        query.awaitTermination()
    while not args.once and not query.awaitTermination(2):
        poll()
    poll()
    return 0


def verify(args: argparse.Namespace) -> int:
    """Check batches of records and merge them, in order and without dropping any."""
    from .plans.shards import RECORD, merged

    spark = session()
    batches = [spark.read.schema(RECORD).json(p).withColumn("line_no", F.monotonically_increasing_id()) for p in args.batches]
    bad = 0
    for path, batch in zip(args.batches, batches):
        n = batch.agg(F.count("*").alias("n"), F.countDistinct("index").alias("ids"), F.count_if(F.col("index").isNull() | F.col("filename").isNull()).alias("empty")).first()
        ok = n.n == n.ids and not n["empty"]
        bad += not ok
        print(f"{path}: {n.n} records, {'ok' if ok else 'duplicate or empty ids'}")
    if args.merged and not bad:
        merged(batches).orderBy("batch_no", "line_no").drop("batch_no", "line_no").coalesce(1).write.mode("overwrite").json(args.merged)
    return int(bad > 0)


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="shardloom", description=__doc__)
    verbs = top.add_subparsers(dest="verb", required=True)
    for name, f in (("run", run), ("status", status), ("ops", ops), ("watch", watch), ("verify", verify)):
        p = verbs.add_parser(name)
        p.set_defaults(f=f)
        if name in ("run", "watch"):
            p.add_argument("--input", required=name == "watch")
            p.add_argument("--output", required=name == "watch")
            p.add_argument("--labels")
            p.add_argument("--template", default="stage1_raw_ingestion")
        if name == "run":
            p.add_argument("--manifest")
            p.add_argument("--steps")
        if name == "status":
            p.add_argument("output")
        if name == "watch":
            p.add_argument("--once", action="store_true")
            p.add_argument("--stage2-template", default="stage2_training_preparation")
            p.add_argument("--triggers", help="folder of trigger.json; by default _watcher below the input")
            p.add_argument("--wait", type=float, metavar="SECONDS", help="wait so long for labels, 0: for ever")
            p.add_argument("--placeholder", action="store_true", help="without labels, go on with placeholders")
        if name == "verify":
            p.add_argument("batches", nargs="+")
            p.add_argument("--merged")
    args = top.parse_args(argv)
    return args.f(args)


if __name__ == "__main__":
    sys.exit(main())
