"""Incremental ingest with Structured Streaming.

The stream's checkpoint is the set of known files; a micro-batch is the set of
new ones. Triggers queue until the first stage has run.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BINARY = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, root: str, pattern: str = "*.{png,jpg,jpeg,bmp}", most: int | None = None) -> DataFrame:
    """A stream of files below root that haven't been seen: path, modificationTime, length."""
    reader = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if most:
        reader = reader.option("maxFilesPerTrigger", most)
    return reader.load(root).select("path", "modificationTime", "length")


def debounced(files: DataFrame, quiet: str = "3 seconds") -> DataFrame:
    """Bursts of arrivals: files less than ``quiet`` apart are one batch, emitted once it has been quiet that long."""
    held = files.withWatermark("modificationTime", quiet)
    return held.groupBy(F.session_window("modificationTime", quiet)).agg(F.count("*").alias("n"), F.collect_set("path").alias("paths")).select("session_window.start", "session_window.end", "n", "paths")


@dataclass
class Ingest:
    """Runs stage 1 on each batch of new files, and queued triggers for stage 2 after it.

    A stage that returns False has not done its work: stage 1 is not done then,
    and a trigger for stage 2 stays in the queue.  A batch or trigger that comes
    while another is at work waits for it.
    """

    stage1: Callable[[DataFrame, int], bool | None]
    stage2: Callable[[dict], bool | None]
    done: bool = False
    queue: list[dict] = field(default_factory=list)
    lock: threading.RLock = field(default_factory=threading.RLock, repr=False)

    def on_batch(self, files: DataFrame, batch: int) -> None:
        if files.isEmpty():
            return
        with self.lock:
            self.done = self.stage1(files, batch) is not False
        self.drain()

    def on_trigger(self, trigger: dict) -> bool:
        """Handle a trigger now if stage 1 is done, else queue it; tells which."""
        with self.lock:
            self.queue.append(trigger)
            return self.drain() > 0

    def drain(self) -> int:
        """Handle queued triggers for which the time has come: how many those were."""
        n = 0
        with self.lock:
            while self.done and self.queue and self.stage2(self.queue[0]) is not False:
                self.queue.pop(0)
                n += 1
        return n

    def start(self, files: DataFrame, checkpoint: str, once: bool = False, every: str = "2 seconds") -> StreamingQuery:
        writer = files.writeStream.foreachBatch(self.on_batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def label_gate(present: bool, waited: float, *, wait: bool, timeout: float = 0, placeholder: bool = False) -> str:
    """What to do about labels: go, wait, placeholder or error; a timeout of 0 waits for ever."""
    if present:
        return "go"
    if wait and (timeout <= 0 or waited < timeout):
        return "wait"
    return "placeholder" if placeholder else "error"


def _folder(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def read_trigger(spark: SparkSession, root: str) -> dict | None:
    """The object in root's trigger.json, which moves to the folder archive; one that isn't whole yet stays, and gives None like a missing one."""
    fs, top = _folder(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path(top, "trigger.json")
    if not fs.exists(path):
        return None
    try:
        held = json.loads(spark.read.option("wholetext", "true").text(path.toString()).first().value)
    except (ValueError, AttributeError):  # cut off, or empty
        return None
    if not isinstance(held, dict):
        return None
    archive = spark._jvm.org.apache.hadoop.fs.Path(top, "archive")
    fs.mkdirs(archive)
    fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(archive, f"trigger_{time.time_ns()}.json"))
    return held


def labels_found(spark: SparkSession, root: str) -> bool:
    """Whether a folder has an annotation file."""
    fs, top = _folder(spark, root)
    return fs.exists(top) and any(s.isFile() and s.getPath().getName().lower().endswith((".json", ".xml", ".txt")) for s in fs.listStatus(top))
