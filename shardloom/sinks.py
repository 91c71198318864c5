"""Files written from executors, and small reports written from the driver, in any file system that pyarrow or Hadoop reaches."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def write_files(df: DataFrame, root: str) -> None:
    """Write each row (path, content) below root; a file appears whole, by renaming."""

    def write(rows) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")
        made = set()
        for row in rows:
            path = f"{base}/{row.path}"
            folder = path.rpartition("/")[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            with store.open_output_stream(f"{path}.tmp") as f:
                f.write(bytes(row.content))
            store.move(f"{path}.tmp", path)

    df.select("path", "content").foreachPartition(write)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file from the driver; it appears whole, by renaming."""
    jvm = spark._jvm
    to, tmp = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(to, False)
    fs.rename(tmp, to)


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(value, indent=2, ensure_ascii=False, default=str))


def delete(spark: SparkSession, path: str) -> None:
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(to, True)


def exists(spark: SparkSession, path: str) -> bool:
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    return to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(to)


def data_yaml(classes: tuple[str, ...], splits: list[str]) -> str:
    lines = ["path: ."] + [f"{s}: {s}/images" for s in splits] + [f"nc: {len(classes)}", "names:"]
    return "\n".join([*lines, *(f"  - {json.dumps(c, ensure_ascii=False)}" for c in classes)]) + "\n"
