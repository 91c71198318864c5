"""Tables in the shared folder, bounded broadcasts, and numbering without a single task."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Values of a narrow table that may be broadcast (16 MB at 16 bytes each); more are joined by a shuffle.
BROADCAST_VALUES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or our own where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='shardloom-')}"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Without it, shuffle files stay until the driver happens to collect its garbage.
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run inside removes its shuffle files when it ends; for plans that nothing runs a second time, such as writes."""
    before = spark.conf.get(_CLEANUP_CONF, None)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_CONF)
        else:
            spark.conf.set(_CLEANUP_CONF, before)


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it back, so that a lost executor costs no recomputation."""
    return written_at(df, name, codec)[0]


def written_at(df: DataFrame, name: str, codec: str = "snappy") -> tuple[DataFrame, str]:
    """The table of ``written`` and its folder, for ``discard``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/shardloom-{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.option("compression", codec).parquet(path)
    if not _WRITTEN:
        atexit.register(clear)
    _WRITTEN[path] = spark
    return spark.read.schema(df.schema).parquet(path), path


#: Written tables that are still there. Lazy results read them, so they go when the process ends, or with clear().
_WRITTEN: dict[str, SparkSession] = {}


def clear() -> None:
    """Remove all tables that this process has written and not discarded."""
    with contextlib.suppress(Exception):  # the session may be gone
        for path, spark in list(_WRITTEN.items()):
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    _WRITTEN.pop(path, None)


def small(df: DataFrame, values: Column | None = None) -> DataFrame:
    """df with a broadcast hint if it holds at most BROADCAST_VALUES values (rows, or the sum of ``values``).

    df should be cheap to count, such as a written table.
    """
    n = df.agg(F.coalesce(F.sum(values), F.lit(0)) if values is not None else F.count("*")).first()[0]
    return F.broadcast(df) if n <= BROADCAST_VALUES else df


#: Rows of one key from which it counts as hot; a table has so many times fewer hot keys than rows.
HOT_ROWS = 20_000


def joined_by_key(left: DataFrame, right: DataFrame, keys: list[str], rows: str, hot: int = HOT_ROWS) -> DataFrame:
    """Inner join with right, a written table of one row a key whose column ``rows`` tells how many rows of left have that key at most.

    Hot keys are few and their rows stay where they are; the others meet by a
    shuffle in which no key has more than ``hot`` rows.
    """
    frequent, rest = right.where(F.col(rows) > hot), right.where(F.col(rows) <= hot).drop(rows)
    if frequent.isEmpty():
        return left.join(small(rest), keys)
    frequent = small(frequent.drop(rows))
    cold = left.join(frequent.select(*keys), keys, "left_anti").join(rest, keys)
    return left.join(frequent, keys).unionByName(cold)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def in_order(rows: DataFrame, *by, name: str = "place") -> DataFrame:
    """rows with a column ``name``: the number of each in the order of the columns ``by``, gapless from 0.

    Rows are range-partitioned, numbered within their partition, and moved on by
    the number of rows before it; one count a partition comes to the driver.
    """
    spark = rows.sparkSession
    held = rows.repartitionByRange(shuffle_partitions(spark), *by).withColumn("__part", F.spark_partition_id())
    held = written(held, "ordered")
    counts = {r["__part"]: r.n for r in held.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for part in sorted(counts):
        before.append((part, total))
        total += counts[part]
    offsets = F.broadcast(spark.createDataFrame(before, "__part int, __before long"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*by))
    return held.withColumn("__within", within).join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__within") - 1).drop("__part", "__within", "__before")
