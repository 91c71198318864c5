"""Listings and images."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixels
from ..storage import in_order

IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "webp", "tif", "tiff")
METRICS = "origin string, height int, width int, blur double, brightness double, contrast double, words array<long>, mean array<double>, std array<double>"


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES) -> DataFrame:
    """path, name (relative), stem, extension and size of the files below root, with their position in name order.

    The listing is Hadoop's, so that empty files, which the image readers skip, are seen too.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(conf)
    base = fs.makeQualified(top).toString().rstrip("/")
    rows, found = [], fs.listFiles(top, True)
    while found.hasNext():
        status = found.next()
        path = status.getPath().toString()
        name = path[len(base) + 1 :]
        stem, dot, extension = posixpath.basename(name).rpartition(".")
        if dot and extension.lower() in suffixes:
            rows.append((path, name, stem, extension.lower(), status.getLen()))
    files = spark.createDataFrame(rows, "path string, name string, stem string, extension string, size long")
    return in_order(files, "name", name="pos")


def file_hashes(spark: SparkSession, root: str) -> DataFrame:
    """path and md5 of the content."""
    held = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return held.select("path", F.md5("content").alias("md5"))


def decoded(spark: SparkSession, root: str) -> DataFrame:
    """origin, height, width, nChannels and data (BGR) of every file that decodes."""
    held = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", "true").load(root)
    return held.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data")


def measured(images: DataFrame, hash_size: int = 16) -> DataFrame:
    """One decode for everything: size, quality, hash words and channel moments of each image."""
    import pandas as pd

    def scan(batches):
        for batch in batches:
            rows = []
            for origin, h, w, n, data in zip(*(batch[c] for c in ("origin", "height", "width", "nChannels", "data"))):
                m = pixels.metrics(pixels.from_row(bytes(data), h, w, n), hash_size)
                rows.append((origin, h, w, *(m[k] for k in ("blur", "brightness", "contrast", "words", "mean", "std"))))
            yield pd.DataFrame(rows, columns=["origin", "height", "width", "blur", "brightness", "contrast", "words", "mean", "std"])

    return images.select("origin", "height", "width", "nChannels", "data").mapInPandas(scan, METRICS)
