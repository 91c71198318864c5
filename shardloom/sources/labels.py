"""COCO, VOC and YOLO annotations, each with a fixed schema."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COCO = T.StructType([
    T.StructField("images", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("file_name", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))),
    T.StructField("annotations", T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("image_id", T.LongType()), T.StructField("category_id", T.IntegerType()), T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("iscrowd", T.IntegerType())]))),
    T.StructField("categories", T.ArrayType(T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())]))),
])
BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")])
VOC = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("size", T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())])),
    T.StructField("object", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("difficult", T.IntegerType()), T.StructField("bndbox", BOX)]))),
])


def stem_of(path):
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """images, annotations (with ord within the file) and categories of a COCO document."""
    doc = spark.read.schema(COCO).option("multiLine", "true").json(path)
    images = doc.select(F.explode("images").alias("i")).select("i.*")
    annotations = doc.select(F.posexplode("annotations").alias("ord", "a")).select("ord", "a.*")
    categories = doc.select(F.explode("categories").alias("c")).select("c.*")
    return images, annotations, categories


def voc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Documents (stem, width, height) and objects (stem, ord, name, xmin..ymax); a malformed file has no objects."""
    doc = spark.read.format("xml").option("rowTag", "annotation").schema(VOC).load(path).withColumn("stem", stem_of(F.input_file_name()))
    objects = doc.select("stem", "size.width", "size.height", F.posexplode("object").alias("ord", "o")).select("stem", "width", "height", "ord", "o.name", "o.bndbox.*")
    return doc.select("stem", "size.width", "size.height"), objects


def yolo(spark: SparkSession, path: str) -> DataFrame:
    """stem and value of every line."""
    return spark.read.text(path).select(stem_of(F.input_file_name()).alias("stem"), "value")


def detect(spark: SparkSession, root: str) -> tuple[str, str | None]:
    """Annotation format below root, and the document where there is one: coco, voc, yolo or unknown."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(conf)
    if not fs.exists(top):
        return "unknown", None
    names = sorted(s.getPath().toString() for s in fs.listStatus(top))
    for path in (n for n in names if n.endswith(".json")):
        columns = spark.read.option("multiLine", "true").json(path).columns
        if {"images", "annotations"} <= set(columns):
            return "coco", path
    for suffix, kind in ((".xml", "voc"), (".txt", "yolo")):
        if any(posixpath.basename(n).endswith(suffix) for n in names):
            return kind, None
    return "unknown", None
