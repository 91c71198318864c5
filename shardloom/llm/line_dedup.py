"""Line deduplication with a log-template tree.

The tree has a fixed depth: a line goes by its number of tokens, then by its
leading tokens, to a leaf.  Tokens with a digit are variable fields from the
start.  In a leaf that enough documents reach, a token stays constant at its
position if enough documents have it there; the others become variable fields.
A template that recurs across ``min_docs`` documents and is mostly constant is
boilerplate: its lines go, except the first one (smallest doc_id, then earliest
line), so that what many copies share survives once.  Copies of a whole text
count as one document.  Only SQL functions run on the executors.

Defined results: a null text counts as empty; blank lines stay; repeated rows are
copies of one text; null ids come last; an empty table gives an empty result.
Extra columns pass through ``without_boilerplate``.  ``docs`` must be a scan or
another input whose rows come in the same partitions each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, written

MIN_DOCS = 10
#: Leading tokens that pick a leaf, and the share of constant tokens from which a template counts.
LEAD, CONSTANT = 3, 0.5
FIELD = "<*>"


def _tokens(line: Column) -> Column:
    return F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda t: t != "")


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, lead: int = LEAD, constant: float = CONSTANT) -> DataFrame:
    """(row, place, template) of every line that goes; rows are numbered by monotonically_increasing_id() over docs."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    lines = rows.select("row", F.xxhash64("text").alias("digest"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    tokens = lines.withColumn("tokens", _tokens(F.col("line"))).where(F.size("tokens") > 0)
    leaf = F.xxhash64(F.size("tokens"), _masked(F.slice("tokens", 1, lead)))
    keys = written(tokens.select("row", "place", "digest", leaf.alias("leaf")), "lines")
    leaves = keys.select("leaf", "digest").distinct().groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("leaf")
    wanted = keys.join(small(written(leaves, "leaves")), "leaf").groupBy("row", "digest").agg(F.collect_list(F.struct("place", "leaf")).alias("wanted"))
    held = rows.join(small(written(wanted, "wanted"), F.size("wanted")), "row").withColumn("lines", F.split("text", "\n"))
    held = held.select("row", "doc_id", "digest", "lines", F.explode("wanted").alias("w"))
    held = held.select("row", "doc_id", "digest", "w.place", "w.leaf", _masked(_tokens(F.element_at("lines", F.col("w.place") + 1))).alias("tokens"))
    held = written(held.withColumn("variant", F.xxhash64("tokens")), "candidates")
    # Variants of a leaf, each with the number of different texts that hold it.
    variants = held.groupBy("leaf", "variant", "digest").agg(F.first("tokens").alias("tokens")).groupBy("leaf", "variant").agg(F.first("tokens").alias("tokens"), F.count("*").alias("docs"))
    variants = written(variants, "variants")
    places = variants.select("leaf", "variant", "docs", F.posexplode("tokens").alias("at", "token"))
    # What stays constant is at most one token in min_docs; the leading tokens of a leaf are in all of its variants.
    constants = places.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("support")).where(F.col("support") >= min_docs)
    constants = written(constants.select("leaf", "at", "token", F.lit(True).alias("constant")), "constants")
    fields = places.join(small(constants), ["leaf", "at", "token"], "left").withColumn("kept", F.when(F.col("constant"), F.col("token")).otherwise(FIELD))
    shaped = fields.groupBy("leaf", "variant").agg(F.array_sort(F.collect_list(F.struct("at", "kept"))).alias("t"), F.first("docs").alias("docs"))
    shaped = written(shaped.select("leaf", "variant", "docs", F.concat_ws(" ", "t.kept").alias("template"), (F.aggregate("t", F.lit(0), lambda n, x: n + (x["kept"] != FIELD).cast("int")) / F.size("t")).alias("share")), "shaped")
    often = shaped.where(F.col("share") >= constant).groupBy("leaf", "template").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("leaf", "template")
    often = written(shaped.join(often, ["leaf", "template"]).select("leaf", "variant", "template"), "often")
    hits = written(held.select("row", "doc_id", "place", "leaf", "variant").join(small(often), ["leaf", "variant"]), "hits")
    first = hits.groupBy("leaf", "template").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "place")).alias("first"))
    return hits.join(small(written(first, "first")), ["leaf", "template"]).where("row <> first.row or place <> first.place").select("row", "place", "template")


def without_boilerplate(docs: DataFrame, min_docs: int = MIN_DOCS, lead: int = LEAD, constant: float = CONSTANT) -> DataFrame:
    """docs with the remaining lines as text, and columns n_lines and n_dropped after its own."""
    gone = dropped_lines(docs, min_docs, lead, constant).groupBy("row").agg(F.collect_set("place").alias("__gone"))  # lines of one row
    gone = written(gone, "gone").withColumnRenamed("row", "__row")
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    held = docs.withColumn("__row", F.monotonically_increasing_id()).join(small(gone, F.size("__gone")), "__row", "left")
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    held = held.withColumn("__lines", F.when(F.col("__gone").isNotNull(), lines))
    left = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__gone"), lambda i: F.element_at("__lines", i + 1)), "\n"))
    return held.select(*(left.alias(c) if c == "text" else F.col(f"`{c}`") for c in columns), F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"))
