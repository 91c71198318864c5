import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, place int, h double, tokens array<string>, n_dropped int"


def prose(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def odd_rows():
    """Nulls, empty, blank, short, very long and repeated texts, near copies, shared passages, and repeated or null ids."""
    rng = random.Random(11)
    base, passage, boiler = prose(rng, 120), prose(rng, 60), "All rights reserved by the Example Company in {}"
    near = base.split()
    near[7] = "changed"
    rows = [
        (1, base), (2, None), (3, ""), (4, " \n\t \n"), (5, "one"), (6, "One  two\tthree"), (7, base), (8, " ".join(near)), (9, base.upper()),
        (10, prose(rng, 80) + " " + passage + " " + prose(rng, 40)), (11, passage + "\n" + prose(rng, 90)), (12, prose(rng, 30_000, 5_000)), (12, prose(rng, 70)), (13, "z " * 200), (14, " 　  wide\u0085 white " + base),
        (None, prose(rng, 60)), (None, base), (15, "é ß 日本 😀 " + prose(rng, 55)), (16, passage + " " + passage),
    ]
    rows += [(20 + i, prose(rng, 40) + "\n" + boiler.format(2000 + i) + "\n" + prose(rng, 30)) for i in range(14)]
    rows += [(40, base)] * 3
    return [(i, t, "en", f"s{k % 3}", len(t or ""), "clash", 1, 0.5, ["x"], 9) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, data):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").orderBy(F.col("doc_id")).collect()]
