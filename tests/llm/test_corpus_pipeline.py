"""The corpus pipeline stage by stage, and the registrations."""

import re
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import __spark_entry__
from shardloom.llm import queries
from tests.llm.test_matching import brute_components, plain_words
from tests.llm.test_scoring_quality_packing import features

ROOT = Path(__file__).resolve().parents[2]


def test_each_stage_on_its_predecessors_rows(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        out = stage(spark, docs, data)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    rows = lambda name: {r.doc_id: r.text for r in inputs[name].collect()}
    start, clean, lines, single, leakless = (rows(n) for n, _ in corpus_pipeline.STAGES)
    assert set(clean) <= {i for i, t in start.items() if not features(t)[-1]} and len(clean) > 0.6 * len(start)
    assert all(clean[i] == start[i] for i in clean)
    assert set(lines) == set(clean) and all(set(lines[i].split("\n")) <= set(clean[i].split("\n")) for i in lines)
    assert set(single) == {c for _, _, c in brute_components(sorted(lines.items()))}
    items = [plain_words(r.text) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    spaced = lambda t: b" " + b" ".join(plain_words(t)) + b" "
    leaked = {i for i, t in single.items() if any(b" " + b" ".join(w) + b" " in spaced(t) for w in items)}
    assert leaked and not leaked & set(leakless) and len(leakless) > 0.8 * (len(single) - len(leaked))
    packed = docs.collect()
    assert {r.doc_id for r in packed} == set(leakless)
    by_run = corpus_pipeline.run(spark, data)
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, by_run.collect())) == sorted(map(key, packed))


def test_near_copies_by_five_words_and_four_fifths(spark, data):
    words = [f"w{i}" for i in range(400)]
    changed = lambda n: [f"other{i}" if 100 <= i < 100 + n else w for i, w in enumerate(words)]
    # A run of 36 words: 356 of 436 shingles of five are shared, 0.817, and 358 of 436 of four, 0.82; one of 46: 346 of 446, 0.776.
    docs = [(1, " ".join(words)), (2, " ".join(changed(36))), (3, " ".join(changed(46)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    for other, alone in ((docs[1], False), (docs[2], True)):
        assert len({c for _, _, c in brute_components([docs[0], other], 5, 80)}) == 1 + alone and len({c for _, _, c in brute_components([docs[0], other])}) == 2
    stays = lambda wanted: {r.doc_id for r in corpus_pipeline.ngram_jaccard_join(spark, frame.where(wanted), data).collect()}
    assert stays("doc_id < 3") == {1} and stays("doc_id <> 2") == {1, 3}


def test_n_chars_follows_the_text(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = corpus_pipeline.line_dedup(spark, docs, data)
    assert out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert out.where("n_chars <> char_length(text)").count() == docs.where("n_chars <> char_length(text)").count()


def test_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(re.match(r"op(\d+)_", n)[1]))
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 11))
    assert set(names) | {"pipeline"} <= set(__spark_entry__.queries())


def test_the_rest_works_without_this_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "shardloom"):
        subprocess.run(["cp", "-r", str(ROOT / name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "shardloom" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
