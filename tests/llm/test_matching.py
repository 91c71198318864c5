"""Decontamination, Jaccard join, substring and line dedup, components, against plain Python."""

import hashlib
import itertools
import pathlib
import random
import string
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.llm import common, components, decontam, jaccard, line_dedup, queries, substring
from shardloom.llm.common import LOWER_AZ


def order_of(i):
    return (i is None, i or 0)


def brute_components(docs, n=4, percent=85):
    sets = []
    for _, t in docs:
        w = (t or "").encode().translate(LOWER_AZ).split()
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        r = root(k)
        least[r] = min(least.get(r, i), i, key=order_of)
    return sorted(((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(docs)), key=lambda x: (order_of(x[0]), x[1]))


def plain_words(text):
    """Words without ASCII punctuation, A-Z in lower case."""
    return (text or "").encode().translate(LOWER_AZ, string.punctuation.encode()).split()


def got_components(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=lambda x: (order_of(x[0]), x[1]))


def test_jaccard_join_on_documents(spark, data, documents):
    assert got_components(queries.op5_ngram_jaccard_join(spark, data)) == brute_components(documents)


@pytest.mark.parametrize("block_tokens", [4_000_000, 300])
def test_jaccard_join_on_odd_rows_and_split_blocks(spark, odd, empty, block_tokens):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert got_components(jaccard.linked(odd, block_tokens=block_tokens)) == brute_components(docs)
    assert jaccard.linked(empty).count() == 0


def near_group(rng, n, words=60, edits=6):
    base = [f"b{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        out.append(" ".join(w[: rng.randint(words - 6, words)]))
    return out


def test_texts_that_share_common_phrases_make_no_large_block(spark, monkeypatch):
    rng = random.Random(4)
    phrases = [" ".join(f"p{i}w{j}" for j in range(6)) for i in range(10)]
    texts = [" ".join([*(rng.choice(phrases) + f" own{k}x{j}" for j in range(3)), f"last{k}"]) for k in range(200)]
    texts += [t + " more" for t in texts[:20]]  # links of which none is lost
    compared, real = {}, jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name, *a: compared.setdefault(name, real(df, name, *a)) if name == "rest" else real(df, name, *a))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got_components(jaccard.linked(frame, block_tokens=500)) == brute_components(list(enumerate(texts)))
    assert "rest" not in compared or compared["rest"].count() < 60  # else each is compared with all others


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    files = lambda: {p for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs() for p in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}
    before = files()
    table = common.written(spark.range(50_000).groupBy((F.col("id") % 10_000).alias("k")).agg(F.count("*").alias("n")), "counts")
    for _ in range(50):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and table.count() == 10_000


def test_jaccard_join_on_groups_near_the_threshold(spark):
    rng = random.Random(0)
    texts = [t for _ in range(10) for t in near_group(rng, 20)]
    docs = [(k, t) for k, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert got_components(jaccard.linked(frame)) == brute_components(docs)


@pytest.mark.parametrize("seed", range(4))
def test_divide_skip_connects_as_all_pairs_do(seed):
    rng = np.random.default_rng(seed)
    base = [rng.choice(3000, 100, replace=False) for _ in range(5)]
    sets = [np.unique(np.concatenate([b[rng.random(100) < rng.uniform(0.85, 1)], rng.choice(3000, rng.integers(0, 12))]).astype(np.uint64)) for b in base for _ in range(15)]
    sets.append(np.asarray([1], np.uint64))
    wanted = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]

    def classes(links):
        k = jaccard.Connected(len(sets))
        for a, b in links:
            k.join(a, b)
        return [k.root(i) for i in range(len(sets))]

    found = jaccard.divide_skip(sets, 85)
    assert set(map(frozenset, found)) <= set(map(frozenset, wanted)) and classes(found) == classes(wanted)
    side = np.arange(len(sets)) % 2
    across = [(a, b) for a, b in wanted if side[a] != side[b]]
    assert classes(jaccard.divide_skip(sets, 85, side)) == classes(across)


def test_one_of_each_keeps_first_rows_and_all_columns(spark, odd):
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    every = jaccard.linked(odd)
    assert kept.count() == every.select("component_row").distinct().count() == every.where("row = component_row").count()
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 10, 11, 12, 16} and not {7, 9, 40} & {r.doc_id for r in kept.collect()}


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_take_few_tables_and_many_the_same_roots(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(150)] + [(300 + (i * 37) % 101, 300 + (i * 37 + 37) % 101) for i in range(90)]
    frame, names, real = spark.createDataFrame(edges, "a long, b long"), [], common.written_at
    monkeypatch.setattr(components, "written_at", lambda df, name: names.append(name) or real(df, name))
    monkeypatch.setattr(components, "written", lambda df, name: components.written_at(df, name)[0])
    few = {tuple(r) for r in components.components(frame).collect()}
    assert len(names) == 2  # the edges and their roots
    monkeypatch.setattr(components, "FEW_EDGES", 0)
    assert {tuple(r) for r in components.components(frame).collect()} == few and len(names) > 6


def brute_substrings(docs, width=20):
    """docs in order; (id, n words, n removed, digest of the kept)."""
    seen, out = set(), []
    for i, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            k = tuple(w[s : s + width])
            if k in seen:
                gone[s : s + width] = [True] * width
            seen.add(k)
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def test_substring_dedup_on_documents(spark, data, documents):
    got = sorted(tuple(r) for r in queries.op7_substring_dedup(spark, data).collect())
    assert got == brute_substrings(documents)


@pytest.mark.parametrize("doublings", [1, 2])
def test_substring_dedup_on_passages(spark, doublings):
    rng = random.Random(9)
    passages = [" ".join(f"p{rng.randrange(500)}" for _ in range(rng.randint(19, 45))) for _ in range(4)]
    docs = [(k, " ".join(rng.choice(passages) if rng.random() < 0.4 else " ".join(f"q{rng.randrange(3000)}" for _ in range(15)) for _ in range(6))) for k in range(60)]
    docs += [(100 + k, docs[k][1]) for k in range(5)] + [(200, "a " * 70), (201, "a " * 19), (202, None), (203, "")]
    every, changed = substring.removable(spark.createDataFrame(docs, "doc_id long, text string"), doublings=doublings)
    removed = {r.row: r.n_removed for r in changed.collect()}
    got = sorted((r.doc_id, r.n_words, r.n_words if r.copy else removed.get(r.row, 0)) for r in every.collect())
    assert got == [x[:3] for x in brute_substrings(docs)]


def test_substring_dedup_on_odd_rows(spark, odd, empty):
    rows = odd.collect()
    got = Counter((r.doc_id, r.n_words) for r in substring.digest(odd).collect())
    assert got == Counter((r.doc_id, len((r.text or "").encode().split())) for r in rows)
    kept = {r.doc_id: r.text for r in substring.deduplicated(odd).collect() if r.doc_id in (1, 7, 9)}
    assert kept[7] == "" and kept[1] == " ".join(next(r.text for r in rows if r.doc_id == 1).split()) and kept[9]
    assert substring.digest(empty).count() == 0


def test_anchors_cover_every_window_alike():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    at, _ = substring.anchors(h, 20, 10)
    for s in range(len(h) - 19):
        inside = [a - s for a in at if s <= a and a + 10 <= s + 20]
        assert inside
    again, _ = substring.anchors(np.concatenate([h[:7], h[100:160], h[:9]]), 20, 10)
    for s in range(100, 140):  # a copied window holds an anchor at the same place in both texts
        assert {a - s for a in at if s <= a <= s + 10} & {a - (s - 93) for a in again if s - 93 <= a <= s - 83}


def smith_waterman(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1))
    for i, j in itertools.product(range(len(a)), range(len(b))):
        table[i + 1, j + 1] = max(0, table[i, j] + (2 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1)
    return table.max()


@pytest.mark.parametrize("seed", range(6))
def test_alignment_equals_the_plain_table(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 5, rng.integers(1, 25)), rng.integers(0, 5, rng.integers(0, 40))
    score, lo, hi = decontam.align(a, b)
    assert score == smith_waterman(a, b) and 0 <= lo <= hi <= len(b)


def test_leaks_exact_edited_and_clean(spark):
    rng = random.Random(2)
    word = lambda: f"v{int(rng.expovariate(0.01))}"
    items = [(k, " ".join(word() for _ in range(rng.randint(12, 50)))) for k in range(12)] + [(90, ""), (91, None), (92, "hi")]
    docs, want = [], set()
    for k in range(200):
        text = [word() for _ in range(rng.randint(30, 120))]
        if k % 4 == 0:
            item, body = k // 4 % 12, items[k // 4 % 12][1].split()
            if k % 8 == 0:  # edited: each eighth word another, one dropped, case and marks changed
                body = [w if n % 8 != 3 else word() for n, w in enumerate(body)]
                del body[len(body) // 2]
                body[0] = body[0].upper() + ","
            text[10:10] = body
            want.add((k, item))
        docs.append((k, " ".join(text)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.matched(frame, bench).collect() if r.item_id < 90}
    assert got == want
    assert {(r.doc_id, r.item_id) for r in decontam.matched(frame, bench, block_words=60).collect() if r.item_id < 90} == want
    clean = decontam.without_leaks(frame, bench.where("item_id < 90"))
    assert {r.doc_id for r in clean.collect()} == {k for k, _ in docs} - {k for k, _ in want}


def test_leaks_of_the_benchmark_table(spark, data, documents):
    got = {(r.doc_id, r.item_id): r for r in queries.op4_benchmark_decontamination(spark, data).collect()}
    items = [(r.item_id, plain_words(r.text)) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    for i, text in documents:
        words = plain_words(text)
        joined = b" " + b" ".join(words) + b" "
        for k, item in items:
            whole = b" " + b" ".join(item) + b" " in joined
            assert not whole or got[i, k].score == 1.0
    assert all(r.score >= decontam.LEAST for r in got.values())


def test_decontamination_on_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, odd.where("doc_id = 1").first().text)], "item_id long, text string")
    got = decontam.matched(odd, bench).collect()
    assert {r.doc_id for r in got} >= {1, 7, 8, 9, 14, 40, None}
    assert decontam.matched(empty, bench).count() == 0 and decontam.matched(odd, bench.where("false")).count() == 0
    assert decontam.without_leaks(odd, bench).columns == odd.columns


def brute_lines(docs, min_docs, lead=3, constant=0.5):
    """The same tree in plain Python: rows as (id, text); the places dropped from each row."""
    masked = lambda ws: tuple("<*>" if any("0" <= c <= "9" for c in w) else w for w in ws)
    lines = [(k, p, tuple(x.decode() for x in line.encode().split())) for k, (_, t) in enumerate(docs) for p, line in enumerate((t or "").split("\n"))]
    lines = [(k, p, masked(w)) for k, p, w in lines if w]
    leaf = lambda w: (len(w), w[:lead])
    texts = defaultdict(set)
    for k, _, w in lines:
        texts[leaf(w)].add(docs[k][1])
    lines = [x for x in lines if len(texts[leaf(x[2])]) >= min_docs]
    variants = defaultdict(set)
    for k, _, w in lines:
        variants[w].add(docs[k][1])
    support = Counter()
    for w, ds in variants.items():
        for at, t in enumerate(w):
            support[leaf(w), at, t] += len(ds)
    shape = {w: tuple(t if support[leaf(w), at, t] >= min_docs else "<*>" for at, t in enumerate(w)) for w in variants}
    total = Counter()
    for w, s in shape.items():
        if sum(t != "<*>" for t in s) >= constant * len(s):
            total[leaf(w), s] += len(variants[w])
    hits = defaultdict(list)
    for k, p, w in lines:
        if total[leaf(w), shape[w]] >= min_docs:
            hits[leaf(w), shape[w]].append((order_of(docs[k][0]), k, p))
    return {(k, p) for found in hits.values() for _, k, p in sorted(found)[1:]}


def test_line_dedup_equals_the_plain_tree(spark):
    rng = random.Random(6)
    shapes = ["Copyright {} by the Example Group of Companies", "Visit our {} page for more and more news", "Share this on {} now"]
    docs = []
    for k in range(80):
        lines = [" ".join(f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randint(3, 12))) for _ in range(4)]
        for s in shapes:
            if rng.random() < 0.4:
                lines.insert(rng.randrange(4), s.format(rng.choice([f"{1990 + rng.randrange(30)}", "home", "Site", f"x{k}y"])))
        docs.append((k, "\n".join(lines)))
    docs += [(100, docs[3][1]), (101, None), (102, ""), (103, "\n\n")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    out = {r.doc_id: r for r in line_dedup.without_boilerplate(frame, min_docs=8).collect()}
    gone = brute_lines(docs, 8)
    assert len(gone) > 40
    for k, (i, t) in enumerate(docs):
        left = [x for p, x in enumerate((t or "").split("\n")) if (k, p) not in gone]
        assert (out[i].text or "") == "\n".join(left) and out[i].n_dropped == sum(a == k for a, _ in gone)


def test_line_dedup_on_odd_rows(spark, odd, empty):
    out = line_dedup.without_boilerplate(odd)
    rows = out.collect()
    assert len(rows) == odd.count() and sum(r.n_dropped for r in rows) == 13
    assert [c for c in out.columns if c not in ("n_lines", "n_dropped")] == [c for c in odd.columns if c != "n_dropped"]
    assert sum("Example Company" in (r.text or "") for r in rows) == 1
    assert line_dedup.without_boilerplate(empty).count() == 0
