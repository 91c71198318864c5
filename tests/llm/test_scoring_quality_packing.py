"""Language-model scores, quality rules and packing, against plain Python."""

import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardloom.llm import attention, lm, packing, quality, queries
from shardloom.llm.common import LOWER_AZ

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_scores(docs):
    words = {k: t.encode().translate(LOWER_AZ).split() for k, (_, t) in enumerate(docs)}
    held = [zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in docs]
    counts, ends = Counter(), 0
    for k in words:
        if not held[k]:
            counts.update(words[k])
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    log = lambda c: math.log10((c + 1) / (n + v + 1))
    return [(i, held[k], len(words[k]) + 1, sum(w in counts for w in words[k]) + (ends > 0), n, sum(log(counts[w]) for w in words[k]) + log(ends)) for k, (i, _) in enumerate(docs)]


def check_scores(got, docs):
    order = lambda x: (x[0] is None, x[0] or 0, x[2], x[5])
    ours = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=order)
    for a, b in zip(ours, sorted(base_scores(docs), key=order), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_base_is_exact_and_model_learns(spark, data, documents):
    got = queries.op1_lm_scoring(spark, data).collect()
    check_scores(got, documents)
    held = [r for r in got if r.held_out]  # better than word counts on texts that it didn't see
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)


def test_lm_learns_from_the_ends_of_long_texts(spark):
    rng = random.Random(3)
    filler = lambda: " ".join(rng.choice(["some", "other", "word", "of", "the", "text"]) for _ in range(1_200))
    tail = " ".join(["quixotic zephyrs juggle"] * 100)
    docs = [(i, tail if zlib.crc32(str(i).encode()) % 7 == 2 else f"{filler()} {tail}") for i in range(40)]
    got = [r for r in lm.scored(spark.createDataFrame(docs, "doc_id long, text string"), *queries.tokenizer()).collect() if r.held_out]
    assert got and all(r.score / r.n_tokens > -1 for r in got)


def test_lm_draws_pieces_from_anywhere():
    places = [p for digest in range(200) for p in lm.drawn(digest << 40, 9_600, 1 / 64)]
    assert 0.5 < len(places) / (200 * 100 / 64) < 1.5 and min(places) < 960 and max(places) >= 8_640
    assert lm.drawn(7, 9_600, 1.0) == list(range(0, 9_600, 96)) and lm.drawn(7, 0, 1.0) == [0]


def test_pieces_of_many_texts_are_drawn_as_of_each():
    rng = np.random.default_rng(6)
    digests, sizes = rng.integers(0, 2**64, 50, dtype=np.uint64), np.append(rng.integers(1, 3_000, 48), [0, 96])
    for share in (1 / 8, 1.0):
        text, place = lm.all_drawn(digests, sizes, share)
        assert list(zip(text.tolist(), place.tolist())) == [(k, p) for k in range(50) for p in lm.drawn(int(digests[k]), int(sizes[k]), share)]
    assert [len(x) for x in lm.all_drawn(digests[:0], sizes[:0], 1.0)] == [0, 0]
    for numbers in (sizes, sizes[:0], np.asarray([2**32 - 1, 0])):
        assert lm.unpacked(lm.packed(numbers)).tolist() == numbers.tolist()



def test_the_model_learns_from_texts_of_which_no_piece_was_drawn(spark):
    frame = spark.createDataFrame([(i, f"the same few words again and again {i % 7} " * 20) for i in range(60)], "doc_id long, text string")
    path, pattern = queries.tokenizer()
    every = lm.written(lm.chunk_words(lm.chunked(frame), path, pattern, 0.0), "chunk-words")
    assert every.where(f"kind = {lm.PIECE}").isEmpty()
    model = lm.fitted(every, lm.Encoder(path, pattern).encoding.n_vocab, 50)
    before = attention.initial(np.random.default_rng(0))
    assert all((model.weights[k] != before[k]).any() for k in ("E", "Q", "W1", "M"))


def test_training_takes_every_block_of_every_training_text_once(monkeypatch):
    monkeypatch.setattr(lm, "PART_WORDS", 3)
    held = SimpleNamespace(ids=lm.packed(np.asarray([5, 6, 7])), length=lm.packed(np.asarray([1, 2])), place=lm.packed(np.asarray([0, 1, 1, 0, 0])), sizes=lm.packed(np.asarray([2, 1, 0, 2])), held_out=[False, True, False, False])
    parts = list(lm.training(held, np.arange(10, dtype=np.int32)))
    assert [[x.tolist() for x in p] for p in parts] == [[[0, 5, 6, 7, 0], [0, 0], [0, 5, 5, 0]]]
    seen, real = [], attention.gradients
    monkeypatch.setattr(attention, "gradients", lambda w, before, own, led, target, counted: seen.extend(target[counted].tolist()) or real(w, before, own, led, target, counted))
    texts = [np.arange(k, k + 40, dtype=np.int32) for k in (0, 100, 200)]
    _, blocks = attention.refined(attention.initial(np.random.default_rng(0)), texts, batch=2)
    assert blocks == 9 and sorted(seen) == sorted(x for t in texts for x in t[1:].tolist())

def test_lm_on_odd_rows(spark, odd, empty):
    docs = [(r.doc_id, r.text or "") for r in odd.collect()]
    check_scores(lm.scored(odd, *queries.tokenizer(), chunks=((300, 2), (5_000, 3))).collect(), docs)
    assert lm.scored(empty, *queries.tokenizer()).count() == 0


def test_attention_scores_are_causal_normalised_and_batch_free():
    rng = np.random.default_rng(0)
    sample = [rng.integers(0, 300, rng.integers(1, 90)) for _ in range(40)]
    model = attention.trained(sample, 300, 0, steps=20)
    tables = model.tables()

    def score(texts, **more):
        ids = np.concatenate([model.known[np.concatenate([[0], x, [0]])] for x in texts])
        n = np.asarray([len(x) + 1 for x in texts])
        return attention.scores(model, tables, ids, np.cumsum(n + 1) - (n + 1), n, **more)

    assert score(sample) == pytest.approx(score(sample, blocks=3), rel=1e-4)
    assert score(sample) == pytest.approx([score([x])[0] for x in sample], rel=1e-4)
    # All endings of a text: the probabilities of its next token sum to 1.
    x = sample[0][:40]
    prefix = model.known[np.concatenate([[0], x])]
    ends = np.arange(attention.GROUPS * attention.MEMBERS)
    ids = np.concatenate([np.concatenate([prefix, [e]]) for e in ends])
    n = np.full(len(ends), len(prefix))
    whole = attention.scores(model, tables, ids, np.cumsum(n + 1) - (n + 1), n)
    head = attention.scores(model, tables, prefix, np.asarray([0]), np.asarray([len(prefix) - 1]))[0]
    assert np.power(10, whole - head).sum() == pytest.approx(1, rel=1e-3)


def test_attention_gradient():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in attention.initial(rng).items()}
    b = (rng.integers(0, 900, (3, attention.BLOCK)), rng.integers(0, 900, (3, attention.BLOCK)), np.asarray([True, False, True]), rng.integers(0, 900, (3, attention.BLOCK)), rng.random((3, attention.BLOCK)) < 0.8)
    _, grad = attention.gradients(w, *b)
    for k in w:
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        e = 1e-5
        w[k][at] += e
        up = attention.gradients(w, *b)[0]
        w[k][at] -= 2 * e
        down = attention.gradients(w, *b)[0]
        w[k][at] += e
        assert grad[k][at] == pytest.approx((up - down) / (2 * e), rel=2e-3, abs=1e-7)


def test_gradient_is_the_same_in_any_slices_and_a_pass_takes_few_steps(monkeypatch):
    rng = np.random.default_rng(2)
    w = attention.initial(rng)
    b = [rng.integers(0, 90, (7, attention.BLOCK)) for _ in range(3)]
    b = (b[0], b[1], rng.random(7) < 0.7, b[2], rng.random((7, attention.BLOCK)) < 0.8)
    loss, whole = attention.gradients(w, *b)
    monkeypatch.setattr(attention, "CACHED", 2)
    monkeypatch.setattr(attention, "CACHED_ROWS", 5)
    sliced, parts = attention.gradients(w, *b)
    assert sliced == pytest.approx(loss, rel=1e-5) and set(parts) == set(w)
    assert all(np.allclose(parts[k], whole[k], rtol=1e-3, atol=1e-6) for k in w)
    nothing, none = attention.gradients(w, *b[:4], np.zeros_like(b[4]))
    assert nothing == 0 and not any(g.any() for g in none.values())
    monkeypatch.undo()
    steps, real = [], attention.gradients
    monkeypatch.setattr(attention, "gradients", lambda *args: steps.append(len(args[2])) or real(*args))
    _, blocks = attention.refined(w, [rng.integers(0, 90, 16 * 1_000 + 1)])
    assert blocks == 1_000 and steps == [512, 488]


def test_sums_by_id_and_lower_bounds_equal_plain_ones():
    rng = np.random.default_rng(5)
    ids, parts = rng.integers(0, 50, 7 * 12), rng.random((7, 3, 12))
    want = np.zeros((60, 3))
    np.add.at(want, ids, parts.transpose(0, 2, 1).reshape(-1, 3))
    assert np.allclose(attention._summed(ids, parts, 60), want)
    for n in (0, 1, 1 << 14, (1 << 14) + 3):
        u = rng.normal(size=(n, 2)).astype(np.float32)
        assert (attention._at_least(u.copy(), 0.05) == np.maximum(u, np.float32(0.05))).all()


def features(text):
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    covered = {i + k for i in range(n - 2) if windows[tuple(words[i : i + 3])] >= 2 for k in range(3)}
    lines, seen = [x for x in text.split("\n") if WORD.search(x)], set()
    dup = sum(x in seen or seen.add(x) is not None for x in lines)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_quality_features_equal_brute_force(spark, data, odd, empty, documents):
    for docs, frame in ((documents, queries.op2_quality_rules(spark, data)), ([(r.doc_id, r.text or "") for r in odd.collect()], quality.judged(odd))):
        got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in frame.collect()]
        want = [(i, *features(t)) for i, t in docs]
        key = lambda x: (x[0] is None, x[0] or 0, x[1:])
        assert sorted(got, key=key) == sorted(want, key=key)
        assert all(not r.kept for r in frame.where("base_failed").collect())
    assert quality.judged(empty).count() == 0


def test_quality_order_never_changes_the_verdict(spark, odd):
    rules = quality.default_rules()
    a = sorted((r.doc_id or -1, r.kept, r.n_words) for r in quality.judged(odd, rules=rules).collect())
    assert a == sorted((r.doc_id or -1, r.kept, r.n_words) for r in quality.judged(odd, rules=rules[::-1]).collect())
    kept = quality.kept_rows(odd)
    assert kept.columns == odd.columns and kept.count() == sum(k for _, k, _ in a)


def test_quality_cascade_prefers_cheap_rejections():
    slow = quality.Rule("slow", lambda t: sum(range(100_000)) < 0)
    fast = quality.Rule("fast", lambda t: "x" in t.text)
    assert [r.name for r in quality.cascade_order([slow, fast], ["x"] * 5)] == ["fast", "slow"]


def test_toxic_words_are_learned_and_caught(spark):
    rng = random.Random(3)
    text = lambda bad: " ".join(rng.choice(["vile" if bad and rng.random() < 0.2 else f"w{rng.randrange(99)}"]) for _ in range(80))
    rows = [(i, text(i % 3 == 0)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (0, None)], "doc_id long, toxic int")
    kept = {r.doc_id for r in quality.judged(docs, labels).where("kept").collect()}
    assert kept == {i for i in range(90) if "vile" not in rows[i][1].split()}


def test_packing_round_trip(spark, data, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer()[0])
    got = queries.op3_best_fit_packing(spark, data).collect()
    check_packing([(i, np.asarray(t.encode(x, add_special_tokens=False).ids + [0], "<u4")) for i, x in documents], got)


def check_packing(want, got, capacity=2048):
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    total = 0
    for i, ids in want:
        pieces = sorted(by.pop(i), key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [p.start for p in pieces] == list(np.cumsum([0] + [p.length for p in pieces])[:-1])
        assert sum(p.length for p in pieces) == len(ids)
        assert len(ids) > capacity or len(pieces) == 1
        assert all(p.length == capacity for p in pieces[1:])
        assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for p in pieces)
        total += len(ids)
    assert not by
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for rows in sequences.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == list(np.cumsum([0] + [r.length for r in rows])[:-1])
        assert sum(r.length for r in rows) <= capacity
    assert len(sequences) <= 1.02 * total / capacity + 2


def test_packing_of_odd_rows(spark, odd, empty):
    pieces = packing.tokenised(odd, *queries.tokenizer())
    got = packing.packed(pieces).collect()
    assert sum(r.length for r in got) == sum(len(r.ids) // 4 for r in pieces.collect())
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert packing.packed(packing.tokenised(empty, *queries.tokenizer())).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=20))
def test_plan_uses_every_piece_once_and_packs_tightly(counts):
    kinds = packing.plan(counts, 32)
    used = Counter()
    for kind, copies in kinds:
        assert sum(kind) <= 32 and copies > 0
        for x in kind:
            used[x] += copies
    assert used == Counter(counts)
    open_bins: list[int] = []  # first fit decreasing, for comparison
    for x in sorted(Counter(counts).elements(), reverse=True):
        at = next((i for i, used_up in enumerate(open_bins) if used_up + x <= 32), None)
        if at is None:
            open_bins.append(x)
        else:
            open_bins[at] += x
    assert sum(c for _, c in kinds) <= 1.1 * len(open_bins) + 1


def test_plan_leaves_short_pieces_to_long_ones():
    kinds = packing.plan({5: 3, 9: 9, 19: 11}, 32)
    assert sum(c for _, c in kinds) == 11  # one for each of length 19
    assert sum((Counter({x: c * n for x, n in Counter(kind).items()}) for kind, c in kinds), Counter()) == Counter({5: 3, 9: 9, 19: 11})


def test_plan_fills_gaps_exactly():
    assert dict(packing.plan({20: 3, 12: 3}, 32)) == {(20, 12): 3}
    assert dict(packing.plan({20: 2, 7: 2, 5: 2}, 32)) == {(20, 7, 5): 2}
    assert dict(packing.plan({20: 1, 6: 1, 4: 1, 2: 1}, 32)) == {(20, 6, 4, 2): 1}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t\r\u3000\xa0aeé日1'.!😀\x00_-", "the", "<|endoftext|>", "  "]), max_size=30).map("".join))
def test_ids_are_those_of_tokenizers(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def _tools():
    from tokenizers import Tokenizer

    return packing.Encoder(*queries.tokenizer()), Tokenizer.from_file(queries.tokenizer()[0])


ENCODER, TOKENIZER = _tools()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters=" \t\n\r\x0b\x0c"), min_size=1, max_size=6), max_size=6))
def test_subwords_of_words_equal_each_words_own(words):
    raw = [w.encode() for w in words]
    ids, n = lm.subwords(ENCODER, b"".join(b" " + w for w in raw))
    assert len(n) == len(words)
    each = [np.frombuffer(ENCODER(" " + w), "<u4") for w in words]
    if n.tolist() == [len(x) for x in each]:
        assert ids.tolist() == [int(i) for x in each for i in x]
