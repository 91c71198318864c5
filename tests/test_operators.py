"""Operators on hand-computed examples and against brute force."""

import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardloom.operators import annotate, augment, deduplicate, resize, split, statistics, tile, validate
from shardloom.plans import partition, shards, throughput
from shardloom.storage import in_order
from shardloom.streaming import telemetry


def greedy(hashes, threshold):
    kept, led = {}, set()
    for o, h in sorted(hashes):
        near = [p for p, g in kept.items() if bin(h ^ g).count("1") <= threshold]
        if near:
            led.add(near[0])
        else:
            kept[o] = h
    return list(kept), sorted(led)


@pytest.mark.parametrize("seed,threshold", [(1, 3), (2, 6), (3, 12)])
def test_near_kept_is_the_greedy_walk(spark, seed, threshold):
    rng = random.Random(seed)
    base = [rng.getrandbits(62) for _ in range(6)]
    rows = [(i, rng.choice(base) ^ sum(1 << rng.randrange(62) for _ in range(rng.randint(0, 6))) & (2**62 - 1)) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(20)]  # a group of copies
    df = spark.createDataFrame(rows, "o long, h long")
    kept, leaders = deduplicate.near_walk(df, "o", ["h"], [62], threshold)
    assert (sorted(r.o for r in kept.collect()), sorted(r.o for r in leaders.collect())) == greedy(rows, threshold)


@pytest.mark.parametrize("walked", [0, 100])
def test_greedy_walk_goes_on_to_the_end_of_a_chain(spark, walked):
    name = lambda i: f"frame{i:03d}"
    nodes = spark.createDataFrame([(name(i),) for i in range(15)], "o string")
    pairs = spark.createDataFrame([(name(i), name(i + 1)) for i in range(14)], "a string, b string")
    got = deduplicate.greedy_kept(nodes, pairs, rounds=3, walked_pairs=walked)
    assert sorted(r.o for r in got.collect()) == [name(i) for i in range(0, 15, 2)]


def test_near_kept_follows_a_chain_not_components(spark):
    # a ~ b ~ c but not a ~ c: b goes, c stays.
    df = spark.createDataFrame([(0, 0b0), (1, 0b111), (2, 0b111111)], "o long, h long")
    assert sorted(r.o for r in deduplicate.near_kept(df, "o", ["h"], [62], 3).collect()) == [0, 2]


def test_wide_thresholds_compare_blocks_and_walk_in_steps(spark, monkeypatch):
    # Bands of three bits would join most rows with most others.
    monkeypatch.setattr(deduplicate, "STEP_ROWS", 400)
    monkeypatch.setattr(deduplicate, "BLOCK_ROWS", 300)
    monkeypatch.setattr(deduplicate, "bands", lambda *a: pytest.fail("joined on bands that select nothing"))
    rng = random.Random(9)
    rows = [(f"f{i}", rng.getrandbits(56)) for i in range(1_000)]
    rows += [(f"g{i}", rows[i][1] ^ sum(1 << rng.randrange(56) for _ in range(9))) for i in range(100)]
    rows += [(f"h{i}", rows[i][1]) for i in range(20)] + [("null", None), (None, 5)]
    df = spark.createDataFrame(rows, "o string, h long")
    given = [r for r in rows if None not in r]
    kept, leaders = deduplicate.near_walk(df, "o", ["h"], [56], 14)
    assert (sorted(r.o for r in kept.collect()), sorted(r.o for r in leaders.collect())) == tuple(sorted(x) for x in greedy(given, 14))
    got = sorted((r.a, r.b, r.distance) for r in deduplicate.near_pairs(df, "o", ["h"], [56], 14).collect())
    far = lambda x, y: bin(x[1] ^ y[1]).count("1")
    assert got == sorted((*sorted((x[0], y[0])), far(x, y)) for x, y in itertools.combinations(given, 2) if far(x, y) <= 14)


def test_near_pairs_over_words_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.getrandbits(62), rng.getrandbits(63)) for i in range(8)]
    rows += [(100 + i, rows[i % 8][1] ^ (1 << rng.randrange(62)), rows[i % 8][2] ^ (1 << rng.randrange(63))) for i in range(24)]
    df = spark.createDataFrame(rows, "o long, h0 long, h1 long")
    got = sorted((r.a, r.b, r.distance) for r in deduplicate.near_pairs(df, "o", ["h0", "h1"], [64, 64], 4).collect())
    d = lambda x, y: bin(x[1] ^ y[1]).count("1") + bin(x[2] ^ y[2]).count("1")
    assert got == sorted((x[0], y[0], d(x, y)) for x, y in itertools.combinations(rows, 2) if d(x, y) <= 4)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 500), st.sampled_from([{"train": 0.8, "val": 0.15, "test": 0.05}, {"train": 0.8, "val": 0.1, "test": 0.1}, {"a": 0.01, "b": 0.99}]))
def test_allocate_uses_every_item(n, ratios):
    counts, owed = split.allocate(n, ratios)
    assert sum(counts) == n and min(counts) >= 0
    assert all(abs(c - n * ratios[s]) < 1 for c, s in zip(counts, split.ordered(ratios)))
    assert abs(sum(owed)) < 1e-6


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=30))
def test_carry_keeps_totals_near_their_shares(sizes):
    plan = split.allocations(list(enumerate(sizes)), split.RATIOS)
    for cls, n in enumerate(sizes):
        assert sum(c for k, _, _, c in plan if k == cls) == n
    for name, share in split.RATIOS.items():
        assert abs(sum(c for _, s, _, c in plan if s == name) - share * sum(sizes)) < 2


def test_over_allocation_is_taken_back():
    # Due: 2.5 and 0.5; the ones left over go by remainder, ties to the first.
    assert split.allocate(1, {"train": 0.5, "val": 0.5}, [2.0, 0.0])[0] == [1, 0]
    # Due: 4.2, 3.1 and -3.3: seven for four; the least remainder is that of test, which has none, then that of val.
    counts, owed = split.allocate(4, {"train": 0.5, "val": 0.25, "test": 0.25}, [2.2, 2.1, -4.3])
    assert counts == [4, 0, 0] and owed == pytest.approx([0.2, 3.1, -3.3])
    # Ties: the first of equal remainders gives first.
    assert split.allocate(2, {"a": 0.5, "b": 0.5}, [2.0, 2.0])[0] == [0, 2]


def test_apportioned_equals_allocate(spark):
    sizes = [(k, n) for k, n in enumerate([0, 1, 2, 3, 7, 19, 20, 101, 999])]
    got = {(r.g, r.split): r["count"] for r in split.apportioned(spark.createDataFrame(sizes, "g int, n long"), "g", "n").collect()}
    assert got == {(g, s): c for g, n in sizes for s, c in zip(split.ordered(split.RATIOS), split.allocate(n, split.RATIOS)[0])}


def test_a_ratio_that_is_not_positive_is_an_error():
    with pytest.raises(ValueError, match="positive"):
        partition.weights_of(0.0)


def test_assigned_splits_each_class(spark):
    rows = [(i, i % 3) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, cls int")
    got = split.assigned(df, "id", stratum="cls").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 80, "val": 15, "test": 5}


def test_primary_class_ties_go_to_the_first_seen(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 1, 2), ("a", 2, 2), ("a", 3, 5), ("b", 0, 1)], "stem string, ord int, cls int")
    assert {r.stem: r.primary for r in split.primary_class(df, "stem", "cls", "ord").collect()} == {"a": 5, "b": 1}


def test_partitions_have_the_documented_shapes(spark):
    files = spark.range(500).select(F.col("id").alias("pos"))
    static = partition.planned(files, "pos", 500, "STATIC", split=partition.static_split(500, 0.8)).orderBy("pos").collect()
    assert [r.target for r in static] == ["CPU"] * 400 + ["CSD"] * 100
    mte = partition.planned(files, "pos", 500, "MTE", split=partition.meeting_split(500, 40, 10)).orderBy("pos").collect()
    assert [r.queue_position for r in mte[400:]] == list(range(99, -1, -1))
    wrr = partition.planned(files, "pos", 500, "WRR", weights=partition.weights_of(4.0)).orderBy("pos").collect()
    assert [r.pos for r in wrr if r.target == "CSD"] == list(range(4, 500, 5))
    assert sorted(r.queue_position for r in wrr if r.target == "CPU") == list(range(400))


@pytest.mark.parametrize("n,cpu,csd,want", [(50, 40, 2, "MTE"), (500, None, None, "MTE"), (500, 40, 20, "MTE"), (500, 40, 2, "WRR"), (100, 40, 2, "MTE"), (101, 40, 2, "WRR"), (500, 3, 1, "MTE")])
def test_automatic_choice(n, cpu, csd, want):
    assert partition.choose(n, cpu, csd).algorithm == want


@pytest.mark.parametrize("a,b,want", [(13.474, 2.261, (6, 1)), (43.3, 6.09, (7, 1)), (100, 22.5, (9, 2)), (25, 1, (25, 1))])
def test_weights(a, b, want):
    assert partition.weights_of(a / b) == want


def test_static_split_rounds_half_to_even():
    assert partition.static_split(5, 0.5) == 2 and partition.static_split(7, 0.5) == 4
    assert partition.static_split(10, 0.5, 99) == 10
    with pytest.raises(ValueError):
        partition.check_targets(["CPU", "GPU"])


def test_letterbox_geometry(spark):
    t = spark.range(1).select(*(v.alias(k) for k, v in resize.letterbox(F.lit(100), F.lit(50), 640, 640).items())).first()
    assert (t.scale_x, t.new_w, t.new_h, t.pad_x, t.pad_y) == (6.4, 640, 320, 0, 160)


def test_coco_box_clamps_each_number_on_its_own(spark):
    box = annotate.coco_box(F.lit(90.0), F.lit(10.0), F.lit(40.0), F.lit(20.0), F.lit(100.0), F.lit(100.0))
    r = spark.range(1).select(*(v.alias(k) for k, v in box.items())).first()
    assert (r.cx, r.cy, r.w, r.h) == (1.0, 0.2, 0.4, 0.2)


def test_yolo_lines_round_trip_and_short_ones_drop(spark):
    df = spark.createDataFrame([("1 0.5 0.25 0.125 1 extra",), ("2 0.5",), ("",)], "value string")
    assert [tuple(r) for r in annotate.yolo_parse(df).collect()] == [(1, 0.5, 0.25, 0.125, 1.0)]


def test_validation_reasons_in_order(spark):
    rows = [("gif", 10, 100, 100), ("png", None, 100, 100), ("png", 0, 100, 100), ("png", 2**40, 100, 100), ("png", 10, None, None), ("png", 10, 31, 100), ("PNG", 10, 32, 32)]
    df = spark.createDataFrame(rows, "e string, s long, w int, h int")
    why = [r[0] for r in df.select(validate.reason(*(F.col(c) for c in "eswh"))).collect()]
    assert why == ["unsupported_format", "unreadable", "empty_file", "file_too_large", "decode_failed", "resolution_too_low", None]
    loose = [r[0] for r in df.select(validate.reason(*(F.col(c) for c in "eswh"), validate.Limits(check_integrity=False))).collect()]
    assert loose[4:] == [None, None, None]


def test_tiles_stay_inside_and_labels_are_clipped(spark):
    images = spark.createDataFrame([("a", 100, 50), ("b", 10, 10)], "stem string, w int, h int")
    cells = tile.grid(images, "w", "h", (40, 40), 0.25, (20, 20))
    got = sorted((r.tile_x, r.tile_y, r.tile_no) for r in cells.where("stem = 'a'").collect())
    assert got == sorted((x, y, 4 * r + c) for r, y in enumerate((0, 10)) for c, x in enumerate((0, 30, 60, 60)))
    assert cells.where("stem = 'b'").count() == 0
    boxes = spark.createDataFrame([("a", 30.0, 0.0, 20.0, 10.0)], "stem string, x double, y double, bw double, bh double")
    part = tile.tile_labels(boxes, cells.where("tile_no = 0").select("stem", "tile_x", "tile_y"), "stem", (40, 40), 0.3).first()
    assert (part.t_visible, part.t_cx, part.t_bw) == (0.5, 0.875, 0.25)


def test_recipes_skip_what_cannot_be_made(spark):
    items = spark.range(200).withColumnRenamed("id", "item")
    got = augment.recipes(items, "item", ("mosaic", "mixup", "cutout", "cutmix"), 3, 42).collect()
    assert {r.method for r in got} == {"skip", "mixup", "cutout"}
    assert all(len(r.sources) == {"skip": 0, "mixup": 2, "cutout": 1}[r.method] for r in got)


def test_ewma_resets_on_drift_and_keeps_the_unmeasured_side(spark):
    rows = [("k", 1, 10.0, 2.0, 100.0), ("k", 2, 20.0, None, 150.0), ("k", 3, 40.0, 8.0, 400.0)]
    df = spark.createDataFrame(rows, "key string, at int, cpu double, csd double, mp double")
    two = throughput.ewma(df.where("at < 3"), "key", ["at"], "cpu", "csd", "mp").first()
    assert (two.cpu, two.csd, two.samples, two.resets) == (15.0, 2.0, 2, 0)
    three = throughput.ewma(df, "key", ["at"], "cpu", "csd", "mp").first()
    assert (three.cpu, three.csd, three.samples, three.resets) == (40.0, 8.0, 1, 1)
    profile = throughput.Profile()
    for _, at, cpu, csd, mp in rows:
        profile = profile.updated(f"j{at}", str(at), cpu, csd, mp)
    assert (profile.cpu_throughput, profile.csd_throughput, len(profile.history)) == (40.0, 8.0, 3) and profile.reset_reason


def test_dropped_by_names_the_first_step(spark):
    files = spark.createDataFrame([(i,) for i in range(4)], "id int")
    steps = [("validate", files.where("id > 0")), ("resize", files.where("id > 1"))]
    assert {r.id: r.dropped_by for r in shards.dropped_by(files, "id", steps).collect()} == {0: "validate", 1: "resize", 2: None, 3: None}


def test_mock_records_go_both_ways(spark):
    up, down = spark.range(1).select(shards.mock_records(2, 4), shards.mock_records(4, 2)).first()
    assert (up, down) == ([2, 3, 4], [4, 3, 2])


def test_telemetry_of_three_samples(spark):
    df = spark.createDataFrame([("d", 1, 25.0), ("d", 2, 28.0), ("d", 3, 31.0)], "device string, sequence int, temperature double")
    assert [r.temperature_norm for r in telemetry.normalised(df, "device", "temperature").orderBy("sequence").collect()] == [0.0, 0.5, 1.0]
    s = telemetry.summary(df, "device", "temperature").first()
    assert (s["mean"], s.warnings) == (28.0, 1)
    assert telemetry.last_state(df, "device", ["sequence"], "temperature").first().state == "warning"


def test_in_order_is_gapless(spark):
    rng = random.Random(0)
    ids = rng.sample(range(10_000), 777)
    got = in_order(spark.createDataFrame([(i,) for i in ids], "i int"), "i").collect()
    assert [r.i for r in sorted(got, key=lambda r: r.place)] == sorted(ids)
    assert sorted(r.place for r in got) == list(range(777))


def test_box_statistics_by_hand(spark):
    df = spark.createDataFrame([(0.01, 0.01), (0.05, 0.1), (0.5, 0.5)], "w double, h double")
    s = statistics.box_statistics(df, F.col("w"), F.col("h")).first()
    assert (s.small, s.medium, s.large, s.w_mean, s.h_min) == (1, 1, 1, 0.1867, 0.01)


def test_written_tables_can_be_cleared(spark):
    from pathlib import Path

    from shardloom import storage

    df, path = storage.written_at(spark.range(5), "kept")
    assert df.count() == 5 and Path(path.removeprefix("file://")).exists()
    storage.clear()
    assert not Path(path.removeprefix("file://")).exists()
