"""Window and join operators on hand-made rows."""

from collections import defaultdict
import random

from pyspark.sql import functions as F

from segloom.functions.arrays import round_even
from segloom.operators.joins import aligned_audit, asof, interval_overlap, nearest
from segloom.operators.windows import absorb_still, block_numbers, bridged, edge_moving_sum, along, gap_clusters, islands, label_runs, moving_sum, segments_from_boundaries
from segloom.operators.segmentation import still_groups


def frames(spark, values, episode=1):
    return spark.createDataFrame([(episode, i, v) for i, v in enumerate(values)], "episode long, frame long, v long")


def test_runs_islands_bridges(spark):
    df = frames(spark, [1, 1, None, None, 2, 1])
    runs = sorted((r.run, r.label, r.start_frame, r.end_frame, r.n) for r in label_runs(df, "v").collect())
    assert [r[1:] for r in runs] == [(1, 0, 1, 2), (None, 2, 3, 2), (2, 4, 4, 1), (1, 5, 5, 1)]
    df = frames(spark, [0, 5, 5, 0, 5, 0, 0, 5, 0])
    assert sorted((r.start_frame, r.end_frame) for r in islands(df, F.col("v") > 0).collect()) == [(1, 2), (4, 4), (7, 7)]
    held = bridged(df, F.col("v") > 0, 1)
    assert sorted((r.start_frame, r.end_frame) for r in islands(held, F.col("bridged")).collect()) == [(1, 4), (7, 7)]
    blocked = bridged(df, F.col("v") > 0, 2, F.col("frame") == 3)
    assert sorted((r.start_frame, r.end_frame) for r in islands(blocked, F.col("bridged")).collect()) == [(1, 2), (4, 7)]
    assert label_runs(df.limit(0), "v").count() == 0


def test_moving_sums(spark):
    df = frames(spark, [1, 2, 3, 4])
    assert [r.s for r in df.select("frame", moving_sum(F.col("v"), 3, along()).alias("s")).orderBy("frame").collect()] == [3, 6, 9, 7]
    assert [r.s for r in df.select("frame", edge_moving_sum(F.col("v"), 3, along()).alias("s")).orderBy("frame").collect()] == [4, 6, 9, 11]


def test_clusters_link_to_the_last_member(spark):
    df = frames(spark, [0, 3, 6, 20, 23])
    assert [r.cluster for r in gap_clusters(df, "v", 3).orderBy("frame").collect()] == [0, 0, 0, 1, 1]


def test_segments_from_boundaries(spark):
    lengths = spark.createDataFrame([(1, 10), (2, 5), (3, 0)], "episode long, n long")
    cuts = spark.createDataFrame([(1, 4), (1, 4), (1, 0), (1, 10), (1, 7)], "episode long, frame long")
    rows = sorted(tuple(r) for r in segments_from_boundaries(cuts, lengths).collect())
    assert rows == [(1, 0, 0, 3), (1, 1, 4, 6), (1, 2, 7, 9), (2, 0, 0, 4)]


def test_still_policy_agrees_with_the_list_form(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for e in range(60):
        still = [rng.random() < 0.5 for _ in range(rng.randint(1, 7))]
        n = [rng.randint(1, 10) for _ in still]
        rows += [(e, i, s, k) for i, (s, k) in enumerate(zip(still, n, strict=True))]
        want[e] = still_groups(still, n, 8)
    df = spark.createDataFrame(rows, "episode long, segment long, s boolean, n long")
    got = defaultdict(lambda: defaultdict(list))
    for r in absorb_still(df, F.col("s"), 8).orderBy("segment").collect():
        got[r.episode][r.group].append(r.segment)
    assert {e: [g[k] for k in sorted(g)] for e, g in got.items()} == want


def test_block_numbers(spark):
    rng = random.Random(2)
    rows = [(rng.randint(-50, 5000), i) for i in range(500)]
    out = block_numbers(spark.createDataFrame(rows, "k long, i long"), "k", ["i"], buckets=7).collect()
    assert [(r.k, r.i) for r in sorted(out, key=lambda r: r.block)] == sorted(rows)
    assert sorted(r.block for r in out) == list(range(500))


def test_asof_ties(spark):
    target = spark.createDataFrame([(1, 10, 0), (1, 5, 1), (1, 0, 2), (2, 3, 3)], "episode long, t long, x long")
    source = spark.createDataFrame([(1, 5, 7), (1, 5, 8), (1, 15, 9)], "episode long, t long, id long")
    got = {r.x: (r.before and r.before.id, r.after and r.after.id, r.near and r.near.id) for r in nearest(asof(target, source)).collect()}
    assert got == {0: (8, 9, 8), 1: (8, 7, 8), 2: (None, 7, 7), 3: (None, None, None)}


def test_interval_overlap_is_complete(spark):
    rng = random.Random(3)
    a = [(1, s, s + rng.randint(0, 200)) for s in (rng.randint(0, 500) for _ in range(40))]
    b = [(1, s, s + rng.randint(0, 200)) for s in (rng.randint(0, 500) for _ in range(40))]
    left = spark.createDataFrame(a, "episode long, start long, stop long")
    right = spark.createDataFrame(b, "episode long, b_start long, b_stop long")
    got = sorted(tuple(r) for r in interval_overlap(left, right).select("start", "stop", "b_start", "b_stop").collect())
    assert got == sorted((s, e, p, q) for _, s, e in a for _, p, q in b if s < q and p < e and s < e and p < q)


def test_aligned_audit(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k long, f string")
    b = spark.createDataFrame([(1, "y"), (2, None), (4, "z")], "k long, f string")
    assert {r.issue: r.n for r in aligned_audit(a, b, ["k"], ["f"]).collect()} == {"differs_f": 1, "missing_left": 1, "missing_right": 1}


def test_half_even_rounding_is_that_of_the_sql(spark):
    import duckdb

    values = [k * 50 / 1e6 for k in range(-4001, 4001, 2)] + [k / 1e6 for k in range(-900_007, 900_000, 997)]
    want = duckdb.connect().execute(f"SELECT round_even(unnest({values}::DOUBLE[]), 4) AS r").fetchall()
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double").orderBy("i").select(round_even(F.col("v"), 4).alias("r")).collect()
    assert [r.r for r in got] == [r[0] for r in want]
