"""Sequence operators, bucketed vs plain vs brute force."""

import math
import random

from pyspark.sql import functions as F

from conftest import moments_df, rows
from strideframe.operators.sequence import (consecutive_gap, forward_fill, head_k, next_in_sequence, next_within,
                                            shot_instant, step_distance, time_buckets)

SEG = ["game_id", "player_id", "quarter"]


def test_step_gap_guard_inclusive(spark):
    # gaps 0.04, 0.5 (kept, inclusive), 0.52 (dropped); last row of the segment; quarter change
    df = moments_df(spark, [
        (1, 1, 1, 10.00, 7, 0, 0),
        (1, 1, 1, 9.96, 7, 3, 4),     # 0.04 s later, 5 m
        (1, 1, 1, 9.46, 7, 3, 5),     # 0.5 s later, 1 m
        (1, 1, 1, 8.94, 7, 3, 9),     # 0.52 s later: not counted
        (1, 1, 2, 720.0, 7, 50, 50),  # other quarter: own segment
        (1, 1, 2, 719.96, 7, 50, 51),
    ])
    for buckets in (None, time_buckets("game_clock", 0.5), time_buckets("game_clock", 60.0)):
        out = step_distance(df, SEG, max_gap=0.5, buckets=buckets)
        d = {(r.quarter, r.game_clock): r.dist_m for r in out.collect()}
        # 10.00 -> 9.96 is 5 m, 9.96 -> 9.46 is 1 m, 9.46 -> 8.94 is beyond the guard
        assert d[(1, 10.0)] == 5.0 and d[(1, 9.96)] == 1.0 and d[(1, 9.46)] == 0.0
        assert d[(1, 8.94)] == 0.0 and d[(2, 720.0)] == 1.0 and d[(2, 719.96)] == 0.0


def _random_moments(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data, seen = [], set()
    while len(data) < n:
        g, p, q = rnd.randint(0, 2), rnd.randint(0, 3), rnd.randint(1, 4)
        c = round(rnd.uniform(0, 720), 2)
        if (g, p, q, c) in seen:
            continue
        seen.add((g, p, q, c))
        data.append((g, 1, q, c, p, rnd.uniform(0, 28), rnd.uniform(0, 15)))
    return moments_df(spark, data), data


def _brute_steps(data, max_gap):
    seg = {}
    for g, _, q, c, p, x, y in data:
        seg.setdefault((g, p, q), []).append((c, x, y))
    tot = {}
    for (g, p, q), pts in seg.items():
        pts.sort(key=lambda t: -t[0])
        for a, b in zip(pts, pts[1:]):
            if a[0] - b[0] <= max_gap:
                tot[p] = tot.get(p, 0.0) + math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2)
            else:
                tot.setdefault(p, 0.0)
        if len(pts) == 1:
            tot.setdefault(p, 0.0)
    return tot


def test_step_distance_bucketed_equals_brute_force(spark):
    df, data = _random_moments(spark)
    expect = _brute_steps(data, 2.0)
    for width in (None, 1.0, 7.5, 100.0):
        b = time_buckets("game_clock", width) if width else None
        got = {r.player_id: r.s for r in step_distance(df, SEG, max_gap=2.0, buckets=b)
               .groupBy("player_id").agg(F.sum("dist_m").alias("s")).collect()}
        assert set(got) == set(expect)
        for k in expect:
            assert math.isclose(got[k], expect[k], rel_tol=1e-9)


def test_next_in_sequence_crosses_empty_buckets_and_quarters(spark):
    df, data = _random_moments(spark, n=800, seed=3)
    order = [("quarter", True), ("game_clock", False)]
    plain = next_in_sequence(df, ["game_id", "player_id"], order, ["x_loc", "game_clock"])
    buck = next_in_sequence(df, ["game_id", "player_id"], order, ["x_loc", "game_clock"],
                            [("quarter", None, True),
                             ("_tb", F.floor(F.col("game_clock") / 5.0), False)])
    cols = ["game_id", "player_id", "quarter", "game_clock", "next_x_loc", "next_game_clock"]
    assert rows(plain.select(cols)) == rows(buck.select(cols))


def test_consecutive_gap(spark):
    df = moments_df(spark, [(1, 1, 1, 10.0, 7, 0, 0), (1, 1, 1, 9.5, 7, 0, 0), (1, 1, 1, 8.0, 7, 0, 0)])
    got = sorted((r.game_clock, r.clock_gap) for r in consecutive_gap(df, SEG, buckets=time_buckets("game_clock", 1.0)).collect())
    assert got == [(8.0, None), (9.5, 1.5), (10.0, 0.5)]


MARGIN_COLS = "game_id long, period int, clk int, eventnum long, margin string"


def test_forward_fill_ties_and_lead_in(spark):
    data = [
        (1, 1, 700, 1, None),      # null lead-in stays null
        (1, 1, 650, 2, "3"),
        (1, 1, 650, 3, None),      # equal clock: event number orders (H2)
        (1, 2, 600, 9, None),      # next period: carries across
        (1, 4, 599, 10, "TIE"),    # text margin is a value for the fill
        (1, 4, 10, 11, None),
        (2, 1, 700, 1, "-2"),      # other game: own sequence
    ]
    df = spark.createDataFrame(data, MARGIN_COLS)
    order = [("period", True), ("clk", False), ("eventnum", True)]
    expect = {(1, 1): None, (1, 2): "3", (1, 3): "3", (1, 9): "3", (1, 10): "TIE", (1, 11): "TIE", (2, 1): "-2"}
    for buckets in (None, [("period", None, True), ("_b", F.floor(F.col("clk") / 60), False)]):
        out = forward_fill(df, ["game_id"], order, "margin", "filled", buckets)
        got = {(r.game_id, r.eventnum): r.filled for r in out.collect()}
        assert got == expect


def test_forward_fill_bucketed_random(spark):
    rnd = random.Random(5)
    data = [(rnd.randint(0, 2), rnd.randint(1, 5), rnd.randint(0, 720), i,
             (str(rnd.randint(-9, 9)) if rnd.random() < 0.2 else None)) for i in range(2000)]
    df = spark.createDataFrame(data, MARGIN_COLS)
    order = [("period", True), ("clk", False), ("eventnum", True)]
    a = forward_fill(df, ["game_id"], order, "margin", "f")
    b = forward_fill(df, ["game_id"], order, "margin", "f",
                     [("period", None, True), ("_b", F.floor(F.col("clk") / 37), False)])
    assert rows(a) == rows(b)


def test_shot_instant_crossing_peak_and_ties(spark):
    df = moments_df(spark, [
        # event 1: crosses 2 m twice; earliest crossing = largest clock
        (1, 1, 4, 100.0, -1, 0, 0, 1.0), (1, 1, 4, 99.0, -1, 0, 0, 2.5), (1, 1, 4, 98.0, -1, 0, 0, 1.0),
        (1, 1, 4, 97.0, -1, 0, 0, 2.0),
        # event 2: never crosses, tie at the peak -> larger clock
        (1, 2, 4, 50.0, -1, 0, 0, 1.5), (1, 2, 4, 49.0, -1, 0, 0, 1.5), (1, 2, 4, 48.0, -1, 0, 0, 1.0),
    ])
    out = {r.event_id: r for r in shot_instant(df, ["game_id", "event_id", "quarter"], threshold=2.0).collect()}
    assert out[1].crossing_clock == 99.0 and out[1].shot_game_clock == 99.0 and out[1].max_height == 2.5
    assert out[2].crossing_clock is None and out[2].max_height_clock == 50.0 and out[2].shot_game_clock == 50.0


def test_head_k_total_order(spark):
    df = spark.createDataFrame([(1, i, 10 - i % 3) for i in range(10)] + [(2, 0, 1)], "u long, id long, t long")
    out = head_k(df, ["u"], [("t", True), ("id", True)], 3)
    assert rows(out.select("u", "id")) == [(1, 2), (1, 5), (1, 8), (2, 0)]


def test_next_within_matches_brute_force(spark):
    df, data = _random_moments(spark, n=4000, seed=9)
    expect = _brute_steps(data, 0.6)
    for width in (0.6, 1.0, 13.0):
        got = {r.player_id: r.s for r in step_distance(df, SEG, max_gap=0.6, bucket_width=width)
               .groupBy("player_id").agg(F.sum("dist_m").alias("s")).collect()}
        assert set(got) == set(expect)
        for k in expect:
            assert math.isclose(got[k], expect[k], rel_tol=1e-9)


def test_next_within_ascending_boundaries(spark):
    ts = [0.0, 59.5, 60.0, 120.5, 121.0, 179.9, 180.4, 240.0]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(ts)], "u long, id long, t double")
    out = {r.id: r.next_t for r in next_within(df, ["u"], "t", True, ["t"], 0.5, 60.0).collect()}
    for i, t in enumerate(ts):
        true_next = ts[i + 1] if i + 1 < len(ts) else None
        # either the true successor or null, and never null within the horizon (inclusive)
        assert out[i] in (true_next, None)
        if true_next is not None and true_next - t <= 0.5:
            assert out[i] == true_next
    assert out[1] == 60.0 and out[5] == 180.4


def test_next_within_large_absolute_times(spark):
    """Microsecond timestamps (~1.7e15) with one-second buckets: a successor
    exactly one horizon away across a bucket edge is still found."""
    base = 1_704_067_200_000_000          # 2024-01-01 in microseconds
    w, h = 1_000_000, 250_000
    ts = [base + 999_900, base + 1_149_900, base + 2_999_750, base + 3_249_750, base + 5_000_000]
    df = spark.createDataFrame([(1, i, float(t)) for i, t in enumerate(ts)], "u long, id long, t double")
    out = {r.id: r.next_t for r in next_within(df, ["u"], "t", True, ["t"], h, w).collect()}
    assert out[0] == float(ts[1]) and out[2] == float(ts[3])     # 150 ms and exactly 250 ms, across edges
    assert out[3] is None or out[3] == float(ts[4])
    assert out[4] is None
