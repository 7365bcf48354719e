"""F7, J1/F12/W3, J6/J7, A6–A8, A15, A20, M1, E-functions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import moments_df, rows
from strideframe.functions import scalar as S
from strideframe.operators.dedupe import dedupe
from strideframe.operators.match import nearest_match
from strideframe.operators.near import exclusive_near, with_target_in_moment
from strideframe.operators.profile import exact_quantiles, histogram, profile, threshold_counts
from strideframe.operators.rates import pivot_rates
from strideframe.operators.score import linear_score, linear_score_columns
from strideframe.plans.distance import MOMENT_KEY, TIE_BREAK

#: Broadcast thresholds that force a shuffle join and allow a broadcast; conftest restores the setting.
JOIN_LIMITS = ("-1", "10m")


def test_dedupe_is_deterministic_across_input_orders(spark):
    base = [(1, 5, 1, 10.0, 7, 3.0, 4.0), (1, 2, 1, 10.0, 7, 9.0, 9.0), (1, 2, 1, 10.0, 7, 1.0, 1.0),
            (1, 1, 1, 9.0, 7, 0.0, 0.0)]
    a = dedupe(moments_df(spark, base), MOMENT_KEY, TIE_BREAK)
    b = dedupe(moments_df(spark, list(reversed(base))).repartition(3), MOMENT_KEY, TIE_BREAK)
    assert rows(a) == rows(b)
    kept = {r.game_clock: (r.event_id, r.x_loc) for r in a.collect()}
    assert kept == {10.0: (2, 1.0), 9.0: (1, 0.0)}


def test_exclusive_near(spark):
    d = moments_df(spark, [
        # moment A: ball + one player within 0.5 (exactly 0.5 counts) + one far -> exclusive
        (1, 1, 1, 10.0, -1, 0.0, 0.0), (1, 1, 1, 10.0, 1, 0.3, 0.4), (1, 1, 1, 10.0, 2, 5.0, 5.0),
        # moment B: two players near -> contested, nobody
        (1, 1, 1, 9.0, -1, 0.0, 0.0), (1, 1, 1, 9.0, 1, 0.1, 0.0), (1, 1, 1, 9.0, 2, 0.0, 0.1),
        # moment C: no ball row
        (1, 1, 1, 8.0, 1, 0.0, 0.0),
        # moment D: nobody near
        (1, 1, 1, 7.0, -1, 0.0, 0.0), (1, 1, 1, 7.0, 1, 3.0, 3.0),
    ])
    out = exclusive_near(with_target_in_moment(d), radius=0.5)
    assert rows(out.select("game_clock", "player_id")) == [(10.0, 1)]


def test_nearest_match_ties_and_tolerance(spark):
    left = spark.createDataFrame([(1, 7, 1, 10.0), (2, 7, 1, 10.0), (1, 8, 1, 50.0)],
                                 "game_id long, player_id long, quarter int, t double")
    right = spark.createDataFrame([
        (1, 7, 1, 9.5, 1.0), (1, 7, 1, 10.5, 2.0),    # equal distance: larger clock wins
        (2, 7, 1, 10.2, 3.0), (2, 7, 1, 13.0, 4.0),   # same player, other game
        (1, 8, 1, 52.0, 5.0),                         # outside a 1 s tolerance
    ], "game_id long, player_id long, quarter int, clock double, x double")
    on = [("game_id", "game_id"), ("player_id", "player_id"), ("quarter", "quarter")]
    for limit in JOIN_LIMITS:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        out = nearest_match(left, right, on, "t", "clock", ["x"])
        got = {(r.game_id, r.player_id): (r.clock, r.x) for r in out.collect()}
        assert got == {(1, 7): (10.5, 2.0), (2, 7): (10.2, 3.0), (1, 8): (52.0, 5.0)}
        tol = nearest_match(left, right, on, "t", "clock", ["x"], tolerance=1.0)
        got = {(r.game_id, r.player_id): (r.clock, r.x) for r in tol.collect()}
        assert got == {(1, 7): (10.5, 2.0), (2, 7): (10.2, 3.0)}


def test_pivot_rates_fill_and_guard(spark):
    df = spark.createDataFrame([(1, "2pt", 1), (1, "2pt", 2), (2, "3pt", 2), (3, "2pt", 2), (3, "3pt", 1)],
                               "player_id long, shot_type string, event_type int")
    names = {"2pt": ("r2", "n2", None), "3pt": ("r3", "n3", None)}
    out = pivot_rates(df, "player_id", "shot_type", ["2pt", "3pt"], F.col("event_type") == 1, names)
    assert rows(out) == [(1, 0.5, 2, 0.0, 0), (2, 0.0, 0, 0.0, 1), (3, 0.0, 1, 1.0, 1)]


def test_round_half_up_like_reference(spark):
    df = spark.createDataFrame([(29, 200), (1, 8)], "m long, n long")
    got = [r.r for r in df.select(S.guarded_ratio("m", "n").alias("r")).collect()]
    assert got == [0.15, 0.13]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_numpy(spark, seed):
    rnd = np.random.default_rng(seed)
    vals = np.concatenate([rnd.normal(size=3000), np.zeros(1000), rnd.integers(0, 5, 500).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.0, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = {r.p: r.v for r in exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert math.isclose(got[p], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-12)


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([(0.0, 3), (1.0, 1), (5.0, 1)], "v double, w long")
    got = {r.p: r.v for r in exact_quantiles(df, "v", [0.5, 0.75], weight="w").collect()}
    ref = np.quantile([0, 0, 0, 1, 5], [0.5, 0.75])
    assert got == {0.5: ref[0], 0.75: ref[1]}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.0,), (None,)], "v double")
    h = {r.bin: r["count"] for r in histogram(df, "v", 4).collect()}
    assert h == {0: 1, 1: 0, 2: 1, 3: 2}          # the max falls in the last bin
    assert np.histogram([0, 1, 2, 2], bins=4)[0].tolist() == [1, 0, 1, 2]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h2 = {r.bin: r["count"] for r in histogram(same, "v", 15).collect()}
    assert h2[7] == 2 and sum(h2.values()) == 2   # all equal: middle bin, like numpy
    clipped = {r.bin: r["count"] for r in histogram(df, "v", 2, clip_upper=1.0).collect()}
    assert clipped == {0: 1, 1: 3}


def test_threshold_counts(spark):
    df = spark.createDataFrame([(0.04,), (0.5,), (0.52,), (None,)], "g double")
    r = threshold_counts(df, "g", [("le", "<=", 0.5), ("gt", ">", 0.5)]).first()
    assert (r.n_values, r.n_le, r.n_gt) == (3, 2, 1)


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "k long, s string")
    p = {r.column: r for r in profile(df, "t").collect()}
    assert (p["k"].nunique, p["k"].nulls, p["k"].sample, p["k"].dtype) == (2, 0, "1", "bigint")
    assert (p["s"].non_null, p["s"].null_pct, p["s"].sample) == (2, 33.3, "a")


@pytest.mark.parametrize("n", [1, 8, 31, 64])
def test_linear_score_lengths(spark, n):
    rnd = np.random.default_rng(n)
    x = rnd.normal(size=(20, n)).astype(np.float32)
    coef = rnd.normal(size=n).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, f array<float>")
    got = {r.id: r.score for r in linear_score(df, "f", [float(c) for c in coef], 0.25).collect()}
    expect = x.astype(np.float64) @ coef.astype(np.float64) + 0.25
    for i in range(20):
        assert math.isclose(got[i], expect[i], rel_tol=1e-9, abs_tol=1e-9)


def test_linear_score_zero_and_wrong_length(spark):
    df = spark.createDataFrame([(0, [0.0] * 4), (1, [1.0] * 3)], "id long, f array<float>")
    got = {r.id: r.score for r in linear_score(df, "f", [1.0, 2.0, 3.0, 4.0], 0.5).collect()}
    assert got == {0: 0.5, 1: None}
    cols = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert linear_score_columns(cols, ["a", "b"], [3.0, 4.0], 1.0).first().score == 12.0


# fixed values: shot positions (m) with their distance to the nearer-half basket and type
SHOT_GOLDEN = [
    (24.051383952, 10.425690096, 4.107261052113884, "2pt"),
    (28.453336032000003, 1.73696376, 6.047864230271612, "2pt"),
    (3.1592489520000004, 6.935583792, 1.70266238006993, "2pt"),
    (9.511378488, 8.573639952, 7.968448671293838, "3pt"),
    (6.784445664, 2.2458243120000003, 7.467139173083161, "3pt"),
]


def test_shot_geometry_goldens(spark):
    df = spark.createDataFrame([(x, y) for x, y, _, _ in SHOT_GOLDEN], "x double, y double")
    out = df.select(S.dist_to_basket("x", "y").alias("d")).withColumn("t", S.shot_type("d")).collect()
    for (x, y, d, t), r in zip(SHOT_GOLDEN, out):
        assert abs(r.d - d) < 1e-12 and r.t == t


def test_clock_parsing(spark):
    df = spark.createDataFrame([("9:59",), ("10:00",), (" 0:07 ",), ("bad",), (None,)], "s string")
    tol = [r.c for r in df.select(S.clock_to_seconds("s", strict=False).alias("c")).collect()]
    assert tol == [599, 600, 7, None, None]
    strict = [r.c for r in df.limit(2).select(S.clock_to_seconds("s").alias("c")).collect()]
    assert strict == [599, 600]


def test_mirror_and_contains(spark):
    df = spark.createDataFrame([(10.0, 20.0, "Curry 3PT Jump", None), (80.0, 5.0, None, None)],
                               "x double, y double, h string, v string")
    xp, yp = S.mirror_to_right_half("x", "y")
    got = df.select(xp.alias("x"), yp.alias("y"), S.contains_any(["h", "v"], "3PT").alias("c")).collect()
    assert [(r.x, r.y, r.c) for r in got] == [(84.0, 30.0, True), (80.0, 5.0, False)]


def test_random_repartition_invariance(spark):
    rnd = random.Random(11)
    data = [(rnd.randint(0, 1), rnd.randint(0, 40), 1, float(rnd.randint(0, 60)), rnd.randint(-1, 3),
             rnd.uniform(0, 5), rnd.uniform(0, 5)) for _ in range(1500)]
    a = dedupe(moments_df(spark, data), MOMENT_KEY, TIE_BREAK)
    b = dedupe(moments_df(spark, list(reversed(data))).repartition(7), MOMENT_KEY, TIE_BREAK)
    assert rows(a) == rows(b)


def _brute_nearest(left, right, tol=None):
    """Pure-Python reference: min over (d, -t, x) per left row, copies included."""
    out = []
    for (g, p, t) in left:
        cands = [(abs(rt - t), -rt, x, rt) for (rg, rp, rt, x) in right if (rg, rp) == (g, p)]
        if tol is not None:
            cands = [c for c in cands if c[0] <= tol]
        if cands:
            d, _, x, rt = min(cands)
            out.append((g, p, t, rt, x))
    return sorted(out)


@pytest.mark.parametrize("width", [None, 0.7, 3.0, 50.0])
def test_nearest_match_bucketed_matches_brute_force(spark, width):
    rnd = random.Random(7)
    # key (1, 1) is hot: most rows of both sides; clocks on a coarse grid so ties occur
    right = [(1 if rnd.random() < 0.7 else rnd.randint(2, 3), rnd.randint(1, 2),
              rnd.randint(0, 80) / 4, float(rnd.randint(0, 3))) for _ in range(400)]
    left = [(1 if rnd.random() < 0.7 else rnd.randint(2, 4), rnd.randint(1, 2), rnd.randint(-8, 90) / 4)
            for _ in range(120)]
    left += left[:10]                       # identical left rows each give a result
    L = spark.createDataFrame(left, "g long, p long, t double").repartition(3)
    R = spark.createDataFrame(right, "g long, p long, clock double, x double").repartition(5)
    on = [("g", "g"), ("p", "p")]
    for limit in JOIN_LIMITS:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = nearest_match(L, R, on, "t", "clock", ["x"], bucket_width=width)
        assert sorted((r.g, r.p, r.t, r.clock, r.x) for r in got.collect()) == _brute_nearest(left, right)
        assert got.count() == len(_brute_nearest(left, right))
        tol = nearest_match(L, R, on, "t", "clock", ["x"], bucket_width=width, tolerance=0.5)
        assert sorted((r.g, r.p, r.t, r.clock, r.x) for r in tol.collect()) == _brute_nearest(left, right, 0.5)


def test_profile_approx_agrees_with_exact(spark):
    rnd = random.Random(3)
    data = [(i % 37, None if i % 5 == 0 else rnd.choice("abcdefg"), float(i % 11) if i % 7 else None)
            for i in range(2000)]
    df = spark.createDataFrame(data, "a long, b string, c double")
    ex = {r.column: r for r in profile(df, "t").collect()}
    ap = {r.column: r for r in profile(df, "t", approx=True).collect()}
    assert set(ex) == set(ap)
    for c in ex:
        e, a = ex[c], ap[c]
        assert (e.ordinal, e.dtype, e.rows, e.non_null, e.nulls, e.null_pct, e.sample) == \
               (a.ordinal, a.dtype, a.rows, a.non_null, a.nulls, a.null_pct, a.sample)
        assert abs(a.nunique - e.nunique) <= max(1, 0.05 * e.nunique)


def test_pivot_rates_keys_outside_the_list(spark):
    """A key whose rows all have other (or null) categories still appears,
    with zero attempts — the same rows a pivot on the fixed list gives."""
    df = spark.createDataFrame([(1, "2pt", 1), (2, "free", 1), (3, None, 1), (3, "3pt", None)],
                               "player_id long, shot_type string, event_type int")
    out = pivot_rates(df, "player_id", "shot_type", ["2pt", "3pt"], F.col("event_type") == 1)
    assert rows(out) == [(1, 1.0, 1, 1, 0.0, 0, 0), (2, 0.0, 0, 0, 0.0, 0, 0), (3, 0.0, 0, 0, 0.0, 1, 0)]


def test_describe_matches_pandas(spark):
    import pandas as pd
    from strideframe.operators.profile import describe
    rnd = random.Random(11)
    vals = [rnd.choice([None, round(rnd.gauss(3.0, 2.0), 3), 1.5]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = describe(df, ["x"]).first()
    exp = pd.Series([v for v in vals if v is not None]).describe()
    assert got["count"] == int(exp["count"])
    for k, e in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                 ("p75", "75%"), ("max", "max")]:
        assert math.isclose(got[k], exp[e], rel_tol=1e-9, abs_tol=1e-12), k
    one = describe(spark.createDataFrame([(2.0,), (None,)], "x double"), ["x"]).first()
    assert one["count"] == 1 and one["mean"] == 2.0 and one["std"] is None and one["p50"] == 2.0


def test_nearest_match_copy_group_on_the_right(spark):
    """300 right rows share one (key, time) with different payloads: the
    smallest payload wins, exactly as the brute force picks it."""
    rnd = random.Random(17)
    right = [(1, 1, 5.0, float(rnd.randint(0, 50))) for _ in range(300)]
    right += [(1, 1, rnd.randint(0, 40) / 4, float(rnd.randint(0, 3))) for _ in range(60)]
    left = [(1, 1, rnd.randint(-4, 44) / 4) for _ in range(40)] + [(1, 1, 5.1)] * 3
    L = spark.createDataFrame(left, "g long, p long, t double")
    R = spark.createDataFrame(right, "g long, p long, clock double, x double").repartition(4)
    got = nearest_match(L, R, [("g", "g"), ("p", "p")], "t", "clock", ["x"], bucket_width=2.0)
    assert sorted((r.g, r.p, r.t, r.clock, r.x) for r in got.collect()) == sorted(_brute_nearest(left, right))


def test_join_target_equals_window_form(spark):
    """The equi-join of player rows with the ball row of the same moment
    gives the same exclusive-possession rows as the one-pass window form."""
    from strideframe.operators.dedupe import split_roles
    from strideframe.operators.near import join_target
    rnd = random.Random(8)
    data = []
    for c in range(60):
        clock = 100.0 - c * 0.04
        if rnd.random() < 0.9:
            data.append((1, 1, 1, clock, -1, rnd.uniform(0, 5), rnd.uniform(0, 5)))
        for p in range(1, 5):
            data.append((1, 1, 1, clock, p, rnd.uniform(0, 5), rnd.uniform(0, 5)))
    d = dedupe(moments_df(spark, data), MOMENT_KEY, TIE_BREAK)
    players, ball = split_roles(d)
    a = exclusive_near(join_target(players, ball), radius=1.5)
    b = exclusive_near(with_target_in_moment(d), radius=1.5)
    cols = ["game_id", "quarter", "game_clock", "player_id"]
    assert rows(a.select(*cols)) == rows(b.select(*cols)) and a.count() > 0


def test_nearest_match_tolerance_large_absolute_times(spark):
    """Microsecond timestamps (~1.7e15), one-second buckets and a 250 ms band:
    right rows exactly one tolerance away across a bucket edge still match;
    one a microsecond further out does not."""
    base = 1_704_067_200_000_000          # 2024-01-01 in microseconds
    w, tol = 1_000_000.0, 250_000.0
    left = [(1, 1, float(base + 999_900)), (1, 2, float(base + 3_000_100)), (1, 3, float(base + 5_000_000))]
    right = [(1, 1, float(base + 1_249_900), 1.0), (1, 2, float(base + 2_750_100), 2.0),
             (1, 3, float(base + 5_250_001), 3.0)]
    L = spark.createDataFrame(left, "g long, p long, t double")
    R = spark.createDataFrame(right, "g long, p long, clock double, x double")
    for limit in JOIN_LIMITS:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = nearest_match(L, R, [("g", "g"), ("p", "p")], "t", "clock", ["x"],
                            tolerance=tol, bucket_width=w)
        assert sorted((r.p, r.clock, r.x) for r in got.collect()) == \
            [(1, float(base + 1_249_900), 1.0), (2, float(base + 2_750_100), 2.0)]


def test_nearest_match_keeps_repeated_left_rows(spark):
    from strideframe.operators.match import nearest_match
    left = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 6.0)], "k int, t double")
    right = spark.createDataFrame([(1, 5.2, 9.0)], "k int, u double, x double")
    for tol in (None, 2.0):
        assert nearest_match(left, right, [("k", "k")], "t", "u", ["x"], tolerance=tol).count() == 3


def test_target_in_moment_drops_null_keys(spark):
    from strideframe.operators import near
    rows = [(1, 1, None, -1, 0.0, 0.0), (1, 1, None, 5, 0.1, 0.0), (1, 1, 2.0, -1, 0.0, 0.0), (1, 1, 2.0, 5, 0.1, 0.0)]
    m = spark.createDataFrame(rows, "game_id long, quarter int, game_clock double, player_id long, x_loc double, y_loc double")
    joined = near.join_target(m.filter("player_id <> -1"), m.filter("player_id = -1"))
    assert near.with_target_in_moment(m).count() == joined.count() == 1
