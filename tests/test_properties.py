"""Property checks (randomised fixtures, several seeds): invariants that hold
for any input, independent of the oracle."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import moments_df
from strideframe.operators.near import exclusive_near, with_target_in_moment
from strideframe.operators.profile import histogram
from strideframe.operators.sequence import forward_fill, step_distance, time_buckets
from strideframe.plans.distance import dedupe_moments

SEG = ["game_id", "player_id", "quarter"]


def _moments(spark, seed, n=1500):
    rnd = random.Random(seed)
    data = [(rnd.randint(1, 2), 1, rnd.randint(1, 2), rnd.randint(0, 60) * 0.04, rnd.randint(-1, 4),
             rnd.uniform(0, 6), rnd.uniform(0, 6)) for _ in range(n)]
    return moments_df(spark, data)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exclusive_rows_at_most_one_per_moment_and_within_radius(spark, seed):
    d = dedupe_moments(_moments(spark, seed), [])
    out = exclusive_near(with_target_in_moment(d), radius=1.0)
    per = out.groupBy("game_id", "quarter", "game_clock").count()
    assert per.filter("count > 1").count() == 0
    far = out.filter(F.sqrt(F.pow(F.col("x_loc") - F.col("ball_x"), 2)
                            + F.pow(F.col("y_loc") - F.col("ball_y"), 2)) > 1.0)
    assert far.count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_path_length_at_least_straight_line(spark, seed):
    """Without a gap guard, the summed steps of a segment are at least the
    distance between its first and last sample (triangle inequality)."""
    d = dedupe_moments(_moments(spark, seed), []).filter("player_id <> -1")
    steps = step_distance(d.select(*SEG, "game_clock", "x_loc", "y_loc"), SEG, max_gap=None,
                          buckets=time_buckets("game_clock", 0.5))
    seg = steps.groupBy(*SEG).agg(
        F.sum("dist_m").alias("path"),
        F.max_by(F.struct("x_loc", "y_loc"), "game_clock").alias("first"),
        F.min_by(F.struct("x_loc", "y_loc"), "game_clock").alias("last"))
    for r in seg.collect():
        straight = math.hypot(r["first"].x_loc - r["last"].x_loc, r["first"].y_loc - r["last"].y_loc)
        assert r.path >= straight - 1e-9


@pytest.mark.parametrize("seed", [6, 7])
def test_forward_fill_is_idempotent(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.randint(0, 2), rnd.randint(1, 4), rnd.randint(0, 720), i,
             str(rnd.randint(-5, 5)) if rnd.random() < 0.3 else None) for i in range(800)]
    df = spark.createDataFrame(data, "game_id long, period int, clock int, eventnum long, margin string")
    order = [("period", True), ("clock", False), ("eventnum", True)]
    buckets = [("period", None, True), ("_cb", F.floor(F.col("clock") / 30), False)]
    once = forward_fill(df, ["game_id"], order, "margin", "filled", buckets)
    twice = forward_fill(once.drop("margin").withColumnRenamed("filled", "margin"), ["game_id"], order,
                         "margin", "filled", buckets)
    a = sorted((r.eventnum, r.filled) for r in once.collect())
    b = sorted((r.eventnum, r.filled) for r in twice.collect())
    assert a == b


@pytest.mark.parametrize("seed", [8, 9])
def test_histogram_counts_add_up(spark, seed):
    rnd = np.random.default_rng(seed)
    vals = [None if rnd.random() < 0.1 else float(v) for v in rnd.gamma(2.0, 3.0, 700)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for bins, clip in ((15, None), (100, 5.0), (7, None)):
        h = histogram(df, "v", bins, clip_upper=clip).collect()
        assert len(h) == bins
        assert sum(r["count"] for r in h) == sum(v is not None for v in vals)
        assert all(r["count"] >= 0 for r in h)
