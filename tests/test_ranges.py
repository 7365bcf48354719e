"""Operators over range partitions, and what is built on them."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from strideframe.functions.scalar import margin_value
from strideframe.operators.dedupe import dedupe
from strideframe.operators.match import nearest_match
from strideframe.operators.profile import Histogram, describe, exact_quantiles, histograms, quantiles_from_counts, value_weights
from strideframe.operators.ranges import PART, in_ranges, next_in_ranges, quantiles_in_ranges
from strideframe.operators.sequence import first_crossing, shot_instant
from strideframe.plans.distance import players_without_minutes
from strideframe.plans.quality import bounds_check, complete_moments, describe_moments
from strideframe.sources import sinks
from strideframe.sources.readers import header_groups, read_table


@pytest.fixture(params=["1", "5", "23"])
def partitions(spark, request):
    """Numbers of range partitions, none of them merged."""
    names = {"spark.sql.shuffle.partitions": request.param, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield int(request.param)
    for k, v in old.items():
        spark.conf.set(k, v)


def test_next_row_equals_a_window(spark, partitions):
    rnd = random.Random(partitions)
    data = [(None if i % 17 == 0 else 0 if i % 3 else rnd.randrange(6), rnd.choice([None, *range(40)]), i, f"v{i % 5}") for i in range(700)]
    df = spark.createDataFrame(data, "u long, t long, id long, v string").repartition(4)
    got = next_in_ranges(df, ["u"], ["t", "id"], ["v", "t"])
    w = Window.partitionBy("u").orderBy("t", "id")
    want = df.select("*", F.lead("v").over(w).alias("next_v"), F.lead("t").over(w).alias("next_t"))
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(next_in_ranges(df.limit(0), ["u"], ["t"], ["v"])) == []


def test_a_hot_key_takes_many_ranges(spark, partitions):
    df = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(3000)], "u long, t long")
    per = [r["count"] for r in in_ranges(df, ["u", "t"]).filter("u = 1").groupBy(PART).count().collect()]
    assert len(per) >= partitions // 2 and max(per) <= 3 * 3000 / partitions


def test_quantiles_per_group(spark, partitions):
    rnd = random.Random(9)
    data = [("hot" if i % 2 else rnd.choice(["a", "b", None]), rnd.choice([0.5, rnd.gauss(0, 9), None])) for i in range(2000)]
    data.append(("single", 3.0))
    df = spark.createDataFrame(data, "g string, v double")
    vw = df.groupBy("g", "v").agg(F.count("*").alias("w"))
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = {(r.g, r.p): r.value for r in quantiles_in_ranges(in_ranges(vw, ["g", "v"]), ["g"], probs).collect()}
    for g in ("hot", "a", "b", None, "single"):
        vals = [v for k, v in data if k == g and v is not None]
        for p in probs:
            assert np.isclose(got[g, p], np.quantile(vals, p), atol=1e-12)
    assert len(got) == 25
    one = {r.p: r.v for r in quantiles_from_counts(value_weights(df, "v"), probs).collect()}
    assert all(np.isclose(one[p], np.quantile([v for _, v in data if v is not None], p)) for p in probs)
    assert exact_quantiles(df.filter("v IS NULL"), "v", probs).count() == 0


def test_describe_many_columns_and_groups(spark, partitions):
    rnd = random.Random(2)
    data = [(rnd.choice(["x", None]), rnd.gauss(5, 2), None if i % 4 else float(i), None) for i in range(400)] + [("one", 7.0, None, None)]
    df = spark.createDataFrame(data, "g string, a double, b double, c double")
    got = {(r.g, r.column): r for r in describe(df, ["a", "b", "c"], by=["g"]).collect()}
    assert len(got) == 9
    for g in ("x", None, "one"):
        for i, c in enumerate("abc"):
            v = np.array([r[i + 1] for r in data if r[0] == g and r[i + 1] is not None])
            r = got[g, c]
            assert r["count"] == len(v)
            if len(v):
                assert np.allclose([r["mean"], r["min"], r.p25, r.p50, r.p75, r["max"]],
                                   [v.mean(), v.min(), *np.quantile(v, [.25, .5, .75]), v.max()])
            assert (r["std"] is None) if len(v) < 2 else np.isclose(r["std"], v.std(ddof=1))
    empty = describe(df.limit(0), ["a", "b"]).collect()
    assert sorted((r.column, r["count"], r["mean"]) for r in empty) == [("a", 0, None), ("b", 0, None)]


def test_histograms_with_their_own_filters_and_edges(spark):
    v = [0.0, 0.1, 0.2, 0.2, 0.7, 0.9, 5.0, None, 30.0]
    df = spark.createDataFrame([(x, 2) for x in v], "v double, w int")
    c = F.col("v")
    got = histograms(df, [Histogram("small", c, 4, keep=c <= 0.2), Histogram("large", c, 3, keep=c > 0.5, clip_upper=6.0),
                          Histogram("fixed", c, 5, lo=0.0, hi=1.0), Histogram("none", c, 2, keep=c > 99)], weight="w").collect()
    by = {(r.histogram, r.bin): (r["count"], r.bin_lo, r.bin_hi) for r in got}
    for name, vals, bins, rng in [("small", [0, .1, .2, .2], 4, None), ("large", [.7, .9, 5, 6], 3, None),
                                  ("fixed", [0, .1, .2, .2, .7, .9], 5, (0, 1))]:
        n, edges = np.histogram(vals, bins=bins, range=rng)
        assert [by[name, i][0] for i in range(bins)] == (2 * n).tolist()
        assert np.allclose([by[name, i][1] for i in range(bins)], edges[:-1]) and np.allclose(by[name, bins - 1][2], edges[-1])
    assert by["none", 0] == by["none", 1] == (0, None, None) and len(by) == 14


def test_match_does_not_depend_on_the_unit_of_time(spark, partitions):
    rnd = random.Random(partitions)
    unit = rnd.choice([1e-6, 1.0, 1e6])
    left = [(0 if i % 2 else rnd.randrange(5), float(rnd.randrange(0, 1000)) * unit, i) for i in range(300)] + [(77, 1.0, 999)]
    right = [(0 if i % 3 == 0 else rnd.randrange(5), float(rnd.randrange(0, 1000)) * unit, float(i)) for i in range(150)]
    L = spark.createDataFrame(left + left[:5], "k long, t double, id long")
    R = spark.createDataFrame(right + right[:40], "k long, c double, x double")
    got = sorted((r.id, r.c, r.x) for r in nearest_match(L, R, [("k", "k")], "t", "c", ["x"]).collect())
    want = []
    for k, t, i in left + left[:5]:
        near = [(abs(c - t), -c, x) for kk, c, x in right if kk == k]
        if near:
            _, c, x = min(near)
            want.append((i, -c, x))
    assert got == sorted(want)


def test_dedupe_keeps_one_row_of_a_hot_key(spark):
    data = [(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (None, 2, "n"), (None, 1, None)] + [(1, 3, "a")] * 500
    df = spark.createDataFrame(data, "k long, o long, p string").repartition(7)
    assert rows(dedupe(df, ["k"], ["o"])) == rows(spark.createDataFrame([(1, 3, "a"), (None, 1, None)], df.schema))
    assert rows(dedupe(df.select("k"), ["k"])) == [(1,), (None,)] or dedupe(df.select("k"), ["k"]).count() == 2


def test_headers_are_read_by_tasks(spark, tmp_path):
    kinds = ["a,b,c", "C,A,B", '"b","a"']
    for i in range(40):
        d = tmp_path / ("x" if i % 2 else "y")
        d.mkdir(exist_ok=True)
        n = len(kinds[i % 3].split(","))
        (d / f"f{i}.csv").write_text(("\ufeff" if i == 3 else "") + kinds[i % 3] + "\n" + ",".join([str(i)] * n) + "\n")
    (tmp_path / "x" / "none.csv").write_text("")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    got = header_groups(spark, str(tmp_path / "*"))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert {k: len(v) for k, v in got.items()} == {("a", "b", "c"): 14, ("c", "a", "b"): 13, ("b", "a"): 13}
    df = read_table(spark, str(tmp_path / "*"))
    assert sorted((int(r.a), int(r.b), r.c and int(r.c)) for r in df.collect()) == [
        (i, i, None if i % 3 == 2 else i) for i in range(40)]


@pytest.mark.parametrize("fails", [1, 2])
def test_a_failed_replacement_leaves_the_old_file(spark, tmp_path, monkeypatch, fails):
    df = spark.range(2)
    path = sinks.write_single_delimited(df, str(tmp_path), "r.txt", header=True)
    old, calls, real = open(tmp_path / "r.txt").read(), [], sinks._rename

    def rename(files, a, b):
        calls.append(1)
        return False if len(calls) == fails else real(files, a, b)

    monkeypatch.setattr(sinks, "_rename", rename)
    with pytest.raises(OSError):
        sinks.write_single_delimited(spark.range(9), str(tmp_path), "r.txt", header=True)
    assert open(tmp_path / "r.txt").read() == old
    monkeypatch.setattr(sinks, "_rename", real)
    assert sinks.write_single_delimited(spark.range(9), str(tmp_path), "r.txt", header=True) == path
    assert len(open(tmp_path / "r.txt").read().split()) == 10
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["r.txt"]


def test_crossing_in_both_directions_and_ties(spark):
    df = spark.createDataFrame([(1, 10.0, 1.0), (1, 9.0, 3.0), (1, 8.0, 3.0), (2, 5.0, 0.0)], "k long, t double, v double")
    down = {r.k: r.c for r in first_crossing(df, ["k"], "t", "v", 2.0, True, "c").collect()}
    up = {r.k: r.c for r in first_crossing(df, ["k"], "t", "v", 2.0, False, "c").collect()}
    assert down == {1: 9.0, 2: None} and up == {1: 8.0, 2: None}
    inst = {r.k: (r.crossing_clock, r.max_height_clock, r.shot_game_clock)
            for r in shot_instant(df, ["k"], "t", "v", 2.0, t_desc=False).collect()}
    assert inst == {1: (8.0, 8.0, 8.0), 2: (None, 5.0, 5.0)}
    m = spark.createDataFrame([("TIE",), (" tie",), ("-3",), ("x",), (None,)], "m string")
    assert [r[0] for r in m.select(margin_value("m", 0)).collect()] == [0, 0, -3, None, None]
    assert [r[0] for r in m.select(margin_value("m")).collect()] == [None, None, -3, None, None]


def test_small_quality_reports(spark):
    cols = "game_id long, event_id long, quarter int, game_clock double, shot_clock double, team_id long, player_id long, x_loc double, y_loc double, radius double"
    data = [(1, 1, 1, 9.0, 1.0, 1, p, 1.0 * (p or 0), 2.0, 1.0) for p in (-1, 1, 2, None)] + [(1, 1, 1, 8.0, 1.0, 1, -1, 99.0, 2.0, 1.0)]
    m = spark.createDataFrame(data, cols)
    by = {r.role: r for r in bounds_check(m).collect()}
    assert (by["players"].n_rows, by["ball"].n_rows, by["ball"].x_out) == (3, 2, 2)      # no id: not the ball
    assert {(r.stage, r.n_moments, r.n_complete, r.pct_complete) for r in complete_moments(m, 4).collect()} == {
        ("raw", 2, 1, 50.0), ("deduped", 2, 1, 50.0)}
    d = {(r.role, r.column): r["count"] for r in describe_moments(m, ["x_loc"]).collect()}
    assert d == {("ball", "x_loc"): 2, ("players", "x_loc"): 3}
    minutes = spark.createDataFrame([(1, 60.0), (1, 30.0)], "player_id long, sec double")
    assert [tuple(r) for r in players_without_minutes(m, minutes).collect()] == [(2, 1)]
