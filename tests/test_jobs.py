"""Composite jobs (Q1–Q4, Q10), sources/sinks (S1–S6), and the registered
queries against their DuckDB oracle on the smallest driver data."""

import math
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, moments_df, rows
from strideframe import schemas
from strideframe.plans import cli
from strideframe.plans.clutch import clutch_efficiency, clutch_shots, locate_shots, shot_locations
from strideframe.plans.distance import distance_per_entity, distance_unfiltered
from strideframe.plans.possession import possession_per_entity
from strideframe.sources.readers import read_results, read_table
from strideframe.sources.sinks import write_single_delimited


def _minutes(spark, data):
    return spark.createDataFrame(data, "player_id long, sec double")


def test_distance_inner_join_and_rate(spark):
    m = moments_df(spark, [
        (1, 1, 1, 10.0, 7, 0, 0), (1, 1, 1, 9.96, 7, 3, 4), (1, 1, 1, 9.96, 7, 30, 40),  # dup key
        (1, 1, 1, 10.0, 8, 0, 0), (1, 1, 1, 9.96, 8, 0, 1),
        (1, 1, 1, 10.0, -1, 5, 5),
    ])
    mins = _minutes(spark, [(7, 600.0), (7, 600.0)])     # 20 minutes over two games; player 8 missing
    out = rows(distance_per_entity(m, mins))
    # 5 m in 20 min -> 5 * 12 / 20 = 3.0 ; player 8 dropped (inner, H17)
    assert out == [(7, 3.0)]


def test_possession_spells_and_left_join(spark):
    data = []
    # player 1 holds the ball at 10.00, 9.96, then player 2 at 9.92, then player 1 again at 9.88
    for c, holder in [(10.00, 1), (9.96, 1), (9.92, 2), (9.88, 1)]:
        data.append((1, 1, 1, c, -1, 10.0, 10.0))
        for p in (1, 2):
            near = p == holder
            data.append((1, 1, 1, c, p, 10.0 + (0.1 if near else 3.0) + c / 100, 10.0))
    m = moments_df(spark, data)
    out = {r.player_id: r for r in possession_per_entity(m, _minutes(spark, [(1, 100.0)]), max_gap=0.05).collect()}
    assert math.isclose(out[1].time_ball_possession_s, 3 * 0.04)
    # steps only between possession rows of the same player within the gap: 10.00 -> 9.96 only
    assert math.isclose(out[1].total_distance_with_ball_possession_m, 0.04 / 100, rel_tol=1e-6)
    assert out[2].total_time_on_court_s is None and out[2].percentage_ball_possession is None
    assert out[1].percentage_ball_possession == round(0.12 / 100 * 100, 2)


EVENT_ROWS = [
    # game, eventnum, type, period, clock, margin, player
    (1, 1, 1, 4, "5:30", "2", 7),      # outside 300 s
    (1, 2, 2, 4, "4:59", None, 7),     # filled 2 -> clutch, missed
    (1, 3, 6, 4, "4:50", "12", 9),     # non-shot margin not seen by the fill (H3)
    (1, 4, 1, 4, "4:40", None, 7),     # still filled 2 -> clutch, made
    (1, 5, 1, 4, "4:30", "TIE", 7),    # text margin -> dropped (H5)
    (1, 6, 1, 3, "1:00", "1", 7),      # period 3
]


def _events(spark, rows_):
    full = [(g, n, t, p, clk, mg, pl, f"P{pl}", None, None) for g, n, t, p, clk, mg, pl in rows_]
    return spark.createDataFrame(full, schemas.EVENTS)


def test_clutch_filters(spark):
    shots = {r.event_id for r in clutch_shots(_events(spark, EVENT_ROWS)).collect()}
    assert shots == {2, 4}


def test_clutch_efficiency_and_shot_locations(spark):
    ev = _events(spark, EVENT_ROWS)
    data = []
    for e, (x, y) in {2: (2.0, 7.62), 4: (20.0, 7.62)}.items():
        # ball rises through 2 m at clock 299.0 (radius in metres)
        data += [(1, e, 4, 299.5, -1, 0, 0, 1.0), (1, e, 4, 299.0, -1, 0, 0, 2.2), (1, e, 4, 298.5, -1, 0, 0, 3.0)]
        data += [(1, e, 4, 299.04, 7, x, y), (1, e, 4, 290.0, 7, 0.0, 0.0)]
    m = moments_df(spark, data)
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        res = {r.player_id: r for r in clutch_efficiency(m, ev).collect()}
        r = res[7]
        # event 2 (missed) at x=2 -> 2pt; event 4 (made) at x=20 -> right basket 7.05 m -> 3pt
        assert (r["2pts_efficiency"], r.nb_2pts_shots, r["3pts_efficiency"], r.nb_3pts_shots) == (0.0, 1, 1.0, 1)
    locs = rows(shot_locations(m, ev, 7).select("event_type", "shot_type", "x_loc"))
    assert locs == [(1, "3pt", 20.0), (2, "2pt", 2.0)]


def test_one_shot_per_event_before_the_player_filter(spark):
    """Two shots of one event: the smaller player id is the event's shot, also when the other player is asked for."""
    ev = _events(spark, EVENT_ROWS)
    shots = clutch_shots(ev).filter("event_id = 2")
    two = shots.unionByName(shots.withColumn("player_id", F.lit(8).cast("long"))).unionByName(shots)
    m = moments_df(spark, [(1, 2, 4, 299.0, -1, 0, 0, 2.2), (1, 2, 4, 299.0, 7, 2.0, 7.0), (1, 2, 4, 299.0, 8, 5.0, 5.0)])
    assert rows(locate_shots(m, two).select("player_id", "x_loc")) == [(7, 2.0)]
    assert rows(locate_shots(m, two, player_id=7).select("player_id", "x_loc")) == [(7, 2.0)]
    assert locate_shots(m, two, player_id=8).count() == 0


def test_distance_unfiltered_crosses_quarters(spark):
    m = moments_df(spark, [(1, 1, 1, 1.0, 7, 0, 0), (1, 1, 2, 720.0, 7, 0, 10), (1, 1, 2, 700.0, 7, 0, 20)])
    r = distance_unfiltered(m, _minutes(spark, [(9, 60.0)])).collect()[0]
    assert math.isclose(r.total_distance_m, 20 * 0.3048) and r.distance_per_quarter_m is None and r.missing_minutes


def _write_csv(path, header, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_cli_end_to_end_with_mixed_case_headers(spark, tmp_path):
    d = tmp_path / "data"
    hdr = "GAME_ID,EVENT_ID,QUARTER,GAME_CLOCK,SHOT_CLOCK,TEAM_ID,PLAYER_ID,X_LOC,Y_LOC,RADIUS"
    _write_csv(str(d / "moments" / "g1.csv"), hdr, ["1,1,1,10.0,,1,7,0,0,1", "1,1,1,9.96,,1,7,10,0,1"])
    _write_csv(str(d / "moments" / "g2.csv"), hdr.lower(), ["2,1,1,10.0,20,1,7,0,0,1"])
    _write_csv(str(d / "minutes_played.csv"), "PLAYER_ID,SEC", ["7,720.0"])
    out = tmp_path / "out"
    path = cli.run(spark, " Distance ", str(d) + "/", str(out) + "/")
    assert path.endswith("distance_per_player.csv") and os.path.isfile(path)
    assert open(path).read().split() == ["7", str(round(10 * 0.3048 * 12 / 12, 2))]
    assert cli.main([]) == 0
    with pytest.raises(ValueError, match="curry"):
        cli.parse_task("speed")
    with pytest.raises(ValueError, match="player"):
        cli.run(spark, "curry", str(d), str(out))


def test_single_file_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "MIDDLE EAST"), (2, "ASIA")], "k int, name string")
    path = write_single_delimited(df.repartition(3), str(tmp_path), "r.txt", sep=" ", header=True)
    assert [p for p in os.listdir(tmp_path) if p.startswith("_tmp")] == []
    back = read_results(spark, path, schema=df.schema)
    assert rows(back) == rows(df)
    t = read_table(spark, path, df.schema, sep=" ")
    assert rows(t.select("k", "name")) == rows(df)


def test_registered_queries_match_oracle_small(spark):
    import __spark_entry__ as E
    from strideframe.plans.registry import QUERIES
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    qs, orc = QUERIES, E.oracle_sql()
    assert set(qs) <= set(orc) and set(qs) <= set(E.queries())
    bad = []
    for name, fn in qs.items():
        df = fn(spark, SF_SMALL)
        got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
        res = con.execute(orc[name])
        cols = [c[0] for c in res.description]
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        exp = sorted((tuple(r[i] for i in idx) for r in res.fetchall()), key=repr)
        if sorted(df.columns) != sorted(cols) or got != exp:
            bad.append(name)
    assert bad == []


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["player_id", "distance_per_quarter_m"] and df.count() > 0
    assert df.filter(F.col("distance_per_quarter_m").isNull()).count() == 0


def test_cli_sizes_from_input_bytes(spark, tmp_path):
    from strideframe.session import cluster_conf
    d = tmp_path / "data"
    _write_csv(str(d / "moments" / "g1.csv"), "GAME_ID,X", ["1,2"] * 100)
    n = cli.input_bytes(spark, str(d))
    assert n == os.path.getsize(d / "moments" / "g1.csv")
    conf = cluster_conf(300 << 30)
    assert conf["spark.sql.shuffle.partitions"] == str((300 << 30) // (256 << 20))


def test_distance_with_hot_player_and_copy_group(spark):
    """One player holds most rows, crossing time-bucket edges, and one of its
    keys is a group of 800 copies with different payloads: the result equals
    a pure-Python dedupe (smallest event id, x, y) plus gap-guarded steps."""
    import random
    rnd = random.Random(21)
    data = [(1, 1, 1, round(130.0 - 0.04 * i, 2), 7, rnd.uniform(0, 28), rnd.uniform(0, 15)) for i in range(2500)]
    data += [(1, rnd.randint(1, 50), 1, 50.0, 7, rnd.uniform(0, 28), rnd.uniform(0, 15)) for _ in range(800)]
    data += [(1, 1, 1, round(130.0 - 0.5 * i, 2), p, rnd.uniform(0, 28), rnd.uniform(0, 15))
             for p in (8, 9) for i in range(100)]
    rnd.shuffle(data)
    m = moments_df(spark, data).repartition(7)
    mins = _minutes(spark, [(7, 1440.0), (8, 720.0), (9, 720.0)])
    got = {r.player_id: r.distance_per_quarter_m for r in distance_per_entity(m, mins).collect()}

    keep = {}
    for g, e, q, c, p, x, y in data:
        k = (g, p, q, c)
        if k not in keep or (e, x, y) < keep[k][:3]:
            keep[k] = (e, x, y)
    seg = {}
    for (g, p, q, c), (_, x, y) in keep.items():
        seg.setdefault((g, p, q), []).append((c, x, y))
    tot = {}
    for (g, p, q), pts in seg.items():
        pts.sort(key=lambda t: -t[0])
        tot[p] = tot.get(p, 0.0) + sum(math.hypot(a[1] - b[1], a[2] - b[2])
                                       for a, b in zip(pts, pts[1:]) if a[0] - b[0] <= 0.5)
    sec = {7: 1440.0, 8: 720.0, 9: 720.0}
    assert set(got) == set(tot)
    for p in tot:
        assert math.isclose(got[p], tot[p] * 12 / (sec[p] / 60), abs_tol=0.0051)


def test_event_path_length_copies_and_hot_user(spark):
    """A hot user with a 400-row group of exact copies and a burst; small
    equi-depth buckets.  Equals a plain sort-and-step over the raw rows."""
    import datetime as dt
    import random
    from strideframe.plans.quality import event_path_length
    rnd = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    rows_ = []
    for i in range(1500):
        u = 0 if rnd.random() < 0.6 else rnd.randint(1, 4)
        rows_.append((u, i, base + dt.timedelta(minutes=rnd.randint(0, 3000)), float(rnd.randint(0, 9))))
    rows_ += [(0, 99999, base + dt.timedelta(minutes=77), 5.0)] * 400
    df = spark.createDataFrame(rows_, "user_id long, event_id long, ts timestamp, value double").repartition(5)
    gap = 6 * 3600 * 1_000_000
    got = {r.user_id: (round(r.path_length, 9), r.n_steps, r.n_events)
           for r in event_path_length(df, gap).collect()}
    exp = {}
    for u in {r[0] for r in rows_}:
        ev = sorted((r for r in rows_ if r[0] == u), key=lambda r: (r[2], r[1]))
        path, steps = 0.0, 0
        for a, b in zip(ev, ev[1:]):
            if (b[2] - a[2]).total_seconds() * 1_000_000 <= gap:
                path += abs(b[3] - a[3])
                steps += 1
        exp[u] = (round(path, 9), steps, len(ev))
    assert got == exp


def test_margin_fill_keeps_copies(spark):
    """A 200-row group of exact copies: every copy is kept and gets the fill a
    plain window over the raw rows gives."""
    from pyspark.sql import Window
    from strideframe.plans.clutch import expand_copies, fill_margins
    cols = ("game_id long, eventnum long, eventmsgtype int, period int, pctimestring string, scoremargin string, "
            "player1_id long, player1_name string, homedescription string, visitordescription string")
    base = [(1, 1, 1, 4, "5:00", "3", 7, "a", None, None), (1, 2, 2, 4, "4:30", None, 7, "a", None, None),
            (1, 3, 1, 4, "4:00", "TIE", 8, "b", None, None), (1, 4, 2, 4, "3:59", None, 8, "b", None, None),
            (2, 1, 2, 1, "11:00", None, 9, "c", None, None)]
    data = base + [base[1]] * 200 + [base[3]] * 3
    ev = spark.createDataFrame(data, cols).repartition(4)
    got = expand_copies(fill_margins(ev))
    assert got.count() == len(data)
    plan = fill_margins(ev)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange[^\n]*description|Join", plan) and "description" not in " ".join(got.columns)
    w = (Window.partitionBy("game_id").orderBy("period", F.col("game_clock_seconds").desc(), "eventnum")
               .rowsBetween(Window.unboundedPreceding, 0))
    plain = (ev.withColumn("game_clock_seconds", F.split("pctimestring", ":")[0].cast("int") * 60
                           + F.split("pctimestring", ":")[1].cast("int"))
               .withColumn("margin_filled", F.last("scoremargin", ignorenulls=True).over(w)))
    key = ["game_id", "eventnum", "margin_filled"]
    assert rows(got.select(*key)) == rows(plain.select(*key))


def test_event_path_length_ignores_session_time_zone(spark):
    """Wall-clock (timestamp_ntz) events across a daylight-saving change: the
    result is the same in any session time zone."""
    from strideframe.plans.quality import event_path_length
    df = spark.createDataFrame([(1, 1, "2024-03-10 01:30:00", 1.0), (1, 2, "2024-03-10 03:10:00", 4.0),
                                (1, 3, "2024-03-10 04:40:00", 6.0)],
                               "user_id long, event_id long, ts string, value double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    gap = 90 * 60 * 1_000_000
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        res = []
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            res.append([tuple(r) for r in event_path_length(df, gap).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    # 01:30 -> 03:10 is 100 wall-clock minutes (over the gap; 40 real minutes
    # in Los Angeles that night), 03:10 -> 04:40 is 90 (within)
    assert res[0] == res[1] == [(1, 2.0, 1, 3)]


def test_csv_glob_aligns_drifting_headers_by_name(spark, tmp_path):
    """Files of one glob whose headers differ in case, order and columns are
    stacked by name (missing -> null), never read by position."""
    from pyspark.sql import types as T
    sch = T.StructType([T.StructField("game_id", T.LongType()), T.StructField("x_loc", T.DoubleType())])
    _write_csv(str(tmp_path / "m" / "a.csv"), "GAME_ID,X_LOC", ["1,2.5"])
    _write_csv(str(tmp_path / "m" / "b.csv"), "game_id,x_loc", ["3,4.5"])
    _write_csv(str(tmp_path / "m" / "c.csv"), "x_loc,game_id", ["6.5,5"])
    _write_csv(str(tmp_path / "m" / "d.csv"), "game_id,extra", ["7,z"])
    got = read_table(spark, str(tmp_path / "m" / "*.csv"), sch)
    assert rows(got.select("game_id", "x_loc")) == [(1, 2.5), (3, 4.5), (5, 6.5), (7, None)]
    assert "extra" in got.columns
