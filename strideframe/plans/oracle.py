"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: plain windows (``row_number``,
``lead``, ``last_value IGNORE NULLS``) over the adapter views, no buckets.
Doubles that come from sums are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from strideframe.sources.adapters import with_views

MAX_GAP = 5
RADIUS = 5.0

# players deduped on the moment key with the tie-break order of the Spark side
DEDUPED_PLAYERS = """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY game_id, player_id, quarter, game_clock
                               ORDER BY event_id NULLS FIRST, x_loc NULLS FIRST,
                                        y_loc NULLS FIRST, radius NULLS FIRST) AS rn_
  FROM {src} WHERE player_id <> -1) WHERE rn_ = 1
"""


def _dedup(src: str, role: str = "player_id <> -1") -> str:
    return DEDUPED_PLAYERS.format(src=src).replace("player_id <> -1", role)


ORACLES: dict[str, str] = {}

ORACLES["distance_per_entity"] = with_views(f"""
, d AS ({_dedup('moments')}),
s AS (
  SELECT player_id,
         CASE WHEN lead(x_loc) OVER w IS NOT NULL
                   AND game_clock - lead(game_clock) OVER w <= {MAX_GAP}
              THEN sqrt(pow(x_loc - lead(x_loc) OVER w, 2) + pow(y_loc - lead(y_loc) OVER w, 2))
              ELSE 0 END AS dist_m
  FROM d WINDOW w AS (PARTITION BY game_id, player_id, quarter ORDER BY game_clock DESC)),
t AS (SELECT player_id, sum(dist_m) AS total_distance_m FROM s GROUP BY player_id),
m AS (SELECT player_id, sum(sec) / 60 AS total_minutes FROM minutes_played GROUP BY player_id)
SELECT t.player_id, round(t.total_distance_m * 12 / m.total_minutes, 2) AS distance_per_quarter_m
FROM t JOIN m ON t.player_id = m.player_id
""")

ALL_DEDUPED = """
SELECT game_id, event_id, quarter, game_clock, shot_clock, team_id, player_id, x_loc, y_loc, radius FROM (
  SELECT *, row_number() OVER (PARTITION BY game_id, player_id, quarter, game_clock
                               ORDER BY event_id NULLS FIRST, x_loc NULLS FIRST, y_loc NULLS FIRST,
                                        radius NULLS FIRST, shot_clock NULLS FIRST, team_id NULLS FIRST) AS rn_
  FROM moments) WHERE rn_ = 1
"""

ORACLES["dedupe_first"] = with_views(f"SELECT * FROM ({ALL_DEDUPED}) x")

EXCLUSIVE = f"""
, d AS ({ALL_DEDUPED}),
b AS (SELECT game_id, quarter, game_clock, x_loc AS ball_x, y_loc AS ball_y FROM d WHERE player_id = -1),
j AS (SELECT p.*, b.ball_x, b.ball_y FROM d p JOIN b ON p.game_id = b.game_id AND p.quarter = b.quarter
      AND p.game_clock = b.game_clock WHERE p.player_id <> -1),
n AS (SELECT *, CASE WHEN sqrt(pow(x_loc - ball_x, 2) + pow(y_loc - ball_y, 2)) <= {RADIUS} THEN 1 ELSE 0 END AS near
      FROM j),
e AS (SELECT game_id, quarter, game_clock, player_id, team_id, x_loc, y_loc FROM (
        SELECT *, sum(near) OVER (PARTITION BY game_id, quarter, game_clock) AS cnt FROM n)
      WHERE near = 1 AND cnt = 1)
"""

ORACLES["exclusive_near_rows"] = with_views(EXCLUSIVE + "SELECT * FROM e")

ORACLES["possession_per_entity"] = with_views(EXCLUSIVE + f"""
, s AS (
  SELECT player_id,
         CASE WHEN lead(x_loc) OVER w IS NOT NULL AND game_clock - lead(game_clock) OVER w <= {MAX_GAP}
              THEN sqrt(pow(x_loc - lead(x_loc) OVER w, 2) + pow(y_loc - lead(y_loc) OVER w, 2))
              ELSE 0 END AS dist_m
  FROM e WINDOW w AS (PARTITION BY game_id, player_id, quarter ORDER BY game_clock DESC)),
st AS (SELECT player_id, sum(dist_m) AS td, count(*) * CAST(0.04 AS DOUBLE) AS tp FROM s GROUP BY player_id),
m AS (SELECT player_id, sum(sec) AS tc FROM minutes_played GROUP BY player_id)
SELECT st.player_id, round(td, 6) AS total_distance_with_ball_possession_m,
       round(tp, 6) AS time_ball_possession_s, round(m.tc, 6) AS total_time_on_court_s,
       round(tp / m.tc * 100, 2) AS percentage_ball_possession
FROM st LEFT JOIN m ON st.player_id = m.player_id
""")


def half_up(expr: str, digits: int) -> str:
    """Spark's round(double, d): HALF_UP on the shortest decimal form."""
    return (f"CAST(round(CAST(CAST(CAST(({expr}) AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits})"
            f" AS DOUBLE)")


def dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


from strideframe.functions import scalar as S  # noqa: E402

SHOT_PLAYER = 3

CLOCK_SECONDS = ("CAST(split_part(pctimestring, ':', 1) AS INTEGER) * 60 + "
                 "CAST(split_part(pctimestring, ':', 2) AS INTEGER)")

FILLED = f"""
, ev AS (SELECT *, {CLOCK_SECONDS} AS game_clock_seconds FROM events_pbp WHERE eventmsgtype IN (1, 2)),
f AS (SELECT *, last_value(scoremargin IGNORE NULLS) OVER (
        PARTITION BY game_id ORDER BY period ASC, game_clock_seconds DESC, eventnum ASC
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS margin_filled FROM ev)
"""

ORACLES["margin_forward_fill"] = with_views(FILLED + """
SELECT game_id, eventnum, period, game_clock_seconds, scoremargin, margin_filled FROM f
""")

CROSSING = """
SELECT DISTINCT game_id, event_id, quarter, crossing_clock, max_height, max_height_clock,
       coalesce(crossing_clock, max_height_clock) AS shot_game_clock {extra}
FROM (SELECT *, max(CASE WHEN radius = max_height THEN game_clock END) OVER w AS max_height_clock
      FROM (SELECT *, max(CASE WHEN radius >= 2.0 THEN game_clock END) OVER w AS crossing_clock,
                      max(radius) OVER w AS max_height
            FROM {src} WINDOW w AS (PARTITION BY game_id, event_id, quarter {wx})) a
      WINDOW w AS (PARTITION BY game_id, event_id, quarter {wx})) b
"""

ORACLES["first_crossing_or_peak"] = with_views(
    "SELECT * FROM (" + CROSSING.format(extra="", wx="", src="(SELECT * FROM moments WHERE player_id = -1)")
    + ") c")

LOCATED = FILLED + f"""
, shots AS (
  SELECT game_id, eventnum AS event_id, period AS quarter, player1_id AS player_id,
         eventmsgtype AS event_type, game_clock_seconds
  FROM f WHERE margin_filled IS NOT NULL AND period >= 4 AND game_clock_seconds <= 300
         AND abs(TRY_CAST(margin_filled AS INTEGER)) <= 5
  QUALIFY row_number() OVER (PARTITION BY game_id, event_id, quarter
                             ORDER BY player_id NULLS FIRST, event_type, game_clock_seconds) = 1),
bm AS (SELECT m.game_id, m.event_id, m.quarter, m.game_clock, m.radius,
              s.player_id, s.event_type, s.game_clock_seconds
       FROM moments m JOIN shots s ON m.game_id = s.game_id AND m.event_id = s.event_id
            AND m.quarter = s.quarter WHERE m.player_id = -1),
inst AS ({CROSSING.format(extra=", player_id, event_type, game_clock_seconds",
                          wx=", player_id, event_type, game_clock_seconds", src="bm")}),
pm AS (SELECT game_id, event_id, player_id, quarter, game_clock AS m_game_clock, x_loc, y_loc
       FROM moments WHERE player_id <> -1),
jn AS (SELECT i.game_id, i.event_id, i.player_id, i.quarter, i.event_type, i.game_clock_seconds,
              i.shot_game_clock AS tracking_game_clock, pm.m_game_clock, pm.x_loc, pm.y_loc,
              row_number() OVER (PARTITION BY i.game_id, i.event_id, i.player_id, i.quarter,
                                              i.event_type, i.game_clock_seconds
                                 ORDER BY abs(pm.m_game_clock - i.shot_game_clock), pm.m_game_clock DESC,
                                          pm.x_loc, pm.y_loc) AS rn
       FROM inst i JOIN pm ON i.game_id = pm.game_id AND i.event_id = pm.event_id
            AND i.player_id = pm.player_id AND i.quarter = pm.quarter),
loc AS (SELECT * EXCLUDE (rn) FROM jn WHERE rn = 1),
typed AS (
  SELECT *, CASE WHEN dist_to_basket <= {S.THREE_POINT_RADIUS_M} THEN '2pt' ELSE '3pt' END AS shot_type
  FROM (SELECT *, sqrt(pow(x_loc - CASE WHEN x_loc < {dbl(S.HALF_COURT_M)} THEN {dbl(S.LEFT_BASKET_X_M)}
                                        ELSE {dbl(S.RIGHT_BASKET_X_M)} END, 2)
                       + pow(y_loc - {dbl(S.BASKET_Y_M)}, 2)) AS dist_to_basket FROM loc) l)
"""

ORACLES["nearest_match"] = with_views(LOCATED + "SELECT * FROM loc")

ORACLES["shot_locations"] = with_views(LOCATED + f"""
SELECT player_id, event_type, shot_type, x_loc, y_loc, dist_to_basket, game_clock_seconds, game_id
FROM typed WHERE player_id = {SHOT_PLAYER}
""")

ORACLES["clutch_efficiency"] = with_views(LOCATED + f"""
, agg AS (SELECT player_id, shot_type, count(*) AS n, sum(CASE WHEN event_type = 1 THEN 1 ELSE 0 END) AS made
          FROM typed GROUP BY player_id, shot_type),
pv AS (SELECT player_id,
              coalesce(sum(n) FILTER (WHERE shot_type = '2pt'), 0) AS s2,
              coalesce(sum(made) FILTER (WHERE shot_type = '2pt'), 0) AS m2,
              coalesce(sum(n) FILTER (WHERE shot_type = '3pt'), 0) AS s3,
              coalesce(sum(made) FILTER (WHERE shot_type = '3pt'), 0) AS m3
       FROM agg GROUP BY player_id)
SELECT player_id,
       CASE WHEN s2 = 0 THEN 0.0 ELSE {half_up('m2 / s2', 2)} END AS "2pts_efficiency",
       CAST(s2 AS BIGINT) AS nb_2pts_shots,
       CASE WHEN s3 = 0 THEN 0.0 ELSE {half_up('m3 / s3', 2)} END AS "3pts_efficiency",
       CAST(s3 AS BIGINT) AS nb_3pts_shots
FROM pv
""")


# ------------------------------------------------------------------ quality

def _dedup_all(src: str) -> str:
    return f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY game_id, player_id, quarter, game_clock
                               ORDER BY event_id NULLS FIRST, x_loc NULLS FIRST, y_loc NULLS FIRST,
                                        radius NULLS FIRST) AS rn_
  FROM {src}) WHERE rn_ = 1"""


ORACLES["distance_unfiltered"] = with_views(f"""
, d AS (SELECT * FROM ({_dedup_all('moments_feet')}) WHERE player_id <> -1),
s AS (SELECT player_id,
             sqrt(pow(x_loc - lead(x_loc) OVER w, 2) + pow(y_loc - lead(y_loc) OVER w, 2)) * 0.3048 AS dist_m
      FROM d WINDOW w AS (PARTITION BY game_id, player_id ORDER BY quarter ASC, game_clock DESC)),
t AS (SELECT player_id, sum(dist_m) AS total_distance_m FROM s GROUP BY player_id),
m AS (SELECT player_id, sum(sec) AS tsp FROM minutes_played GROUP BY player_id)
SELECT t.player_id, round(t.total_distance_m, 6) AS total_distance_m,
       CAST(round_even(t.total_distance_m * 12 / (m.tsp / 60), 0) AS BIGINT) AS distance_per_quarter_m,
       m.tsp IS NULL AS missing_minutes
FROM t LEFT JOIN m ON t.player_id = m.player_id
""")

PROFILE_TABLES = {
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
}


def _profile_sql() -> str:
    parts = []
    for table, cols in PROFILE_TABLES.items():
        for i, (c, t) in enumerate(cols):
            parts.append(f"""
SELECT '{table}' AS table_name, '{c}' AS "column", CAST({i} AS INTEGER) AS ordinal, '{t}' AS dtype,
       count(*) AS "rows", count({c}) AS non_null, count(*) - count({c}) AS nulls,
       {half_up(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100', 1)} AS null_pct,
       count(DISTINCT {c}) AS nunique, CAST(min({c}) AS VARCHAR) AS sample
FROM {table}""")
    return "\nUNION ALL".join(parts)


ORACLES["table_profile"] = _profile_sql()

ORACLES["moment_completeness"] = with_views("""
SELECT 'raw' AS stage, rows_per_ts, count(*) AS n_moments
FROM (SELECT count(*) AS rows_per_ts FROM moments GROUP BY game_id, quarter, game_clock) a GROUP BY rows_per_ts
UNION ALL
SELECT 'deduped' AS stage, rows_per_ts, count(*) AS n_moments
FROM (SELECT count(*) AS rows_per_ts
      FROM (SELECT DISTINCT game_id, player_id, quarter, game_clock FROM moments) u
      GROUP BY game_id, quarter, game_clock) b GROUP BY rows_per_ts
""")

ORACLES["bounds_check"] = with_views("""
SELECT CASE WHEN player_id = -1 THEN 'ball' ELSE 'players' END AS role, count(*) AS n_rows,
       min(x_loc) AS x_min, max(x_loc) AS x_max, count(*) FILTER (WHERE x_loc < 0 OR x_loc > 94) AS x_out,
       min(y_loc) AS y_min, max(y_loc) AS y_max, count(*) FILTER (WHERE y_loc < 0 OR y_loc > 50) AS y_out
FROM moments_feet GROUP BY 1
""")

ORACLES["clock_check"] = with_views(f"""
SELECT count(*) AS n_rows, min(game_clock) AS clock_min, max(game_clock) AS clock_max,
       count(*) FILTER (WHERE game_clock < 0) AS clock_below, count(*) FILTER (WHERE game_clock > 720) AS clock_above,
       count(*) FILTER (WHERE shot_clock IS NULL) AS shot_nulls,
       {half_up('avg(CASE WHEN shot_clock IS NULL THEN 1.0 ELSE 0.0 END) * 100', 1)} AS shot_null_pct,
       min(shot_clock) AS shot_min, max(shot_clock) AS shot_max,
       count(*) FILTER (WHERE shot_clock < 0) AS shot_below, count(*) FILTER (WHERE shot_clock > 24) AS shot_above,
       count(DISTINCT quarter) AS n_quarters, count(*) FILTER (WHERE quarter > 4) AS overtime_rows
FROM moments_feet
""")

ORACLES["quarter_values"] = with_views("SELECT DISTINCT quarter FROM moments WHERE quarter IS NOT NULL")

JUMPS = f"""
, d AS (SELECT * FROM ({_dedup_all('moments_feet')}) WHERE player_id <> -1),
j AS (SELECT sqrt(pow(x_loc - lead(x_loc) OVER w, 2) + pow(y_loc - lead(y_loc) OVER w, 2)) AS jump_ft
      FROM d WINDOW w AS (PARTITION BY game_id, player_id ORDER BY quarter ASC, game_clock DESC)),
jj AS (SELECT jump_ft FROM j WHERE jump_ft IS NOT NULL)
"""

ORACLES["jump_report"] = with_views(JUMPS + """
SELECT count(*) AS n_jumps, round(avg(jump_ft), 6) AS mean, round(quantile_cont(jump_ft, 0.5), 6) AS median,
       round(quantile_cont(jump_ft, 0.95), 6) AS p95, round(max(jump_ft), 6) AS max,
       count(*) FILTER (WHERE jump_ft > 10) AS n_over_big, count(*) FILTER (WHERE jump_ft > 50) AS n_over_huge,
""" + half_up("CAST(count(*) FILTER (WHERE jump_ft > 10) AS DOUBLE) * 100 / count(*)", 2) + """ AS pct_over_big
FROM jj
""")


def _hist_sql(values_cte: str, bins: int) -> str:
    return f"""{values_cte}
, mm0 AS (SELECT min(v) AS lo0, max(v) AS hi0 FROM vals),
mm AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
              CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM mm0),
b AS (SELECT LEAST(CAST(floor((v - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) AS bin FROM vals, mm),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin),
r AS (SELECT range AS bin FROM range({bins}))
SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * ((hi - lo) / {bins}), 6) AS bin_lo,
       round(lo + (r.bin + 1) * ((hi - lo) / {bins}), 6) AS bin_hi, coalesce(c.cnt, 0) AS "count"
FROM r CROSS JOIN mm LEFT JOIN c ON r.bin = c.bin
"""


ORACLES["jump_histogram"] = with_views(_hist_sql(JUMPS + ", vals AS (SELECT least(jump_ft, 20.0) AS v FROM jj)", 100))

GAPS = """
, g AS (SELECT game_clock - lead(game_clock) OVER (PARTITION BY game_id, player_id, quarter
                                                    ORDER BY game_clock DESC) AS gap
        FROM moments WHERE player_id <> -1),
gg AS (SELECT gap FROM g WHERE gap IS NOT NULL)
"""

GAP_CUTS = [("le_0_04", "<=", 0.04), ("le_0_05", "<=", 0.05), ("le_0_10", "<=", 0.10),
            ("le_0_50", "<=", 0.50), ("gt_0_50", ">", 0.50), ("gt_1_00", ">", 1.00)]

ORACLES["gap_report"] = with_views(GAPS + "SELECT min(gap) AS gap_min, round(avg(gap), 6) AS gap_mean, "
                                   "max(gap) AS gap_max, count(*) AS n_values, " + ", ".join(
    f"count(*) FILTER (WHERE gap {op} {dbl(v)}) AS n_{n}, "
    f"count(*) FILTER (WHERE gap {op} {dbl(v)}) / count(*) AS share_{n}" for n, op, v in GAP_CUTS)
    + " FROM gg")

ORACLES["gap_quantiles"] = with_views(GAPS + """
SELECT p, round(gap, 6) AS gap FROM (
  SELECT unnest(CAST([0.5, 0.9, 0.95, 0.99, 0.999] AS DOUBLE[])) AS p,
         unnest(quantile_cont(gap, [0.5, 0.9, 0.95, 0.99, 0.999])) AS gap FROM gg) q
""")

ORACLES["text_shots_located"] = with_views(f"""
, ts AS (
  SELECT game_id, eventnum, player1_id AS player_id, player1_name, period AS quarter,
         CAST(TRY_CAST(split_part(trim(pctimestring), ':', 1) AS INTEGER) * 60
              + TRY_CAST(split_part(trim(pctimestring), ':', 2) AS INTEGER) AS DOUBLE) AS game_clock_approx,
         eventmsgtype = 1 AS made, row_number() OVER () AS copy
  FROM events_pbp
  WHERE eventmsgtype IN (1, 2) AND (coalesce(contains(homedescription, '3PT'), false)
                                    OR coalesce(contains(visitordescription, '3PT'), false))),
c AS (
  SELECT t.*, m.game_clock, m.x_loc, m.y_loc,
         row_number() OVER (PARTITION BY t.copy
                            ORDER BY abs(m.game_clock - t.game_clock_approx), m.game_clock DESC,
                                     m.x_loc, m.y_loc) AS rn
  FROM ts t JOIN moments m ON m.game_id = t.game_id AND m.player_id = t.player_id AND m.quarter = t.quarter
       AND abs(m.game_clock - t.game_clock_approx) <= 1.0
  WHERE t.game_clock_approx IS NOT NULL AND m.player_id <> -1)
SELECT game_id, eventnum, player_id, player1_name, quarter, game_clock_approx, made, game_clock, x_loc, y_loc,
       dist_nearest_basket, dist_nearest_basket > {S.THREE_POINT_RADIUS_M} AS outside_arc
FROM (SELECT *, least(sqrt(pow(x_loc - {dbl(S.LEFT_BASKET_X_M)}, 2) + pow(y_loc - {dbl(S.BASKET_Y_M)}, 2)),
                      sqrt(pow(x_loc - {dbl(S.RIGHT_BASKET_X_M)}, 2) + pow(y_loc - {dbl(S.BASKET_Y_M)}, 2)))
                AS dist_nearest_basket FROM c WHERE rn = 1) z
""")

ORACLES["height_coverage"] = with_views(f"""
, ball AS (SELECT * FROM moments WHERE player_id = -1),
se AS (SELECT DISTINCT game_id, eventnum AS event_id FROM events_pbp WHERE eventmsgtype IN (1, 2)),
me AS (SELECT DISTINCT game_id, eventnum AS event_id FROM events_pbp WHERE eventmsgtype = 1),
ins AS (SELECT b.* FROM ball b WHERE EXISTS (SELECT 1 FROM se WHERE se.game_id = b.game_id
                                                                AND se.event_id = b.event_id)),
mb AS (SELECT b.game_id, b.event_id, max(CASE WHEN radius >= 2.0 THEN 1 ELSE 0 END) AS hi
       FROM ball b JOIN me ON b.game_id = me.game_id AND b.event_id = me.event_id GROUP BY 1, 2),
x AS (SELECT (SELECT count(*) FROM ball) AS ball_rows,
             (SELECT count(*) FROM ins) AS ball_rows_in_shots,
             (SELECT count(*) FROM ins WHERE radius >= 2.0) AS ball_rows_high,
             (SELECT count(*) FROM me) AS made_events,
             (SELECT count(*) FROM mb) AS made_with_ball,
             (SELECT count(*) FROM me WHERE NOT EXISTS (SELECT 1 FROM ball b WHERE b.game_id = me.game_id
                                                                           AND b.event_id = me.event_id))
                 AS made_without_ball,
             (SELECT CAST(coalesce(sum(hi), 0) AS BIGINT) FROM mb) AS made_high)
SELECT *, {half_up('CAST(ball_rows_high AS DOUBLE) * 100 / ball_rows_in_shots', 1)} AS pct_high,
       made_with_ball - made_high AS made_not_high,
       {half_up('CAST(made_high AS DOUBLE) * 100 / made_events', 1)} AS coverage_pct
FROM x
""")

ORACLES["low_ball_rows"] = with_views("""
SELECT x_loc, y_loc, radius, game_clock, quarter, game_id, event_id FROM moments_feet
WHERE player_id = -1 AND radius < 0.5
ORDER BY radius, game_id, quarter, game_clock DESC, event_id, x_loc, y_loc LIMIT 20
""")

_POSSESSION_Q = ORACLES["possession_per_entity"]

ORACLES["rate_histogram"] = _hist_sql(
    f"WITH vals AS (SELECT percentage_ball_possession / 100 AS v FROM ({_POSSESSION_Q}) q "
    f"WHERE percentage_ball_possession IS NOT NULL)", 15)

ORACLES["possession_summary"] = f"""
WITH vals AS (SELECT percentage_ball_possession / 100 AS v FROM ({_POSSESSION_Q}) q)
SELECT 'possession_fraction' AS "column", count(v) AS "count", round(avg(v), 6) AS mean,
       round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS p25,
       round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, round(max(v), 6) AS max
FROM vals
"""

ORACLES["shot_chart_points"] = with_views(LOCATED + f"""
, pts AS (SELECT player_id, game_id, event_type, shot_type, game_clock_seconds,
                 x_loc / 0.3048 AS x_ft, y_loc / 0.3048 AS y_ft
          FROM typed WHERE player_id = {SHOT_PLAYER}),
lab AS (SELECT *, CASE WHEN x_ft < 47.0 THEN 94.0 - x_ft ELSE x_ft END AS x_plot,
               CASE WHEN x_ft < 47.0 THEN 50.0 - y_ft ELSE y_ft END AS y_plot,
               CASE WHEN event_type = 1 THEN 'made' WHEN event_type = 2 THEN 'missed' ELSE 'other' END AS outcome
        FROM pts)
SELECT outcome, player_id, game_id, event_type, shot_type, game_clock_seconds,
       round(x_ft, 6) AS x_ft, round(y_ft, 6) AS y_ft, round(x_plot, 6) AS x_plot, round(y_plot, 6) AS y_plot,
       count(*) OVER (PARTITION BY outcome) AS n_outcome
FROM lab
""")

EMBED_COEF = [(i % 7 - 3) / 10 for i in range(64)]
_terms = " + ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) * {dbl(c)}" for i, c in enumerate(EMBED_COEF))
ORACLES["linear_score_array"] = f"""
SELECT vec_id, label, round(CASE WHEN len(embedding) = 64 THEN (0.0 + {_terms}) + 0.5 END, 6) AS score
FROM embeddings
"""

ORACLES["linear_score_columns"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       round(0.0 + l_quantity * {dbl(0.5)} + l_extendedprice * {dbl(0.001)} + l_discount * {dbl(-20.0)}
             + l_tax * {dbl(10.0)} + 1.0, 6) AS score
FROM lineitem
"""

ORACLES["pivot_success_rates"] = f"""
SELECT o_orderpriority,
       CASE WHEN ns = 0 THEN 0.0 ELSE {half_up('ms / ns', 2)} END AS small_rate, ns AS nb_small, ms AS nb_small_made,
       CASE WHEN nl = 0 THEN 0.0 ELSE {half_up('ml / nl', 2)} END AS large_rate, nl AS nb_large, ml AS nb_large_made
FROM (SELECT o_orderpriority,
             count(*) FILTER (WHERE o_totalprice < 100000) AS ns,
             count(*) FILTER (WHERE o_totalprice < 100000 AND o_orderstatus = 'F') AS ms,
             count(*) FILTER (WHERE o_totalprice >= 100000) AS nl,
             count(*) FILTER (WHERE o_totalprice >= 100000 AND o_orderstatus = 'F') AS ml
      FROM orders GROUP BY o_orderpriority) a
"""

ORACLES["top_k_per_group"] = """
SELECT user_id, event_id, ts, event_type, value, CAST(rn AS INTEGER) AS rn FROM (
  SELECT user_id, event_id, ts, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) e
WHERE rn <= 3
"""

ORACLES["value_counts"] = 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type'

ORACLES["threshold_counts"] = "SELECT count(l_quantity) AS n_values, " + ", ".join(
    f"count(*) FILTER (WHERE l_quantity {op} {dbl(v)}) AS n_{n}, "
    f"count(*) FILTER (WHERE l_quantity {op} {dbl(v)}) / count(l_quantity) AS share_{n}"
    for n, op, v in [("le_10", "<=", 10.0), ("le_25", "<=", 25.0), ("gt_40", ">", 40.0), ("gt_49", ">", 49.0)]
) + " FROM lineitem"

ORACLES["event_path_length"] = """
WITH e AS (
  SELECT user_id, value, epoch_us(ts) AS t, lead(value) OVER w AS nv, lead(epoch_us(ts)) OVER w AS nt
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id,
       round(sum(CASE WHEN nt IS NOT NULL AND nt - t <= 21600000000 THEN abs(nv - value) ELSE 0.0 END), 6)
           AS path_length,
       count(*) FILTER (WHERE nt IS NOT NULL AND nt - t <= 21600000000) AS n_steps,
       count(*) AS n_events
FROM e GROUP BY user_id
"""

ORACLES["delimited_round_trip"] = "SELECT r_regionkey, r_name FROM region"

ORACLES["nearest_match_tolerance"] = with_views(f"""
, ts AS (
  SELECT game_id, eventnum, player1_id AS player_id, period AS quarter,
         CAST(TRY_CAST(split_part(trim(pctimestring), ':', 1) AS INTEGER) * 60
              + TRY_CAST(split_part(trim(pctimestring), ':', 2) AS INTEGER) AS DOUBLE) AS event_clock,
         row_number() OVER () AS copy
  FROM events_pbp WHERE eventmsgtype IN (1, 2)),
c AS (
  SELECT t.*, m.game_clock, abs(m.game_clock - t.event_clock) AS clock_diff, m.x_loc, m.y_loc,
         row_number() OVER (PARTITION BY t.copy
                            ORDER BY abs(m.game_clock - t.event_clock), m.game_clock DESC, m.x_loc, m.y_loc) AS rn
  FROM ts t JOIN moments m ON m.game_id = t.game_id AND m.player_id = t.player_id AND m.quarter = t.quarter
       AND abs(m.game_clock - t.event_clock) <= 1.0
  WHERE m.player_id <> -1)
SELECT game_id, eventnum, player_id, quarter, event_clock, game_clock, clock_diff, x_loc, y_loc FROM c WHERE rn = 1
""")

ORACLES["duplicate_keys"] = with_views("""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n) - count(*) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS n FROM moments GROUP BY game_id, player_id, quarter, game_clock) a
""")

ORACLES["ball_rows_in_shots"] = with_views("""
SELECT m.game_id, m.event_id, m.quarter, m.game_clock, m.radius
FROM moments m
WHERE m.player_id = -1
  AND EXISTS (SELECT 1 FROM events_pbp e
              WHERE e.eventmsgtype IN (1, 2) AND e.game_id = m.game_id AND e.eventnum = m.event_id)
""")

ORACLES["untracked_made_events"] = with_views("""
SELECT DISTINCT e.game_id, e.eventnum AS event_id
FROM events_pbp e
WHERE e.eventmsgtype = 1
  AND NOT EXISTS (SELECT 1 FROM moments m
                  WHERE m.player_id = -1 AND m.game_id = e.game_id AND m.event_id = e.eventnum)
""")


def _profile_columns(tables: dict[str, list[tuple[str, str]]]) -> str:
    return "\nUNION ALL".join(f"""
SELECT '{view}' AS table_name, '{c}' AS "column", CAST({i} AS INTEGER) AS ordinal, '{t}' AS dtype,
       count(*) AS "rows", count({c}) AS non_null, count(*) - count({c}) AS nulls,
       {half_up(f'CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100', 1)} AS null_pct,
       count(DISTINCT {c}) AS nunique
FROM {source}""" for (view, source), cols in tables.items() for i, (c, t) in enumerate(cols))


ORACLES["tracking_profile"] = with_views(_profile_columns({
    ("moments", "moments_feet"): [
        ("game_id", "bigint"), ("event_id", "bigint"), ("quarter", "int"), ("game_clock", "double"), ("shot_clock", "double"),
        ("team_id", "bigint"), ("player_id", "bigint"), ("x_loc", "double"), ("y_loc", "double"), ("radius", "double")],
    ("events", "events_pbp"): [
        ("game_id", "bigint"), ("eventnum", "bigint"), ("eventmsgtype", "int"), ("period", "int"), ("pctimestring", "string"),
        ("scoremargin", "string"), ("player1_id", "bigint"), ("player1_name", "string"), ("homedescription", "string"),
        ("visitordescription", "string")],
    ("minutes_played", "minutes_played"): [("player_id", "bigint"), ("sec", "double")]}))

ORACLES["complete_moments"] = f"""
SELECT stage, CAST(sum(n_moments) AS BIGINT) AS n_moments, CAST(sum(n) AS BIGINT) AS n_complete,
       {half_up('CAST(sum(n) AS DOUBLE) * 100 / sum(n_moments)', 1)} AS pct_complete
FROM (SELECT *, CASE WHEN rows_per_ts = 2 THEN n_moments ELSE 0 END AS n FROM ({ORACLES["moment_completeness"]}) m) x
GROUP BY stage
"""


def _describe_sql(source: str, cols: list[str], by: list[str]) -> str:
    group = "".join(f"{c}, " for c in by)
    return "\nUNION ALL ".join(f"""
SELECT {group}'{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max
FROM {source} {('GROUP BY ' + ', '.join(by)) if by else ''}""" for c in cols)


MEASURED = ["game_clock", "shot_clock", "x_loc", "y_loc", "radius"]
ORACLES["describe_moments"] = with_views(_describe_sql("moments_feet", MEASURED, []))
ORACLES["describe_moments_per_role"] = with_views(
    ", r AS (SELECT *, CASE WHEN player_id = -1 THEN 'ball' ELSE 'players' END AS role FROM moments_feet)"
    + _describe_sql("r", MEASURED, ["role"]))
ORACLES["shot_height_summary"] = (f"WITH b AS ({ORACLES['ball_rows_in_shots']}) " + _describe_sql("b", ["radius"], []))

ORACLES["gap_histograms"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS histogram, q.* FROM ("
    + with_views(_hist_sql(GAPS + f", vals AS (SELECT gap AS v FROM gg WHERE {cond})", bins)) + ") q"
    for name, cond, bins in [("small", f"gap <= {dbl(0.2)}", 100), ("large", f"gap > {dbl(0.5)}", 50)])

ORACLES["low_ball_histogram"] = ("SELECT 'x_loc' AS histogram, q.* FROM (" + with_views(_hist_sql(
    ", vals AS (SELECT x_loc AS v FROM moments_feet WHERE player_id = -1 AND radius < 0.5)", 50)) + ") q")

ORACLES["players_without_minutes"] = with_views("""
SELECT count(*) AS n_players, count(*) FILTER (WHERE player_id NOT IN (
         SELECT player_id FROM minutes_played)) AS n_without_minutes
FROM (SELECT DISTINCT player_id FROM moments_feet WHERE player_id <> -1) p
""")

ORACLES["first_crossing_upwards"] = """
SELECT user_id, min(ts) FILTER (WHERE value >= 90) AS first_ts FROM events GROUP BY user_id
"""

ORACLES["clutch_shots_with_ties"] = with_views(FILLED + """
SELECT DISTINCT game_id, eventnum AS event_id, period AS quarter, player1_id AS player_id, eventmsgtype AS event_type,
       game_clock_seconds
FROM f WHERE margin_filled IS NOT NULL AND period >= 4 AND game_clock_seconds <= 300
       AND abs(CASE WHEN margin_filled = 'TIE' THEN 0 ELSE TRY_CAST(margin_filled AS INTEGER) END) <= 5
""")

ORACLES["drifting_headers"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority
FROM orders
"""
