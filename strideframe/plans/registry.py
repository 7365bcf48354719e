"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the driver tables (through the adapter views).  Column names match the
oracle SQL in ``strideframe.plans.oracle``.

Parameters for the driver data: its clocks are whole numbers of days, so the
gap guard is 5 (not 0.5) and the possession radius 5 m (not 0.5 m).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.sources import adapters as A
from strideframe.plans import distance as D

MAX_GAP = 5.0
RADIUS = 5.0


def _round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Round sum-derived doubles so engines that add in another order agree."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def q_distance_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    return D.distance_per_entity(A.moments(spark, sf), A.minutes(spark, sf), max_gap=MAX_GAP)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "distance_per_entity": q_distance_per_entity,
}


from strideframe.plans import possession as P  # noqa: E402
from strideframe.operators.dedupe import dedupe  # noqa: E402


def q_possession_per_entity(spark, sf):
    df = P.possession_per_entity(A.moments(spark, sf), A.minutes(spark, sf), radius=RADIUS, max_gap=MAX_GAP)
    return _round(df, ["total_distance_with_ball_possession_m", "time_ball_possession_s",
                       "total_time_on_court_s"])


def q_exclusive_near_rows(spark, sf):
    return P.possession_moments(A.moments(spark, sf), radius=RADIUS)


def q_dedupe_first(spark, sf):
    return dedupe(A.moments(spark, sf), D.MOMENT_KEY, D.TIE_BREAK)


QUERIES.update({
    "possession_per_entity": q_possession_per_entity,
    "exclusive_near_rows": q_exclusive_near_rows,
    "dedupe_first": q_dedupe_first,
})


from strideframe.plans import clutch as C  # noqa: E402
from strideframe.operators.sequence import shot_instant  # noqa: E402
from strideframe.operators.dedupe import split_roles  # noqa: E402

SHOT_PLAYER = 3


def q_clutch_efficiency(spark, sf):
    return C.clutch_efficiency(A.moments(spark, sf), A.events(spark, sf))


def q_shot_locations(spark, sf):
    return C.shot_locations(A.moments(spark, sf), A.events(spark, sf), SHOT_PLAYER)


def q_margin_forward_fill(spark, sf):
    f = C.expand_copies(C.fill_margins(A.events(spark, sf)))
    return f.select("game_id", "eventnum", "period", "game_clock_seconds", "scoremargin", "margin_filled")


def q_first_crossing_or_peak(spark, sf):
    _, ball = split_roles(A.moments(spark, sf))
    return shot_instant(ball, ["game_id", "event_id", "quarter"], v="radius", threshold=C.BALL_HEIGHT_M)


def q_nearest_match(spark, sf):
    loc = C.locate_shots(A.moments(spark, sf), C.clutch_shots(A.events(spark, sf)))
    return loc.select("game_id", "event_id", "player_id", "quarter", "event_type", "game_clock_seconds",
                      "tracking_game_clock", "m_game_clock", "x_loc", "y_loc")


QUERIES.update({
    "clutch_efficiency": q_clutch_efficiency,
    "shot_locations": q_shot_locations,
    "margin_forward_fill": q_margin_forward_fill,
    "first_crossing_or_peak": q_first_crossing_or_peak,
    "nearest_match": q_nearest_match,
})


from strideframe.plans import quality as Q  # noqa: E402
from strideframe.plans import reports as R  # noqa: E402
from strideframe.operators import profile as PR  # noqa: E402
from strideframe.operators.rates import pivot_rates  # noqa: E402
from strideframe.operators.score import linear_score_columns  # noqa: E402
from strideframe.operators.sequence import head_k  # noqa: E402
from strideframe.sources.readers import read_results  # noqa: E402
from strideframe.sources.sinks import write_single_delimited  # noqa: E402
from strideframe.session import shared_dir  # noqa: E402

# Fixed coefficient rule for the scoring queries: coef_i = (i % 7 - 3) / 10.
EMBED_DIM = 64
EMBED_COEF = [(i % 7 - 3) / 10 for i in range(EMBED_DIM)]
EMBED_INTERCEPT = 0.5
LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_COEF = [0.5, 0.001, -20.0, 10.0]
LINE_INTERCEPT = 1.0
PATH_GAP_MICROS = 6 * 3600 * 1_000_000


def q_table_profile(spark, sf):
    return Q.table_profile({"orders": A.table(spark, sf, "orders"), "customer": A.table(spark, sf, "customer")})


def q_moment_completeness(spark, sf):
    return Q.moment_completeness(A.moments(spark, sf))


def q_bounds_check(spark, sf):
    return Q.bounds_check(A.moments_feet(spark, sf))


def q_clock_check(spark, sf):
    return Q.clock_check(A.moments_feet(spark, sf))


def q_quarter_values(spark, sf):
    return PR.sorted_distinct(A.moments(spark, sf), "quarter")


def q_jump_report(spark, sf):
    return _round(Q.jump_report(A.moments_feet(spark, sf)), ["mean", "median", "p95", "max"])


def q_jump_histogram(spark, sf):
    h = PR.histogram(Q.jumps(A.moments_feet(spark, sf)), "jump_ft", 100, clip_upper=20.0)
    return _round(h, ["bin_lo", "bin_hi"])


def q_gap_report(spark, sf):
    return _round(Q.gap_report(A.moments(spark, sf)), ["gap_mean"])


def q_gap_quantiles(spark, sf):
    return _round(Q.gap_quantiles(A.moments(spark, sf)), ["gap"])


def q_distance_unfiltered(spark, sf):
    df = D.distance_unfiltered(A.moments_feet(spark, sf), A.minutes(spark, sf))
    return _round(df, ["total_distance_m"])


def q_text_shots_located(spark, sf):
    df = Q.locate_text_shots(A.moments(spark, sf), A.events(spark, sf))
    return df.drop("clock_diff")


def q_height_coverage(spark, sf):
    return Q.height_coverage(A.moments(spark, sf), A.events(spark, sf))


def q_low_ball_rows(spark, sf):
    return Q.low_ball_rows(A.moments_feet(spark, sf))


def _possession(spark, sf):
    return P.possession_per_entity(A.moments(spark, sf), A.minutes(spark, sf), radius=RADIUS, max_gap=MAX_GAP)


def q_rate_histogram(spark, sf):
    return _round(R.possession_distribution(_possession(spark, sf)), ["bin_lo", "bin_hi"])


def q_possession_summary(spark, sf):
    return _round(R.possession_summary(_possession(spark, sf)), ["mean", "std", "min", "p25", "p50", "p75", "max"])


def q_shot_chart_points(spark, sf):
    shots = C.shot_locations(A.moments(spark, sf), A.events(spark, sf), SHOT_PLAYER)
    return _round(R.shot_chart_points(shots), ["x_ft", "y_ft", "x_plot", "y_plot"])


def q_linear_score_array(spark, sf):
    df = R.score_table(A.table(spark, sf, "embeddings"), "vec_id", "embedding", EMBED_COEF, EMBED_INTERCEPT,
                       keep=["label"])
    return _round(df, ["score"])


def q_linear_score_columns(spark, sf):
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *LINE_COLS)
    return _round(linear_score_columns(li, LINE_COLS, LINE_COEF, LINE_INTERCEPT).drop(*LINE_COLS), ["score"])


def q_pivot_success_rates(spark, sf):
    o = A.table(spark, sf, "orders").withColumn(
        "size_class", F.when(F.col("o_totalprice") < 100000, F.lit("small")).otherwise(F.lit("large")))
    return pivot_rates(o, "o_orderpriority", "size_class", ["small", "large"], F.col("o_orderstatus") == "F")


def q_top_k_per_group(spark, sf):
    ev = A.table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return head_k(ev, ["user_id"], [("ts", True), ("event_id", True)], 3)


def q_value_counts(spark, sf):
    return PR.value_counts(A.table(spark, sf, "events"), "event_type")


def q_threshold_counts(spark, sf):
    cuts = [("le_10", "<=", 10.0), ("le_25", "<=", 25.0), ("gt_40", ">", 40.0), ("gt_49", ">", 49.0)]
    return PR.threshold_counts(A.table(spark, sf, "lineitem"), "l_quantity", cuts)


def q_event_path_length(spark, sf):
    """W1/W2 on the raw event stream: per user, the summed change of
    ``value`` between consecutive events (time order, event id breaks ties)
    when they are at most 6 h apart."""
    out = Q.event_path_length(A.table(spark, sf, "events"), PATH_GAP_MICROS)
    return _round(out, ["path_length"])


def q_delimited_round_trip(spark, sf):
    """S4 -> S5: the report writer's single space-delimited file, read back."""
    region = A.table(spark, sf, "region")
    out = shared_dir(spark, "round-trip")
    path = write_single_delimited(region, out, "region.txt", sep=" ", header=True)
    return read_results(spark, path, schema=region.schema, sep=" ", header=True)


QUERIES.update({
    "distance_unfiltered": q_distance_unfiltered,
    "table_profile": q_table_profile,
    "moment_completeness": q_moment_completeness,
    "bounds_check": q_bounds_check,
    "clock_check": q_clock_check,
    "quarter_values": q_quarter_values,
    "jump_report": q_jump_report,
    "jump_histogram": q_jump_histogram,
    "gap_report": q_gap_report,
    "gap_quantiles": q_gap_quantiles,
    "text_shots_located": q_text_shots_located,
    "height_coverage": q_height_coverage,
    "low_ball_rows": q_low_ball_rows,
    "rate_histogram": q_rate_histogram,
    "possession_summary": q_possession_summary,
    "shot_chart_points": q_shot_chart_points,
    "linear_score_array": q_linear_score_array,
    "linear_score_columns": q_linear_score_columns,
    "pivot_success_rates": q_pivot_success_rates,
    "top_k_per_group": q_top_k_per_group,
    "value_counts": q_value_counts,
    "threshold_counts": q_threshold_counts,
    "event_path_length": q_event_path_length,
    "delimited_round_trip": q_delimited_round_trip,
})


from strideframe.operators.match import nearest_match  # noqa: E402


def q_nearest_match_tolerance(spark, sf):
    """J7 on every made/missed event: the shooter's sample nearest in time
    within ±1 s, same game and quarter."""
    ev = A.events(spark, sf)
    from strideframe.functions import scalar as S
    shots = (ev.filter(F.col("eventmsgtype").isin(1, 2))
               .select("game_id", "eventnum", F.col("player1_id").alias("player_id"),
                       F.col("period").alias("quarter"),
                       S.clock_to_seconds("pctimestring", strict=False).cast("double").alias("event_clock")))
    players, _ = split_roles(A.moments(spark, sf))
    m = players.select("game_id", "player_id", "quarter", "game_clock", "x_loc", "y_loc")
    on = [("game_id", "game_id"), ("player_id", "player_id"), ("quarter", "quarter")]
    return nearest_match(shots, m, on, "event_clock", "game_clock", ["x_loc", "y_loc"], tolerance=1.0)


def q_duplicate_keys(spark, sf):
    return PR.duplicate_key_count(A.moments(spark, sf), D.MOMENT_KEY)


QUERIES.update({
    "nearest_match_tolerance": q_nearest_match_tolerance,
    "duplicate_keys": q_duplicate_keys,
})


def q_ball_rows_in_shots(spark, sf):
    return Q.ball_rows_in_shots(A.moments(spark, sf), A.events(spark, sf))


def q_untracked_made_events(spark, sf):
    return Q.untracked_made_events(A.moments(spark, sf), A.events(spark, sf))


QUERIES.update({
    "ball_rows_in_shots": q_ball_rows_in_shots,
    "untracked_made_events": q_untracked_made_events,
})


def q_tracking_profile(spark, sf):
    """Q5 over the tracking tables themselves (without the samples, whose
    text form differs between engines)."""
    return Q.table_profile({"moments": A.moments_feet(spark, sf), "events": A.events(spark, sf),
                            "minutes_played": A.minutes(spark, sf)}).drop("sample")


def q_complete_moments(spark, sf):
    return Q.complete_moments(A.moments(spark, sf), expected=2)


def q_describe_moments(spark, sf):
    return _round(Q.describe_moments(A.moments_feet(spark, sf), per_role=False), SUMMARY)


def q_describe_moments_per_role(spark, sf):
    return _round(Q.describe_moments(A.moments_feet(spark, sf)), SUMMARY)


def q_gap_histograms(spark, sf):
    return _round(Q.gap_histograms(A.moments(spark, sf)), ["bin_lo", "bin_hi"])


def q_players_without_minutes(spark, sf):
    return D.players_without_minutes(A.moments_feet(spark, sf), A.minutes(spark, sf))


def q_shot_height_summary(spark, sf):
    return _round(Q.shot_height_summary(A.moments(spark, sf), A.events(spark, sf)), SUMMARY)


def q_low_ball_histogram(spark, sf):
    return _round(Q.low_ball_histogram(A.moments_feet(spark, sf)), ["bin_lo", "bin_hi"])


def q_first_crossing_upwards(spark, sf):
    """W5 where time runs upwards: a user's first event of at least 90."""
    ev = A.table(spark, sf, "events")
    return first_crossing(ev, ["user_id"], "ts", "value", 90.0, t_desc=False, out="first_ts")


def q_clutch_shots_with_ties(spark, sf):
    """H5: the clutch shots where a tie counts as a margin of 0."""
    return C.clutch_shots(A.events(spark, sf), tie_value=0)


DRIFT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def q_drifting_headers(spark, sf):
    """Orders as CSV files whose headers differ in case, order and
    columns (one kind lacks the priority), read back by name."""
    orders = A.table(spark, sf, "orders").select(*DRIFT)
    folder = shared_dir(spark, "drifting")
    heads = {"F": DRIFT, "O": [c.upper() for c in reversed(DRIFT)], "P": [*DRIFT[2:4], *DRIFT[:2]]}
    for status, names in heads.items():
        part = orders.filter(F.col("o_orderstatus") == status)
        part.select(*[F.col(n.lower()).alias(n) for n in names]).write.csv(f"{folder}/{status}", header=True)
    return read_table(spark, f"{folder}/*", orders.schema).select(*DRIFT)


SUMMARY = ["mean", "std", "min", "p25", "p50", "p75", "max"]

from strideframe.operators.sequence import first_crossing  # noqa: E402
from strideframe.sources.readers import read_table  # noqa: E402

QUERIES.update({
    "tracking_profile": q_tracking_profile,
    "complete_moments": q_complete_moments,
    "describe_moments": q_describe_moments,
    "describe_moments_per_role": q_describe_moments_per_role,
    "gap_histograms": q_gap_histograms,
    "players_without_minutes": q_players_without_minutes,
    "shot_height_summary": q_shot_height_summary,
    "low_ball_histogram": q_low_ball_histogram,
    "first_crossing_upwards": q_first_crossing_upwards,
    "clutch_shots_with_ties": q_clutch_shots_with_ties,
    "drifting_headers": q_drifting_headers,
})
