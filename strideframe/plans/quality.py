"""Data-quality jobs Q5–Q9, Q11, Q12 (the exploratory checks, as Spark jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from strideframe.functions import scalar as S
from strideframe.operators.dedupe import split_roles
from strideframe.operators.match import anti_join, nearest_match, semi_join
from strideframe.operators.profile import (Histogram, count_of_counts, describe, exact_quantiles, histograms, profile,
                                           quantiles_from_counts, summary_from_counts, threshold_counts, value_weights)
from strideframe.operators.ranges import next_in_ranges
from strideframe.operators.sequence import next_in_sequence, time_buckets
from strideframe.plans.distance import MOMENT_KEY, dedupe_moments

MOMENT = ["game_id", "quarter", "game_clock"]


def table_profile(tables: dict[str, DataFrame], approx: bool = False) -> DataFrame:
    """Q5: column profile of several tables, stacked (``approx``: sketched
    distinct counts, see ``profile``)."""
    out = None
    for name, df in tables.items():
        p = profile(df, name, approx=approx)
        out = p if out is None else out.unionByName(p)
    return out


def moment_completeness(moments: DataFrame) -> DataFrame:
    """Q6: rows per moment (expected 1 ball + 10 players) before and after
    the dedupe: stage, rows_per_ts, n_moments."""
    raw = count_of_counts(moments, MOMENT, "rows_per_ts", "n_moments").withColumn("stage", F.lit("raw"))
    # the dedupe leaves one row per distinct key, and only their number counts here
    dd = count_of_counts(moments.select(*MOMENT_KEY).distinct(), MOMENT, "rows_per_ts", "n_moments") \
        .withColumn("stage", F.lit("deduped"))
    return raw.unionByName(dd).select("stage", "rows_per_ts", "n_moments")


def complete_moments(moments: DataFrame, expected: int = 11) -> DataFrame:
    """Q6: per stage (raw, deduped) the number of moments, how many hold the
    expected rows (one ball, ten players), and their share in percent."""
    sizes = moment_completeness(moments)
    full = F.sum(F.when(F.col("rows_per_ts") == F.lit(expected), F.col("n_moments")).otherwise(0))
    out = sizes.groupBy("stage").agg(F.sum("n_moments").alias("n_moments"), full.alias("n_complete"))
    return out.withColumn("pct_complete", F.round(F.try_divide(F.col("n_complete") * 100.0, F.col("n_moments")), 1))


def _role():
    """Ball or players; a row without an id is no ball row."""
    return F.when(F.col("player_id") == S.BALL_ID, F.lit("ball")).otherwise(F.lit("players")).alias("role")


def describe_moments(moments: DataFrame, cols=("game_clock", "shot_clock", "x_loc", "y_loc", "radius"),
                     per_role: bool = True) -> DataFrame:
    """A14 over the moments: describe of the measured columns, per role (Q7)
    or over all rows."""
    if not per_role:
        return describe(moments, list(cols))
    return describe(moments.select(_role(), *cols), list(cols), by=["role"])


def bounds_check(moments_feet: DataFrame, length: float = S.COURT_LENGTH_FT,
                 width: float = S.COURT_WIDTH_FT) -> DataFrame:
    """Q7: coordinate ranges and out-of-court counts per role (feet); rows
    without an id count with the players, as they are not the ball's."""
    return (moments_feet.groupBy(_role()).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("x_loc").alias("x_min"), F.max("x_loc").alias("x_max"),
        F.count_if(S.out_of_range("x_loc", 0.0, length)).alias("x_out"),
        F.min("y_loc").alias("y_min"), F.max("y_loc").alias("y_max"),
        F.count_if(S.out_of_range("y_loc", 0.0, width)).alias("y_out")))


def clock_check(moments: DataFrame, clock_max: float = 720.0, shot_max: float = 24.0) -> DataFrame:
    """Q7: game clock and shot clock ranges, nulls and out-of-range counts,
    and the number of distinct quarters / overtime rows, in one aggregate."""
    return moments.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("game_clock").alias("clock_min"), F.max("game_clock").alias("clock_max"),
        F.count_if(F.col("game_clock") < 0).alias("clock_below"),
        F.count_if(F.col("game_clock") > clock_max).alias("clock_above"),
        F.count_if(F.col("shot_clock").isNull()).alias("shot_nulls"),
        F.round(F.avg(F.col("shot_clock").isNull().cast("double")) * 100, 1).alias("shot_null_pct"),
        F.min("shot_clock").alias("shot_min"), F.max("shot_clock").alias("shot_max"),
        F.count_if(F.col("shot_clock") < 0).alias("shot_below"),
        F.count_if(F.col("shot_clock") > shot_max).alias("shot_above"),
        F.count_distinct("quarter").alias("n_quarters"),
        F.count_if(F.col("quarter") > 4).alias("overtime_rows"))


def jumps(moments_feet: DataFrame, bucket_seconds: float | None = 60.0) -> DataFrame:
    """Distance (feet) from each deduped player sample to the next
    one of the same player in the same game, across quarter breaks, no gap
    guard; the last sample of a player-game has no jump (dropped)."""
    players, _ = split_roles(dedupe_moments(moments_feet, []))
    buckets = None
    if bucket_seconds:
        buckets = [("quarter", None, True),
                   ("_tb", F.floor(F.col("game_clock") / F.lit(float(bucket_seconds))), False)]
    nx = next_in_sequence(players.select("game_id", "player_id", "quarter", "game_clock", "x_loc", "y_loc"),
                          ["game_id", "player_id"], [("quarter", True), ("game_clock", False)],
                          ["x_loc", "y_loc"], buckets)
    return (nx.filter(F.col("next_x_loc").isNotNull())
              .select("game_id", "player_id", "quarter", "game_clock",
                      S.dist2d("x_loc", "y_loc", "next_x_loc", "next_y_loc").alias("jump_ft")))


def jump_report(moments_feet: DataFrame, big: float = 10.0, huge: float = 50.0) -> DataFrame:
    """Q8: mean / median / 95th percentile / max of the jumps and the counts
    beyond ``big`` (likely gaps) and ``huge`` (data errors).  Everything is
    read from one (jump, count) table, so the jump pipeline runs once."""
    vc = value_weights(jumps(moments_feet), "jump_ft")
    q = quantiles_from_counts(vc, [0.5, 0.95], "jump_ft")
    qp = q.agg(F.max(F.when(F.col("p") == 0.5, F.col("jump_ft"))).alias("median"),
               F.max(F.when(F.col("p") == 0.95, F.col("jump_ft"))).alias("p95"))
    base = summary_from_counts(vc, [("over_big", ">", big), ("over_huge", ">", huge)]).select(
        F.col("n").alias("n_jumps"), "mean", "max", "n_over_big", "n_over_huge")
    both = base.unionByName(qp, allowMissingColumns=True)
    cols = ["n_jumps", "mean", "median", "p95", "max", "n_over_big", "n_over_huge"]
    out = both.agg(*[F.max(c).alias(c) for c in cols])
    return out.withColumn("pct_over_big", F.round(F.try_divide(F.col("n_over_big") * 100.0, F.col("n_jumps")), 2))


def gap_distribution(moments: DataFrame, bucket_seconds: float | None = 60.0) -> DataFrame:
    """W10 on raw (not deduped) player rows, as weighted gaps ``(gap, w)``.

    Equal clocks of one player contribute zero gaps, so the rows are reduced
    to (player segment, clock, multiplicity) first — a combining aggregate,
    safe against any number of copies — and the sequence step runs over
    distinct clocks: m copies give m - 1 zero gaps plus one step to the next
    distinct clock.  Same multiset as a lead over the raw rows."""
    players, _ = split_roles(moments)
    seg = ["game_id", "player_id", "quarter"]
    c = players.groupBy(*seg, "game_clock").agg(F.count(F.lit(1)).alias("m"))
    zeros = c.filter(F.col("m") > 1).select(F.lit(0.0).alias("gap"), (F.col("m") - 1).alias("w"))
    buckets = time_buckets("game_clock", bucket_seconds) if bucket_seconds else None
    nx = next_in_sequence(c.select(*seg, "game_clock"), seg, [("game_clock", False)], ["game_clock"], buckets)
    steps = (nx.filter(F.col("next_game_clock").isNotNull())
               .select((F.col("game_clock") - F.col("next_game_clock")).alias("gap"), F.lit(1).cast("bigint").alias("w")))
    return zeros.unionByName(steps)


GAP_CUTS = [("le_0_04", "<=", 0.04), ("le_0_05", "<=", 0.05), ("le_0_10", "<=", 0.10),
            ("le_0_50", "<=", 0.50), ("gt_0_50", ">", 0.50), ("gt_1_00", ">", 1.00)]


def gap_report(moments: DataFrame, cuts=GAP_CUTS) -> DataFrame:
    """Q9: gap summary (min, mean, max, weighted) and counts per cut-off, in
    one aggregate over one run of the gaps."""
    g = gap_distribution(moments).select(F.col("gap").alias("v"), "w")
    s = summary_from_counts(g, cuts)
    shares = [c for name, _, _ in cuts for c in (
        F.col(f"n_{name}"), F.try_divide(F.col(f"n_{name}"), F.col("n")).alias(f"share_{name}"))]
    return s.select(F.col("min").alias("gap_min"), F.col("mean").alias("gap_mean"), F.col("max").alias("gap_max"),
                    F.coalesce("n", F.lit(0)).alias("n_values"), *shares)


def gap_histograms(moments: DataFrame, small: float = 0.2, large: float = 0.5) -> DataFrame:
    """Q9 (A20): the gaps up to ``small`` in 100 bins (the frame rate) and
    those beyond ``large`` in 50 (likely substitutions), in one run."""
    gap = F.col("gap")
    return histograms(gap_distribution(moments), [
        Histogram("small", gap, 100, keep=gap <= F.lit(small)),
        Histogram("large", gap, 50, keep=gap > F.lit(large))], weight="w")


def gap_quantiles(moments: DataFrame, probs=(0.5, 0.9, 0.95, 0.99, 0.999)) -> DataFrame:
    """Q9 (A15): exact percentiles of the gaps."""
    return exact_quantiles(gap_distribution(moments), "gap", list(probs), weight="w")


def text_shots(events: DataFrame, token: str = "3PT") -> DataFrame:
    """made/missed events whose description mentions ``token``,
    with the clock parsed tolerantly (unparsable -> dropped)."""
    is_shot = F.col("eventmsgtype").isin(S.EVENT_MADE, S.EVENT_MISSED)
    txt = S.contains_any(["homedescription", "visitordescription"], token)
    return (events.filter(is_shot & txt)
                  .withColumn("game_clock_approx", S.clock_to_seconds("pctimestring", strict=False).cast("double"))
                  .filter(F.col("game_clock_approx").isNotNull()))


def locate_text_shots(moments: DataFrame, events: DataFrame, tolerance: float = 1.0, token: str = "3PT",
                      radius: float = S.THREE_POINT_RADIUS_M) -> DataFrame:
    """Q11: each text-identified shot matched to the shooter's sample
    nearest in time within ±``tolerance`` s in the same game and quarter
    (J7; the game key is part of the match, H24), with distance to the
    nearer basket and the outside-the-arc sanity flag (E11, E17)."""
    shots = text_shots(events, token).select(
        "game_id", "eventnum", F.col("player1_id").alias("player_id"), "player1_name",
        F.col("period").alias("quarter"), "game_clock_approx",
        S.made_flag("eventmsgtype").alias("made"))
    players, _ = split_roles(moments)
    m = players.select("game_id", "player_id", "quarter", "game_clock", "x_loc", "y_loc")
    on = [("game_id", "game_id"), ("player_id", "player_id"), ("quarter", "quarter")]
    loc = nearest_match(shots, m, on, "game_clock_approx", "game_clock", ["x_loc", "y_loc"], tolerance=tolerance)
    d = S.min_dist_to_baskets("x_loc", "y_loc")
    return (loc.withColumn("dist_nearest_basket", d)
               .withColumn("outside_arc", S.outside_arc("dist_nearest_basket", radius)))


def height_coverage(moments: DataFrame, events: DataFrame, height: float = 2.0) -> DataFrame:
    """Q12 (A22, J8, J9): how well ball tracking covers shot events.

    Ball rows in shot events (made or missed), the share at or above
    ``height``; made-shot events with ball rows, without any, and with at
    least one row at or above ``height``.  Events are keyed by (game, event).

    One pass per table: ball rows are reduced to (rows, high rows) per event
    and events to (is shot, is made) per event — both partial aggregates,
    one row per key — then full-outer joined, so the semi join (J8, ball rows
    of shot events) and the anti join (J9, made events without ball rows)
    become conditional counts over the joined table.  A key with null parts
    never matches, as in an equi-join."""
    _, ball = split_roles(moments)
    ek = ["game_id", "event_id"]
    high = F.col("radius") >= F.lit(float(height))
    per_ball = ball.groupBy(*ek).agg(F.count(F.lit(1)).alias("n"), F.count_if(high).alias("nh"))
    per_ev = (events.select("game_id", F.col("eventnum").alias("event_id"), "eventmsgtype")
                    .groupBy(*ek).agg(
                        F.max(F.col("eventmsgtype").isin(S.EVENT_MADE, S.EVENT_MISSED)).alias("shot"),
                        F.max(F.col("eventmsgtype") == S.EVENT_MADE).alias("made")))
    j = per_ball.alias("b").join(per_ev.alias("e"),
                                 (F.col("b.game_id") == F.col("e.game_id")) & (F.col("b.event_id") == F.col("e.event_id")),
                                 "full_outer")
    shot, made = F.coalesce(F.col("shot"), F.lit(False)), F.coalesce(F.col("made"), F.lit(False))
    zero = F.lit(0).cast("bigint")
    out = j.agg(
        F.coalesce(F.sum("n"), zero).alias("ball_rows"),
        F.coalesce(F.sum(F.when(shot, F.col("n"))), zero).alias("ball_rows_in_shots"),
        F.coalesce(F.sum(F.when(shot, F.col("nh"))), zero).alias("ball_rows_high"),
        F.count_if(made).alias("made_events"),
        F.count_if(made & F.col("n").isNotNull()).alias("made_with_ball"),
        F.count_if(made & F.col("n").isNull()).alias("made_without_ball"),
        F.count_if(made & (F.col("nh") > 0)).alias("made_high"))
    cols = ["ball_rows", "ball_rows_in_shots", "ball_rows_high", "made_events", "made_with_ball",
            "made_without_ball", "made_high"]
    return out.select(
        *cols,
        F.round(F.try_divide(F.col("ball_rows_high") * 100.0, F.col("ball_rows_in_shots")), 1).alias("pct_high"),
        (F.col("made_with_ball") - F.col("made_high")).alias("made_not_high"),
        F.round(F.try_divide(F.col("made_high") * 100.0, F.col("made_events")), 1).alias("coverage_pct"))


def _event_keys(events: DataFrame, types) -> DataFrame:
    return (events.filter(F.col("eventmsgtype").isin(*types))
                  .select("game_id", F.col("eventnum").alias("event_id")))


def ball_rows_in_shots(moments: DataFrame, events: DataFrame) -> DataFrame:
    """The ball samples that belong to a shot event (made or missed)."""
    _, ball = split_roles(moments)
    return semi_join(ball.select("game_id", "event_id", "quarter", "game_clock", "radius"),
                     _event_keys(events, [S.EVENT_MADE, S.EVENT_MISSED]), ["game_id", "event_id"])


def untracked_made_events(moments: DataFrame, events: DataFrame) -> DataFrame:
    """Made-shot events (game, event) without any ball sample."""
    _, ball = split_roles(moments)
    made = _event_keys(events, [S.EVENT_MADE]).distinct()
    return anti_join(made, ball, ["game_id", "event_id"])


def shot_height_summary(moments: DataFrame, events: DataFrame) -> DataFrame:
    """Q12 (A14): describe of the ball's height in shot events."""
    return describe(ball_rows_in_shots(moments, events), ["radius"])


def low_ball_histogram(moments_feet: DataFrame, below: float = 0.5, bins: int = 50) -> DataFrame:
    """Q12 (A20): where on the court the ball is near the floor."""
    _, ball = split_roles(moments_feet)
    return histograms(ball, [Histogram("x_loc", F.col("x_loc"), bins, keep=F.col("radius") < F.lit(float(below)))])


def low_ball_rows(moments_feet: DataFrame, below: float = 0.5, k: int = 20) -> DataFrame:
    """the ``k`` lowest ball samples under ``below`` (a top-k report;
    the order is total so the cut is deterministic)."""
    _, ball = split_roles(moments_feet)
    return (ball.filter(F.col("radius") < F.lit(float(below)))
                .select("x_loc", "y_loc", "radius", "game_clock", "quarter", "game_id", "event_id")
                .orderBy("radius", "game_id", "quarter", F.col("game_clock").desc(), "event_id", "x_loc", "y_loc")
                .limit(k))


def event_path_length(events: DataFrame, max_gap_us: int) -> DataFrame:
    """W1/W2 on a raw event stream (user_id, event_id, ts, value): per user,
    the summed change of ``value`` between consecutive events (time order,
    event id breaks ties) at most ``max_gap_us`` microseconds apart, the
    number of such steps and the number of events."""
    if isinstance(events.schema["ts"].dataType, TimestampNTZType):
        # wall-clock time: microseconds since the epoch without any time
        # zone, so the session zone (and its daylight-saving shifts) never
        # changes a gap
        t_us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    else:
        t_us = F.unix_micros(F.col("ts"))          # an instant: zone-free already
    ev = events.select("user_id", "event_id", "value", t_us.alias("t_us"))
    # exact copies are reduced to (row, multiplicity) by a combining
    # aggregate: m copies are m - 1 in-gap steps of length 0 (when the time
    # is known) plus one step from the last copy to the next distinct event
    evc = ev.groupBy("user_id", "event_id", "value", "t_us").agg(F.count(F.lit(1)).alias("m"))
    # sorted ranges of (user, time): a hot user (or a burst) is split over
    # many partitions; the next event across a border is carried in
    nx = next_in_ranges(evc, ["user_id"], ["t_us", "event_id", "value"], ["value", "t_us"])
    ok = F.col("next_t_us").isNotNull() & ((F.col("next_t_us") - F.col("t_us")) <= F.lit(max_gap_us))
    step = F.when(ok, F.abs(F.col("next_value") - F.col("value"))).otherwise(F.lit(0.0))
    copy_steps = F.when(F.col("t_us").isNotNull(), F.col("m") - 1).otherwise(F.lit(0).cast("bigint"))
    return nx.groupBy("user_id").agg(F.sum(step).alias("path_length"),
                                     (F.count_if(ok) + F.sum(copy_steps)).alias("n_steps"),
                                     F.sum("m").alias("n_events"))
