"""Q1 distance per entity and Q10 unfiltered distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.operators.dedupe import dedupe, split_roles
from strideframe.operators.rates import per_unit_rate, total_per
from strideframe.operators.sequence import next_in_sequence, step_distance
from strideframe.functions.scalar import FEET_TO_METERS, dist2d

MOMENT_KEY = ["game_id", "player_id", "quarter", "game_clock"]
TIE_BREAK = ["event_id", "x_loc", "y_loc", "radius"]
SEGMENT = ["game_id", "player_id", "quarter"]


def dedupe_moments(moments: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """F7 on the moment key with the deterministic tie-break (H1)."""
    if cols is not None:
        moments = moments.select(*dict.fromkeys(MOMENT_KEY + TIE_BREAK + cols))
    return dedupe(moments, MOMENT_KEY, TIE_BREAK)


def seconds_on_court(minutes: DataFrame, out: str = "total_seconds") -> DataFrame:
    return total_per(minutes, "player_id", "sec", out)


def distance_per_entity(moments: DataFrame, minutes: DataFrame, max_gap: float = 0.5,
                        unit_minutes: float = 12, bucket_seconds: float | None = 60.0) -> DataFrame:
    """Q1: gap-guarded path length per player, normalised to ``unit_minutes``
    of play.  Players without minutes are dropped (inner join, H17)."""
    players, _ = split_roles(moments)
    players = dedupe_moments(players, [])
    steps = step_distance(players.select(*SEGMENT, "game_clock", "x_loc", "y_loc"), SEGMENT,
                          max_gap=max_gap, bucket_width=bucket_seconds)
    dist = total_per(steps, "player_id", "dist_m", "total_distance_m")
    mins = seconds_on_court(minutes).withColumn("total_minutes", F.col("total_seconds") / 60)
    return (dist.join(mins, "player_id")
                .select("player_id",
                        per_unit_rate("total_distance_m", "total_minutes", unit_minutes)
                        .alias("distance_per_quarter_m"))
                .orderBy(F.col("distance_per_quarter_m").desc(), F.col("player_id")))


def distance_unfiltered(moments_feet: DataFrame, minutes: DataFrame, unit_minutes: float = 12,
                        bucket_seconds: float | None = 60.0) -> DataFrame:
    """Q10: dedupe all rows, then step to the next sample of the same player
    within a game across quarter breaks, no gap guard, feet -> metres; left
    join with minutes; rate rounded half-even to a whole number (null when
    the player has no minutes)."""
    d = dedupe_moments(moments_feet, [])
    players, _ = split_roles(d)
    order = [("quarter", True), ("game_clock", False)]
    buckets = None
    if bucket_seconds:
        buckets = [("quarter", None, True),
                   ("_tb", F.floor(F.col("game_clock") / F.lit(float(bucket_seconds))), False)]
    nx = next_in_sequence(players.select("game_id", "player_id", "quarter", "game_clock", "x_loc", "y_loc"),
                          ["game_id", "player_id"], order, ["x_loc", "y_loc"], buckets)
    steps = nx.withColumn("dist_m", dist2d("x_loc", "y_loc", "next_x_loc", "next_y_loc") * F.lit(FEET_TO_METERS))
    dist = total_per(steps, "player_id", "dist_m", "total_distance_m")
    mins = seconds_on_court(minutes, "total_seconds_played")
    rate = F.bround(F.try_divide(F.col("total_distance_m") * F.lit(unit_minutes),
                                 F.col("total_seconds_played") / 60), 0).cast("bigint")
    return (dist.join(mins, "player_id", "left")
                .select("player_id", "total_distance_m", rate.alias("distance_per_quarter_m"),
                        F.col("total_seconds_played").isNull().alias("missing_minutes")))


def players_without_minutes(moments_feet: DataFrame, minutes: DataFrame) -> DataFrame:
    """Q10: players in the tracking data, and how many of them have no entry
    in the minutes (counted on distinct ids; no distances are computed)."""
    players, _ = split_roles(moments_feet)
    seen = players.select("player_id").distinct().join(
        seconds_on_court(minutes, "total_seconds_played"), "player_id", "left")
    return seen.agg(F.count(F.lit(1)).alias("n_players"),
                    F.count_if(F.col("total_seconds_played").isNull()).alias("n_without_minutes"))
