"""Q2 possession per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions.scalar import SECONDS_PER_SAMPLE
from strideframe.operators.near import MOMENT, exclusive_near, with_target_in_moment
from strideframe.operators.rates import percent_of, ticks_to_seconds
from strideframe.operators.sequence import step_distance
from strideframe.plans.distance import SEGMENT, dedupe_moments, seconds_on_court


def possession_moments(moments: DataFrame, radius: float = 0.5) -> DataFrame:
    """Rows where exactly one player is within ``radius`` of the ball.

    Both roles are deduped on the moment key in one aggregate, the ball's
    position is spread over its moment with a window on the moment key."""
    d = dedupe_moments(moments.select("game_id", "event_id", "quarter", "game_clock", "team_id",
                                      "player_id", "x_loc", "y_loc", "radius"), ["team_id"])
    joined = with_target_in_moment(d.drop("event_id", "radius"), MOMENT)
    near = exclusive_near(joined, MOMENT, radius=radius)
    return near.select("game_id", "quarter", "game_clock", "player_id", "team_id", "x_loc", "y_loc")


def possession_per_entity(moments: DataFrame, minutes: DataFrame, radius: float = 0.5,
                          max_gap: float = 0.5, seconds_per_sample: float = SECONDS_PER_SAMPLE,
                          bucket_seconds: float | None = 60.0) -> DataFrame:
    """Q2: distance covered and time spent in exclusive possession, time on
    court, and possession share in percent.  Steps are taken between
    possession rows only, so the gap guard also splits possession spells
    (H18).  Players without minutes are kept with nulls (left join, H17)."""
    pos = possession_moments(moments, radius)
    steps = step_distance(pos, SEGMENT, max_gap=max_gap, bucket_width=bucket_seconds)
    stats = steps.groupBy("player_id").agg(
        F.sum("dist_m").alias("total_distance_with_ball_possession_m"),
        ticks_to_seconds(F.count(F.lit(1)), seconds_per_sample).alias("time_ball_possession_s"))
    court = seconds_on_court(minutes, "total_time_on_court_s")
    return (stats.join(court, "player_id", "left")
                 .select("player_id", "total_distance_with_ball_possession_m", "time_ball_possession_s",
                         "total_time_on_court_s",
                         percent_of("time_ball_possession_s", "total_time_on_court_s")
                         .alias("percentage_ball_possession")))
