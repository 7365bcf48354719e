"""Q13 possession distribution, Q14 shot-chart points, Q15 scoring table —
the numbers behind the reference's plots (drawing itself is out of scope)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions import scalar as S
from strideframe.operators.profile import describe, histogram
from strideframe.operators.score import linear_score


def possession_fraction(result: DataFrame) -> DataFrame:
    return result.select("player_id", (F.col("percentage_ball_possession") / 100).alias("possession_fraction"))


def possession_distribution(result: DataFrame, bins: int = 15) -> DataFrame:
    """Q13 (A20): equal-width histogram of the possession fraction over its
    min..max, last bin right-closed."""
    return histogram(possession_fraction(result), "possession_fraction", bins)


def possession_summary(result: DataFrame) -> DataFrame:
    """Q13 (A14, A21): describe() of the possession fraction (mean = the
    plotted mean line)."""
    return describe(possession_fraction(result), ["possession_fraction"])


def shot_chart_points(shots: DataFrame) -> DataFrame:
    """Q14 (E13, E16): shot positions back in feet, folded onto the right
    half, labelled made / missed, with the count per label (legend)."""
    x_ft, y_ft = S.to_feet("x_loc"), S.to_feet("y_loc")
    xp, yp = S.mirror_to_right_half(x_ft, y_ft)
    pts = shots.select("player_id", "game_id", "event_type", "shot_type", "game_clock_seconds",
                       x_ft.alias("x_ft"), y_ft.alias("y_ft"), xp.alias("x_plot"), yp.alias("y_plot"),
                       F.when(S.made_flag("event_type"), F.lit("made"))
                        .when(F.col("event_type") == S.EVENT_MISSED, F.lit("missed"))
                        .otherwise(F.lit("other")).alias("outcome"))
    counts = pts.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_outcome"))
    # at most three labels: a bounded side
    return pts.join(F.broadcast(counts), "outcome")


def score_table(df: DataFrame, id_col: str, features: str, coef: Sequence[float], intercept: float,
                keep: Sequence[str] = ()) -> DataFrame:
    """Q15: one score per row."""
    return linear_score(df.select(id_col, features, *keep), features, coef, intercept).drop(features)
