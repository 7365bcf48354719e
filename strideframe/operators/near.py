"""Proximity operators: target lookup per moment (J1), threshold flag (F12),
exclusive proximity (W3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.scalar import BALL_ID, dist2d

MOMENT = ["game_id", "quarter", "game_clock"]


def join_target(players: DataFrame, target: DataFrame, keys: Sequence[str] = MOMENT,
                cols: Sequence[str] = ("x_loc", "y_loc"), prefix: str = "ball_") -> DataFrame:
    """Inner equi-join of entity rows with the target's row of the same
    moment (exact key match, H9).  ``target`` must be one row per key."""
    t = target.select(*keys, *[F.col(c).alias(prefix + c.split("_")[0]) for c in cols])
    return players.join(t, list(keys), "inner")


def with_target_in_moment(moments: DataFrame, keys: Sequence[str] = MOMENT, role: str = "player_id",
                          target_id=BALL_ID, cols: Sequence[str] = ("x_loc", "y_loc"),
                          prefix: str = "ball_") -> DataFrame:
    """J1 in one pass: the target's coordinates spread to every row of the
    same moment with an unordered window over the moment key, then the
    target rows removed.  Same result as ``join_target`` on deduped input
    (entity rows of moments without a target get nulls, then drop out of
    any distance predicate), without a second scan and join.  Rows with a
    null key belong to no moment and go, as the join drops them.  A moment
    holds one row per entity, so window partitions stay small."""
    w = Window.partitionBy(*keys)
    is_t = F.col(role) == F.lit(target_id)
    out = moments.dropna(subset=list(keys)).withColumns({prefix + c.split("_")[0]: F.max(F.when(is_t, F.col(c))).over(w) for c in cols})
    return out.filter(F.col(role) != F.lit(target_id))


def near_flag(dist, radius: float) -> F.Column:
    """1 when within radius (inclusive), else 0 (null distance -> 0)."""
    d = F.col(dist) if isinstance(dist, str) else dist
    return F.when(d <= F.lit(float(radius)), 1).otherwise(0)


def exclusive_near(df: DataFrame, keys: Sequence[str] = MOMENT, x: str = "x_loc", y: str = "y_loc",
                   tx: str = "ball_x", ty: str = "ball_y", radius: float = 0.5) -> DataFrame:
    """Rows within ``radius`` of the target where they are the only such
    row of their moment (contested moments belong to nobody, H10)."""
    w = Window.partitionBy(*keys)
    near = near_flag(dist2d(x, y, tx, ty), radius)
    return (df.withColumn("near_ball", near)
              .withColumn("players_near_ball", F.sum("near_ball").over(w))
              .filter((F.col("near_ball") == 1) & (F.col("players_near_ball") == 1))
              .drop("near_ball", "players_near_ball"))
