"""F1 role split and F7 deterministic dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.scalar import BALL_ID


def split_roles(df: DataFrame, key: str = "player_id", sentinel=BALL_ID) -> tuple[DataFrame, DataFrame]:
    """(players, ball).  Rows with a null key fall in neither."""
    return df.filter(F.col(key) != F.lit(sentinel)), df.filter(F.col(key) == F.lit(sentinel))


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """keep one row per key, the smallest by ``order_by`` then by every
    other column (ascending, nulls first) — a total order, so the survivor is
    the same on every run and under any partitioning.

    ``row_number() = 1`` is planned with a group limit before the exchange: a
    task sends at most one row per key, so a key that holds a large share of
    all rows (a group of copies) never reaches one task in full, and no
    buffers of whole rows are aggregated.
    """
    keys = list(keys)
    rest = [c for c in order_by if c not in keys]
    rest += [c for c in df.columns if c not in keys and c not in rest]
    first = Window.partitionBy(*keys).orderBy(*rest) if rest else Window.partitionBy(*keys).orderBy(*keys)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
