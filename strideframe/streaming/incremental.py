"""Incremental distance job over per-game files (Structured Streaming).

Tracking data lands one file per game.  Every distance quantity of the
distance job is a sum over (game, player, quarter) segments, so a game can be
processed on its own as soon as its file arrives: a file-source stream feeds
micro-batches of whole files to ``foreachBatch``, which computes the per-game
partial sums (dedupe, gap-guarded steps) and writes them under the batch id —
overwriting on a retry, so a replayed batch never counts twice.  The final
per-player rate is a cheap aggregate over the partials.

Requirement: all rows of a game are in one file (the delivery layout).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe import schemas
from strideframe.functions.scalar import FEET_TO_METERS
from strideframe.operators.dedupe import split_roles
from strideframe.operators.rates import per_unit_rate
from strideframe.operators.sequence import step_distance
from strideframe.plans.distance import SEGMENT, dedupe_moments, seconds_on_court
from strideframe.sources.readers import scale_columns


def game_partials(moments_m: DataFrame, max_gap: float = 0.5, bucket_seconds: float | None = 60.0) -> DataFrame:
    """(game_id, player_id, distance_m) for the games in ``moments_m``."""
    players, _ = split_roles(moments_m)
    players = dedupe_moments(players, [])
    steps = step_distance(players.select(*SEGMENT, "game_clock", "x_loc", "y_loc"), SEGMENT,
                          max_gap=max_gap, bucket_width=bucket_seconds)
    return steps.groupBy("game_id", "player_id").agg(F.sum("dist_m").alias("distance_m"))


def start_distance_stream(spark: SparkSession, moments_dir: str, partials_path: str,
                          checkpoint: str, max_files_per_trigger: int = 8,
                          max_gap: float = 0.5, available_now: bool = True):
    """Start the stream; returns the StreamingQuery.

    ``checkpoint`` belongs to ``partials_path``: a restart with both goes on
    where the last run stopped.  A file whose header does not name the
    columns in their order stops the stream, its values are never misread."""
    src = (spark.readStream.schema(schemas.MOMENTS).option("header", "true").option("enforceSchema", "false")
                .option("maxFilesPerTrigger", max_files_per_trigger).csv(moments_dir))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        m = scale_columns(batch, ["x_loc", "y_loc", "radius"], FEET_TO_METERS)
        (game_partials(m, max_gap).write.mode("overwrite")
            .parquet(f"{partials_path.rstrip('/')}/batch={batch_id}"))

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def distance_from_partials(spark: SparkSession, partials_path: str, minutes: DataFrame,
                           unit_minutes: float = 12) -> DataFrame:
    """Per-player rate from the accumulated per-game partials (same result as
    the batch distance job over the same games)."""
    parts = spark.read.parquet(partials_path)
    dist = parts.groupBy("player_id").agg(F.sum("distance_m").alias("total_distance_m"))
    mins = seconds_on_court(minutes).withColumn("total_minutes", F.col("total_seconds") / 60)
    return (dist.join(mins, "player_id")
                .select("player_id", per_unit_rate("total_distance_m", "total_minutes", unit_minutes)
                        .alias("distance_per_quarter_m")))
