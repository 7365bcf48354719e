"""The jobs from the command line.

    python -m strideframe distance   DATA OUT [--format csv|parquet] [--header] [--master URL]
    python -m strideframe possession DATA OUT ...
    python -m strideframe clutch     DATA OUT ...
    python -m strideframe curry      DATA OUT --player ID ...

DATA holds the tables a job needs: ``moments/*``, ``events/*`` and
``minutes_played*`` (CSV with a header in any case, or Parquet); folders of
other tables need not exist.  The result is one space-separated file in OUT.
Without the three positional arguments the usage is shown and the exit code is
0; an unknown task is an error that names the known ones.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strideframe import schemas
from strideframe.functions.scalar import FEET_TO_METERS
from strideframe.plans import clutch, distance, possession
from strideframe.session import apply_if_unset, cluster_conf
from strideframe.sources.readers import read_table, scale_columns
from strideframe.sources.sinks import write_single_delimited


@dataclass(frozen=True)
class Job:
    """``compute`` gets the ``inputs`` in their order (and the player, if it takes one)."""
    result: str
    inputs: tuple[str, ...]
    compute: Callable[..., DataFrame]
    per_player: bool = False


JOBS = {
    "distance": Job("distance_per_player.csv", ("moments", "minutes"), distance.distance_per_entity),
    "possession": Job("possession_per_player.csv", ("moments", "minutes"), possession.possession_per_entity),
    "clutch": Job("clutch_efficiency.csv", ("moments", "events"), clutch.clutch_efficiency),
    "curry": Job("curry_shot_locations.csv", ("moments", "events"), clutch.shot_locations, per_player=True),
}


def _moments(spark: SparkSession, data: str, fmt: str) -> DataFrame:
    raw = read_table(spark, f"{data}/moments/" + ("*.csv" if fmt == "csv" else "*"), schemas.MOMENTS, fmt)
    return scale_columns(raw, ["x_loc", "y_loc", "radius"], FEET_TO_METERS)


def _events(spark: SparkSession, data: str, fmt: str) -> DataFrame:
    return read_table(spark, f"{data}/events/" + ("*.csv" if fmt == "csv" else "*"), schemas.EVENTS, fmt)


def _minutes(spark: SparkSession, data: str, fmt: str) -> DataFrame:
    return read_table(spark, f"{data}/minutes_played" + (".csv" if fmt == "csv" else ""), schemas.MINUTES, fmt)


LOADERS = {"moments": _moments, "events": _events, "minutes": _minutes}


def parse_task(name: str) -> str:
    task = name.strip().lower()
    if task not in JOBS:
        raise ValueError(f"no task {name!r}; there are {', '.join(JOBS)}")
    return task


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop file system summary)."""
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jp.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(jp).getLength())


def run(spark: SparkSession, task: str, data: str, out: str, fmt: str = "csv", player: int | None = None,
        header: bool = False) -> str:
    """Computes one job from the tables it needs; returns the result file's path."""
    job = JOBS[parse_task(task)]
    if job.per_player and player is None:
        raise ValueError("this task needs a player")
    tables = [LOADERS[name](spark, data.removesuffix("/"), fmt) for name in job.inputs]
    result = job.compute(*tables, *([player] if job.per_player else []))
    return write_single_delimited(result, out.removesuffix("/"), job.result, sep=" ", header=header)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strideframe", description="Jobs over position-tracking tables.")
    ap.add_argument("task", nargs="?", help=" | ".join(JOBS))
    ap.add_argument("data", nargs="?", help="folder of the input tables")
    ap.add_argument("out", nargs="?", help="folder of the result file")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--player", type=int, help="player id, for curry")
    ap.add_argument("--header", action="store_true", help="write column names")
    ap.add_argument("--master", help="Spark master")
    a = ap.parse_args(sys.argv[1:] if argv is None else argv)
    if a.out is None:
        ap.print_help()
        return 0
    if JOBS[parse_task(a.task)].per_player and a.player is None:
        ap.error("--player is required for this task")
    builder = SparkSession.builder.appName(f"strideframe-{a.task}").config("spark.ui.enabled", "false")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    try:
        apply_if_unset(spark, cluster_conf(input_bytes(spark, a.data)))
        print(run(spark, a.task, a.data, a.out, a.format, a.player, a.header))
    finally:
        spark.stop()
    return 0
