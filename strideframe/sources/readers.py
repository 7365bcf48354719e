"""Readers (S1, S2, S3, S5).

Tracking data arrives as one delimited file per game (``moments/*.csv``,
``events/*.csv``) or as Parquet.  Schemas are explicit, so no inference pass
runs over the data; headers are lower-cased so mixed-case files line up.
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.scalar import FEET_TO_METERS


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_table(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
               fmt: str = "csv", sep: str = ",", header: bool = True) -> DataFrame:
    """Read one path or glob (``dir/*.csv``) into a DataFrame.

    CSV: the header is matched case-insensitively against ``schema`` by
    lower-casing the file's header first; columns missing in a file come back
    as nulls, extra columns are kept.  Files of a glob may order their columns
    differently: they are grouped by header (``header_groups``) and stacked by
    name.
    """
    if fmt == "parquet":
        df = spark.read.parquet(*([path] if isinstance(path, str) else path))
        df = lower_case_columns(df)
        if schema is not None:
            df = df.select(*[
                (F.col(f.name).cast(f.dataType) if f.name in df.columns
                 else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema.fields
            ])
        return df
    if fmt != "csv":
        return lower_case_columns(spark.read.format(fmt).load(path))
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    if header:
        # every file's header is checked against the columns (case-insensitive):
        # files are grouped by header first, so this only guards against a
        # header that changes between listing and reading
        reader = reader.option("enforceSchema", "false")
    if not header:
        return reader.schema(schema).csv(path) if schema is not None else reader.csv(path)
    groups = header_groups(spark, path, sep)
    frames = []
    for names, files in sorted(groups.items()):
        raw = lower_case_columns(reader.option("inferSchema", "false").csv(files))
        frames.append(raw if schema is None else _conform(raw, schema))
    if not frames:
        raise FileNotFoundError(f"no CSV file matches {path}")
    return union_by_name(frames)


def _conform(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Schema columns by name (case-insensitive; missing -> null), typed with
    ``try_cast``; extra columns kept."""
    cols = []
    for f in schema.fields:
        if f.name in raw.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [F.col(c) for c in raw.columns if c not in schema.fieldNames()]
    return raw.select(*cols, *extra)


def header_groups(spark: SparkSession, path: str | list[str], sep: str = ",") -> dict[tuple, list[str]]:
    """S2 with drifting headers: the files behind ``path`` (globs allowed)
    grouped by their header line (lower-cased column names, in order).

    The first lines are read by tasks, one file each, and grouped by an
    aggregate: a task takes the first row of its file and stops, and what
    reaches the driver is a list of paths per header (a reader's argument).
    Each group is then read by one distributed CSV scan, and the groups are
    stacked by name — so files whose columns come in another order or with
    other columns line up, as a by-name concat would.  Files without any line
    are left out."""
    reader = (spark.read.option("header", "false").option("multiLine", "true")     # a file is not split, and not read on
              .option("sep", "\u0001").option("quote", "").schema("line string"))
    lines = reader.csv(path).select("line", F.col("_metadata.file_path").alias("file"))

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.slice(0, 1)
                return

    names = F.transform(F.split(F.regexp_replace("line", "^\ufeff", ""), re.escape(sep)),
                        lambda x: F.lower(F.regexp_replace(F.trim(x), '^"+|"+$', "")))
    with _one_file_per_task(spark):
        found = lines.mapInArrow(first_lines, "line string, file string").groupBy(names.alias("names")).agg(
            F.collect_list("file").alias("files")).collect()
    return {tuple(r.names): sorted(r.files) for r in found}


@contextlib.contextmanager
def _one_file_per_task(spark: SparkSession) -> Iterator[None]:
    """While a scan is planned here, small files do not share a task."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(1 << 40))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames whose headers drift (missing columns -> null)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def scale_columns(df: DataFrame, cols: Iterable[str], factor: float = FEET_TO_METERS) -> DataFrame:
    """S3: multiply columns by a factor (feet -> metres at load)."""
    return df.withColumns({c: F.col(c) * F.lit(factor) for c in cols})


def read_results(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 sep: str = " ", header: bool = True) -> DataFrame:
    """Re-read a result file written by ``write_single_delimited``."""
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)
