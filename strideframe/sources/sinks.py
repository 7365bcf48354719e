"""Sinks (S4).

``write_single_delimited`` produces one delimited file named ``name`` in
``out_dir`` (the report format: space separated, optional header).  It goes
through the Hadoop FileSystem of the output path, so it works the same on a
local folder, HDFS or an object store.  One file means one writer task: use
it for reports, never for large outputs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def write_single_delimited(df: DataFrame, out_dir: str, name: str, sep: str = " ",
                           header: bool = False) -> str:
    """Write ``df`` as the one file ``out_dir/name`` and return its path.

    The rows are computed in parallel; only the finished result is brought
    together (``repartition(1)``).  An existing file keeps its content until
    the new one is complete: it steps aside under another name, comes back if
    the new one cannot take its place, and goes only when that is done."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(out_dir)
    mark = uuid.uuid4().hex
    target, staging, aside = (hadoop.Path(folder, x) for x in (name, f".{name}.{mark}", f".{name}.{mark}.old"))
    df.repartition(1).write.csv(staging.toString(), sep=sep, header=header)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    (written,) = [f.getPath() for f in files.globStatus(hadoop.Path(staging, "part-*"))]
    try:
        _replace(files, written, target, aside)
    finally:
        files.delete(staging, True)
    return target.toString()


def _rename(files, source, target) -> bool:
    return files.rename(source, target)


def _replace(files, written, target, aside) -> None:
    """Puts ``written`` in the place of ``target``; the old file is kept aside until that is done."""
    had = files.exists(target)
    if had and not _rename(files, target, aside):
        raise OSError(f"{target} could not be set aside")
    moved = False
    try:
        moved = _rename(files, written, target)
    finally:
        if had and not moved and not files.exists(target):
            files.rename(aside, target)
    if not moved:
        raise OSError(f"{target} could not be put in place")
    if had:
        files.delete(aside, False)
