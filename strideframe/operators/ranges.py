"""Operators over range partitions: next row, ranks and quantiles.

``repartitionByRange`` cuts the sorted order of the rows into partitions of
like size, wherever the values lie and whatever key holds them: an entity with
a third of all rows gets a third of the partitions.  What crosses a border is
carried by a table of one row per partition (its first row, or its totals).
No row counts, sketches or limits are needed; the number of partitions is the
session's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.session import reliable_checkpoint

PART = "_part"


def in_ranges(df: DataFrame, by: Sequence[str], name: str = "ranges") -> DataFrame:
    """``df`` range-partitioned and sorted by ``by`` (ascending, nulls first),
    with the number of its partition, written once to the shared folder."""
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return reliable_checkpoint(ranged.withColumn(PART, F.spark_partition_id()), name)


def same_key(a: str, b: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys of two aliased frames."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


# ---------------------------------------------------------------- next row

def next_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str],
                   prefix: str = "next_") -> DataFrame:
    """``prefix + c`` = value of ``c`` on the following row in ``order``
    (ascending, nulls first) within ``keys``; null on the last row of a key.

    One exchange, by range of (keys, order).  Within a partition the sorted
    rows are shifted by one as they stream past; the last row of a partition
    takes its successor from the first row of the next one.  Null keys are a
    key like any other; equal rows follow one another in any order.
    """
    keys, carry, by = list(keys), list(carry), [*keys, *order]
    names = df.columns
    schema = T.StructType([*df.schema.fields, *[T.StructField(prefix + c, df.schema[c].dataType) for c in carry],
                           T.StructField(PART, T.IntegerType()), T.StructField("_head", T.BooleanType()),
                           T.StructField("_tail", T.BooleanType())])

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, head = TaskContext.get().partitionId(), None, True

        def rows(now: pa.RecordBatch, nxt: pa.RecordBatch | None) -> pa.RecordBatch:
            n = now.num_rows
            if nxt is None:
                follow = [pa.nulls(n, now.schema.field(c).type) for c in carry]
            else:
                same = pa.array(np.ones(n, dtype=bool))
                for k in keys:
                    a, b = now.column(k), nxt.column(k)
                    same = pc.and_(same, pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))))
                follow = [pc.if_else(same, nxt.column(c), pa.nulls(n, nxt.schema.field(c).type)) for c in carry]
            marks = [np.full(n, part, dtype=np.int32), (np.arange(n) == 0) & head, np.full(n, nxt is None)]
            return pa.RecordBatch.from_arrays([*now.columns, *follow, *map(pa.array, marks)], names=schema.names)

        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            if b.num_rows > 1:
                yield rows(b.slice(0, b.num_rows - 1), b.slice(1))
                head = False
            held = b.slice(b.num_rows - 1)
        if held is not None:
            yield rows(held, None)

    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by)
    done = reliable_checkpoint(ranged.mapInArrow(shift, schema), "next-rows")
    after = done.filter("_head").select(PART, F.lead(F.struct(*dict.fromkeys([*keys, *carry]))).over(
        Window.orderBy(PART)).alias("_x"))
    tails = done.filter("_tail").alias("t").join(after.alias("h"), F.col(f"t.{PART}") == F.col(f"h.{PART}"), "left")
    goes_on = F.col("h._x").isNotNull()
    for k in keys:
        goes_on = goes_on & F.col(f"t.{k}").eqNullSafe(F.col(f"h._x.{k}"))
    last = tails.select(*[F.col(f"t.{c}").alias(c) for c in names],
                        *[F.when(goes_on, F.col(f"h._x.{c}")).alias(prefix + c) for c in carry])
    return done.filter("NOT _tail").select(*names, *[prefix + c for c in carry]).unionByName(last)


# ---------------------------------------------------------------- quantiles

def quantiles_in_ranges(parts: DataFrame, keys: Sequence[str], probs: Sequence[float], v: str = "v",
                        w: str = "w") -> DataFrame:
    """(keys, p, value): exact quantiles of the weighted values of each key,
    linear between ranks (position p * (n - 1)).

    ``parts``: distinct (keys, v) with weights, from ``in_ranges`` by (keys,
    v).  The totals of (key, partition) give the ranks at which each starts;
    only the partitions in which a wanted rank lies are sorted and counted
    through.  Null values do not count; a key without values has no row.
    """
    keys = list(keys)
    vals = parts.filter(F.col(v).isNotNull())
    totals = vals.groupBy(*keys, PART).agg(F.sum(w).alias("_t"))
    every = Window.partitionBy(*keys)
    upto = every.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    off = totals.withColumns({"_before": F.coalesce(F.sum("_t").over(upto), F.lit(0)), "_n": F.sum("_t").over(every)})
    pos = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    low = [F.floor(x).cast("long") for x in pos]
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), (x - lo).alias("part"), F.lit(side).alias("side"),
                                (lo if side == 0 else F.least(lo + 1, F.col("_n") - 1)).alias("rank"))
                       for p, x, lo in zip(probs, pos, low) for side in (0, 1)])
    inside = lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_t"))
    cells = off.withColumn("_r", F.filter(wanted, inside)).filter(F.size("_r") > 0).select(*keys, PART, "_before", "_r")
    near = vals.alias("a").join(cells.alias("c"), (F.col(f"a.{PART}") == F.col(f"c.{PART}")) & same_key("a", "c", keys)).select(
        *[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{PART}").alias(PART), F.col(f"a.{v}").alias("_v"),
        F.col(f"a.{w}").alias("_w"), "_before", "_r")
    run = Window.partitionBy(*keys, PART).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = near.withColumn("_hi", F.col("_before") + F.sum("_w").over(run))
    hits = F.filter("_r", lambda r: (r["rank"] < F.col("_hi")) & (r["rank"] >= F.col("_hi") - F.col("_w")))
    found = ranked.withColumn("_r", hits).filter(F.size("_r") > 0).select(*keys, "_v", F.explode("_r").alias("_x"))
    at = lambda side: F.max(F.when(F.col("_x.side") == side, F.col("_v")))
    out = found.groupBy(*keys, F.col("_x.p").alias("p")).agg(at(0).alias("_a"), at(1).alias("_b"), F.max("_x.part").alias("_f"))
    return out.select(*keys, "p", (F.col("_a") + F.col("_f") * (F.col("_b") - F.col("_a"))).alias("value"))
