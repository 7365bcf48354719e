"""Matching joins: nearest-in-time (J6), nearest within a tolerance band
(J7), semi / anti joins by key set (J8, J9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.operators.ranges import PART, in_ranges


def nearest_match(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_t: str,
                  right_t: str, right_cols: Sequence[str], later_first: bool = True,
                  tolerance: float | None = None, diff_col: str = "clock_diff",
                  bucket_width: float | None = 60.0) -> DataFrame:
    """J6/J7 as-of match: for every ``left`` row, the ``right`` row with equal
    keys and the smallest ``abs(right_t - left_t)``; ties go to the larger
    ``right_t`` (earlier on a count-down clock) when ``later_first``, then to
    the smaller ``right_cols`` values.  Left rows without a candidate (or
    with a null key or time) are dropped (inner semantics); every other left
    row, copies included, gives its own result row.  With ``tolerance`` the match must lie within
    ``abs(diff) <= tolerance`` — the nearest row overall, kept only when it is
    that close, which is the nearest row inside the band.

    Sort-based, no pairs: both sides are unioned and sorted by (key, time) in
    range partitions, so neither the clock's unit nor a hot key matters: a
    key with many rows takes many partitions.  In this order the last right
    row before a left row is its only candidate on that side (none, if it has
    another key), and so is the first one after it.  Within a partition they
    come from two growing-frame windows (``last`` ignoring nulls, one in each
    direction); across borders from a table with one row per partition, its
    first and last right row, scanned in both directions.  With a tolerance
    band no wider than ``bucket_width`` the rows are sorted within (key, time
    bucket) instead, and right rows near a bucket edge are copied into the
    neighbouring bucket (one exchange, nothing carried).  The work is linear
    in the rows; nothing is built per pair.

    Both sides are first reduced with combining aggregates — right rows to
    one per (key, time), left rows to distinct rows with their number — so a
    group of copies on either side never reaches a window partition whole, and
    every left row with a match gives a result row.  Right rows whose key the
    left side does not have are filtered out by a semi join with its distinct
    keys, which adaptive execution broadcasts when they are measured small;
    else it splits a hot key's rows, as another exchange follows.
    """
    right_cols = list(right_cols)
    lcols = left.columns
    keys = [lc for lc, _ in on]
    r_t_type = right.schema[right_t].dataType
    r = right.select(*[F.col(rc).alias(lc) for lc, rc in on], F.col(right_t).alias("_t"),
                     *[F.col(c) for c in right_cols if c != right_t])
    r = r.join(left.select(*keys).distinct(), keys, "left_semi")
    valid = F.col("_t").isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    extra = [c for c in right_cols if c != right_t]

    def tie_key(prefix: str = "") -> Column:
        return F.struct(*[F.col(prefix + c).alias(c) for c in extra]) if extra else F.struct(F.lit(0).alias("_z"))

    rstruct = F.struct(F.col("_t").alias("t"), *[F.col(c) for c in extra])
    # identical left rows are matched once and given out again as often
    counted = left.groupBy(*lcols).agg(F.count("*").cast("int").alias("_n"))
    # Right rows at the same (key, time) can only ever contribute their
    # smallest payload, so they are reduced to that row first: a combining
    # aggregate that collapses any group of copies map-side, before a single
    # row of it is shuffled into the windows.
    best_r = (r.filter(valid).groupBy(*keys, "_t")
               .agg(F.min(F.struct(tie_key().alias("rk"), rstruct.alias("r"))).alias("_m")))
    rows_r = best_r.select(*keys, "_t", F.lit(0).alias("_side"), F.col("_m.r").alias("_r"),
                           F.col("_m.rk").alias("_rk"),
                           F.lit(None).cast(counted.select(F.struct(*lcols, "_n")).schema[0].dataType).alias("_l"))
    lsel = counted.select(*keys, F.col(left_t).alias("_t"), F.struct(*lcols, "_n").alias("_l"))
    rows_l = lsel.filter(valid).select(*keys, "_t", F.lit(1).alias("_side"),
                                       F.lit(None).cast(rows_r.schema["_r"].dataType).alias("_r"),
                                       F.lit(None).cast(rows_r.schema["_rk"].dataType).alias("_rk"), "_l")
    part = list(keys)
    band = tolerance is not None and bucket_width and float(tolerance) <= float(bucket_width)
    if band:
        # every candidate inside the band lies in the left row's bucket or a
        # neighbour: right rows within the band of a bucket edge are copied
        # into the neighbouring bucket (one pass, posexplode) — exact, with no
        # per-bucket aggregate or carried rows
        w, tol = float(bucket_width), float(tolerance)
        # margin: a fraction of the bucket plus a few units in the last place
        # of the time itself; extra copies never change a result
        reach = F.lit(tol) + F.lit(w * 1e-9) + F.abs(F.col("_t").cast("double")) * F.lit(1e-14)
        b = F.floor(F.col("_t") / F.lit(w))
        lo = F.when(F.floor((F.col("_t") - reach) / F.lit(w)) < b, F.array(b - 1)) \
              .otherwise(F.array().cast("array<bigint>"))
        hi = F.when(F.floor((F.col("_t") + reach) / F.lit(w)) > b, F.array(b + 1)) \
              .otherwise(F.array().cast("array<bigint>"))
        rows_r = rows_r.withColumn("_b", F.explode(F.concat(F.array(b), lo, hi)))
        rows_l = rows_l.withColumn("_b", b)
        part.append("_b")
    both = rows_r.unionByName(rows_l)
    grow = (Window.unboundedPreceding, 0)
    if band:
        tail = [F.col("_side").asc(), F.col("_rk").desc(), F.col("_l").asc()]
        fwd = Window.partitionBy(*part).orderBy(F.col("_t").asc(), *tail)
        bwd = Window.partitionBy(*part).orderBy(F.col("_t").desc(), *tail)
        picked = both.select(
            "_side", "_t", "_l", F.last("_r", ignorenulls=True).over(fwd.rowsBetween(*grow)).alias("_p"),
            F.last("_r", ignorenulls=True).over(bwd.rowsBetween(*grow)).alias("_n")).filter(F.col("_side") == 1)
    else:
        picked = _around(both, keys)
    dp, dn = F.abs(F.col("_p.t") - F.col("_t")), F.abs(F.col("_n.t") - F.col("_t"))
    take_next = F.col("_p").isNull() | (F.col("_n").isNotNull() & (
        (dn < dp) | ((dn == dp) & F.lit(bool(later_first)))))
    best = F.when(take_next, F.col("_n")).otherwise(F.col("_p"))
    out = picked.select("_t", "_l", best.alias("_m")).filter(F.col("_m").isNotNull()) \
                .withColumn("_d", F.abs(F.col("_m.t") - F.col("_t")))
    if tolerance is not None:
        out = out.filter(F.col("_d") <= F.lit(float(tolerance)))
    out = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_l._n"))))
    return out.select(*[F.col(f"_l.{c}").alias(c) for c in lcols],
                      F.col("_m.t").cast(r_t_type).alias(right_t), F.col("_d").alias(diff_col),
                      *[F.col(f"_m.{c}").alias(c) for c in extra])


def semi_join(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys_df`` (no duplication).

    The key side is reduced to distinct keys first (a combining aggregate),
    so a key repeated many times on that side reaches the join as one row;
    a hot key on ``df``'s side is split by AQE's skew handling (the left side
    of a semi join may be split).  A small key set is broadcast by AQE from
    its measured size."""
    return df.join(keys_df.select(*on).distinct(), list(on), "left_semi")


def anti_join(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``keys_df`` (key side reduced
    to distinct keys first, as in ``semi_join``)."""
    return df.join(keys_df.select(*on).distinct(), list(on), "left_anti")


def _around(both: DataFrame, keys: list[str]) -> DataFrame:
    """(_t, _l, _p, _n): each left row (``_side`` 1) with the last right row
    before and the first one after it in the order of (keys, _t, _side), if
    they have its keys."""
    order = [*keys, "_t", "_side", "_h"]        # the hash splits left rows of one key and time
    both = both.withColumn("_h", F.when(F.col("_side") == 1, F.xxhash64("_l")))
    rows = in_ranges(both.withColumn("_c", F.when(F.col("_side") == 0, F.struct(*keys, "_r"))).drop("_r", "_rk"), order, "match")
    back = [F.col(c).desc() for c in order]
    grow = (Window.unboundedPreceding, 0)
    near = rows.select(PART, "_side", "_t", "_l", *keys,
                       F.last("_c", ignorenulls=True).over(Window.partitionBy(PART).orderBy(*order).rowsBetween(*grow)).alias("_b"),
                       F.last("_c", ignorenulls=True).over(Window.partitionBy(PART).orderBy(*back).rowsBetween(*grow)).alias("_a"))
    # one row per partition: its first and last right row, then those of the partitions around it
    ends = rows.groupBy(PART).agg(
        F.max(F.when(F.col("_side") == 0, F.struct(*order, "_c"))).alias("_hi"),
        F.min(F.when(F.col("_side") == 0, F.struct(*order, "_c"))).alias("_lo"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(PART, F.last(F.col("_hi._c"), ignorenulls=True).over(before).alias("_eb"),
                       F.last(F.col("_lo._c"), ignorenulls=True).over(after).alias("_ea"))
    met = near.filter(F.col("_side") == 1).join(ends, PART).withColumns(
        {"_b": F.coalesce("_b", "_eb"), "_a": F.coalesce("_a", "_ea")})

    def own(c: str) -> Column:
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(f"{c}.{k}") == F.col(k))
        return F.when(same, F.col(f"{c}._r"))

    return met.select("_t", "_l", own("_b").alias("_p"), own("_a").alias("_n"))
