"""Ordered-sequence operators: next row, step length, gaps, forward fill,
first crossing / peak, head-k (W1–W12).

Scale design.  A plain ``Window.partitionBy(entity)`` puts a whole entity's
history in one task.  When one entity holds a large share of all rows that
task becomes the job.  Every sequence operator here therefore accepts
``buckets``: coarse, order-preserving split columns (e.g. ``floor(clock /
60)``).  The window then runs per (entity, bucket), and the one value that
crosses a bucket boundary (the next bucket's first row for ``lead``, the
previous buckets' last non-null value for a forward fill) is computed from
a per-bucket aggregate — one row per bucket — and appended to the bucket as a
sentinel row before the window.  Results are exact; a bucket, not an entity,
bounds the work of a task, and the data is still shuffled only once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.scalar import dist2d

Order = Sequence[tuple[str, bool]]            # (column, ascending)
Buckets = Sequence[tuple[str, Column | None, bool]]  # (name, expression or None, ascending)


def time_buckets(t: str, width: float, ascending: bool = False, name: str = "_tb") -> list:
    """One split column ``floor(t / width)``, ordered like ``t``."""
    return [(name, F.floor(F.col(t) / F.lit(float(width))), ascending)]


def _sort(order: Order) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def _asc_key(order: Order) -> list[Column]:
    """Order columns turned into an ascending key (numeric columns only)."""
    return [(F.col(c) if asc else -F.col(c)).alias(f"_o{i}") for i, (c, asc) in enumerate(order)]


def _add_buckets(df: DataFrame, buckets: Buckets) -> tuple[DataFrame, list[str], list[str]]:
    new = {name: expr for name, expr, _ in buckets if expr is not None}
    return (df.withColumns(new) if new else df), [b[0] for b in buckets], list(new)


def _nulls_like(df: DataFrame, present: dict[str, Column]) -> list[Column]:
    return [(present[f.name] if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in df.schema.fields]


def next_in_sequence(df: DataFrame, keys: Sequence[str], order: Order, carry: Sequence[str],
                     buckets: Buckets | None = None, prefix: str = "next_") -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the following row in
    ``order`` within ``keys`` (null on the last row).
    """
    keys, carry = list(keys), list(carry)
    if not buckets:
        w = Window.partitionBy(*keys).orderBy(*_sort(order))
        return df.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in carry])

    base, bnames, added = _add_buckets(df, buckets)
    # first row of every (entity, bucket).  Order columns that are bucket
    # columns are constant within a bucket; when one order column remains,
    # min_by / max_by pick the row with fixed-width buffers (hash aggregate,
    # no map-side sort); otherwise the minimum of an order struct.
    inner = [(c, asc) for c, asc in order if c not in bnames]
    if len(inner) == 1:
        c0, asc0 = inner[0]
        pick = F.min_by if asc0 else F.max_by
        heads = base.groupBy(*keys, *bnames).agg(
            F.struct(*[pick(F.col(c), F.col(c0)).alias(c) for c in carry]).alias("_h"))
    else:
        heads = base.groupBy(*keys, *bnames).agg(
            F.min(F.struct(*_asc_key(order), *[F.col(c).alias(c) for c in carry])).alias("_h"))
    wb = Window.partitionBy(*keys).orderBy(*_sort([(b, asc) for b, _, asc in buckets]))
    nxt = heads.select(*keys, *bnames, F.lead("_h").over(wb).alias("_h")).filter(F.col("_h").isNotNull())
    # sentinel rows: the next bucket's first row, sorted after every real row
    real = base.withColumn("_sent", F.lit(0))
    present = {k: F.col(k) for k in keys + bnames}
    present.update({c: F.col(f"_h.{c}") for c in carry})
    present["_sent"] = F.lit(1)
    sent = nxt.select(*_nulls_like(real, present))
    w = Window.partitionBy(*keys, *bnames).orderBy(F.col("_sent").asc(), *_sort(order))
    out = (real.unionByName(sent)
               .select("*", *[F.lead(c).over(w).alias(prefix + c) for c in carry])
               .filter(F.col("_sent") == 0))
    return out.drop("_sent", *added)


def next_within(df: DataFrame, keys: Sequence[str], t: str, ascending: bool, carry: Sequence[str],
                horizon: float, width: float, tie_break: Sequence[str] = (), prefix: str = "next_") -> DataFrame:
    """Next row within a time horizon, in one shuffle.

    Rows are windowed per (entity, ``floor(t / width)``).  A row that lies
    within ``horizon`` of the edge its successors come from is also copied
    into the neighbouring bucket, after that bucket's own rows in time order.
    So the last row of a bucket sees its true successor whenever the gap is
    at most ``horizon``: ``prefix + c`` is always either the true successor's
    value or null, and null only when the successor is further than
    ``horizon`` away (or absent).  Copies are a fraction
    ``horizon / width`` of the rows; extra copies (the small safety margin)
    never change a result.  Requires ``horizon <= width``.
    """
    if horizon > width:
        raise ValueError("horizon must not exceed the bucket width")
    keys, carry = list(keys), list(carry)
    w, h = float(width), float(horizon)
    tc = F.col(t)
    # safety margin: a fraction of the bucket plus a few units in the last
    # place of t itself (large absolute times round coarsely); extra copies
    # never change a result
    margin = F.lit(w * 1e-9) + F.abs(tc.cast("double")) * F.lit(1e-14)
    b = F.floor(tc / F.lit(w))
    if ascending:   # successors have larger t: rows near a bucket's lower edge serve the bucket below
        near = F.floor((tc - (F.lit(h) + margin)) / F.lit(w)) < b
        other = b - 1
    else:           # count-down clock: rows near a bucket's upper edge serve the bucket above
        near = F.floor((tc + (F.lit(h) + margin)) / F.lit(w)) > b
        other = b + 1
    # one pass over the input: every row in its own bucket (position 0), a
    # row near the edge also as a copy in the neighbouring bucket (position 1)
    both = df.select("*", F.posexplode(F.when(near, F.array(b, other)).otherwise(F.array(b)))
                           .alias("_copy", "_b"))
    both = both.withColumn("_copy", F.col("_copy") == 1)
    order = [tc.asc() if ascending else tc.desc()] + [F.col(c).asc() for c in tie_break]
    win = Window.partitionBy(*keys, "_b").orderBy(*order)
    out = both.select("*", *[F.lead(c).over(win).alias(prefix + c) for c in carry])
    return out.filter(~F.col("_copy")).drop("_b", "_copy")


def step_distance(df: DataFrame, keys: Sequence[str], t: str = "game_clock", x: str = "x_loc",
                  y: str = "y_loc", max_gap: float | None = 0.5, t_desc: bool = True,
                  buckets: Buckets | None = None, out: str = "dist_m",
                  bucket_width: float | None = None) -> DataFrame:
    """Euclidean step to the next row; 0 when there is no next row or
    the time gap exceeds ``max_gap`` (inclusive ``<=``, gap measured forward
    in time: ``t - t_next`` for a count-down clock).

    With ``bucket_width`` (>= max_gap) the single-shuffle ``next_within``
    is used; with ``buckets`` the sentinel-based ``next_in_sequence``."""
    if bucket_width is not None and max_gap is not None:
        nx = next_within(df, keys, t, not t_desc, [x, y, t], max_gap, max(bucket_width, max_gap))
    else:
        nx = next_in_sequence(df, keys, [(t, not t_desc)], [x, y, t], buckets)
    gap = (F.col(t) - F.col("next_" + t)) if t_desc else (F.col("next_" + t) - F.col(t))
    ok = F.col("next_" + x).isNotNull()
    if max_gap is not None:
        ok = ok & (gap <= F.lit(float(max_gap)))
    step = F.when(ok, dist2d(x, y, "next_" + x, "next_" + y)).otherwise(F.lit(0.0))
    return nx.withColumn(out, step)


def consecutive_gap(df: DataFrame, keys: Sequence[str], t: str = "game_clock", t_desc: bool = True,
                    buckets: Buckets | None = None, out: str = "clock_gap") -> DataFrame:
    """Time to the next row (null on the last row)."""
    nx = next_in_sequence(df, keys, [(t, not t_desc)], [t], buckets)
    gap = (F.col(t) - F.col("next_" + t)) if t_desc else (F.col("next_" + t) - F.col(t))
    return nx.withColumn(out, gap).drop("next_" + t)


def forward_fill(df: DataFrame, keys: Sequence[str], order: Order, value: str, out: str,
                 buckets: Buckets | None = None) -> DataFrame:
    """``out`` = last non-null ``value`` up to and including the current
    row (ROWS UNBOUNDED PRECEDING .. CURRENT ROW)."""
    keys = list(keys)
    if not buckets:
        w = Window.partitionBy(*keys).orderBy(*_sort(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(w))

    base, bnames, added = _add_buckets(df, buckets)
    v = F.col(value)
    last_in_bucket = base.groupBy(*keys, *bnames).agg(
        F.max(F.when(v.isNotNull(), F.struct(*_asc_key(order), v.alias("v")))).alias("_l"))
    wb = (Window.partitionBy(*keys).orderBy(*_sort([(b, asc) for b, _, asc in buckets]))
                .rowsBetween(Window.unboundedPreceding, -1))
    carry_in = last_in_bucket.select(*keys, *bnames,
                                     F.last(F.col("_l.v"), ignorenulls=True).over(wb).alias("_c"))
    carry_in = carry_in.filter(F.col("_c").isNotNull())
    real = base.withColumn("_sent", F.lit(1))
    present = {k: F.col(k) for k in keys + bnames}
    present[value] = F.col("_c")
    present["_sent"] = F.lit(0)
    sent = carry_in.select(*_nulls_like(real, present))
    w = (Window.partitionBy(*keys, *bnames).orderBy(F.col("_sent").asc(), *_sort(order))
               .rowsBetween(Window.unboundedPreceding, 0))
    res = (real.unionByName(sent)
               .withColumn(out, F.last(value, ignorenulls=True).over(w))
               .filter(F.col("_sent") == 1))
    return res.drop("_sent", *added)


def shot_instant(df: DataFrame, keys: Sequence[str], t: str = "game_clock", v: str = "radius",
                 threshold: float = 2.0, carry: Sequence[str] = (), t_desc: bool = True) -> DataFrame:
    """W5–W7 as one aggregate per ``keys`` (partial aggregation, skew safe).

    crossing_clock: the earliest t with v >= threshold (W5) — the largest one
      where the clock counts down (``t_desc``), else the smallest;
    max_height / max_height_clock: peak and the earliest t among peak rows (W6);
    shot_game_clock: crossing, else the peak's clock (W7).
    ``carry`` columns are constant per key and kept with ``first`` semantics
    made deterministic by ``min``.
    """
    earliest = F.max if t_desc else F.min
    at = F.col(t) if t_desc else -F.col(t)
    aggs = [earliest(F.when(F.col(v) >= F.lit(float(threshold)), F.col(t))).alias("crossing_clock"),
            F.max(F.struct(F.col(v).alias("h"), at.alias("t"))).alias("_pk")] + [F.min(c).alias(c) for c in carry]
    out = df.groupBy(*keys).agg(*aggs)
    return (out.withColumn("max_height", F.col("_pk.h"))
               .withColumn("max_height_clock", F.col("_pk.t") if t_desc else -F.col("_pk.t"))
               .withColumn("shot_game_clock", F.coalesce("crossing_clock", "max_height_clock"))
               .drop("_pk"))


def first_crossing(df: DataFrame, keys: Sequence[str], t: str, v: str, threshold: float, t_desc: bool,
                   out: str = "crossing_clock") -> DataFrame:
    """Per ``keys`` the earliest ``t`` at which ``v`` has reached
    ``threshold``; null if it never does."""
    reached = F.when(F.col(v) >= F.lit(float(threshold)), F.col(t))
    return df.groupBy(*keys).agg((F.max if t_desc else F.min)(reached).alias(out))


def head_k(df: DataFrame, keys: Sequence[str], order: Order, k: int, rank_col: str = "rn") -> DataFrame:
    """First k rows per group (``order`` should be a total order).

    ``row_number() <= k`` is planned with a partial WindowGroupLimit before
    the shuffle, so a hot group sends at most k rows per map task."""
    w = Window.partitionBy(*keys).orderBy(*_sort(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
