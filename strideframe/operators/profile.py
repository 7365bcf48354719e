"""Data-quality and distribution operators.

All of them are aggregates with map-side combine; exact quantiles rank
sorted range partitions by their totals.  Where histogram edges come from the
data, two numbers per histogram reach the driver, never the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.operators.ranges import in_ranges, quantiles_in_ranges, same_key
from strideframe.session import reliable_checkpoint


def _w(weight) -> Column:
    if weight is None:
        return F.lit(1).cast("bigint")
    return F.col(weight) if isinstance(weight, str) else weight


# ---------------------------------------------------------------- counting

def summary_from_counts(vc: DataFrame, cuts: Sequence[tuple[str, str, float]] = ()) -> DataFrame:
    """n, mean, min, max and counts per cut-off from a (v, w) table."""
    v, w = F.col("v"), F.col("w")
    ops = {"<=": v.__le__, "<": v.__lt__, ">": v.__gt__, ">=": v.__ge__}
    return vc.agg(F.sum(w).alias("n"), (F.sum(v * w) / F.sum(w)).alias("mean"), F.min(v).alias("min"),
                  F.max(v).alias("max"),
                  *[F.sum(F.when(ops[op](F.lit(val)), w).otherwise(0)).alias(f"n_{name}") for name, op, val in cuts])


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Frequency per value (sorted by frequency desc, value asc)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), F.col(col))


def count_of_counts(df: DataFrame, keys: Sequence[str], size_col: str = "rows_per_key",
                    out: str = "n_keys") -> DataFrame:
    """Distribution of group sizes (how many keys have n rows)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(size_col))
    return sizes.groupBy(size_col).agg(F.count(F.lit(1)).alias(out))


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, rows beyond the first per key."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
                   (F.sum("_n") - F.count(F.lit(1))).alias("n_duplicates"))


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values in ascending order."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def threshold_counts(df: DataFrame, col: str, cuts: Sequence[tuple[str, str, float]],
                     weight=None) -> DataFrame:
    """Counts and shares of rows under/over cut-offs in one aggregate.

    cuts: (name, op, value) with op in ``<=, <, >, >=``; output columns
    ``n_<name>`` and ``share_<name>`` (share of non-null values)."""
    v, w = F.col(col), _w(weight)
    ops = {"<=": v.__le__, "<": v.__lt__, ">": v.__gt__, ">=": v.__ge__}
    aggs = [F.sum(F.when(v.isNotNull(), w).otherwise(0)).alias("n_values")]
    for name, op, val in cuts:
        aggs.append(F.sum(F.when(ops[op](F.lit(val)), w).otherwise(0)).alias(f"n_{name}"))
    out = df.agg(*aggs)
    return out.select("n_values", *[c for name, _, _ in cuts for c in (
        F.col(f"n_{name}"), F.try_divide(F.col(f"n_{name}"), F.col("n_values")).alias(f"share_{name}"))])


# ---------------------------------------------------------------- quantiles

def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], weight=None) -> DataFrame:
    """Exact quantiles with linear interpolation (pos = p * (n - 1)),
    one row ``(p, value)`` per probability.

    Values are first reduced to (value, count) with a combining aggregate and
    then ranked by the totals of sorted range partitions
    (``quantiles_in_ranges``).  No task ever holds all values.  Optional
    ``weight`` counts a row that many times.
    """
    return quantiles_from_counts(value_weights(df, col, weight), probs, col)


def value_weights(df: DataFrame, col: str, weight=None) -> DataFrame:
    """(v, w): distinct non-null values of ``col`` with their total weight —
    a combining aggregate, bounded by the number of distinct values (which
    can approach the row count for measured doubles) — in sorted ranges,
    written once to the shared checkpoint folder: the quantile and summary
    steps neither replay the upstream pipeline nor depend on any executor's
    cached blocks."""
    vals = df.select(F.col(col).cast("double").alias("v"), _w(weight).alias("w")).filter(F.col("v").isNotNull())
    return in_ranges(vals.groupBy("v").agg(F.sum("w").alias("w")).filter(F.col("w") > 0), ["v"], "value-weights")


def quantiles_from_counts(vc: DataFrame, probs: Sequence[float], col: str = "v") -> DataFrame:
    """Exact quantiles from a table of ``value_weights``."""
    return quantiles_in_ranges(vc, [], probs).withColumnRenamed("value", col)


QUARTILES = [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, std (sample), min, 25/50/75 %, max per column, one
    row per column, and per group of the columns ``by`` if given.

    The cells are unpivoted to (group, column, value, weight), one combining
    aggregate over one run of the upstream pipeline, and written once in
    sorted ranges; all statistics of all columns and groups are read from
    there.  The standard deviation is taken about the mean (numerically
    stable).  Nulls do not count; a column without values has a row with count
    0 (without ``by`` for an empty table too).  Groups may be null.
    """
    by = list(by)
    keys = [*by, "column"]
    cell = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_c")
    cells = df.select(*by, cell).select(*by, "_c.column", "_c.v").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("w"))
    parts = in_ranges(cells, [*keys, "v"], "describe")
    v, w = F.col("v"), F.when(F.col("v").isNotNull(), F.col("w"))
    base = parts.groupBy(*keys).agg(F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias("count"),
                                    (F.sum(v * w) / F.sum(w)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    means = base.select(*keys, F.col("mean").alias("_m"))
    dev = parts.filter(v.isNotNull()).alias("a").join(means.alias("m"), same_key("a", "m", keys)).groupBy(
        *[F.col(f"a.{k}").alias(k) for k in keys]).agg(F.sum(F.col("w") * F.pow(F.col("v") - F.col("_m"), 2)).alias("_d"))
    q = quantiles_in_ranges(parts, keys, [p for p, _ in QUARTILES]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for p, name in QUARTILES])
    out = base.alias("b").join(dev.alias("d"), same_key("b", "d", keys), "left").join(
        q.alias("q"), same_key("b", "q", keys), "left").select(
        *[F.col(f"b.{k}").alias(k) for k in keys], "count", "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("_d") / (F.col("count") - 1))).alias("std"), "min",
        *[name for _, name in QUARTILES], "max")
    if by:
        return out
    named = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
    return named.join(out, "column", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))


# ---------------------------------------------------------------- histogram

@dataclass(frozen=True)
class Histogram:
    """Equal-width bins of ``value`` over [lo, hi] (default: the least and the
    largest kept value; all-equal data gets [v - 0.5, v + 0.5]), the last one
    closed on the right.  Only rows for which ``keep`` holds count; values are
    cut off at ``clip_upper`` first (E10)."""

    name: str
    value: Column
    bins: int
    keep: Column | None = None
    lo: float | None = None
    hi: float | None = None
    clip_upper: float | None = None

    def cell(self) -> Column:
        v = self.value.cast("double")
        if self.clip_upper is not None:
            # least() skips nulls; a null must stay null, not become the clip value
            v = F.when(v.isNotNull(), F.least(v, F.lit(float(self.clip_upper))))
        return v if self.keep is None else F.when(self.keep, v)


def histograms(df: DataFrame, specs: Sequence[Histogram], weight=None) -> DataFrame:
    """Several histograms of one table, each with its own filter and
    edges, in one count by (histogram, bin).  Every bin has a row (empty ones
    with count 0): histogram, bin, bin_lo, bin_hi, count.

    Where edges come from the data, the table is reduced to (histogram, value,
    weight) in one run and written once; least and largest values and all
    counts are read from there.  Null values do not count; without any kept
    value the edges are null.
    """
    spark = df.sparkSession
    cell = F.explode(F.array(*[F.struct(F.lit(i).alias("h"), s.cell().alias("v")) for i, s in enumerate(specs)]))
    vals = df.select(cell.alias("c"), _w(weight).alias("w")).select("c.h", "c.v", "w").filter(F.col("v").isNotNull())
    edges = {i: (s.lo, s.hi) for i, s in enumerate(specs)}
    if any(x is None for e in edges.values() for x in e):
        vals = reliable_checkpoint(vals.groupBy("h", "v").agg(F.sum("w").alias("w")), "histogram-values")
        met = {r.h: (r.lo, r.hi) for r in vals.groupBy("h").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
        edges = {i: tuple(met.get(i, (None, None))[k] if e[k] is None else e[k] for k in (0, 1)) for i, e in edges.items()}
    table = []
    for i, s in enumerate(specs):
        lo, hi = edges[i]
        if lo is not None and lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        table.append(F.struct(F.lit(i).alias("h"), F.lit(s.name).alias("histogram"), F.lit(s.bins).alias("n"),
                              F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi")))
    named = spark.range(1).select(F.explode(F.array(*table)).alias("s")).select("s.*")      # a row per histogram
    share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    bin_ = F.least(F.floor(share * F.col("n")), F.col("n") - 1).cast("int").alias("bin")
    counts = vals.join(F.broadcast(named.drop("histogram")), "h").filter("v >= lo AND v <= hi").groupBy(
        "h", bin_).agg(F.sum("w").cast("bigint").alias("count"))
    width = (F.col("hi") - F.col("lo")) / F.col("n")
    bins = named.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return bins.join(counts, ["h", "bin"], "left").select(
        "histogram", "bin", (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"))


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None,
              clip_upper: float | None = None, weight=None) -> DataFrame:
    """One histogram of a column: bin, bin_lo, bin_hi, count."""
    one = Histogram(col, F.col(col), bins, lo=lo, hi=hi, clip_upper=clip_upper)
    return histograms(df, [one], weight).drop("histogram")


# ---------------------------------------------------------------- profile

def profile(df: DataFrame, table: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Q5 (A10, A17, A18): per column — type, non-null and null counts, null
    percent (1 decimal), distinct values, and a deterministic sample (the
    smallest value).

    Exact: values are unpivoted to (column, value) and reduced per distinct
    pair map-side, so a hot value costs nothing; the shuffle carries every
    distinct (column, value) pair.  ``approx=True`` replaces the distinct
    count with a HyperLogLog++ sketch per column (relative error ``rsd``):
    one aggregate over the table, partial sketches combined map-side, one
    row out — the choice for very large, high-cardinality tables."""
    fields = df.schema.fields
    if approx:
        aggs = [F.count(F.lit(1)).alias("_rows")]
        for i, f in enumerate(fields):
            c = F.col(f"`{f.name}`")
            aggs += [F.count(c).alias(f"_nn{i}"), F.approx_count_distinct(c, rsd).alias(f"_nd{i}"),
                     F.min(c).cast("string").alias(f"_mn{i}")]
        one = df.agg(*aggs)
        per = one.select(F.explode(F.array(*[
            F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("ordinal"),
                     F.lit(f.dataType.simpleString()).alias("dtype"), F.col("_rows").alias("rows"),
                     F.col(f"_nn{i}").alias("non_null"), F.col(f"_nd{i}").alias("nunique"),
                     F.col(f"_mn{i}").alias("sample"))
            for i, f in enumerate(fields)])).alias("p")).select("p.*")
        return per.select(F.lit(table).alias("table_name"), "column", "ordinal", "dtype", "rows", "non_null",
                          (F.col("rows") - F.col("non_null")).alias("nulls"),
                          F.round(F.try_divide(F.col("rows") - F.col("non_null"), F.col("rows")) * 100, 1)
                          .alias("null_pct"),
                          "nunique", "sample")
    cells = F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 F.lit(i).alias("ordinal"), F.col(f"`{f.name}`").cast("string").alias("value"))
        for i, f in enumerate(fields)]))
    pairs = (df.select(cells.alias("c")).select("c.*")
               .groupBy("column", "dtype", "ordinal", "value").agg(F.count(F.lit(1)).alias("n")))
    per = pairs.groupBy("column", "dtype", "ordinal").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
        F.count("value").alias("nunique"))
    mins = df.agg(*[F.min(F.col(f"`{f.name}`")).cast("string").alias(f.name) for f in fields])
    sample = mins.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("sample")) for f in fields])).alias("s")
    ).select("s.*")
    return (per.join(F.broadcast(sample), "column", "left")
               .select(F.lit(table).alias("table_name"), "column", "ordinal", "dtype", "rows", "non_null",
                       (F.col("rows") - F.col("non_null")).alias("nulls"),
                       F.round(F.try_divide(F.col("rows") - F.col("non_null"), F.col("rows")) * 100, 1)
                       .alias("null_pct"),
                       "nunique", "sample"))
