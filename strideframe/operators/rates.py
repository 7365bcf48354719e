"""Grouped totals, rates and pivoted success rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions.scalar import SECONDS_PER_SAMPLE, guarded_ratio


def total_per(df: DataFrame, key: str | Sequence[str], value: str, out: str) -> DataFrame:
    """A1: grouped sum (partial + final aggregate)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def ticks_to_seconds(count_col: Column | None = None, seconds_per_tick: float = SECONDS_PER_SAMPLE) -> Column:
    """A2: number of samples x seconds per sample."""
    c = F.count(F.lit(1)) if count_col is None else count_col
    return c * F.lit(seconds_per_tick)


def per_unit_rate(total, minutes, unit_minutes: float = 12, digits: int | None = 2) -> Column:
    """Total * unit / minutes, rounded HALF_UP; null when minutes is 0/null."""
    t = F.col(total) if isinstance(total, str) else total
    m = F.col(minutes) if isinstance(minutes, str) else minutes
    r = F.try_divide(t * F.lit(unit_minutes), m)
    return r if digits is None else F.round(r, digits)


def percent_of(part, whole, digits: int = 2) -> Column:
    """Part / whole * 100, rounded."""
    p = F.col(part) if isinstance(part, str) else part
    w = F.col(whole) if isinstance(whole, str) else whole
    return F.round(F.try_divide(p, w) * F.lit(100), digits)


def pivot_rates(df: DataFrame, key: str, category: str, categories: Sequence[str], success: Column,
                names: dict[str, tuple[str, str, str]] | None = None, digits: int = 2) -> DataFrame:
    """Attempts and successes per (key, category), pivoted on a fixed
    category list, missing cells 0, rate = 0.0 when there are no attempts
    else round(made / attempts).

    With the category list fixed, the pivot is a set of conditional counts
    in one aggregate (``count_if`` per category): one shuffle of partial
    counts, hash aggregation in codegen — instead of an aggregate per
    (key, category) followed by a pivot aggregate.  A key whose rows all fall
    outside the list still appears, with zeros (as with a pivot).

    names maps a category to (rate column, attempts column, made column);
    default ``{cat}_rate``, ``nb_{cat}``, ``nb_{cat}_made``.
    """
    aggs = []
    for i, cat in enumerate(categories):
        is_c = F.col(category) == F.lit(cat)
        aggs += [F.count_if(is_c).alias(f"_s{i}"), F.count_if(is_c & success).alias(f"_m{i}")]
    counts = df.groupBy(key).agg(*aggs)
    cols = [F.col(key)]
    for i, cat in enumerate(categories):
        rate, nb, made = (names or {}).get(cat, (f"{cat}_rate", f"nb_{cat}", f"nb_{cat}_made"))
        cols.append(guarded_ratio(F.col(f"_m{i}"), F.col(f"_s{i}"), digits).alias(rate))
        cols.append(F.col(f"_s{i}").alias(nb))
        if made:
            cols.append(F.col(f"_m{i}").alias(made))
    return counts.select(*cols)
