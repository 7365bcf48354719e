"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that define the court and the unit conversion -------------
# Court 94 x 50 ft, baskets at x = 5.25 ft and x = 88.75 ft, y = 25 ft.
# Three-point rule is a plain 6.71 m circle; 25 samples per second.
FEET_TO_METERS = 0.3048
COURT_LENGTH_FT = 94.0
COURT_WIDTH_FT = 50.0
HALF_COURT_M = 94 * 0.3048 / 2
LEFT_BASKET_X_M = 5.25 * 0.3048
RIGHT_BASKET_X_M = 88.75 * 0.3048
BASKET_Y_M = 25.0 * 0.3048
THREE_POINT_RADIUS_M = 6.71
SAMPLES_PER_SECOND = 25
SECONDS_PER_SAMPLE = 1.0 / 25.0
EVENT_MADE = 1
EVENT_MISSED = 2
BALL_ID = -1
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dist2d(x1, y1, x2, y2) -> Column:
    """Planar distance in the ``sqrt(pow + pow)`` form."""
    return F.sqrt(F.pow(_c(x1) - _c(x2), 2) + F.pow(_c(y1) - _c(y2), 2))


def clock_to_seconds(s, strict: bool = True) -> Column:
    """``"M:SS"`` / ``"MM:SS"`` left on the clock -> integer seconds.

    strict: plain split + cast (errors surface under ANSI);
    tolerant: trims and turns anything unparsable into null.
    """
    s = _c(s)
    if strict:
        mm = F.split(s, ":").getItem(0).cast("int")
        ss = F.split(s, ":").getItem(1).cast("int")
        return mm * 60 + ss
    t = F.trim(s)
    parts = F.split(t, ":")
    mm = F.when(F.size(parts) == 2, parts.getItem(0).try_cast("int"))
    ss = F.when(F.size(parts) == 2, parts.getItem(1).try_cast("int"))
    return mm * 60 + ss


def margin_value(s, tie_value: int | None = None, tie: str = "TIE") -> Column:
    """Score margin text -> int; the tie marker -> ``tie_value`` (null unless
    given), other non-numeric text -> null."""
    number = _c(s).try_cast("int")
    if tie_value is None:
        return number
    return F.when(F.upper(F.trim(_c(s))) == tie.upper(), F.lit(tie_value)).otherwise(number)


def nearest_basket_x(x) -> Column:
    """Left basket when on the left half, right basket otherwise."""
    return F.when(_c(x) < F.lit(HALF_COURT_M), F.lit(LEFT_BASKET_X_M)).otherwise(F.lit(RIGHT_BASKET_X_M))


def dist_to_basket(x, y) -> Column:
    return dist2d(x, y, nearest_basket_x(x), F.lit(BASKET_Y_M))


def shot_type(dist, radius: float = THREE_POINT_RADIUS_M) -> Column:
    """E15: '2pt' within the radius (inclusive), '3pt' beyond."""
    return F.when(_c(dist) <= F.lit(radius), F.lit("2pt")).otherwise(F.lit("3pt"))


def min_dist_to_baskets(x, y) -> Column:
    """Distance to the closer of the two baskets."""
    return F.least(dist2d(x, y, F.lit(LEFT_BASKET_X_M), F.lit(BASKET_Y_M)),
                   dist2d(x, y, F.lit(RIGHT_BASKET_X_M), F.lit(BASKET_Y_M)))


def outside_arc(dist, radius: float = THREE_POINT_RADIUS_M) -> Column:
    """True when a shot labelled three-point lies beyond the arc."""
    return _c(dist) > F.lit(radius)


def mirror_to_right_half(x_ft, y_ft, length: float = COURT_LENGTH_FT,
                         width: float = COURT_WIDTH_FT) -> tuple[Column, Column]:
    """Fold points of the left half onto the right half (180° turn)."""
    left = _c(x_ft) < F.lit(length / 2)
    return (F.when(left, F.lit(length) - _c(x_ft)).otherwise(_c(x_ft)),
            F.when(left, F.lit(width) - _c(y_ft)).otherwise(_c(y_ft)))


def to_meters(c) -> Column:
    return _c(c) * F.lit(FEET_TO_METERS)


def to_feet(c) -> Column:
    return _c(c) / F.lit(FEET_TO_METERS)


def guarded_ratio(num, den, digits: int = 2) -> Column:
    """0.0 when the denominator is 0, else round(num/den, digits) (HALF_UP)."""
    return F.when(_c(den) == 0, F.lit(0.0)).otherwise(F.round(F.try_divide(_c(num), _c(den)), digits))


def made_flag(event_type) -> Column:
    """E18."""
    return _c(event_type) == F.lit(EVENT_MADE)


def contains_any(cols, token: str) -> Column:
    """token in any of the text columns; null text counts as False."""
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(_c(c).contains(token), F.lit(False))
    return out


def out_of_range(c, lo: float, hi: float) -> Column:
    """strictly below lo or above hi (null -> False)."""
    return F.coalesce((_c(c) < F.lit(lo)) | (_c(c) > F.lit(hi)), F.lit(False))
