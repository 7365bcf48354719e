"""Q3 clutch efficiency and Q4 shot locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions import scalar as S
from strideframe.operators.dedupe import dedupe, split_roles
from strideframe.operators.match import nearest_match
from strideframe.operators.rates import pivot_rates
from strideframe.operators.sequence import forward_fill, shot_instant

# Clutch definition: fourth period or later, at most 300 s left, margin
# within 5 points (all inclusive); shots located at the ball's first rise to
# 2 m (or its peak).  Fixed values of the job, parameters of the functions.
MIN_PERIOD = 4
CLUTCH_SECONDS = 300
CLUTCH_MARGIN = 5
BALL_HEIGHT_M = 2.0
FILL_BUCKET_SECONDS = 1
EVENT_KEY = ["game_id", "event_id", "quarter"]


#: All that a fill looks at, and what the shots carry through it.
FILL_COLUMNS = ["game_id", "eventnum", "period", "player1_id", "eventmsgtype", "game_clock_seconds", "scoremargin"]


def fill_margins(events: DataFrame, bucket_seconds: int | None = FILL_BUCKET_SECONDS,
                 fill_before_filter: bool = False, copies: str = "n_copies") -> DataFrame:
    """``FILL_COLUMNS`` of the shots (made/missed), distinct, with their number
    ``copies`` and ``margin_filled``: last non-null score margin
    within the game in time order (period asc, clock desc, event number asc —
    the event number breaks ties at equal clocks, H2).  As in the reference,
    only shot rows are seen by the fill unless ``fill_before_filter`` (H3).

    The fill runs per (game, period, clock second): a window group holds the
    events of one game-second, and the carry-in table has at most one row per
    period and second of a game, whatever the data volume.  Only the columns
    that decide on a fill are shuffled (no names, no descriptions), and a
    combining aggregate folds equal rows into one with a count, as a row's fill
    depends on its content only: no group of copies passes through a window
    task, and ``expand_copies`` gives every input row back without a join."""
    ev = events.withColumn("game_clock_seconds", S.clock_to_seconds("pctimestring"))
    is_shot = F.col("eventmsgtype").isin(S.EVENT_MADE, S.EVENT_MISSED)
    if not fill_before_filter:
        ev = ev.filter(is_shot)
    order = [("period", True), ("game_clock_seconds", False), ("eventnum", True)]
    buckets = None
    if bucket_seconds:
        buckets = [("period", None, True),
                   ("_cb", F.floor(F.col("game_clock_seconds") / F.lit(bucket_seconds)), False)]
    narrow = ev.groupBy(*FILL_COLUMNS).agg(F.count(F.lit(1)).alias(copies))
    filled = forward_fill(narrow, ["game_id"], order, "scoremargin", "margin_filled", buckets)
    return filled.filter(is_shot) if fill_before_filter else filled


def expand_copies(df: DataFrame, copies: str = "n_copies") -> DataFrame:
    """Each row as often as its number says."""
    return df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop("_i", copies)


def clutch_shots(events: DataFrame, min_period: int = MIN_PERIOD, clutch_seconds: int = CLUTCH_SECONDS,
                 margin: int = CLUTCH_MARGIN, fill_before_filter: bool = False,
                 tie_value: int | None = None) -> DataFrame:
    """The distinct clutch shots (only one of each event is
    located).  ``tie_value`` is the margin that the tie marker stands for (H5:
    without it such rows drop out)."""
    f = fill_margins(events, fill_before_filter=fill_before_filter)
    return (f.filter(F.col("margin_filled").isNotNull())
             .filter(F.col("period") >= min_period)
             .filter(F.col("game_clock_seconds") <= clutch_seconds)
             .filter(F.abs(S.margin_value("margin_filled", tie_value)) <= margin)
             .select(F.col("game_id"), F.col("eventnum").alias("event_id"), F.col("period").alias("quarter"),
                     F.col("player1_id").alias("player_id"), F.col("eventmsgtype").alias("event_type"),
                     F.col("game_clock_seconds")))


def one_shot_per_event(shots: DataFrame) -> DataFrame:
    """One shot per (game, event, quarter), as every ball sample of an event
    belongs to one shot: the smallest by player, then type, then clock (the
    reference keeps any one)."""
    return dedupe(shots, EVENT_KEY, ["player_id", "event_type", "game_clock_seconds"])


def locate_shots(moments: DataFrame, shots: DataFrame, height: float = BALL_HEIGHT_M,
                 player_id: int | None = None) -> DataFrame:
    """The shooter's position at the shot instant, one
    shot per event; with ``player_id`` only that player's shots are located.

    The shot instant per (game, event, quarter) is an aggregate over the
    event's ball rows, combined map-side, so one row per event and task is
    shuffled and joined to the shots.  Moments are not deduped (H11).
    """
    shots = one_shot_per_event(shots)
    if player_id is not None:
        shots = shots.filter(F.col("player_id") == F.lit(player_id))
        moments = moments.filter(F.col("player_id").isin(player_id, S.BALL_ID))
    players, ball = split_roles(moments)
    per_event = shot_instant(ball.select(*EVENT_KEY, "game_clock", "radius"), EVENT_KEY, v="radius", threshold=height)
    inst = per_event.join(shots, EVENT_KEY).select(
        *shots.columns, F.col("shot_game_clock").alias("tracking_game_clock"),
        F.col("max_height").alias("ball_height"))
    on = [(c, c) for c in ["game_id", "event_id", "player_id", "quarter"]]
    loc = nearest_match(inst, players.select("game_id", "event_id", "player_id", "quarter", "game_clock",
                                             "x_loc", "y_loc"),
                        on, "tracking_game_clock", "game_clock", ["x_loc", "y_loc"])
    return loc.drop("clock_diff").withColumnRenamed("game_clock", "m_game_clock")


def classify_shots(located: DataFrame, radius: float = S.THREE_POINT_RADIUS_M) -> DataFrame:
    """Nearest basket by half, distance, 2pt / 3pt."""
    d = S.dist_to_basket("x_loc", "y_loc")
    return (located.withColumn("dist_to_basket", d)
                   .withColumn("shot_type", S.shot_type("dist_to_basket", radius)))


def typed_clutch_shots(moments: DataFrame, events: DataFrame, player_id: int | None = None, **kw) -> DataFrame:
    """Located and typed clutch shots, of one player if given: the other
    players' shots go after the margin fill and the choice of one shot per
    event, before anything is located."""
    return classify_shots(locate_shots(moments, clutch_shots(events, **kw), player_id=player_id))


def clutch_efficiency(moments: DataFrame, events: DataFrame, **kw) -> DataFrame:
    """Q3: per player, 2pt and 3pt success rate and attempts in clutch time."""
    typed = typed_clutch_shots(moments, events, **kw)
    names = {"2pt": ("2pts_efficiency", "nb_2pts_shots", None),
             "3pt": ("3pts_efficiency", "nb_3pts_shots", None)}
    res = pivot_rates(typed, "player_id", "shot_type", ["2pt", "3pt"], S.made_flag("event_type"), names)
    return res.orderBy(F.col("2pts_efficiency").desc(), F.col("player_id"))


def shot_locations(moments: DataFrame, events: DataFrame, player_id: int, **kw) -> DataFrame:
    """Q4: one player's clutch shots with position, type and distance."""
    return typed_clutch_shots(moments, events, player_id, **kw).select(
        "player_id", "event_type", "shot_type", "x_loc", "y_loc", "dist_to_basket", "game_clock_seconds", "game_id")
