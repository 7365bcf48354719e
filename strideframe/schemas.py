"""Explicit schemas of the tracking tables (no inference pass over the data).

Column names are lower case; readers lower-case headers on load so that
``PLAYER_ID`` and ``player_id`` resolve to the same column.
"""

from pyspark.sql import types as T

MOMENTS = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("game_clock", T.DoubleType()),
    T.StructField("shot_clock", T.DoubleType()),
    T.StructField("team_id", T.LongType()),
    T.StructField("player_id", T.LongType()),
    T.StructField("x_loc", T.DoubleType()),
    T.StructField("y_loc", T.DoubleType()),
    T.StructField("radius", T.DoubleType()),
])

EVENTS = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("eventnum", T.LongType()),
    T.StructField("eventmsgtype", T.IntegerType()),
    T.StructField("period", T.IntegerType()),
    T.StructField("pctimestring", T.StringType()),
    T.StructField("scoremargin", T.StringType()),
    T.StructField("player1_id", T.LongType()),
    T.StructField("player1_name", T.StringType()),
    T.StructField("homedescription", T.StringType()),
    T.StructField("visitordescription", T.StringType()),
])

MINUTES = T.StructType([
    T.StructField("player_id", T.LongType()),
    T.StructField("sec", T.DoubleType()),
])

DISTANCE_RESULT = T.StructType([
    T.StructField("player_id", T.LongType()),
    T.StructField("distance_per_quarter_m", T.DoubleType()),
])

POSSESSION_RESULT = T.StructType([
    T.StructField("player_id", T.LongType()),
    T.StructField("total_distance_with_ball_possession_m", T.DoubleType()),
    T.StructField("time_ball_possession_s", T.DoubleType()),
    T.StructField("total_time_on_court_s", T.DoubleType()),
    T.StructField("percentage_ball_possession", T.DoubleType()),
])

CLUTCH_RESULT = T.StructType([
    T.StructField("player_id", T.LongType()),
    T.StructField("2pts_efficiency", T.DoubleType()),
    T.StructField("nb_2pts_shots", T.LongType()),
    T.StructField("3pts_efficiency", T.DoubleType()),
    T.StructField("nb_3pts_shots", T.LongType()),
])

SHOT_LOCATIONS_RESULT = T.StructType([
    T.StructField("player_id", T.LongType()),
    T.StructField("event_type", T.IntegerType()),
    T.StructField("shot_type", T.StringType()),
    T.StructField("x_loc", T.DoubleType()),
    T.StructField("y_loc", T.DoubleType()),
    T.StructField("dist_to_basket", T.DoubleType()),
    T.StructField("game_clock_seconds", T.IntegerType()),
    T.StructField("game_id", T.LongType()),
])

TABLES = {"moments": MOMENTS, "events": EVENTS, "minutes_played": MINUTES}
