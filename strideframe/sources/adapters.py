"""Driver tables -> tracking tables.

The driver ships TPC-H-like Parquet tables, not court data.  These views map
them onto the tracking schemas so every job runs on the whole of the given
tables (no id subsets): lineitem -> moments, orders -> play-by-play events,
customer -> minutes played (account balance / 1000 as seconds, so a
player has game-like minutes).  Keys are chosen so that (game_id, event_id) is
unique per order and moments of an order carry that order's event key, which
makes the event <-> moment joins meaningful.

``*_SQL`` strings are the same mapping written for DuckDB; the oracle
queries in ``strideframe.plans.oracle`` are built on top of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.sources.readers import scale_columns

EPOCH = "1995-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(c: str):
    return F.datediff(F.to_date(F.col(c)), F.lit(EPOCH).cast("date"))


def moments_feet(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") % 10).alias("game_id"),
        F.expr("l_orderkey div 10").alias("event_id"),
        F.expr("1 + (l_orderkey div 10) % 5").cast("int").alias("quarter"),
        (_days("l_shipdate") % 721).cast("double").alias("game_clock"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("double"))
         .otherwise(F.col("l_extendedprice") % 25).alias("shot_clock"),
        (F.col("l_suppkey") % 2).alias("team_id"),
        (F.col("l_partkey") % 11 - 1).alias("player_id"),
        (F.col("l_quantity") * 94 / 50).alias("x_loc"),
        (F.col("l_discount") * 500).alias("y_loc"),
        (F.col("l_tax") * 100).alias("radius"),
    )


def moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments in metres (x, y, radius scaled at load, as the jobs expect)."""
    return scale_columns(moments_feet(spark, sf_dir), ["x_loc", "y_loc", "radius"])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    clock = _days("o_orderdate") % 721
    margin = F.floor(F.col("o_totalprice")).cast("bigint") % 13 - 6
    desc = F.concat(F.col("o_orderpriority"),
                    F.when(F.col("o_custkey") % 3 == 0, F.lit(" 3PT Jump Shot"))
                     .otherwise(F.lit(" Driving Layup")))
    home = F.col("o_orderkey") % 2 == 0
    return o.select(
        (F.col("o_orderkey") % 10).alias("game_id"),
        F.expr("o_orderkey div 10").alias("eventnum"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
         .otherwise(3).cast("int").alias("eventmsgtype"),
        F.expr("1 + (o_orderkey div 10) % 5").cast("int").alias("period"),
        F.concat((clock / 60).cast("bigint").cast("string"), F.lit(":"),
                 F.lpad((clock % 60).cast("string"), 2, "0")).alias("pctimestring"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string"))
         .when(margin == 0, F.lit("TIE"))
         .otherwise(margin.cast("string")).alias("scoremargin"),
        (F.col("o_custkey") % 10).alias("player1_id"),
        F.concat(F.lit("player_"), (F.col("o_custkey") % 10).cast("string")).alias("player1_name"),
        F.when(home, desc).alias("homedescription"),
        F.when(~home, desc).alias("visitordescription"),
    )


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select((F.col("c_custkey") % 10).alias("player_id"),
                    (F.abs(F.col("c_acctbal")) / 1000).alias("sec"))


# --- the same views for DuckDB (oracle side) --------------------------------

MOMENTS_FEET_SQL = """
SELECT l_orderkey % 10 AS game_id,
       l_orderkey // 10 AS event_id,
       CAST(1 + (l_orderkey // 10) % 5 AS INTEGER) AS quarter,
       CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 721 AS DOUBLE) AS game_clock,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_extendedprice % 25 END AS shot_clock,
       l_suppkey % 2 AS team_id,
       l_partkey % 11 - 1 AS player_id,
       l_quantity * 94 / 50 AS x_loc,
       l_discount * 500 AS y_loc,
       l_tax * 100 AS radius
FROM lineitem
"""

MOMENTS_SQL = f"""
SELECT game_id, event_id, quarter, game_clock, shot_clock, team_id, player_id,
       x_loc * 0.3048 AS x_loc, y_loc * 0.3048 AS y_loc, radius * 0.3048 AS radius
FROM ({MOMENTS_FEET_SQL}) mf
"""

EVENTS_SQL = """
SELECT o_orderkey % 10 AS game_id,
       o_orderkey // 10 AS eventnum,
       CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS INTEGER) AS eventmsgtype,
       CAST(1 + (o_orderkey // 10) % 5 AS INTEGER) AS period,
       CAST(clk // 60 AS VARCHAR) || ':' || lpad(CAST(clk % 60 AS VARCHAR), 2, '0') AS pctimestring,
       CASE WHEN o_orderstatus = 'O' THEN NULL
            WHEN mrg = 0 THEN 'TIE'
            ELSE CAST(mrg AS VARCHAR) END AS scoremargin,
       o_custkey % 10 AS player1_id,
       'player_' || CAST(o_custkey % 10 AS VARCHAR) AS player1_name,
       CASE WHEN o_orderkey % 2 = 0 THEN dsc END AS homedescription,
       CASE WHEN o_orderkey % 2 <> 0 THEN dsc END AS visitordescription
FROM (SELECT *,
             date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 721 AS clk,
             CAST(floor(o_totalprice) AS BIGINT) % 13 - 6 AS mrg,
             o_orderpriority || CASE WHEN o_custkey % 3 = 0 THEN ' 3PT Jump Shot'
                                     ELSE ' Driving Layup' END AS dsc
      FROM orders) o
"""

MINUTES_SQL = """
SELECT c_custkey % 10 AS player_id, abs(c_acctbal) / 1000 AS sec FROM customer
"""


def with_views(sql_body: str) -> str:
    """Prefix a DuckDB query with the adapter views as CTEs."""
    return (f"WITH moments AS ({MOMENTS_SQL}), moments_feet AS ({MOMENTS_FEET_SQL}), "
            f"events_pbp AS ({EVENTS_SQL}), minutes_played AS ({MINUTES_SQL})\n{sql_body}")
