"""The driver's TPC-H-like tables seen as the match warehouse star schema.

Each star table is a projection of one driver table, so its size grows with
the driver data and every query over it reads the whole table:

=================  ==========  ==================================================
star table         driver      mapping
=================  ==========  ==================================================
Country            region      r_regionkey -> id, r_name -> name
League             nation      n_nationkey -> id, n_regionkey -> country_id
Team               supplier    s_suppkey -> id and team_api_id
Team_Attributes    part        p_partkey -> id, p_partkey % 10 -> team ids
Player             customer    c_custkey -> id, player_api_id, player_fifa_api_id
Player_Attributes  events      event_id -> id, user_id -> player ids, ts -> date
Match              orders      o_orderkey -> id and match_api_id, see below
=================  ==========  ==================================================

Match derives league, teams and goals from order columns.  ``o_custkey % 30``
gives a league id of which 25..29 have no League row (so the inner join drops
matches), ``o_custkey % 7`` a country id of which 5 and 6 are orphans, and the
home goal is NULL whenever ``floor(o_totalprice) % 6`` is 5 (missing scores on
purpose).  Home and away team are never equal: ``(h + 1 + o_custkey % 9) % 10``.

The same projections are written in DuckDB SQL in ``matchlake.oracle`` for the
correctness check; keep both sides in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
]


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _long(name: str) -> Column:
    return F.col(name).cast("bigint")


def _text_time(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "region").select(
        _long("r_regionkey").alias("id"), F.col("r_name").alias("name")
    )


def league(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "nation").select(
        _long("n_nationkey").alias("id"),
        _long("n_regionkey").alias("country_id"),
        F.col("n_name").alias("name"),
    )


def team(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "supplier").select(
        _long("s_suppkey").alias("id"),
        _long("s_suppkey").alias("team_api_id"),
        F.col("s_nationkey").cast("double").alias("team_fifa_api_id"),
        F.col("s_name").alias("team_long_name"),
        F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("team_short_name"),
    )


def player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "customer").select(
        _long("c_custkey").alias("id"),
        _long("c_custkey").alias("player_api_id"),
        F.col("c_name").alias("player_name"),
        _long("c_custkey").alias("player_fifa_api_id"),
        F.lit(None).cast("string").alias("birthday"),
        (F.lit(150) + F.lit(2) * F.col("c_nationkey")).cast("double").alias("height"),
        F.col("c_acctbal").alias("weight"),
    )


def player_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "events").select(
        _long("event_id").alias("id"),
        _long("user_id").alias("player_fifa_api_id"),
        _long("user_id").alias("player_api_id"),
        _text_time(F.col("ts")).alias("date"),
        F.col("value").alias("overall_rating"),
        (F.col("value") + F.lit(1.0)).alias("potential"),
        F.col("event_type").alias("preferred_foot"),
        F.col("props").alias("attacking_work_rate"),
    )


def team_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated team style ratings; the team is ``p_partkey % 10`` (teams 0..9
    exist at every scale), ratings and classes come from part columns."""
    team_key = (F.col("p_partkey") % 10).cast("bigint")
    return driver_table(spark, sf_dir, "part").select(
        _long("p_partkey").alias("id"),
        team_key.alias("team_fifa_api_id"),
        team_key.alias("team_api_id"),
        F.lit(None).cast("string").alias("date"),
        F.col("p_size").cast("double").alias("buildUpPlaySpeed"),
        F.col("p_brand").alias("buildUpPlaySpeedClass"),
        F.col("p_retailprice").alias("buildUpPlayPassing"),
        F.col("p_type").alias("buildUpPlayPassingClass"),
    )


def match(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    home = F.col("o_orderkey") % 10
    return o.select(
        _long("o_orderkey").alias("id"),
        (F.col("o_custkey") % 7).cast("bigint").alias("country_id"),
        (F.col("o_custkey") % 30).cast("bigint").alias("league_id"),
        F.concat(year.cast("string"), F.lit("/"), (year + 1).cast("string")).alias("season"),
        F.month("o_orderdate").cast("int").alias("stage"),
        _text_time(F.col("o_orderdate")).alias("date"),
        _long("o_orderkey").alias("match_api_id"),
        home.cast("bigint").alias("home_team_api_id"),
        ((home + 1 + F.col("o_custkey") % 9) % 10).cast("bigint").alias("away_team_api_id"),
        F.nullif(F.floor("o_totalprice") % 6, F.lit(5)).cast("int").alias("home_team_goal"),
        (F.col("o_custkey") % 5).cast("int").alias("away_team_goal"),
    )


STAR_BUILDERS = {
    "Country": country,
    "League": league,
    "Team": team,
    "Team_Attributes": team_attributes,
    "Player": player,
    "Player_Attributes": player_attributes,
    "Match": match,
}


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All star tables (lazy; nothing is read until an action)."""
    return {name: build(spark, sf_dir) for name, build in STAR_BUILDERS.items()}


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Register every star table as a temp view under its warehouse name."""
    tables = star_tables(spark, sf_dir)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables
