"""Distribution keys and statistics: plans with and without them."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from matchlake import catalog
from matchlake.operators.load import Warehouse
from matchlake.plans import star
from matchlake.schemas import TABLES


def test_tables_with_one_distribution_key_join_without_an_exchange(spark):
    wh = catalog.loaded_by_key(spark, SF_SMALL, buckets=8)
    for fact, dim in (("Player_Attributes", "Player"), ("Match", "Team")):
        keys = catalog.DISTRIBUTION
        facts, dims = wh.table(fact), wh.table(dim).hint("merge")
        plan = plan_text(facts.join(dims, facts[keys[fact]] == dims[keys[dim]])
                         .groupBy(dims[keys[dim]]).count())
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert plan.count("Bucketed: true") == 2
        # Without the distribution both sides are shuffled.
        plain = plan_text(facts.repartition(3).join(dims.repartition(3),
                                                    facts[keys[fact]] == dims[keys[dim]]))
        assert plain.count("hashpartitioning") >= 2
    wh.drop()


def test_statistics_steer_the_join_and_count_rows(spark):
    wh = Warehouse(spark)
    wh.create("Player_Attributes")
    wh.create("Player")
    ratings, players = star.player_attributes(spark, SF_SMALL), star.player(spark, SF_SMALL)
    more = [f for f in TABLES["Player_Attributes"].columns if f not in ratings.columns]
    wh.load(ratings.select("*", *[F.lit(None).alias(c) for c in more])
            .select(*TABLES["Player_Attributes"].columns), "Player_Attributes")
    wh.load(players, "Player")

    def scan(table):
        return wh.table(table).count()

    assert wh.analyzed_rows("Player") is None
    wh.analyze("Player")
    wh.analyze("Player_Attributes")
    assert wh.analyzed_rows("Player") == scan("Player")
    wh.load(players, "Player", append_only=True)
    assert wh.analyzed_rows("Player") in (None, scan("Player"))  # never a stale count
    wh.analyze("Player")
    assert wh.analyzed_rows("Player") == scan("Player") == 2 * players.count()
    wh.load(players.limit(7), "Player")
    wh.analyze("Player")
    assert wh.analyzed_rows("Player") == scan("Player") == 7

    def joined():
        ratings = wh.table("Player_Attributes")
        few = ratings.where("player_api_id = 11").select("player_api_id", "id")
        size = re.search(r"sizeInBytes=([0-9.]+) (\w+)(, rowCount=)?", plan_text(few, "cost"))
        other = ratings.select(F.col("player_api_id").alias("p"), "date")
        return (float(size.group(1)) * {"B": 1, "KiB": 1024, "MiB": 2 ** 20}[size.group(2)],
                bool(size.group(3)), other.join(few, F.col("p") == F.col("player_api_id")))

    try:
        spark.conf.set("spark.sql.adaptive.enabled", False)
        spark.conf.set("spark.sql.cbo.enabled", False)
        blind, counted, _ = joined()
        assert not counted
        spark.conf.set("spark.sql.cbo.enabled", True)
        known, counted, _ = joined()
        assert counted and known < blind  # the filter's selectivity is known
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", int((known + blind) / 2))
        assert "BroadcastHashJoin" in plan_text(joined()[2])
        spark.conf.set("spark.sql.cbo.enabled", False)
        assert "SortMergeJoin" in plan_text(joined()[2])
    finally:
        for c in ("spark.sql.cbo.enabled", "spark.sql.adaptive.enabled",
                  "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(c)
        spark.conf.set("spark.sql.adaptive.enabled", True)
    wh.drop()
