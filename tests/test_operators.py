"""Operator tests: exact quantiles, repeated rows, row index, standings
properties, stage refresh, and the shape of the physical plans."""

import numpy as np
import pandas as pd
import pytest
from conftest import SF_MID, SF_SMALL, plan_text
from pyspark.sql import functions as F

from matchlake.operators import points as P
from matchlake.operators.indexing import with_row_index
from matchlake.operators.profile import (duplicate_rows, numeric_profile, repeated_groups,
                                         repeated_rows)
from matchlake.operators.quantiles import exact_quantiles, long_values
from matchlake.operators.quality import (Reference, constraint_report, fk_orphans, pk_violations,
                                         unique_violations)
from matchlake.plans import jobs, star
from matchlake.schemas import TABLES
from matchlake.session import work_dir

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _frame(spark, values):
    return spark.createDataFrame(pd.DataFrame({"v": values}), "v double")


def _quantiles(df, names, probs):
    got = {r.c: r.q for r in exact_quantiles(long_values(df, names), probs).collect()}
    return {n: got.get(i) for i, n in enumerate(names)}


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([
        rng.normal(0, 1e6, 3000),
        np.full(2000, 7.0),          # a hot value: a third of the rows
        rng.integers(-5, 5, 1000).astype(float),
    ])
    got = _quantiles(_frame(spark, values.tolist()).repartition(6), ["v"], PROBS)["v"]
    assert got == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-9)


def test_exact_quantiles_nulls_nan_infinity_and_empty(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, None, -inf), (None, None, inf), (3.0, None, float("nan")),
                                (None, None, 2.0), (None, None, inf)],
                               "a double, b double, c double")
    got = _quantiles(df, ["a", "b", "c"], [0.0, 0.5, 1.0])
    assert got == {"a": [1.0, 2.0, 3.0], "b": None, "c": [-inf, inf, inf]}
    rows = {r.column_name: r for r in numeric_profile(df, "t").collect()}
    assert rows["b"]["count"] == 0 and rows["b"].q50 is None and rows["c"].max == inf


def test_numeric_profile_matches_pandas_describe(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": rng.normal(5, 2, 500), "k": rng.integers(0, 50, 500)})
    df = spark.createDataFrame(pdf)
    got = {r.column_name: r for r in numeric_profile(df, "t").collect()}
    want = pdf.describe()
    for c in ["x", "k"]:
        for stat, key in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                          ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
            assert got[c][stat] == pytest.approx(float(want.loc[key, c]), rel=1e-9)


def test_numeric_profile_of_sixty_columns(spark):
    df = spark.range(2000).select(*[(F.col("id") * (i + 1) % 997).cast("double").alias(f"c{i}")
                                    for i in range(60)])
    rows = {r.column_name: r for r in numeric_profile(df, "t").collect()}
    want = df.toPandas().describe()
    assert len(rows) == 60
    for c in ("c0", "c31", "c59"):
        assert rows[c].q25 == pytest.approx(want.loc["25%", c])


ROWS = [(1, "a", 0.0), (1, "a", -0.0), (1, "a", 0.0), (2, None, 1.5), (2, None, 1.5),
        (None, "b", None), (3, "c", None)]


def test_repeated_groups_match_pandas(spark):
    df = spark.createDataFrame(ROWS, "k long, s string, x double")
    got = sorted((r.k, r.s, r.n_copies) for r in repeated_groups(df).collect())
    assert got == [(1, "a", 3), (2, None, 2)]
    pdf = pd.DataFrame(ROWS, columns=["k", "s", "x"])
    (row,) = duplicate_rows(df, "t").collect()
    assert row.duplicate_rows == int(pdf.duplicated().sum()) == 3
    assert row.row_count == len(ROWS)
    copies = sorted((r.k, r.s) for r in repeated_rows(df).collect())
    assert copies == [(1, "a"), (1, "a"), (2, None)]


def test_copies_of_a_hot_row_come_back_from_many_tasks(spark, monkeypatch):
    from matchlake.operators import profile

    monkeypatch.setattr(profile, "COPIES_PER_ROW", 50)
    rows = repeated_rows(spark.range(1001).select(F.lit(5).alias("k")))
    assert rows.count() == 1000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:  # small partitions would be read by one task
        assert rows.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hash_collision_rows_are_told_apart(spark):
    # Spark hashes skip NULLs, so (1, NULL) and (NULL, 1) hash alike.
    df = spark.createDataFrame([(1, None), (None, 1)], "a long, b long")
    assert repeated_groups(df).count() == 0


def test_row_index_splits_a_hot_key(spark):
    df = spark.range(6000).select((F.col("id") % 3 * F.col("id")).alias("k"), "id").repartition(6)
    out = with_row_index(df, "k", "ix")
    assert out.where(F.col("k") == 0).select(F.spark_partition_id()).distinct().count() >= 1
    rows = sorted((r.ix, r.k) for r in out.collect())
    assert [i for i, _ in rows] == list(range(6000))
    assert [k for _, k in rows] == sorted(k for _, k in rows)


def test_row_index_is_consecutive_in_key_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("id"))
    out = with_row_index(df.repartition(5), "id", "ix").collect()
    assert sorted((r.ix, r.id) for r in out) == [(i, i) for i in range(5000)]


def test_keys_and_references(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (None, 99), (3, None)],
                                  "id long, parent long")
    parent = spark.createDataFrame([(10,), (12,)], "pid long")
    pk = sorted((r.key_value, r.n_rows) for r in pk_violations(child, "c", ["id"]).collect())
    assert pk == [("2", 2), ("NULL", 1)]
    assert unique_violations(child, "c", ["id"]).count() == 1
    orphans = fk_orphans(child, "c", [Reference("parent", parent, "p", "pid")]).collect()
    assert sorted((r.key_value, r.n_rows) for r in orphans) == [("11", 1), ("99", 1)]


def test_key_checks_deal_their_keys_to_given_tasks(spark):
    rows = spark.range(40_000).selectExpr("if(id % 3 = 0, NULL, id % 30000) AS id",
                                          "CAST(id % 7 AS STRING) AS t")
    for check in (pk_violations, unique_violations):
        dealt = check(rows, "r", ["id", "t"], tasks=37)
        whole = check(rows, "r", ["id", "t"])
        assert dealt.exceptAll(whole).count() == 0 and whole.exceptAll(dealt).count() == 0
        assert dealt.rdd.getNumPartitions() == 37 and dealt.schema == whole.schema


def test_team_points_per_match_sum_to_3_or_2(spark):
    tmp = P.team_match_points(star.match(spark, SF_SMALL), star.league(spark, SF_SMALL))
    per_match = tmp.groupBy("match_api_id").agg(F.sum("points").alias("s"), F.count("*").alias("n"))
    bad = per_match.where(~F.col("s").isin(2, 3) | (F.col("n") != 2)).count()
    assert bad == 0


def test_last_stage_running_total_equals_season_total(spark):
    m, lg = star.match(spark, SF_SMALL), star.league(spark, SF_SMALL)
    stage_pts = P.team_stage_points(m, lg)
    table = P.league_table_by_stage(stage_pts)
    keys = ["league_id", "season", "team_api_id"]
    season = stage_pts.groupBy(keys).agg(F.sum("points").alias("season_points"))
    last = table.groupBy(keys).agg(F.max_by("points", "stage").alias("final_points"))
    assert last.join(season, keys).where(F.col("final_points") != F.col("season_points")).count() == 0


README_MATCHES = [
    # id, country, league, season, stage, date, match_api_id, home, away, and
    # goals -- the goals are invented for the test (the samples do not show them).
    (1, 1, 1, "2008/2009", 1, "2008-08-17 00:00:00", 492473, 9987, 9993, 1, 1),
    (2, 1, 1, "2008/2009", 1, "2008-08-16 00:00:00", 492474, 10000, 9994, 0, 0),
    (3, 1, 1, "2008/2009", 1, "2008-08-16 00:00:00", 492475, 9984, 8635, 0, 3),
    (4, 1, 1, "2008/2009", 1, "2008-08-17 00:00:00", 492476, 9991, 9998, 5, 0),
    (5, 1, 1, "2008/2009", 1, "2008-08-16 00:00:00", 492477, 7947, 9985, 1, 3),
]


def test_readme_sample_matches(spark):
    cols = ("id long, country_id long, league_id long, season string, stage int, date string, "
            "match_api_id long, home_team_api_id long, away_team_api_id long, "
            "home_team_goal int, away_team_goal int")
    m = spark.createDataFrame(README_MATCHES, cols)
    lg = spark.createDataFrame([(1, 1, "Belgium Jupiler League")], "id long, country_id long, name string")
    res = {r.match_api_id: r.result for r in P.points_result(m, lg).collect()}
    assert res == {492473: "Tie", 492474: "Tie", 492475: "Away", 492476: "Home", 492477: "Away"}
    table = {r.team_api_id: (r.points, r.position) for r in
             P.league_table_by_stage(P.team_stage_points(m, lg)).collect()}
    assert table[9991] == (3, 1) and table[8635] == (3, 2) and table[9985] == (3, 3)
    assert table[9987] == (1, 4) and table[9984] == (0, 9)


def test_stage_refresh_equals_full_rebuild(spark, tmp_dir):
    m, lg = star.match(spark, SF_SMALL), star.league(spark, SF_SMALL)
    full = P.team_stage_points(m, lg)
    from matchlake.sinks.files import write_parquet

    last = jobs.latest_stage_matches(m)
    before = m.join(last.select("id"), "id", "left_anti")
    write_parquet(P.team_stage_points(before, lg), tmp_dir, partition_by=jobs.STAGE_PARTITIONS)
    schema = spark.read.parquet(tmp_dir).schema
    assert spark.read.schema(schema).parquet(tmp_dir).count() < full.count()
    jobs.refresh_stage_points(last, lg, tmp_dir)
    back = spark.read.schema(schema).parquet(tmp_dir).select(*full.columns)
    assert back.exceptAll(full).count() == 0 and full.exceptAll(back).count() == 0


# --- plan shape -------------------------------------------------------------------

def test_flagship_plan_broadcasts_league_and_prunes_columns(spark):
    df = P.points_result(star.match(spark, SF_MID), star.league(spark, SF_MID))
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double," \
           "o_orderdate:timestamp_ntz>" in plan


def test_standings_plan_sums_facts_before_each_shuffle(spark):
    df = P.league_table_by_stage(P.team_stage_points(star.match(spark, SF_MID),
                                                     star.league(spark, SF_MID)))
    plan = plan_text(df, "simple")
    # Facts are summed before they are shuffled, for the totals and for the stages.
    assert "partial_sum" in plan and "partial_collect_set" in plan
    assert plan.count("orders.parquet") == 2
    # Windows over one team's stages and over one stage's teams, none over a league-season.
    assert plan.count("Window [") == 2


def test_fk_checks_scan_the_child_once(spark):
    t = star.star_tables(spark, SF_MID)
    refs = [Reference("league_id", t["League"], "League", "id"),
            Reference("country_id", t["Country"], "Country", "id")]
    plan = plan_text(fk_orphans(t["Match"], "Match", refs), "simple")
    assert plan.count("orders.parquet") == 1  # one scan of the child for both references


def test_reference_checks_never_broadcast_the_parents_keys(spark):
    """A key out of the 115 columns of Match looks small to the planner at any size."""
    t = star.star_tables(spark, SF_MID)
    path = work_dir(spark, "wide-match")
    jobs.conform(t["Match"], TABLES["Match"].schema).write.parquet(path)
    wide = {"Match": spark.read.parquet(path),
            "Point": P.points_result(t["Match"], t["League"].hint("merge"))}
    refs = [Reference("match_api_id", wide["Match"], "Match", "match_api_id")]
    assert "BroadcastExchange" not in plan_text(fk_orphans(wide["Point"], "Point", refs), "simple")
    plan = plan_text(constraint_report({n: df.select("match_api_id") for n, df in wide.items()}),
                     "simple")
    assert "HashedRelationBroadcastMode(List(input[0, int, false], input[1, string" not in plan


# --- hot keys: one value holds a third of the rows ----------------------------------

def test_hot_repeated_row_comes_back_as_one_line(spark):
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("s"))
    rows = repeated_groups(df.repartition(8)).collect()
    assert [(r.k, r.s, r.n_copies) for r in rows] == [(-1, "hot", n // 3)]
    (row,) = duplicate_rows(df, "t").collect()
    assert row.duplicate_rows == n // 3 - 1 and row.row_count == n


def test_hot_league_standings_are_whole(spark):
    m = star.match(spark, SF_SMALL)
    hot = m.withColumn("league_id", F.when(F.col("id") % 3 == 0, F.lit(0).cast("bigint"))
                       .otherwise(F.col("league_id")))
    lg = star.league(spark, SF_SMALL)
    pts = P.team_stage_points(hot, lg)
    played = pts.agg(F.sum("played")).first()[0]
    scored = (hot.join(lg.select(F.col("id").alias("league_id")), "league_id")
              .where(F.col("home_team_goal").isNotNull() & F.col("away_team_goal").isNotNull())
              .count())
    assert played == 2 * scored
    table = P.league_table_by_stage(pts)
    pair = ["league_id", "season"]
    whole = (pts.select(*pair, "stage").distinct().join(
        pts.select(*pair, "team_api_id").distinct(), pair).count())
    assert table.count() == whole >= pts.count()


def test_a_team_on_a_free_week_stays_in_the_table(spark):
    cols = ("match_api_id long, league_id long, season string, stage int, home_team_api_id long, "
            "away_team_api_id long, home_team_goal int, away_team_goal int")
    m = spark.createDataFrame([(1, 1, "s", 1, 7, 8, 2, 0), (2, 1, "s", 2, 9, 8, 0, 0)], cols)
    lg = spark.createDataFrame([(1, "L")], "id long, name string")
    got = {(r.stage, r.team_api_id): (r.played, r.points, r.position)
           for r in P.league_table_by_stage(P.team_stage_points(m, lg)).collect()}
    assert got == {(1, 7): (1, 3, 1), (1, 8): (1, 0, 3), (1, 9): (0, 0, 2),
                   (2, 7): (1, 3, 1), (2, 8): (2, 1, 3), (2, 9): (1, 1, 2)}


def test_building_an_operator_starts_no_job(spark):
    m, lg = star.match(spark, SF_SMALL), star.league(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        P.points_result(m, lg)
        P.league_table_by_stage(P.team_stage_points(m, lg))
        jobs.latest_stage_matches(m)
        repeated_rows(m)
        fk_orphans(m, "Match", [Reference("league_id", lg, "League", "id")])
        assert list(tracker.getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_points_without_broadcast_use_a_shuffle_join_and_agree(spark):
    m, lg = star.match(spark, SF_SMALL), star.league(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = P.points_result(m, lg)
        plan = plan_text(shuffled)
        assert "BroadcastHashJoin" not in plan
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        rows = shuffled.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(rows) == sorted(P.points_result(m, lg).collect())


def test_load_rejects_a_wrong_column_count(spark):
    from matchlake.operators.load import Warehouse

    wh = Warehouse(spark)
    wh.create("Country")
    with pytest.raises(ValueError, match="columns given"):
        wh.load(spark.range(3), "Country")
