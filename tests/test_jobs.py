"""Job-level tests: extract to text then staged load, truncate, comments,
and a refresh that stops on a failed check."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from matchlake.operators.load import Warehouse
from matchlake.operators.quality import Check
from matchlake.plans import jobs, star
from matchlake.schemas import TABLES
from matchlake.sinks.files import write_delimited
from matchlake.sources.csv import read_staged
from matchlake.session import work_dir


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_extract_lands_any_dataframe_in_both_forms(spark, fmt):
    root = work_dir(spark, "extract")
    tables = {n: star.STAR_BUILDERS[n](spark, SF_SMALL) for n in ("League", "Player")}
    paths = jobs.extract_tables(tables, root, fmt)
    for n, df in tables.items():
        schema = TABLES[n].schema
        back = read_staged(spark, paths[n], schema) if fmt == "csv" else \
            spark.read.schema(schema).parquet(paths[n])
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    with pytest.raises(ValueError, match="landing format"):
        jobs.extract_table(tables["League"], root, fmt="xml")


def test_refresh_keeps_long_text(spark):
    root = work_dir(spark, "long-goal")
    m = jobs.conform(star.match(spark, SF_SMALL).limit(20), TABLES["Match"].schema) \
        .withColumn("goal", F.repeat(F.lit("x;\n"), 5_000))
    staged = jobs.extract_tables({"Match": m}, root, "csv")
    wh = Warehouse(spark, location=f"{root}/warehouse")
    jobs.full_refresh(spark, wh, staged)
    assert wh.table("Match").select(F.min(F.length("goal")), F.max(F.length("goal"))).first() == \
        (15_000, 15_000)


def test_constraints_of_the_schema_are_all_checked(spark):
    from matchlake.operators.quality import constraint_report

    country = spark.createDataFrame([(1, "A"), (1, "B"), (None, "B")], "id long, name string")
    match = spark.createDataFrame([(1, 1, 10), (2, 7, 11)], "id long, country_id long, match_api_id long")
    point = spark.createDataFrame([(10,), (12,), (12,), (None,)], "match_api_id long")
    rows = {(r.table_name, r.constraint, r.column_name): (r.bad_keys, r.bad_rows)
            for r in constraint_report({"Country": country, "Match": match, "Point": point}).collect()}
    assert rows == {("Country", "primary key", "id"): (2, 3), ("Country", "unique", "name"): (1, 2),
                    ("Match", "primary key", "id"): (0, 0), ("Match", "unique", "match_api_id"): (0, 0),
                    ("Match", "reference", "country_id"): (1, 1),
                    ("Point", "reference", "match_api_id"): (1, 2)}


def test_partitioned_table_prunes_and_loads_by_declared_order(spark):
    wh = Warehouse(spark)
    wh.create("Match", partition_by=["season", "stage"])
    m = jobs.conform(star.match(spark, SF_SMALL), TABLES["Match"].schema)
    wh.load(m, "Match")
    back = wh.table("Match").select(*m.columns)
    assert back.exceptAll(m).count() == 0 and m.exceptAll(back).count() == 0
    assert "PartitionFilters: [isnotnull(stage" in plan_text(wh.table("Match").where("stage = 3"))


def test_every_rating_column_has_its_own_comment():
    t = TABLES["Player_Attributes"]
    assert set(t.comments) == set(t.columns) and len(set(t.comments.values())) == len(t.columns)


def test_truncate_and_comments(spark):
    wh = Warehouse(spark)
    wh.create("Country")
    wh.load(star.country(spark, SF_SMALL), "Country")
    assert wh.table("Country").count() == 5
    wh.truncate("Country")
    assert wh.table("Country").count() == 0
    comments = {r.col_name: r.comment for r in wh.comments("Country").collect()}
    assert comments["id"] == "Number of the country row."
    assert comments["name"] == "Name of the country, as leagues refer to it."


def test_drop_removes_the_database(spark):
    wh = Warehouse(spark)
    wh.create("Country")
    wh.drop()
    assert wh.database not in [d.name for d in spark.catalog.listDatabases()]


def test_full_refresh_is_idempotent_and_stops_on_a_failed_check(spark):
    root = work_dir(spark, "refresh")
    staged = {}
    for name in ["Country", "League"]:
        df = star.STAR_BUILDERS[name](spark, SF_SMALL)
        staged[name] = f"{root}/raw/{name}"
        write_delimited(jobs.conform(df, TABLES[name].schema), staged[name])
    wh = Warehouse(spark, location=f"{root}/warehouse")
    for _ in range(2):
        report = jobs.full_refresh(spark, wh, staged)
        assert all(r["passed"] for r in report)
    assert wh.table("Country").count() == 5 and wh.table("League").count() == 25
    with pytest.raises(ValueError, match="League: found 25"):
        jobs.full_refresh(spark, wh, staged, checks=[Check("League", 11)])


def test_latest_stage_matches_are_the_last_stage_of_each_season(spark):
    m = star.match(spark, SF_SMALL)
    last = jobs.latest_stage_matches(m)
    want = m.groupBy("season").agg(F.max("stage").alias("stage"))
    got = last.select("season", "stage").distinct()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert last.count() == m.join(want, ["season", "stage"]).count()


def test_failed_load_stops_the_refresh_before_the_next_level(spark):
    import os

    root = work_dir(spark, "refresh-fail")
    staged = {}
    for name in ["Country", "League"]:
        staged[name] = f"{root}/raw/{name}"
        write_delimited(jobs.conform(star.STAR_BUILDERS[name](spark, SF_SMALL),
                                     TABLES[name].schema), staged[name])
    os.makedirs(f"{root}/raw/Match")
    with open(f"{root}/raw/Match/part-0.csv", "w") as fh:
        fh.write(";".join(TABLES["Match"].columns) + "\n" + "x" + ";" * 114 + "\n")
    staged["Match"] = f"{root}/raw/Match"
    points = f"{root}/lake/points"   # a valid Point dataset: it would load if the refresh went on
    from matchlake.operators.points import points_result
    from matchlake.sinks.files import write_parquet

    write_parquet(points_result(star.match(spark, SF_SMALL), star.league(spark, SF_SMALL)), points)
    wh = Warehouse(spark, location=f"{root}/warehouse")
    with pytest.raises(Exception, match="cannot load column id"):
        jobs.full_refresh(spark, wh, staged, points)
    assert wh.table("League").count() == 25      # level 1 was loaded
    assert wh.table("Point").count() == 0         # level 3 never ran
