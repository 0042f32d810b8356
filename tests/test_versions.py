"""Versioned tables: one switch for all, retries, conflicts, old readers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from matchlake.operators.quality import Check
from matchlake.operators.versions import Conflict, VersionedWarehouse
from matchlake.plans import jobs, star

POINT = "match_api_id long, home_team_goal int, away_team_goal int, season string, result string, name string"


def points(spark, *ids):
    return spark.createDataFrame([(i, 1, 0, "s", "Home", "L") for i in ids], POINT)


def ids(wh, number=None):
    return sorted(r.match_api_id for r in wh.table("Point", number).collect())


def leagues(spark, *rows):
    return spark.createDataFrame(rows, "id long, country_id long, name string")


def test_failed_checks_leave_every_table_as_it_was(spark):
    wh = VersionedWarehouse(spark)
    countries = star.country(spark, SF_SMALL)
    assert jobs.checked_refresh(wh, {"League": leagues(spark, (1, 1, "A")), "Country": countries}) == 1
    before = wh.table("League")
    bad = [
        ({"League": leagues(spark, (1, 1, "A"), (1, 2, "B"))}, None, "primary key"),
        ({"League": leagues(spark, (None, 1, "A"))}, None, "primary key"),
        ({"League": leagues(spark, (1, 1, "A"), (2, 1, "A"))}, None, "unique name"),
        ({"League": leagues(spark, (3, 1, "C"))}, [Check("League", 11)], "wanted"),
        ({"League": leagues(spark, (3, 1, "C"))},
         [Check("League", 0, "sql", sql="SELECT count(*) FROM League WHERE id = 3")], "wanted"),
        ({"League": leagues(spark).limit(0)}, None, "found 0"),
        ({"League": leagues(spark, (3, 1, "C")).withColumn("name", F.raise_error(F.lit("lost")))},
         None, "lost"),
    ]
    for tables, checks, why in bad:
        with pytest.raises(Exception, match=why):
            jobs.checked_refresh(wh, tables, checks)
        assert wh.version().number == 1 and [r.id for r in wh.table("League").collect()] == [1]
    assert jobs.checked_refresh(wh, {"League": leagues(spark, (9, 1, "Z"))}) == 2
    assert [r.id for r in wh.table("League").collect()] == [9]
    assert [r.id for r in before.collect()] == [1]  # a reader from before the switch
    assert [r.id for r in wh.table("League", 1).collect()] == [1]
    assert wh.table("Country").count() == countries.count()  # not given: as it was


def test_references_can_be_made_to_hold(spark):
    wh = VersionedWarehouse(spark)
    tables = {"Country": spark.createDataFrame([(1, "x")], "id long, name string"),
              "Match": jobs.conform(star.match(spark, SF_SMALL), jobs.TABLES["Match"].schema)}
    with pytest.raises(jobs.FailedConstraint, match="reference country_id"):
        jobs.checked_refresh(wh, tables, must_hold=("reference",))
    assert wh.version().number == 0


def test_a_batch_counts_once(spark):
    wh = VersionedWarehouse(spark)
    assert wh.append(points(spark, 1, 2), "Point", "a")
    assert not wh.append(points(spark, 1, 2), "Point", "a")
    assert wh.append(points(spark, 2, 3), "Point", "b")
    assert ids(wh) == [1, 2, 2, 3] and ids(wh, 1) == [1, 2]
    # A job that died after writing its rows and before the commit: its folder stays unread.
    wh.write(points(spark, 7), "Point", 2)
    assert ids(wh) == [1, 2, 2, 3]
    assert wh.append(points(spark, 7), "Point", "c") and ids(wh) == [1, 2, 2, 3, 7]
    # Replacing the table starts it, and its ledger, anew.
    refresh = wh.begin()
    refresh.load(points(spark, 5), "Point")
    assert ids(wh) == [1, 2, 2, 3, 7]
    refresh.publish()
    assert ids(wh) == [5] and wh.append(points(spark, 1), "Point", "a") and ids(wh) == [1, 5]


def test_two_writers(spark):
    wh, other = (VersionedWarehouse(spark, w) for w in [VersionedWarehouse(spark).location] * 2)
    refresh = wh.begin()
    refresh.load(points(spark, 1), "Point")
    assert other.append(points(spark, 2), "Point", "b")
    with pytest.raises(Conflict):
        refresh.publish()
    assert ids(wh) == [2]
    # An append that is overtaken tries its commit again.
    commit, calls = wh.pointers.commit, []

    def overtaken(number, text):
        if not calls:
            calls.append(other.append(points(spark, 3), "Point", "c"))
        commit(number, text)

    wh.pointers.commit = overtaken
    assert wh.append(points(spark, 4), "Point", "d") and ids(wh) == [2, 3, 4]


def test_vacuum_keeps_what_kept_versions_name(spark):
    wh = VersionedWarehouse(spark)
    for i in range(5):
        refresh = wh.begin()
        refresh.load(points(spark, i), "Point")
        refresh.publish()
    assert wh.vacuum(keep=2) == 3 and ids(wh) == [4] and ids(wh, 4) == [3]


def test_wrong_number_of_columns(spark):
    with pytest.raises(ValueError, match="2 columns"):
        VersionedWarehouse(spark).append(points(spark, 1).select("season", "name"), "Point", "a")
