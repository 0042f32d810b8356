"""The league table carried forward from a changed stage equals the full table."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from matchlake.operators import carried_standings as C
from matchlake.operators import points as P
from matchlake.plans import star
from matchlake.session import work_dir

MATCH = ("match_api_id long, league_id long, season string, stage int, home_team_api_id long, "
         "away_team_api_id long, home_team_goal int, away_team_goal int")


def rows_of(df):
    cols = sorted(df.columns)
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def assert_table(spark, root, matches, league):
    want = P.league_table_by_stage(P.team_stage_points(matches, league))
    assert rows_of(C.read_standings(spark, root, league)) == rows_of(want)


@pytest.fixture()
def leagues(spark):
    return spark.createDataFrame([(1, "One"), (2, "Two")], "id long, name string")


def games(spark, rows):
    """(league, season, stage, home, away, goals, goals) rows as matches."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], MATCH)


SEASON = [(1, "a", s, h, a, (s * h) % 4, (s + a) % 3) for s in range(1, 7)
          for h, a in ((1, 2), (3, 4))]
# League 2 has no stages 3 and 4; unknown leagues, a season without a name.
OTHERS = [(2, "a", s, 5, 6, s % 3, 1) for s in (1, 2, 5, 6)] + [
    (9, "a", 1, 1, 2, 1, 0), (None, "a", 2, 1, 2, 1, 0), (1, None, 1, 1, 2, 3, 0),
    (1, None, 2, 2, 1, 3, 0), (1, "a/b=c", 1, 1, None, 0, 0)]


def of_stages(rows, wanted):
    return [r for r in rows if (r[1], r[2]) in wanted]


def test_first_build_and_correction(spark, leagues):
    root, rows = work_dir(spark, "carried"), SEASON + OTHERS
    C.update_standings(games(spark, rows), root)
    assert_table(spark, root, games(spark, rows), leagues)
    rows = [(*r[:5], r[5] + 2, r[6]) if (r[1], r[2]) == ("a", 4) else r for r in rows]
    todo = C.update_standings(games(spark, of_stages(rows, {("a", 4)})), root)
    assert todo == [C.Span("a", 4, 3)]
    assert_table(spark, root, games(spark, rows), leagues)


def test_stage_by_stage(spark, leagues):
    root = work_dir(spark, "carried")
    for s in (1, 2, 3):
        rows = [r for r in SEASON if r[2] == s]
        todo = C.update_standings(games(spark, rows), root)
        assert todo == [C.Span("a", None if s == 1 else s, None if s == 1 else s - 1)]
    assert_table(spark, root, games(spark, [r for r in SEASON if r[2] <= 3]), leagues)


def test_team_comes_in_late_and_leaves_again(spark, leagues):
    root, late = work_dir(spark, "carried"), (1, "a", 5, 7, 8, 4, 4)
    C.update_standings(games(spark, SEASON), root)
    stage = of_stages(SEASON, {("a", 5)})
    assert C.update_standings(games(spark, [*stage, late]), root) == [C.Span("a", None, None)]
    assert_table(spark, root, games(spark, [*SEASON, late]), leagues)
    assert C.update_standings(games(spark, stage), root) == [C.Span("a", None, None)]
    assert_table(spark, root, games(spark, SEASON), leagues)


def test_stage_that_loses_all_scores(spark, leagues):
    root = work_dir(spark, "carried")
    C.update_standings(games(spark, SEASON), root)
    for gone in (6, 1):
        lost = [(*r[:5], None, r[6]) for r in SEASON if r[2] == gone]
        C.update_standings(games(spark, lost), root)
        rest = [r for r in SEASON if r[2] != gone]
        assert_table(spark, root, games(spark, rest + lost), leagues)
        C.update_standings(games(spark, of_stages(SEASON, {("a", gone)})), root)
    assert_table(spark, root, games(spark, SEASON), leagues)


def test_nulls_and_empty_input(spark, leagues):
    root = work_dir(spark, "carried")
    assert C.update_standings(games(spark, []), root) == []
    assert C.read_standings(spark, root, leagues).count() == 0
    odd = [(1, "a", None, 1, 2, 1, 0), (1, "a", 1, None, 2, 1, 0), (1, "a", 1, 3, 4, None, None)]
    C.update_standings(games(spark, odd), root)
    assert_table(spark, root, games(spark, odd[1:]), leagues)


@pytest.mark.parametrize("dies_at", ["points", "table"])
def test_dead_call_is_finished_by_its_repetition(spark, leagues, monkeypatch, dies_at):
    root, late = work_dir(spark, "carried"), (1, "a", 5, 7, 8, 4, 4)
    C.update_standings(games(spark, SEASON), root)
    write = C.overwrite_partitions

    def dies(df, path, by, **kw):
        if path.endswith(dies_at):  # only the stages from 4 on get through
            write(df.where("stage >= 4"), path, by, **kw)
            raise RuntimeError("executor lost")
        write(df, path, by, **kw)

    changed = games(spark, [*of_stages(SEASON, {("a", 5)}), late])
    with monkeypatch.context() as m:
        m.setattr(C, "overwrite_partitions", dies)
        with pytest.raises(RuntimeError):
            C.update_standings(changed, root)
    C.update_standings(changed, root)
    assert_table(spark, root, games(spark, [*SEASON, late]), leagues)


def test_earlier_folders_are_not_read(spark, leagues):
    """Files of earlier stages are spoilt; the correction works all the same."""
    root = work_dir(spark, "carried")
    C.update_standings(games(spark, SEASON), root)
    spoilt = [*glob.glob(f"{root}/points/season=a/stage=[123]/*.parquet"),
              *glob.glob(f"{root}/table/season=a/stage=[12]/*.parquet")]
    assert len(spoilt) == 5
    for path in spoilt:
        with open(path, "wb") as f:
            f.write(b"not parquet")
    fixed = [(*r[:5], r[5] + 1, r[6]) for r in of_stages(SEASON, {("a", 4)})]
    assert C.update_standings(games(spark, fixed), root) == [C.Span("a", 4, 3)]
    rows = [r for r in SEASON if r[2] != 4] + fixed
    want = P.league_table_by_stage(P.team_stage_points(games(spark, rows), leagues))
    got = spark.read.schema(C.TABLE).parquet(f"{root}/table").where("stage >= 3 AND in_stage")
    got = P.name_stages(got, leagues, "goal_difference", "position")
    assert rows_of(got) == rows_of(want.where("stage >= 3"))


def test_filters_reach_the_folders(spark):
    root = work_dir(spark, "carried")
    C.update_standings(star.match(spark, SF_SMALL), root)
    todo = [C.Span("1995/1996", 7, 6)]
    points, base = C.read_span(spark, root, todo)
    for df, part in ((points, "stage#"), (base, "stage#")):
        filters = [line for line in plan_text(df).splitlines() if "PartitionFilters" in line]
        assert filters and all(part in line and "1995/1996" in line for line in filters)
    assert {r.stage for r in base.select(F.col("stage")).distinct().collect()} == {6}
