"""Complete stages: late results, corrections, moves, replays, and what a batch reads."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from matchlake.operators import points as P
from matchlake.plans import star
from matchlake.session import work_dir
from matchlake.sinks.files import write_parquet
from matchlake.streaming import stage_completion as C

COLUMNS = C.MATCH_COLUMNS.fieldNames()


class Stream:
    def __init__(self, spark, league):
        self.spark, self.league, self.root = spark, league, work_dir(spark, "completion-test")

    def land(self, *rows):
        df = rows[0] if len(rows) == 1 and hasattr(rows[0], "columns") else \
            self.spark.createDataFrame(list(rows), C.MATCH_COLUMNS)
        write_parquet(df.select(*COLUMNS).coalesce(1), f"{self.root}/landing", mode="append")
        return self.run()

    def run(self):
        r = self.root
        q = C.start(self.spark, f"{r}/landing", self.league, f"{r}/matches", f"{r}/totals",
                    f"{r}/published", f"{r}/checkpoint", buckets=8)
        q.awaitTermination()
        assert q.exception() is None
        return self.published()

    def published(self):
        return sorted((r.season, r.stage, r.league_id, r.team_api_id, r.played, r.points,
                       r.goals_for) for r in C.read_published(self.spark, f"{self.root}/published")
                      .na.fill("-", "season").collect())


def test_published_when_complete_withdrawn_when_not(spark):
    s = Stream(spark, spark.createDataFrame([(1, 1, "L")], "id long, country_id long, name string"))
    assert s.land((10, 1, "a", 1, 5, 6, 2, 1), (11, 1, "a", 1, 7, 8, None, None)) == []
    one = [("a", 1, 1, 5, 1, 3, 2), ("a", 1, 1, 6, 1, 0, 1)]
    done = one + [("a", 1, 1, 7, 1, 1, 0), ("a", 1, 1, 8, 1, 1, 0)]
    assert s.land((11, 1, "a", 1, 7, 8, 0, 0)) == done
    # A late correction is published again.
    fixed = [("a", 1, 1, 5, 1, 1, 1), ("a", 1, 1, 6, 1, 1, 1)] + done[2:]
    assert s.land((10, 1, "a", 1, 5, 6, 1, 1)) == fixed
    assert s.land((10, 1, "a", 1, 5, 6, 1, 1)) == fixed  # the same again
    # A further match opens the stage again; when it moves away the stage is complete.
    assert s.land((12, 1, "a", 1, 5, 8, None, 1)) == []
    assert s.land((12, 1, None, 2, 5, 8, 4, 1)) == sorted(
        fixed + [("-", 2, 1, 5, 1, 3, 4), ("-", 2, 1, 8, 1, 0, 1)])
    # An annulled result, an unknown league, no league, no key.
    assert s.land((11, 1, "a", 1, 7, 8, None, 0), (20, 9, "a", 1, 1, 2, 1, 1),
                  (21, None, "a", 1, 1, 2, 1, 1), (None, 1, "a", 1, 5, 6, 1, 1)) == \
        [("-", 2, 1, 5, 1, 3, 4), ("-", 2, 1, 8, 1, 0, 1)]
    assert s.run() == [("-", 2, 1, 5, 1, 3, 4), ("-", 2, 1, 8, 1, 0, 1)]


def test_a_batch_that_dies_and_is_replayed_counts_once(spark, monkeypatch):
    s = Stream(spark, star.league(spark, SF_SMALL))
    m = star.match(spark, SF_SMALL).withColumn(
        "home_team_goal", F.coalesce("home_team_goal", F.lit(0)))
    write, left = C.overwrite_partitions, []

    def dying(df, path, by, **more):
        if left and path.endswith(left[0]):
            left.pop(0)
            raise RuntimeError("executor lost")
        write(df, path, by, **more)

    monkeypatch.setattr(C, "overwrite_partitions", dying)
    for part, die_at in [("id % 2 = 0", "totals"), ("id % 2 = 1", "published"),
                         ("id % 4 = 0", "matches")]:
        left.append(die_at)
        landing = m.where(part).withColumn("stage", F.col("stage") % 5)
        with pytest.raises(Exception, match="executor lost"):
            s.land(landing)
        s.run()
    final = m.withColumn("stage", F.col("stage") % 5)
    want = P.team_stage_points(final, s.league)
    got = C.read_published(spark, f"{s.root}/published").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_batch_reads_the_state_buckets_of_its_matches_only(spark):
    s = Stream(spark, star.league(spark, SF_SMALL))
    s.land(star.match(spark, SF_SMALL))
    state = spark.read.schema(C.STATE).parquet(f"{s.root}/matches")
    assert state.select("bucket").distinct().count() == 8
    read = state.where(F.col("bucket").isin([3]))
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ = 3", plan_text(read, "extended"))
    assert read.select(F.input_file_name()).distinct().count() == 1
    before = {f: 1 for f in state.inputFiles()}
    one = state.where("bucket = 3").limit(1)
    s.land(one.withColumn("home_team_goal", F.lit(9)))
    after = spark.read.schema(C.STATE).parquet(f"{s.root}/matches").inputFiles()
    assert sum(f not in before for f in after) == 1  # one bucket was written anew
