"""The standings stream: incremental runs over one checkpoint equal a full rebuild."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from matchlake.operators import points as P
from matchlake.plans import star
from matchlake.session import work_dir
from matchlake.sinks.files import write_parquet
from matchlake.streaming import stage_refresh


def _same(a, b):
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _run(spark, root, league):
    q = stage_refresh.start(spark, f"{root}/landing", league, f"{root}/processed",
                            f"{root}/standings", f"{root}/checkpoint", files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    return stage_refresh.read_standings(spark, f"{root}/standings")


def test_stream_catches_up_in_steps_and_replays_nothing(spark):
    m = star.match(spark, SF_SMALL).select(*stage_refresh.MATCH_COLUMNS.fieldNames())
    league = star.league(spark, SF_SMALL)
    root = work_dir(spark, "stream-test")
    # First half of the year lands, the stream runs; then the rest lands.
    write_parquet(m.where(F.col("stage") <= 6), f"{root}/landing")
    first = _run(spark, root, league)
    expected_first = P.league_table_by_stage(
        P.team_stage_points(m.where(F.col("stage") <= 6), league))
    assert _same(first, expected_first)

    write_parquet(m.where(F.col("stage") > 6), f"{root}/landing", mode="append")
    second = _run(spark, root, league)
    full = P.league_table_by_stage(P.team_stage_points(m, league))
    assert _same(second, full)

    # Nothing new: a rerun over the same checkpoint leaves the table as it is.
    third = _run(spark, root, league)
    assert _same(third, full)


def test_relanded_corrected_moved_and_seasonless_matches(spark):
    league = star.league(spark, SF_SMALL)
    root = work_dir(spark, "stream-corrections")
    m = star.match(spark, SF_SMALL).select(*stage_refresh.MATCH_COLUMNS.fieldNames())
    m = m.withColumn("season", F.when(F.col("match_api_id") % 5 == 0, F.lit(None).cast("string"))
                     .otherwise(F.col("season")))
    # All matches of one league-season move away later on.
    lonely = (F.col("league_id") == 3) & (F.col("season") == "1995/1996")
    write_parquet(m, f"{root}/landing")
    assert _same(_run(spark, root, league),
                 P.league_table_by_stage(P.team_stage_points(m, league)))

    write_parquet(m, f"{root}/landing", mode="append")  # the same files land again
    assert _same(_run(spark, root, league),
                 P.league_table_by_stage(P.team_stage_points(m, league)))

    corrected = (m.where(lonely | (F.col("match_api_id") % 7 == 0))
                 .withColumn("away_team_goal", (F.col("away_team_goal") + 2).cast("int"))
                 .withColumn("league_id", F.when(lonely, F.lit(4).cast("bigint"))
                             .otherwise(F.col("league_id"))))
    write_parquet(corrected, f"{root}/landing", mode="append")
    want = m.join(corrected.select("match_api_id"), "match_api_id", "left_anti") \
        .select(*m.columns).unionByName(corrected)
    got = _run(spark, root, league)
    assert _same(got, P.league_table_by_stage(P.team_stage_points(want, league)))
    assert got.where((F.col("league_id") == 3) & (F.col("season") == "1995/1996")).count() == 0
    assert got.where(F.col("season").isNull()).count() > 0
