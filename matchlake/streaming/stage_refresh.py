"""Refresh the league table as match files land (D4 as a stream).

The source pipeline refreshes weekly, "once all matches of the stage are
completed".  As a stream: new Match files are picked up by a file source.  The
state holds every match once, keyed by ``match_api_id``, in one folder per
season.  Each micro-batch

1. finds the (season, league) pairs it touches: those of its own matches and
   those under which the same matches are stored so far (a corrected match may
   have moved);
2. merges the stored matches of these seasons with its own, the latest landing of
   a match winning, checkpoints them and replaces exactly these folders of the
   state: the state keeps one folder per season however many batches ran;
3. recomputes the standings of these pairs and replaces exactly their folders
   of the output.

Keys are compared null-safe, so matches without a season or league keep their
place.  A match without ``match_api_id`` cannot be told from another landing of
itself and takes no part.  Merging the same batch again gives the same state,
so a replayed batch changes nothing and the output is exactly-once.

A dynamic overwrite never empties a folder, so every touched season and pair also
gets a marker row without ids, which readers leave out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchlake.operators.points import league_table_by_stage, team_stage_points
from matchlake.session import ensure_checkpoint_dir
from matchlake.sinks.files import overwrite_partitions

MATCH_COLUMNS = T.StructType([
    T.StructField("match_api_id", T.LongType()),
    T.StructField("league_id", T.LongType()),
    T.StructField("season", T.StringType()),
    T.StructField("stage", T.IntegerType()),
    T.StructField("home_team_api_id", T.LongType()),
    T.StructField("away_team_api_id", T.LongType()),
    T.StructField("home_team_goal", T.IntegerType()),
    T.StructField("away_team_goal", T.IntegerType()),
])

STANDINGS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("stage", T.IntegerType()),
    T.StructField("team_api_id", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in
      ["played", "wins", "draws", "losses", "goals_for", "goals_against", "points",
       "goal_difference"]],
    T.StructField("position", T.IntegerType()),
    T.StructField("season", T.StringType()),
    T.StructField("league_id", T.LongType()),
])

PAIR = ["season", "league_id"]

# The season last, as it comes back from the folder names.
STATE = T.StructType(
    [f for f in MATCH_COLUMNS.fields if f.name not in PAIR]
    + [T.StructField("epoch", T.LongType()), T.StructField("landed", T.TimestampType())]
    + [f for n in reversed(PAIR) for f in MATCH_COLUMNS.fields if f.name == n])


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def merge_matches(state: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matches of the touched seasons, each in its latest landing; the touched pairs)."""
    own = batch.select("match_api_id").distinct()
    stored = state.where(F.col("match_api_id").isNotNull())
    moved = stored.join(own, "match_api_id", "left_semi").select(*PAIR)
    touched = batch.select(*PAIR).unionByName(moved).distinct()
    seasons = touched.select("season").distinct()
    before = stored.join(seasons, _same(stored, seasons, ["season"]), "left_semi")
    rest = [c for c in STATE.fieldNames() if c not in ("epoch", "landed")]
    latest = F.max(F.struct("epoch", "landed", *rest)).alias("m")
    merged = (before.select(*STATE.fieldNames()).unionByName(batch.select(*STATE.fieldNames()))
              .groupBy("match_api_id").agg(latest).select("m.*"))
    return merged.select(*STATE.fieldNames()), touched


def _with_markers(df: DataFrame, touched: DataFrame) -> DataFrame:
    return df.unionByName(touched, allowMissingColumns=True)


def start(spark: SparkSession, landing: str, league: DataFrame, processed: str, output: str,
          checkpoint: str, files_per_trigger: int = 1,
          available_now: bool = True) -> StreamingQuery:
    """Start the refresh stream over Parquet match files landing in ``landing``."""
    ensure_checkpoint_dir(spark)
    stream = (spark.readStream.schema(MATCH_COLUMNS)
              .option("maxFilesPerTrigger", files_per_trigger)
              .parquet(landing)
              .select("*", F.col("_metadata.file_modification_time").alias("landed")))
    # The state exists before the first batch, so every batch reads it alike.
    spark.createDataFrame([], STATE).write.mode("append").partitionBy("season").parquet(processed)

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        new = (batch.where(F.col("match_api_id").isNotNull())
               .withColumn("epoch", F.lit(epoch_id).cast("bigint")).select(*STATE.fieldNames()))
        merged, touched = merge_matches(spark.read.schema(STATE).parquet(processed), new)
        merged, touched = merged.checkpoint(eager=True), touched.checkpoint(eager=True)
        marked = _with_markers(merged, touched.select("season").distinct())
        overwrite_partitions(marked, processed, ["season"])
        changed = merged.join(touched, _same(merged, touched, PAIR), "left_semi")
        standings = league_table_by_stage(team_stage_points(changed, league))
        # Only known leagues have standings; their markers clear emptied pairs.
        known = touched.join(league.select(F.col("id").alias("league_id")), "league_id",
                             "left_semi")
        overwrite_partitions(_with_markers(standings, known.select(*PAIR)), output, PAIR,
                             cluster=True)

    writer = (stream.writeStream.foreachBatch(refresh)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_standings(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(STANDINGS).parquet(output).where(F.col("position").isNotNull())
