"""Publish a stage once all its matches are completed (D4), from keyed state.

The source refreshes its standings "once all matches of the stage are completed".
Match files land in any order; a match may land again with its score, a correction,
another stage or no score any more.

1. The state holds each match as it counted last, in hash buckets of
   ``match_api_id``.  A micro-batch reads and rewrites only the buckets of its own
   matches.  What it finds there says which stage a match leaves, so nothing else is
   searched; the state files read grow with the batch, not with the table.
2. Every match that changed gives its old contribution with weight -1 and its new
   one with weight 1.  Their sums are added to the totals per (league, season,
   stage) and team: how many matches there are, how many have both goals, and the
   points.  Only folders of seasons that the batch touches are read and written.
3. Of the touched stages, those whose matches all have both goals are published,
   replacing what was published before; those that are not (or no longer) are
   withdrawn.

A batch is safe to replay.  A total carries the epoch that it counts up to, so the
same batch adds nothing twice, and the state is written last: as long as it is not,
a replay finds the same contributions again.

A hot league or stage is summed before the shuffle.  A match without
``match_api_id`` cannot be told from another landing of itself and takes no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchlake.operators.points import STAGE_KEYS, STAGE_METRICS, name_stages, signed_totals
from matchlake.session import ensure_checkpoint_dir
from matchlake.sinks.files import overwrite_partitions
from matchlake.streaming.stage_refresh import MATCH_COLUMNS

FIELDS = [f for f in MATCH_COLUMNS.fieldNames() if f != "match_api_id"]
BUCKETS = 64  # of the state; choose it once per stream, for buckets of a few hundred MB
STATE = T.StructType([*MATCH_COLUMNS.fields, T.StructField("bucket", T.IntegerType())])

COUNTS = ["matches", "scored"]
STAGE = ["league_id", "season", "stage"]
# One row per team of a stage and one without a team, which counts the stage's matches.
# The season stands last, as it comes back from the folder names.
TOTALS = T.StructType(
    [T.StructField("league_id", T.LongType()), T.StructField("stage", T.IntegerType()),
     T.StructField("of_stage", T.BooleanType()), T.StructField("team_api_id", T.LongType()),
     *[T.StructField(c, T.LongType()) for c in [*COUNTS, *STAGE_METRICS]],
     T.StructField("epoch", T.LongType()), T.StructField("season", T.StringType())])
PUBLISHED = T.StructType(
    [T.StructField("league_id", T.LongType()), T.StructField("name", T.StringType()),
     T.StructField("stage", T.IntegerType()), T.StructField("team_api_id", T.LongType()),
     *[T.StructField(c, T.LongType()) for c in STAGE_METRICS],
     T.StructField("season", T.StringType())])


def _same(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & a[n].eqNullSafe(b[n])
    return out


def latest(landings: DataFrame, buckets: int) -> DataFrame:
    """The latest landing of every match (of several with one time, that with the largest
    values) in the columns of ``STATE``."""
    return (landings.where(F.col("match_api_id").isNotNull())
            .groupBy("match_api_id").agg(F.max(F.struct("landed", *FIELDS)).alias("m"))
            .select("match_api_id", *[F.col(f"m.{f}") for f in FIELDS],
                    F.pmod(F.xxhash64("match_api_id"), F.lit(buckets)).cast("int").alias("bucket")))


def contributions(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Old (weight -1) and new (weight 1) contribution of every match that changed."""
    old = stored.select("match_api_id", F.struct(*FIELDS).alias("old"))
    pairs = batch.select("match_api_id", F.struct(*FIELDS).alias("new")) \
        .join(old, "match_api_id", "left").where(~F.col("new").eqNullSafe(F.col("old")))
    sides = F.array(F.struct(F.lit(1).alias("weight"), F.col("new").alias("m")),
                    F.struct(F.lit(-1).alias("weight"), F.col("old").alias("m")))
    return (pairs.select("match_api_id", F.inline(sides)).where(F.col("m").isNotNull())
            .select("match_api_id", *[F.col(f"m.{f}") for f in FIELDS], "weight"))


def batch_totals(batch: DataFrame) -> DataFrame:
    """The weighted contributions summed per stage, and per team of a stage."""
    scored = F.col("home_team_goal").isNotNull() & F.col("away_team_goal").isNotNull()
    stages = batch.groupBy(*STAGE).agg(
        F.sum("weight").alias("matches"),
        F.sum(F.when(scored, F.col("weight")).otherwise(0)).alias("scored"))
    teams = signed_totals(batch)
    stages = stages.select(*STAGE, F.lit(True).alias("of_stage"),
                           F.lit(None).cast("long").alias("team_api_id"), *COUNTS,
                           *[F.lit(0).cast("long").alias(c) for c in STAGE_METRICS])
    teams = teams.select(*STAGE, F.lit(False).alias("of_stage"), "team_api_id",
                         *[F.lit(0).cast("long").alias(c) for c in COUNTS], *STAGE_METRICS)
    return stages.unionByName(teams)


def _seasons(df: DataFrame, seasons: list[str | None]) -> DataFrame:
    """Rows of the named seasons; a filter on the folder names."""
    named = F.col("season").isin([s for s in seasons if s is not None])
    return df.where(named | F.col("season").isNull() if None in seasons else named)


def add_batch(stored: DataFrame, added: DataFrame, epoch: int) -> DataFrame:
    """Stored totals plus the batch's, which rows of this epoch or a later one have already."""
    keys = [*STAGE, "of_stage", "team_api_id"]
    sums = [*COUNTS, *STAGE_METRICS]
    new = added.withColumn("epoch", F.lit(epoch).cast("long"))
    both = stored.select(*keys, *sums, "epoch", F.lit(False).alias("_new")).unionByName(
        new.select(*keys, *sums, "epoch", F.lit(True).alias("_new")))
    have = F.max(F.when(~F.col("_new"), F.col("epoch")))
    grouped = both.groupBy(*keys).agg(
        have.alias("_have"), F.max("epoch").alias("epoch"),
        *[F.sum(F.when(~F.col("_new"), F.col(c))).alias(f"_old_{c}") for c in sums],
        *[F.sum(F.when(F.col("_new"), F.col(c))).alias(f"_new_{c}") for c in sums])
    counted = F.coalesce(F.col("_have") >= epoch, F.lit(False))
    return grouped.select(*keys, *[
        (F.coalesce(f"_old_{c}", F.lit(0))
         + F.when(counted, F.lit(0)).otherwise(F.coalesce(f"_new_{c}", F.lit(0))))
        .cast("long").alias(c) for c in sums], "epoch").select(*TOTALS.fieldNames())


def complete_stages(totals: DataFrame) -> DataFrame:
    """(league_id, season, stage) of which every match has both goals."""
    return totals.where("of_stage AND matches > 0 AND scored = matches").select(*STAGE)


def start(spark: SparkSession, landing: str, league: DataFrame, matches: str, totals: str,
          output: str, checkpoint: str, files_per_trigger: int = 100, buckets: int = BUCKETS,
          available_now: bool = True) -> StreamingQuery:
    """Start the stream over Parquet match files landing in ``landing``."""
    ensure_checkpoint_dir(spark)
    stream = (spark.readStream.schema(MATCH_COLUMNS)
              .option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
              .select("*", F.col("_metadata.file_modification_time").alias("landed")))
    for path, schema, by in ((matches, STATE, "bucket"), (totals, TOTALS, "season"),
                             (output, PUBLISHED, "season")):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(by).parquet(path)

    def publish(landings: DataFrame, epoch: int) -> None:
        batch = latest(landings, buckets).checkpoint(eager=True)
        own = [r.bucket for r in batch.select("bucket").distinct().collect()]
        if not own:
            return
        stored = spark.read.schema(STATE).parquet(matches).where(F.col("bucket").isin(own))
        added = batch_totals(contributions(stored, batch)).checkpoint(eager=True)
        touched = added.select(*STAGE).distinct()
        # Names of the seasons in the batch: as many as the season folders at most.
        seasons = [r.season for r in touched.select("season").distinct().collect()]
        if seasons:
            _publish_seasons(added, touched, seasons, epoch)
        # The matches of the batch replace themselves; written last, see above.
        kept = stored.join(batch.select("match_api_id"), "match_api_id", "left_anti")
        merged = kept.select(*STATE.fieldNames()).unionByName(batch).checkpoint(eager=True)
        overwrite_partitions(merged, matches, ["bucket"], cluster=True)

    def _publish_seasons(added: DataFrame, touched: DataFrame, seasons: list[str | None],
                         epoch: int) -> None:
        stored = _seasons(spark.read.schema(TOTALS).parquet(totals), seasons)
        grown = add_batch(stored, added, epoch).checkpoint(eager=True)
        overwrite_partitions(grown, totals, ["season"])
        before = _seasons(spark.read.schema(PUBLISHED).parquet(output), seasons) \
            .where(F.col("name").isNotNull())
        kept = before.join(touched, _same(before, touched, STAGE), "left_anti")
        done, rows = complete_stages(grown), grown.where("NOT of_stage AND played > 0")
        new = rows.join(done, _same(rows, done, STAGE), "left_semi")
        new = new.join(touched, _same(new, touched, STAGE), "left_semi")
        out = kept.unionByName(name_stages(new, league)).checkpoint(eager=True)
        # A dynamic overwrite never empties a folder: a marker row without a league name
        # stands for a season of which nothing is published.
        marker = spark.createDataFrame([(s,) for s in seasons], "season string")
        overwrite_partitions(out.unionByName(marker, allowMissingColumns=True), output, ["season"])

    writer = (stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_published(spark: SparkSession, output: str) -> DataFrame:
    """Points per team of every complete stage of a known league."""
    return spark.read.schema(PUBLISHED).parquet(output).where(F.col("name").isNotNull())
