"""The league table carried forward from a changed stage on.

``league_table_by_stage`` computes whole seasons.  Here the running totals are kept,
one folder per (season, stage): points per stage, and the table after each stage.  When
the matches of stage k change, the points of stages from k on and the one table before
k are read, and the tables from k on are written; earlier folders are neither read
nor written.  The next stage of a season costs as much as one stage, however long the
season is.

A team that is new to a league-season, or leaves it, has (or loses) a row in earlier
stages too; such a season is computed from its first stage.

A call that fails is repeated with the same matches.  What has to be computed is noted
before anything is written and forgotten when all is, so the repeated call finishes
what a dead one began.  One call at a time works on a folder.

Matches without a stage take no part.  A stage of which no match has both goals any
more disappears.  Names are joined when the table is read.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.operators.growing_profile import NO_VALUE
from matchlake.operators.points import STAGE_METRICS, STANDING_ORDER, name_stages, stage_totals
from matchlake.session import ensure_checkpoint_dir
from matchlake.sinks.files import overwrite_partitions

FOLDERS = ["season", "stage"]
KEYS = ["league_id", "season", "team_api_id"]
_METRICS = [T.StructField(c, T.LongType()) for c in STAGE_METRICS]
_WHERE = [T.StructField("season", T.StringType()), T.StructField("stage", T.IntegerType())]
# A dynamic overwrite never empties a folder: a row without games stands for an empty one.
POINTS = T.StructType([T.StructField("league_id", T.LongType()),
                       T.StructField("team_api_id", T.LongType()), *_METRICS, *_WHERE])
# Every team of a league-season has a row in every stage of the season; ``in_stage`` tells
# whether its league plays that stage, else the row only hands the totals on.
TABLE = T.StructType([T.StructField("league_id", T.LongType()),
                      T.StructField("team_api_id", T.LongType()), *_METRICS,
                      T.StructField("goal_difference", T.LongType()),
                      T.StructField("position", T.IntegerType()),
                      T.StructField("in_stage", T.BooleanType()), *_WHERE])
PENDING = T.StructType(_WHERE)  # a season and the stage to begin at; NULL: the first


class Span(NamedTuple):
    """What to compute of a season: the stages from ``first`` on (None: all), which begin
    with the totals after stage ``base`` (None: from nothing)."""

    season: str | None
    first: int | None
    base: int | None


def stage_folders(table: DataFrame) -> dict[str | None, list[int]]:
    """The stages of each season that have a folder, from the file listing alone."""
    found: dict[str | None, set[int]] = {}
    for path in table.inputFiles():
        names = dict(part.split("=", 1) for part in path.split("/") if "=" in part)
        season = unquote(unquote(names["season"]))  # escaped in the name, and in the URI
        found.setdefault(None if season == NO_VALUE else season, set()).add(int(names["stage"]))
    return {season: sorted(stages) for season, stages in found.items()}


def spans(changed: list[tuple[str | None, int | None]],
          have: dict[str | None, list[int]]) -> list[Span]:
    """One span per season of the changed (season, stage), given the tables that exist."""
    first: dict[str | None, int | None] = {}
    for season, stage in changed:
        known = first.get(season, stage)
        first[season] = None if known is None or stage is None else min(known, stage)
    out = []
    for season, stage in first.items():
        before = [s for s in have.get(season, []) if stage is not None and s < stage]
        out.append(Span(season, stage if before else None, max(before, default=None)))
    return out


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _from(todo: list[Span]) -> Column:
    """The folders to compute: a filter on the folder names."""
    return _any([F.col("season").eqNullSafe(F.lit(s.season))
                 & (F.lit(True) if s.first is None else F.col("stage") >= s.first) for s in todo])


def _base(todo: list[Span]) -> Column:
    return _any([F.col("season").eqNullSafe(F.lit(s.season)) & (F.col("stage") == s.base)
                 for s in todo if s.base is not None])


def _join(a: DataFrame, b: DataFrame, names: list[str], how: str) -> DataFrame:
    """Null-safe join on columns of the same names, which the result has once."""
    renamed = b.withColumnsRenamed({n: f"_{n}" for n in names})
    on = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    return a.join(renamed, on, how).drop(*[f"_{n}" for n in names])


def read_span(spark: SparkSession, root: str, todo: list[Span]) -> tuple[DataFrame, DataFrame]:
    """Points of the stages to compute, and the tables they begin with."""
    points = spark.read.schema(POINTS).parquet(f"{root}/points").where(_from(todo))
    base = spark.read.schema(TABLE).parquet(f"{root}/table").where(_base(todo))
    return points.where(F.col("played") > 0), base.where(F.col("position").isNotNull())


def changed_rosters(points: DataFrame, base: DataFrame, todo: list[Span]) -> list[str | None]:
    """Seasons with a base in which a team comes in that the base does not know, or goes
    that had no game before."""
    grown = [s for s in todo if s.base is not None]
    later = points.where(_from(grown)).select(*KEYS).distinct()
    new = _join(later, base.select(*KEYS), KEYS, "left_anti").select("season")
    idle = base.where(F.col("played") == 0)
    gone = _join(idle.select(*KEYS), later, KEYS, "left_anti").select("season")
    return [r.season for r in new.unionByName(gone).distinct().collect()]  # a row per season


def carried(points: DataFrame, base: DataFrame) -> DataFrame:
    """The tables after each stage of ``points``, begun with the totals of ``base``."""
    teams = base.select(*KEYS).unionByName(points.select(*KEYS)).distinct()
    # As many rows as there are folders at most, which the driver has listed anyway.
    weeks = F.broadcast(points.select(*FOLDERS).distinct())
    grid = _join(teams, weeks, ["season"], "inner")
    got = _join(grid, points, [*KEYS, "stage"], "left").select(
        *KEYS, "stage", *[F.coalesce(m, F.lit(0)).alias(m) for m in STAGE_METRICS],
        F.lit(False).alias("is_base"))
    both = got.unionByName(base.select(*KEYS, "stage", *STAGE_METRICS,
                                       F.lit(True).alias("is_base")))
    running = Window.partitionBy(*KEYS).orderBy("stage") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = both.select(*KEYS, "stage", "is_base",
                         *[F.sum(m).over(running).cast("long").alias(m) for m in STAGE_METRICS]) \
        .where("NOT is_base").withColumn("goal_difference", F.expr("goals_for - goals_against"))
    standing = Window.partitionBy("league_id", "season", "stage").orderBy(
        *[F.col(c).desc() for c in STANDING_ORDER])
    ranked = totals.withColumn("position", F.rank().over(standing))
    played = points.select("league_id", *FOLDERS).distinct().withColumn("in_stage", F.lit(True))
    return (_join(ranked, played, ["league_id", *FOLDERS], "left")
            .withColumn("in_stage", F.coalesce("in_stage", F.lit(False)))
            .select(*TABLE.fieldNames()))


def _empty_folders(spark: SparkSession, folders: list[tuple[str | None, int]],
                   **values: int | bool) -> DataFrame:
    marks = spark.createDataFrame(folders, T.StructType(_WHERE))
    return marks.select("*", *[F.lit(v).alias(c) for c, v in values.items()])


def _note(spark: SparkSession, root: str, what: list[tuple[str | None, int | None]]) -> None:
    spark.createDataFrame(what, PENDING).coalesce(1).write.mode("append") \
        .parquet(f"{root}/pending")


def update_standings(match_changed: DataFrame, root: str) -> list[Span]:
    """Bring points and tables under ``root`` up to date and return what was computed.

    ``match_changed`` must hold every match of each (season, stage) it touches, scored
    or not.  The first call may bring all matches.
    """
    spark = match_changed.sparkSession
    ensure_checkpoint_dir(spark)
    match_changed = match_changed.where(F.col("stage").isNotNull())
    # A row per touched folder.
    touched = [tuple(r) for r in match_changed.select(*FOLDERS).distinct().collect()]
    for path, schema in (("points", POINTS), ("table", TABLE)):
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*FOLDERS) \
            .parquet(f"{root}/{path}")
    _note(spark, root, touched)
    if touched:
        totals = stage_totals(match_changed).unionByName(
            _empty_folders(spark, touched, played=0), allowMissingColumns=True)
        overwrite_partitions(totals.select(*POINTS.fieldNames()), f"{root}/points", FOLDERS,
                             cluster=True)

    def plan() -> list[Span]:
        noted = spark.read.schema(PENDING).parquet(f"{root}/pending").distinct().collect()
        have = stage_folders(spark.read.schema(TABLE).parquet(f"{root}/table"))
        return spans([tuple(r) for r in noted], have)

    todo = plan()
    rosters = changed_rosters(*read_span(spark, root, todo), todo) if todo else []
    if rosters:
        _note(spark, root, [(season, None) for season in rosters])
        todo = plan()
    if todo:
        rows = carried(*read_span(spark, root, todo))
        have = stage_folders(spark.read.schema(POINTS).parquet(f"{root}/points"))
        written = [(s.season, stage) for s in todo for stage in have.get(s.season, [])
                   if s.first is None or stage >= s.first]
        rows = rows.unionByName(_empty_folders(spark, written, in_stage=False),
                                allowMissingColumns=True)
        overwrite_partitions(rows.select(*TABLE.fieldNames()).checkpoint(eager=True),
                             f"{root}/table", FOLDERS, cluster=True)
    spark.createDataFrame([], PENDING).write.mode("overwrite").parquet(f"{root}/pending")
    return todo


def read_standings(spark: SparkSession, root: str, league: DataFrame) -> DataFrame:
    """The table after every stage of every league-season, as ``league_table_by_stage`` has it;
    leagues without a name drop out."""
    rows = spark.read.schema(TABLE).parquet(f"{root}/table").where("in_stage")
    return name_stages(rows, league, "goal_difference", "position")
