"""Points table (W1) and the documented league standings.

Plan shape, checked with ``explain``:

* ``points_result``: one scan of Match (5 columns read), a join with League (a
  broadcast hash join while League is small by the planner's own size, a
  shuffle join beyond), a projection.
* ``team_stage_points``: one scan of Match, a Generate that turns each match
  into its two team rows, a partial (map-side) aggregate, one shuffle on the
  four group keys, the final aggregate, then a broadcast join for the league
  name.  A hot league or team is collapsed by the partial aggregate before the
  shuffle, so skew in the facts does not reach a single reducer.
* ``league_table_by_stage``: only the aggregated rows (teams x stages, bounded by
  the dimensions, not by the number of matches) are shuffled again; the windows are
  those of one team and of one stage, never of a whole league-season.

Building a plan starts no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions.results import match_points, match_result
POINT_COLUMNS = ["match_api_id", "home_team_goal", "away_team_goal", "season", "result", "name"]

STAGE_METRICS = ["played", "wins", "draws", "losses", "goals_for", "goals_against", "points"]


def _league_names(league: DataFrame) -> DataFrame:
    return league.select(F.col("id").alias("_league_key"), F.col("name"))


def points_result(match: DataFrame, league: DataFrame, strict: bool = False) -> DataFrame:
    """Label each match Home / Away / Tie and attach its league name.

    Inner join: a match whose league id is NULL or unknown is dropped.
    """
    m = match.select("match_api_id", "home_team_goal", "away_team_goal", "season", "league_id")
    joined = m.join(_league_names(league),
                    F.col("league_id") == F.col("_league_key"), "inner")
    return joined.select(
        "match_api_id",
        "home_team_goal",
        "away_team_goal",
        "season",
        match_result(F.col("home_team_goal"), F.col("away_team_goal"), strict).alias("result"),
        "name",
    )


def _team_rows(match: DataFrame, *more: str) -> DataFrame:
    """Two rows per scored match, one per team, in one pass (no union of two scans)."""
    scored = match.where(F.col("home_team_goal").isNotNull() & F.col("away_team_goal").isNotNull())

    def side(team: str, venue: str, gf: str, ga: str) -> Column:
        return F.struct(
            F.col(team).alias("team_api_id"),
            F.lit(venue).alias("venue"),
            F.col(gf).alias("goals_for"),
            F.col(ga).alias("goals_against"),
        )

    sides = F.inline(F.array(
        side("home_team_api_id", "home", "home_team_goal", "away_team_goal"),
        side("away_team_api_id", "away", "away_team_goal", "home_team_goal"),
    ))
    rows = scored.select("match_api_id", "league_id", "season", "stage", *more, sides)
    return rows.withColumn("points", match_points(F.col("goals_for"), F.col("goals_against")))


def team_match_points(match: DataFrame, league: DataFrame) -> DataFrame:
    """3 / 1 / 0 points per team per match (D1); matches without both scores are skipped."""
    rows = _team_rows(match)
    joined = rows.join(_league_names(league),
                       F.col("league_id") == F.col("_league_key"), "inner")
    return joined.select(
        "match_api_id", "league_id", "name", "season", "stage",
        "team_api_id", "venue", "goals_for", "goals_against", "points",
    )


STAGE_KEYS = ["league_id", "season", "stage", "team_api_id"]


def stage_totals(match: DataFrame) -> DataFrame:
    """Per (league_id, season, stage, team_api_id): the additive metrics of D2,
    before any league lookup.  Partial aggregate map-side, one shuffle."""
    rows = _team_rows(match)
    return rows.groupBy(*STAGE_KEYS).agg(
        F.count(F.lit(1)).alias("played"),
        F.count_if(F.col("points") == 3).alias("wins"),
        F.count_if(F.col("points") == 1).alias("draws"),
        F.count_if(F.col("points") == 0).alias("losses"),
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
        F.sum("points").alias("points"),
    )


def signed_totals(match: DataFrame) -> DataFrame:
    """``stage_totals`` of matches with a ``weight``: 1 adds the match, -1 takes it away."""
    rows, weight = _team_rows(match, "weight"), F.col("weight").cast("bigint")

    def counted(points: int) -> Column:
        return F.sum(F.when(F.col("points") == points, weight).otherwise(0))

    return rows.groupBy(*STAGE_KEYS).agg(
        F.sum(weight).alias("played"),
        counted(3).alias("wins"), counted(1).alias("draws"), counted(0).alias("losses"),
        *[F.sum(F.col(c) * weight).alias(c) for c in ("goals_for", "goals_against", "points")])


def name_stages(totals: DataFrame, league: DataFrame, *more: str) -> DataFrame:
    """Attach the league name; unknown leagues drop out (inner join)."""
    named = totals.join(_league_names(league),
                        F.col("league_id") == F.col("_league_key"), "inner")
    return named.select("league_id", "name", "season", "stage", "team_api_id", *STAGE_METRICS,
                        *more)


def team_stage_points(match: DataFrame, league: DataFrame) -> DataFrame:
    """Per team and stage (a league week): games, wins, draws, losses, goals, points.

    The name is joined after the aggregate: the join sees one row per team and
    stage instead of one per match.
    """
    return name_stages(stage_totals(match), league)


# The tie-break of the standings is our choice (the source names none):
# points, then goal difference, then goals scored, all descending.
STANDING_ORDER = ["points", "goal_difference", "goals_for"]


def league_table_by_stage(stage_points: DataFrame) -> DataFrame:
    """The whole league table after every stage of every season (D3).

    Every team of a league-season has a row in every stage of that
    league-season: totals are running sums over the stages so far (zeros before
    a team's first match, carried on through weeks without one) and position is
    ``rank()`` among all teams by ``STANDING_ORDER``.
    """
    week = F.struct("stage", F.struct(*STAGE_METRICS).alias("got"))
    per_team = stage_points.groupBy("league_id", "name", "season", "team_api_id").agg(
        F.collect_list(week).alias("weeks"))
    # The stages of a league-season, a small set that a partial aggregate finds (in a second
    # scan, of few columns); joined back, so no task has to hold a whole league-season.
    stages = stage_points.groupBy(F.col("league_id").alias("_league"),
                                  F.col("season").alias("_season")) \
        .agg(F.collect_set("stage").alias("stages"))
    grid = (per_team.join(stages, F.col("league_id").eqNullSafe(F.col("_league"))
                          & F.col("season").eqNullSafe(F.col("_season")))
            .withColumn("stage", F.explode("stages"))
            .withColumn("week", F.get(F.filter(
                "weeks", lambda w: w["stage"].eqNullSafe(F.col("stage"))), F.lit(0))))
    running = (
        Window.partitionBy("league_id", "season", "team_api_id")
        .orderBy("stage")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = grid.select(
        "league_id", "name", "season", "stage", "team_api_id",
        *[F.sum(F.coalesce(F.col("week.got")[m], F.lit(0))).over(running).cast("bigint").alias(m)
          for m in STAGE_METRICS],
    ).withColumn("goal_difference", F.col("goals_for") - F.col("goals_against"))
    standing = Window.partitionBy("league_id", "season", "stage").orderBy(
        *[F.col(c).desc() for c in STANDING_ORDER]
    )
    return totals.withColumn("position", F.rank().over(standing))
