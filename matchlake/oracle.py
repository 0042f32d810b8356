"""DuckDB SQL for the correctness check: the same star projections and queries.

The driver runs each registered Spark query and the SQL here on the same
parquet tables (views ``region nation customer ...`` are pre-registered) and
compares row counts, schemas and values.  Column names and types are kept
equal on both sides: sums are cast to BIGINT (DuckDB would give HUGEINT),
floats are rounded where the two engines may differ in the last bits.
"""

from __future__ import annotations

# Star tables over the driver tables; mirrors matchlake.plans.star.
STAR_CTES = {
    "country": """country AS (
  SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region)""",
    "league": """league AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(n_regionkey AS BIGINT) AS country_id,
         n_name AS name
  FROM nation)""",
    "team": """team AS (
  SELECT CAST(s_suppkey AS BIGINT) AS id, CAST(s_suppkey AS BIGINT) AS team_api_id,
         CAST(s_nationkey AS DOUBLE) AS team_fifa_api_id, s_name AS team_long_name,
         'T' || CAST(s_suppkey AS VARCHAR) AS team_short_name
  FROM supplier)""",
    "team_attributes": """team_attributes AS (
  SELECT CAST(p_partkey AS BIGINT) AS id, CAST(p_partkey % 10 AS BIGINT) AS team_fifa_api_id,
         CAST(p_partkey % 10 AS BIGINT) AS team_api_id, CAST(NULL AS VARCHAR) AS date,
         CAST(p_size AS DOUBLE) AS "buildUpPlaySpeed", p_brand AS "buildUpPlaySpeedClass",
         p_retailprice AS "buildUpPlayPassing", p_type AS "buildUpPlayPassingClass"
  FROM part)""",
    "player": """player AS (
  SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_custkey AS BIGINT) AS player_api_id,
         c_name AS player_name, CAST(c_custkey AS BIGINT) AS player_fifa_api_id,
         CAST(NULL AS VARCHAR) AS birthday, CAST(150 + 2 * c_nationkey AS DOUBLE) AS height,
         c_acctbal AS weight
  FROM customer)""",
    "player_attributes": """player_attributes AS (
  SELECT CAST(event_id AS BIGINT) AS id, CAST(user_id AS BIGINT) AS player_fifa_api_id,
         CAST(user_id AS BIGINT) AS player_api_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS date, value AS overall_rating,
         value + CAST(1.0 AS DOUBLE) AS potential, event_type AS preferred_foot,
         props AS attacking_work_rate
  FROM events)""",
    "match": """match AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id,
         CAST(o_custkey % 7 AS BIGINT) AS country_id,
         CAST(o_custkey % 30 AS BIGINT) AS league_id,
         CAST(year(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) + 1 AS VARCHAR)
           AS season,
         CAST(month(o_orderdate) AS INTEGER) AS stage,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date,
         CAST(o_orderkey AS BIGINT) AS match_api_id,
         CAST(o_orderkey % 10 AS BIGINT) AS home_team_api_id,
         CAST((o_orderkey % 10 + 1 + o_custkey % 9) % 10 AS BIGINT) AS away_team_api_id,
         CAST(nullif(CAST(floor(o_totalprice) AS BIGINT) % 6, 5) AS INTEGER) AS home_team_goal,
         CAST(o_custkey % 5 AS INTEGER) AS away_team_goal
  FROM orders)""",
}

STAR_ORDER = ["country", "league", "team", "team_attributes", "player", "player_attributes",
              "match"]

RESULT_CASE = """CASE WHEN m.home_team_goal > m.away_team_goal THEN 'Home'
            WHEN m.home_team_goal < m.away_team_goal THEN 'Away'
            ELSE 'Tie' END"""

RESULT_CASE_STRICT = """CASE WHEN m.home_team_goal > m.away_team_goal THEN 'Home'
            WHEN m.home_team_goal < m.away_team_goal THEN 'Away'
            WHEN m.home_team_goal = m.away_team_goal THEN 'Tie' END"""

POINTS_SQL = f"""SELECT m.match_api_id, m.home_team_goal, m.away_team_goal, m.season,
       {RESULT_CASE} AS result,
       l.name
FROM match m JOIN league l ON l.id = m.league_id"""

POINTS_STRICT_SQL = f"""SELECT m.match_api_id, m.home_team_goal, m.away_team_goal, m.season,
       {RESULT_CASE_STRICT} AS result,
       l.name
FROM match m JOIN league l ON l.id = m.league_id"""

TEAM_ROWS_CTE = """team_rows AS (
  SELECT match_api_id, league_id, season, stage, home_team_api_id AS team_api_id,
         'home' AS venue, home_team_goal AS goals_for, away_team_goal AS goals_against
  FROM match WHERE home_team_goal IS NOT NULL AND away_team_goal IS NOT NULL
  UNION ALL
  SELECT match_api_id, league_id, season, stage, away_team_api_id AS team_api_id,
         'away' AS venue, away_team_goal AS goals_for, home_team_goal AS goals_against
  FROM match WHERE home_team_goal IS NOT NULL AND away_team_goal IS NOT NULL),
team_pts AS (
  SELECT *, CASE WHEN goals_for > goals_against THEN 3
                 WHEN goals_for = goals_against THEN 1 ELSE 0 END AS points
  FROM team_rows)"""

TEAM_MATCH_POINTS_SQL = """SELECT t.match_api_id, t.league_id, l.name, t.season, t.stage,
       t.team_api_id, t.venue, t.goals_for, t.goals_against, t.points
FROM team_pts t JOIN league l ON l.id = t.league_id"""

TEAM_STAGE_CTE = """tsp AS (
  SELECT t.league_id, l.name, t.season, t.stage, t.team_api_id,
         CAST(count(*) AS BIGINT) AS played,
         CAST(count(*) FILTER (WHERE t.points = 3) AS BIGINT) AS wins,
         CAST(count(*) FILTER (WHERE t.points = 1) AS BIGINT) AS draws,
         CAST(count(*) FILTER (WHERE t.points = 0) AS BIGINT) AS losses,
         CAST(sum(t.goals_for) AS BIGINT) AS goals_for,
         CAST(sum(t.goals_against) AS BIGINT) AS goals_against,
         CAST(sum(t.points) AS BIGINT) AS points
  FROM team_pts t JOIN league l ON l.id = t.league_id
  GROUP BY t.league_id, l.name, t.season, t.stage, t.team_api_id)"""

LEAGUE_TABLE_SQL = """SELECT *, CAST(rank() OVER (PARTITION BY league_id, season, stage
                            ORDER BY points DESC, goal_difference DESC, goals_for DESC)
                AS INTEGER) AS position
FROM (
  SELECT league_id, name, season, stage, team_api_id,
         CAST(sum(coalesce(played, 0)) OVER w AS BIGINT) AS played,
         CAST(sum(coalesce(wins, 0)) OVER w AS BIGINT) AS wins,
         CAST(sum(coalesce(draws, 0)) OVER w AS BIGINT) AS draws,
         CAST(sum(coalesce(losses, 0)) OVER w AS BIGINT) AS losses,
         CAST(sum(coalesce(goals_for, 0)) OVER w AS BIGINT) AS goals_for,
         CAST(sum(coalesce(goals_against, 0)) OVER w AS BIGINT) AS goals_against,
         CAST(sum(coalesce(points, 0)) OVER w AS BIGINT) AS points,
         CAST(sum(coalesce(goals_for, 0)) OVER w AS BIGINT)
           - CAST(sum(coalesce(goals_against, 0)) OVER w AS BIGINT) AS goal_difference
  FROM (SELECT DISTINCT league_id, name, season, stage FROM tsp) weeks
       JOIN (SELECT DISTINCT league_id, season, team_api_id FROM tsp) teams
         USING (league_id, season)
       LEFT JOIN tsp USING (league_id, name, season, stage, team_api_id)
  WINDOW w AS (PARTITION BY league_id, season, team_api_id ORDER BY stage
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
) cum"""


def with_star(body: str, *extra_ctes: str, tables: list[str] | None = None) -> str:
    """Prefix ``body`` with the star CTEs (all, or ``tables``) and extra CTEs."""
    names = tables if tables is not None else STAR_ORDER
    ctes = [STAR_CTES[n] for n in names] + list(extra_ctes)
    return "WITH " + ",\n".join(ctes) + "\n" + body
