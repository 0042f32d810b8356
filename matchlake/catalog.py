"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator,
next to the DuckDB SQL it is checked against.

Every query reads the whole driver tables (through the star projections of
``matchlake.plans.star``), so its work grows with them.  Queries that write
(files, warehouse tables, a stream) do so in a fresh folder
under the shared checkpoint folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import oracle as O
from matchlake.functions.rules import WHITESPACE
from matchlake.operators import carried_standings, growing_profile
from matchlake.operators import points as P
from matchlake.operators import profile as PR
from matchlake.operators import quality as Q
from matchlake.operators import snapshot
from matchlake.operators.indexing import with_row_index
from matchlake.operators.load import Warehouse, register_view
from matchlake.operators.versions import VersionedWarehouse
from matchlake.plans import jobs, star
from matchlake.schemas import POINT, TABLES
from matchlake.session import work_dir
from matchlake.sinks import files
from matchlake.sources.csv import EXTRACT, INDEX_COLUMN, read_delimited, read_indexed, read_staged
from matchlake.sources.parquet import read_parquet
from matchlake.sources.split_csv import read_split_staged
from matchlake.streaming import stage_completion, stage_refresh

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def _conformed_sql(table: str, view: str, view_columns: list[str]) -> str:
    """SELECT of all columns of warehouse ``table``: the star view's own columns
    where it has them, typed NULLs for the rest."""
    cols = []
    for f in TABLES[table].schema.fields:
        t = DUCK_TYPES[f.dataType.simpleString()]
        src = f.name if f.name in view_columns else "NULL"
        cols.append(f'CAST({src} AS {t}) AS "{f.name}"')
    return f"SELECT {', '.join(cols)} FROM {view}"


MATCH_VIEW_COLUMNS = [
    "id", "country_id", "league_id", "season", "stage", "date", "match_api_id",
    "home_team_api_id", "away_team_api_id", "home_team_goal", "away_team_goal",
]
MATCH_VIEW_TYPES = ["bigint", "bigint", "bigint", "string", "int", "string", "bigint",
                    "bigint", "bigint", "int", "int"]
PLAYER_ATTR_NUMERIC = ["id", "player_fifa_api_id", "player_api_id", "overall_rating", "potential"]
LEAGUE_MATCH = ["league", "match"]
STAR_NAMES = ["Country", "League", "Team", "Team_Attributes", "Player", "Player_Attributes",
              "Match"]
STAR_VIEW = {"Country": "country", "League": "league", "Team": "team",
             "Team_Attributes": "team_attributes", "Player": "player",
             "Player_Attributes": "player_attributes", "Match": "match"}


# =============================================================================
# Points table and standings
# =============================================================================

@register("points_result", O.with_star(O.POINTS_SQL, tables=LEAGUE_MATCH))
def q_points_result(spark, sf_dir):
    return P.points_result(star.match(spark, sf_dir), star.league(spark, sf_dir))


@register("points_result_strict", O.with_star(O.POINTS_STRICT_SQL, tables=LEAGUE_MATCH))
def q_points_result_strict(spark, sf_dir):
    return P.points_result(star.match(spark, sf_dir), star.league(spark, sf_dir), strict=True)


@register("team_match_points", O.with_star(O.TEAM_MATCH_POINTS_SQL, O.TEAM_ROWS_CTE,
                                           tables=LEAGUE_MATCH))
def q_team_match_points(spark, sf_dir):
    return P.team_match_points(star.match(spark, sf_dir), star.league(spark, sf_dir))


@register("team_stage_points", O.with_star("SELECT * FROM tsp", O.TEAM_ROWS_CTE,
                                           O.TEAM_STAGE_CTE, tables=LEAGUE_MATCH))
def q_team_stage_points(spark, sf_dir):
    return P.team_stage_points(star.match(spark, sf_dir), star.league(spark, sf_dir))


@register("league_table_by_stage", O.with_star(O.LEAGUE_TABLE_SQL, O.TEAM_ROWS_CTE,
                                               O.TEAM_STAGE_CTE, tables=LEAGUE_MATCH))
def q_league_table_by_stage(spark, sf_dir):
    return P.league_table_by_stage(
        P.team_stage_points(star.match(spark, sf_dir), star.league(spark, sf_dir))
    )


# The points query as SQL text over named views (K9, P1): the same Catalyst plan.
POINTS_SPARK_SQL = """
SELECT m.match_api_id, m.home_team_goal, m.away_team_goal, m.season,
       CASE WHEN m.home_team_goal > m.away_team_goal THEN 'Home'
            WHEN m.home_team_goal < m.away_team_goal THEN 'Away'
            ELSE 'Tie' END AS result,
       l.name
FROM Match m JOIN League l ON l.id = m.league_id
"""


@register("temp_view_query", O.with_star(O.POINTS_SQL, tables=LEAGUE_MATCH))
def q_temp_view_query(spark, sf_dir):
    register_view(star.match(spark, sf_dir), "Match")
    register_view(star.league(spark, sf_dir), "League")
    return spark.sql(POINTS_SPARK_SQL)


# =============================================================================
# Files: Parquet and CSV round trips, staged loads
# =============================================================================

@register("points_parquet_roundtrip", O.with_star(O.POINTS_SQL, tables=LEAGUE_MATCH))
def q_points_parquet_roundtrip(spark, sf_dir):
    """W1 from Parquet landings: Match and League landed (K4), points written
    (K3), read back and loaded into the Point table (S6)."""
    root = work_dir(spark, "points-parquet")
    files.write_parquet(star.match(spark, sf_dir), f"{root}/lake/Match")
    files.write_parquet(star.league(spark, sf_dir), f"{root}/lake/League")
    jobs.points_job(spark, f"{root}/lake/Match", f"{root}/lake/League",
                    f"{root}/lake/points", source="parquet")
    wh = Warehouse(spark, location=f"{root}/warehouse")
    wh.create("Point")
    wh.load(read_parquet(spark, f"{root}/lake/points", POINT), "Point")
    return wh.table("Point")


# A text cell made from every match that holds line breaks, quotes and separators.
AWKWARD_SQL = """SELECT *, 'a"' || season || '";' || chr(10) || CASE id % 3
  WHEN 0 THEN '' WHEN 1 THEN chr(10) ELSE ',"' || chr(13) || chr(10) || ' x\\' END AS goal
FROM match"""


def _awkward(m: DataFrame) -> DataFrame:
    tail = (F.when(F.col("id") % 3 == 0, F.lit(""))
            .when(F.col("id") % 3 == 1, F.lit("\n")).otherwise(F.lit(',"\r\n x\\')))
    return m.withColumn("goal", F.concat(F.lit('a"'), "season", F.lit('";\n'), tail))


@register("match_csv_roundtrip", O.with_star(AWKWARD_SQL, tables=["match"]))
def q_match_csv_roundtrip(spark, sf_dir):
    """K1 then S3 under the default dialect: ';' text with a header, read back by
    position; the last column holds line breaks, quotes and separators."""
    m = _awkward(star.match(spark, sf_dir))
    path = work_dir(spark, "match-csv")
    files.write_delimited(m, path, EXTRACT)
    return read_delimited(spark, path, m.schema, EXTRACT)


@register("split_csv_read", O.with_star(AWKWARD_SQL, tables=["match"]))
def q_split_csv_read(spark, sf_dir):
    """S3 of large files: ';' text whose cells hold line breaks, quotes and separators, each
    file read by as many tasks as it has splits."""
    m = _awkward(star.match(spark, sf_dir))
    path = work_dir(spark, "large-csv")
    files.write_delimited(m, path, EXTRACT)
    return read_split_staged(spark, path, m.schema)


@register("points_csv_job", O.with_star(O.POINTS_SQL, tables=LEAGUE_MATCH))
def q_points_csv_job(spark, sf_dir):
    """W1 as the pipeline runs it: staged ';' files of Match (115 columns) and
    League in, points Parquet out."""
    root = work_dir(spark, "points-csv")
    files.write_delimited(jobs.conform(star.match(spark, sf_dir), TABLES["Match"].schema),
                          f"{root}/raw/Match")
    files.write_delimited(star.league(spark, sf_dir), f"{root}/raw/League")
    return jobs.points_job(spark, f"{root}/raw/Match", f"{root}/raw/League", f"{root}/lake/points")


@register("staged_csv_load", O.with_star(_conformed_sql("Match", "match", MATCH_VIEW_COLUMNS),
                                         tables=["match"]))
def q_staged_csv_load(spark, sf_dir):
    """S5 + K5 + K7: Match conformed to all 115 columns, staged as ';' text
    (NULL cells empty), loaded by position into the typed table with the
    load rules (F4, F5, F6, F8)."""
    root = work_dir(spark, "staged-match")
    files.write_delimited(jobs.conform(star.match(spark, sf_dir), TABLES["Match"].schema),
                          f"{root}/raw/Match")
    wh = Warehouse(spark, location=f"{root}/warehouse")
    wh.create("Match")
    wh.load(read_staged(spark, f"{root}/raw/Match", TABLES["Match"].schema), "Match")
    return wh.table("Match")


INTEGER_COLUMNS = [c for c, t in zip(MATCH_VIEW_COLUMNS, MATCH_VIEW_TYPES) if t != "string"]
AS_DECIMAL = [f"CASE WHEN id % 4 = 0 THEN CAST({c} AS STRING) ELSE CAST({c} AS STRING) || '.0' END AS {c}"
              if c in INTEGER_COLUMNS else c for c in MATCH_VIEW_COLUMNS]


@register("decimal_integer_load", O.with_star("SELECT * FROM match", tables=["match"]))
def q_decimal_integer_load(spark, sf_dir):
    """S5 + F8: Match staged the way pandas writes it (whole numbers of a column with
    NULLs as "7.0"), loaded into the typed columns."""
    m = star.match(spark, sf_dir)
    path = work_dir(spark, "decimal-match")
    files.write_delimited(m.selectExpr(*AS_DECIMAL), path)
    return read_staged(spark, path, m.schema)


@register("long_text_load", """SELECT CAST(c_custkey AS BIGINT) AS id,
       repeat(c_name, 600) AS player_name
FROM customer""")
def q_long_text_load(spark, sf_dir):
    """S5 without a given length: texts of over 10,000 characters load whole."""
    c = star.driver_table(spark, sf_dir, "customer").select("c_custkey", "c_name")

    def lengthened(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("c_custkey").cast("bigint").alias("id"),
                           F.repeat("c_name", F.lit(600)).alias("player_name"))

    path = work_dir(spark, "very-long-names")
    spread = c.repartition(files.delimited_files(lengthened(c)))  # short rows are dealt, not long
    files.write_delimited(lengthened(spread), path)
    return read_staged(spark, path, NAME_SCHEMA)


# Raw text cells for the blank rule, derived from every customer row: empty,
# blank, tab-only and leading-blank cells next to untouched names.
def _raw_names(spark, sf_dir):
    c = star.driver_table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 5
    raw = (F.when(k == 0, F.lit(""))
           .when(k == 1, F.lit("   "))
           .when(k == 2, F.lit("\t "))
           .when(k == 3, F.concat(F.lit("  "), F.col("c_name")))
           .otherwise(F.col("c_name")))
    return c.select(F.col("c_custkey").cast("bigint").alias("id"), raw.alias("player_name"))


RAW_NAMES_CTE = """raw AS (
  SELECT CAST(c_custkey AS BIGINT) AS id,
         CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN chr(9) || ' '
              WHEN 3 THEN '  ' || c_name ELSE c_name END AS player_name
  FROM customer)"""

DUCK_WHITESPACE = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)

NAME_SCHEMA = T.StructType([T.StructField("id", T.LongType()),
                            T.StructField("player_name", T.StringType())])


@register("blank_to_null", f"""WITH {RAW_NAMES_CTE}
SELECT id, CASE WHEN length(trim(player_name, {DUCK_WHITESPACE})) = 0 THEN NULL
                ELSE player_name END AS player_name
FROM raw""")
def q_blank_to_null(spark, sf_dir):
    """F4 + F5 through a file: blank and empty cells load as NULL, other text
    is kept untrimmed."""
    path = work_dir(spark, "blank-names")
    files.write_delimited(_raw_names(spark, sf_dir), path)
    return read_staged(spark, path, NAME_SCHEMA)


@register("truncate_text", """SELECT CAST(c_custkey AS BIGINT) AS id,
       left(c_name, 12) AS player_name
FROM customer""")
def q_truncate_text(spark, sf_dir):
    """text cut to the column length (12 characters here) on load."""
    c = star.driver_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("id"), F.col("c_name").alias("player_name"))
    path = work_dir(spark, "long-names")
    files.write_delimited(c, path)
    return read_staged(spark, path, NAME_SCHEMA, text_lengths={"player_name": 12})


# =============================================================================
# Warehouse loads (K5-K8)
# =============================================================================

def _load_points(spark, sf_dir, append_second: bool) -> DataFrame:
    wh = Warehouse(spark)
    wh.create("Point")
    pts = P.points_result(star.match(spark, sf_dir), star.league(spark, sf_dir))
    wh.load(pts, "Point")
    wh.load(pts, "Point", append_only=append_second)
    return wh.table("Point")


@register("load_overwrite", O.with_star(O.POINTS_SQL, tables=LEAGUE_MATCH))
def q_load_overwrite(spark, sf_dir):
    """K7/K8 without append_only, run twice: the table holds one copy."""
    return _load_points(spark, sf_dir, append_second=False)


@register("load_append", O.with_star(f"{O.POINTS_SQL}\nUNION ALL\n{O.POINTS_SQL}",
                                     tables=LEAGUE_MATCH))
def q_load_append(spark, sf_dir):
    """K7/K8 with append_only on the second run: the table holds two copies."""
    return _load_points(spark, sf_dir, append_second=True)


@register("truncate_load", O.with_star(O.POINTS_SQL, tables=LEAGUE_MATCH))
def q_truncate_load(spark, sf_dir):
    """K6: Point loaded, emptied, and loaded again by appending: one copy."""
    wh = Warehouse(spark)
    wh.create("Point")
    pts = P.points_result(star.match(spark, sf_dir), star.league(spark, sf_dir))
    wh.load(pts, "Point")
    wh.truncate("Point")
    wh.load(pts, "Point", append_only=True)
    return wh.table("Point")


@register("partitioned_load", O.with_star(
    "SELECT season, CAST(count(*) AS BIGINT) AS matches, CAST(sum(home_team_goal) AS BIGINT) AS goals "
    "FROM match WHERE stage = 3 GROUP BY season", tables=["match"]))
def q_partitioned_load(spark, sf_dir):
    """Match (115 columns) loaded into a warehouse table in folders by season and
    stage; a filter on the stage reads only that stage's folders."""
    wh = Warehouse(spark)
    wh.create("Match", partition_by=["season", "stage"])
    m = jobs.conform(star.match(spark, sf_dir), TABLES["Match"].schema)
    # Rows of one folder meet in as many tasks as their size asks for.
    wh.load(m.hint("rebalance", "season", "stage"), "Match")
    return (wh.table("Match").where(F.col("stage") == 3).groupBy("season")
            .agg(F.count(F.lit(1)).alias("matches"), F.sum("home_team_goal").alias("goals")))


@register("distributed_join", O.with_star("""
SELECT 'Player_Attributes' AS fact, p.player_api_id AS key, p.player_name AS name,
       CAST(count(*) AS BIGINT) AS facts, max(a.overall_rating) AS most
FROM player_attributes a JOIN player p ON p.player_api_id = a.player_api_id GROUP BY ALL
UNION ALL
SELECT 'Match', t.team_api_id, t.team_long_name, CAST(count(*) AS BIGINT),
       CAST(max(m.home_team_goal) AS DOUBLE)
FROM match m JOIN team t ON t.team_api_id = m.home_team_api_id GROUP BY ALL""",
    tables=["player", "player_attributes", "team", "match"]))
def q_distributed_join(spark, sf_dir):
    """Facts and dimensions in tables with one distribution key, joined and summed by
    it without a shuffle of either side."""
    return distributed_join(loaded_by_key(spark, sf_dir))


# Table -> its distribution key.
DISTRIBUTION = {"Player": "player_api_id", "Player_Attributes": "player_api_id",
                "Team": "team_api_id", "Match": "home_team_api_id"}


def loaded_by_key(spark, sf_dir, buckets: int = 8) -> Warehouse:
    wh = Warehouse(spark)
    for name, key in DISTRIBUTION.items():
        wh.create(name, distribute_by=key, buckets=buckets)
        wh.load(jobs.conform(star.STAR_BUILDERS[name](spark, sf_dir), TABLES[name].schema), name)
    return wh


def distributed_join(wh: Warehouse) -> DataFrame:
    parts = []
    for fact, dim, name, most in [("Player_Attributes", "Player", "player_name", "overall_rating"),
                                  ("Match", "Team", "team_long_name", "home_team_goal")]:
        facts, dims = wh.table(fact), wh.table(dim).hint("merge")
        joined = facts.join(dims, facts[DISTRIBUTION[fact]] == dims[DISTRIBUTION[dim]])
        parts.append(joined.groupBy(dims[DISTRIBUTION[dim]].alias("key"), dims[name].alias("name"))
                     .agg(F.count(F.lit(1)).alias("facts"), F.max(facts[most]).alias("most"))
                     .select(F.lit(fact).alias("fact"), "key", "name", "facts",
                             F.col("most").cast("double").alias("most")))
    return parts[0].unionByName(parts[1])


@register("analyzed_counts", O.with_star("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) * {2 if n == 'Player' else 1} AS row_count "
    f"FROM {STAR_VIEW[n]}" for n in STAR_NAMES)))
def q_analyzed_counts(spark, sf_dir):
    """A1 from the statistics of the catalog, after an overwrite of every table and an append
    to Player; no table is scanned for the count."""
    wh = Warehouse(spark)
    for n, df in star.star_tables(spark, sf_dir).items():
        wh.create(n)
        wh.load(jobs.conform(df, TABLES[n].schema), n)
        if n == "Player":
            wh.load(df, n, append_only=True)
        wh.analyze(n)
    counts = [(n, wh.analyzed_rows(n)) for n in STAR_NAMES]  # one number a table
    return spark.createDataFrame(counts, "table_name string, row_count long")


@register("load_fields", O.with_star(
    "SELECT m.match_api_id, CAST(NULL AS INTEGER) AS home_team_goal, "
    "CAST(NULL AS INTEGER) AS away_team_goal, m.season, "
    f"{O.RESULT_CASE} AS result, CAST(NULL AS VARCHAR) AS name "
    "FROM match m JOIN league l ON l.id = m.league_id", tables=LEAGUE_MATCH))
def q_load_fields(spark, sf_dir):
    """``INSERT INTO Point (match_api_id, season, result) SELECT ...``: the
    columns left out are NULL."""
    wh = Warehouse(spark)
    wh.create("Point")
    pts = P.points_result(star.match(spark, sf_dir), star.league(spark, sf_dir))
    wh.load(pts.select("match_api_id", "season", "result"), "Point",
            fields=["match_api_id", "season", "result"])
    return wh.table("Point")


# =============================================================================
# Counts and checks
# =============================================================================

def _star_counts_sql(extra: str = "") -> str:
    parts = [f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS row_count "
             f"FROM {STAR_VIEW[n]}" for n in STAR_NAMES]
    return O.with_star("\nUNION ALL\n".join(parts))


@register("row_counts", _star_counts_sql())
def q_row_counts(spark, sf_dir):
    return Q.row_counts(star.star_tables(spark, sf_dir))


@register("null_key_counts", O.with_star("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, 'id' AS key_column, CAST(count(*) AS BIGINT) AS row_count, "
    f"CAST(count(*) FILTER (WHERE id IS NULL) AS BIGINT) AS null_keys FROM {STAR_VIEW[n]}"
    for n in STAR_NAMES)))
def q_null_key_counts(spark, sf_dir):
    return Q.null_key_counts(star.star_tables(spark, sf_dir), "id")


DQ_SQL_CHECKS = [
    Q.Check("Match", 0, "sql", sql="SELECT COUNT(*) FROM Match WHERE home_team_goal IS NULL"),
    Q.Check("League", 0, "sql", sql="SELECT id FROM League WHERE id < 0"),
]
DQ_CHECKS = Q.REFERENCE_CHECKS + Q.non_empty_checks(STAR_NAMES) + DQ_SQL_CHECKS


def _dq_sql() -> str:
    rows = []
    duck_sql = {
        "SELECT COUNT(*) FROM Match WHERE home_team_goal IS NULL":
            "(SELECT CAST(count(*) AS BIGINT) FROM match WHERE home_team_goal IS NULL)",
        "SELECT id FROM League WHERE id < 0":
            "(SELECT CAST(id AS BIGINT) FROM league WHERE id < 0 LIMIT 1)",
    }
    for i, c in enumerate(DQ_CHECKS, start=1):
        view = STAR_VIEW[c.table]
        if c.kind == "sql":
            actual = duck_sql[c.sql]
        elif c.kind == "null_count":
            actual = f"(SELECT CAST(count(*) AS BIGINT) FROM {view} WHERE {c.column} IS NULL)"
        else:
            actual = f"(SELECT CAST(count(*) AS BIGINT) FROM {view})"
        check_sql = c.check_sql.replace("'", "''")
        rows.append(f"SELECT {i} AS check_id, '{c.table}' AS table_name, '{check_sql}' AS check_sql, "
                    f"'{c.comparison}' AS comparison, CAST({c.expected} AS BIGINT) AS expected, "
                    f"{actual} AS actual")
    body = "\nUNION ALL\n".join(rows)
    return O.with_star(f"""SELECT *,
  CASE WHEN actual IS NULL THEN false
       WHEN comparison = '>' THEN actual > expected ELSE actual = expected END AS passed,
  CASE WHEN actual IS NULL THEN table_name || ': the check query gave no row'
       WHEN (comparison = '>' AND actual > expected) OR (comparison = '=' AND actual = expected)
         THEN table_name || ': ok, ' || CAST(actual AS VARCHAR)
       ELSE table_name || ': found ' || CAST(actual AS VARCHAR) || ', wanted ' || comparison
            || ' ' || CAST(expected AS VARCHAR) END AS message
FROM (
{body}
) checks""")


@register("dq_report", _dq_sql())
def q_dq_report(spark, sf_dir):
    """Q1-Q5: the pipeline's own checks (counts of 11 / 11 / 183978 rows, no
    NULL ids), non-empty checks on every table, and two SQL checks, one of
    which returns no row."""
    tables = star.register_views(spark, sf_dir)
    return Q.check_report(spark, tables, DQ_CHECKS)


# =============================================================================
# Key constraints
# =============================================================================

PK_TABLES = [(n, ["id"]) for n in STAR_NAMES]
LINEITEM_KEY = ["l_orderkey", "l_linenumber"]


def _lineitem_keys(spark, sf_dir):
    return star.driver_table(spark, sf_dir, "lineitem").select(*LINEITEM_KEY)


def _key_sql(table: str, view: str, keys: list[str], primary: bool) -> str:
    key_value = " || ',' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in keys)
    any_null = " OR ".join(f"{k} IS NULL" for k in keys)
    where = "" if primary else f"WHERE NOT ({any_null})"
    having = f"count(*) > 1 OR {any_null}" if primary else "count(*) > 1"
    return (f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns, "
            f"{key_value} AS key_value, CAST(count(*) AS BIGINT) AS n_rows "
            f"FROM {view} {where} GROUP BY {', '.join(keys)} HAVING {having}")


@register("pk_violations", O.with_star("\nUNION ALL\n".join(
    [_key_sql(n, STAR_VIEW[n], k, True) for n, k in PK_TABLES]
    + [_key_sql("lineitem", "lineitem", LINEITEM_KEY, True)])))
def q_pk_violations(spark, sf_dir):
    """C1 on every star table, plus (l_orderkey, l_linenumber), which repeats."""
    tables = star.star_tables(spark, sf_dir)
    parts = [Q.pk_violations(tables[n], n, k, Q.key_tasks(tables[n])) for n, k in PK_TABLES]
    lines = _lineitem_keys(spark, sf_dir)
    parts.append(Q.pk_violations(lines, "lineitem", LINEITEM_KEY, Q.key_tasks(lines)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


UNIQUE_KEYS = [(t.name, [u]) for t in TABLES.values() for u in t.unique
               if t.name in STAR_NAMES]


@register("unique_violations", O.with_star("\nUNION ALL\n".join(
    [_key_sql(n, STAR_VIEW[n], k, False) for n, k in UNIQUE_KEYS]
    + [_key_sql("lineitem", "lineitem", LINEITEM_KEY, False)])))
def q_unique_violations(spark, sf_dir):
    """C2 on every declared unique column, plus the lineitem key, which repeats."""
    tables = star.star_tables(spark, sf_dir)
    parts = [Q.unique_violations(tables[n], n, k, Q.key_tasks(tables[n])) for n, k in UNIQUE_KEYS]
    lines = _lineitem_keys(spark, sf_dir)
    parts.append(Q.unique_violations(lines, "lineitem", LINEITEM_KEY, Q.key_tasks(lines)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Written out, not taken from the schema that the query reads.  Every Point row has its
# match, so the query leaves every fifth match out of the parent side.
FK_EXPECTED = [
    ("Match", "country_id", "Country", "id"),
    ("Match", "league_id", "League", "id"),
    ("Match", "home_team_api_id", "Team", "team_api_id"),
    ("Match", "away_team_api_id", "Team", "team_api_id"),
    ("Team_Attributes", "team_api_id", "Team", "team_api_id"),
    ("Player_Attributes", "player_fifa_api_id", "Player", "player_fifa_api_id"),
    ("Player_Attributes", "player_api_id", "Player", "player_api_id"),
    ("Point", "match_api_id", "Match", "match_api_id"),
]
POINT_CTE = f"point AS ({O.POINTS_SQL})"
PARENT_VIEW = STAR_VIEW | {"Match": "(SELECT * FROM match WHERE id % 5 <> 0)"}
CHILD_VIEW = STAR_VIEW | {"Point": "point"}


def _tables_with_points(spark, sf_dir) -> dict[str, DataFrame]:
    tables = star.star_tables(spark, sf_dir)
    tables["Point"] = P.points_result(tables["Match"], tables["League"])
    return tables


@register("fk_orphans", O.with_star("\nUNION ALL\n".join(
    f"SELECT '{c}' AS child_table, '{col}' AS child_column, '{p}' AS parent_table, "
    f"'{pcol}' AS parent_column, CAST({col} AS VARCHAR) AS key_value, "
    f"CAST(count(*) AS BIGINT) AS n_rows FROM {CHILD_VIEW[c]} ch "
    f"WHERE {col} IS NOT NULL AND NOT EXISTS "
    f"(SELECT 1 FROM {PARENT_VIEW[p]} pa WHERE pa.{pcol} = ch.{col}) GROUP BY {col}"
    for c, col, p, pcol in FK_EXPECTED), POINT_CTE))
def q_fk_orphans(spark, sf_dir):
    """Child keys without a parent row, for every enabled reference of the schema;
    one scan per child table."""
    tables = _tables_with_points(spark, sf_dir)
    parents = tables | {"Match": tables["Match"].where(F.col("id") % 5 != 0)}
    out = None
    for name, t in TABLES.items():
        refs = [Q.Reference(r.column, parents[r.parent], r.parent, r.parent_column)
                for r in t.references if r.enabled]
        if refs:
            part = Q.fk_orphans(tables[name], name, refs)
            out = part if out is None else out.unionByName(part)
    return out


PK_EXPECTED = [(n, "id") for n in STAR_NAMES]
UNIQUE_EXPECTED = [("Country", "name"), ("League", "name"), ("Team", "team_api_id"),
                   ("Player", "player_api_id"), ("Player", "player_fifa_api_id"),
                   ("Match", "match_api_id")]


def _constraint_sql() -> str:
    def one(labels: str, bad: str) -> str:
        return (f"SELECT {labels}, CAST(count(*) AS BIGINT) AS bad_keys, "
                f"CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows FROM ({bad}) b")
    parts = [one(f"'{t}' AS table_name, 'primary key' AS \"constraint\", '{c}' AS column_name, "
                 f"CAST(NULL AS VARCHAR) AS parent",
                 f"SELECT count(*) AS n FROM {CHILD_VIEW[t]} GROUP BY {c} "
                 f"HAVING count(*) > 1 OR {c} IS NULL") for t, c in PK_EXPECTED]
    parts += [one(f"'{t}' AS table_name, 'unique' AS \"constraint\", '{c}' AS column_name, "
                  f"CAST(NULL AS VARCHAR) AS parent",
                  f"SELECT count(*) AS n FROM {CHILD_VIEW[t]} WHERE {c} IS NOT NULL GROUP BY {c} "
                  f"HAVING count(*) > 1") for t, c in UNIQUE_EXPECTED]
    parts += [one(f"'{t}' AS table_name, 'reference' AS \"constraint\", '{c}' AS column_name, "
                  f"'{p}.{pc}' AS parent",
                  f"SELECT count(*) AS n FROM {CHILD_VIEW[t]} ch WHERE {c} IS NOT NULL AND NOT EXISTS "
                  f"(SELECT 1 FROM {CHILD_VIEW[p]} pa WHERE pa.{pc} = ch.{c}) GROUP BY {c}")
              for t, c, p, pc in FK_EXPECTED]
    return O.with_star("\nUNION ALL\n".join(parts), POINT_CTE)


@register("constraint_report", _constraint_sql())
def q_constraint_report(spark, sf_dir):
    """Every declared key, unique column and enabled reference, one row each."""
    return Q.constraint_report(_tables_with_points(spark, sf_dir))


# =============================================================================
# Profiles (A3-A7, P7, P8, L1)
# =============================================================================

@register("null_profile", O.with_star("\nUNION ALL\n".join(
    f"SELECT 'Match' AS table_name, '{c}' AS column_name, {i + 1} AS position, "
    f"'{t}' AS data_type, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count "
    f"FROM match" for i, (c, t) in enumerate(zip(MATCH_VIEW_COLUMNS, MATCH_VIEW_TYPES))),
    tables=["match"]))
def q_null_profile(spark, sf_dir):
    """A3 + A7: NULLs per column with the column's type, one pass."""
    return PR.null_profile(star.match(spark, sf_dir), "Match")


@register("shape", O.with_star("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, "
    f"{len(cols)} AS n_columns FROM {STAR_VIEW[n]}"
    for n, cols in [("Country", 2), ("League", 3), ("Team", 5), ("Team_Attributes", 8),
                    ("Player", 7), ("Player_Attributes", 8), ("Match", 11)]
    for cols in [range(cols)])))
def q_shape(spark, sf_dir):
    tables = star.star_tables(spark, sf_dir)
    out = None
    for n in STAR_NAMES:
        part = PR.shape(tables[n], n)
        out = part if out is None else out.unionByName(part)
    return out


LINEITEM_LABEL = "lineitem(l_orderkey,l_linenumber)"
DUP_SOURCES = ["Match", "Player_Attributes", LINEITEM_LABEL]


def _dup_source(spark, sf_dir, name):
    if name == LINEITEM_LABEL:
        return _lineitem_keys(spark, sf_dir)
    return star.STAR_BUILDERS[name](spark, sf_dir)


def _dup_sql(table: str, view: str, cols: str) -> str:
    return (f"SELECT '{table}' AS table_name, CAST((SELECT count(*) FROM {view}) AS BIGINT) "
            f"AS row_count, CAST(coalesce((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM "
            f"{view} GROUP BY {cols} HAVING count(*) > 1) g), 0) AS BIGINT) AS duplicate_rows")


@register("duplicate_rows", O.with_star("\nUNION ALL\n".join([
    _dup_sql("Match", "match", ", ".join(MATCH_VIEW_COLUMNS)),
    _dup_sql("Player_Attributes", "player_attributes",
             "id, player_fifa_api_id, player_api_id, date, overall_rating, potential, "
             "preferred_foot, attacking_work_rate"),
    _dup_sql(LINEITEM_LABEL, "lineitem", "l_orderkey, l_linenumber"),
])))
def q_duplicate_rows(spark, sf_dir):
    """A4: second and later copies of a row, over all columns of two star tables and
    over the key columns of lineitem."""
    out = None
    for n in DUP_SOURCES:
        part = PR.duplicate_rows(_dup_source(spark, sf_dir, n), n)
        out = part if out is None else out.unionByName(part)
    return out


@register("repeated_rows", """SELECT l_orderkey, l_linenumber
FROM (SELECT l_orderkey, l_linenumber,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS copy FROM lineitem) c
WHERE copy > 1""")
def q_repeated_rows(spark, sf_dir):
    """The second and later copies of each lineitem key, as rows."""
    return PR.repeated_rows(_lineitem_keys(spark, sf_dir))


@register("literal_filter", O.with_star("SELECT * FROM match WHERE season = '1995/1996'",
                                        tables=["match"]))
def q_literal_filter(spark, sf_dir):
    """Rows of Match that equal a literal."""
    return star.match(spark, sf_dir).where(F.col("season") == F.lit("1995/1996"))


def _numeric_profile_sql() -> str:
    def r(e):
        return f"round({e}, 6)"
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
        f"CAST(count({c}) AS BIGINT) AS count, {r(f'avg({c})')} AS mean, "
        f"{r(f'stddev_samp({c})')} AS std, {r(f'CAST(min({c}) AS DOUBLE)')} AS min, "
        f"{r(f'quantile_cont({c}, 0.25)')} AS q25, {r(f'quantile_cont({c}, 0.5)')} AS q50, "
        f"{r(f'quantile_cont({c}, 0.75)')} AS q75, {r(f'CAST(max({c}) AS DOUBLE)')} AS max "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM {STAR_VIEW[t]})"
        for t, c in [*(("Player_Attributes", c) for c in PLAYER_ATTR_NUMERIC),
                     *(("Match", c) for c in INTEGER_COLUMNS)]
    ]
    return O.with_star("\nUNION ALL\n".join(parts), tables=["player_attributes", "match"])


@register("numeric_profile", _numeric_profile_sql())
def q_numeric_profile(spark, sf_dir):
    """A5: ``describe()`` with exact quartiles, rounded to 6 places, over all numeric
    columns that the driver's data give Player_Attributes and Match."""
    return PR.numeric_profile(star.player_attributes(spark, sf_dir), "Player_Attributes",
                              digits=6).unionByName(
        PR.numeric_profile(star.match(spark, sf_dir), "Match", digits=6))


# What the sketches must keep to: quartiles within 2 % of the ranks, distinct values within 6 %.
GROWING = INTEGER_COLUMNS


@register("growing_profile", O.with_star("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS null_count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max, true AS quartiles_close, true AS distinct_close FROM match"
    for c in GROWING), tables=["match"]))
def q_growing_profile(spark, sf_dir):
    """A3 + A5 of a table that grows: sketches per season folder, brought up to date after a
    part of the seasons, after the rest and after nothing; then merged.  The sketches'
    quartiles and distinct counts are held against exact ranks and counts."""
    m, root = star.match(spark, sf_dir), work_dir(spark, "growing")
    late = F.col("season") >= "1996/1997"

    def update():
        table = spark.read.schema(m.select(*[c for c in m.columns if c != "season"], "season").schema) \
            .parquet(f"{root}/match")
        growing_profile.update_profile(table, "season", f"{root}/sketches")
        return table

    for part in (~late, late):
        files.write_parquet(m.where(part), f"{root}/match", mode="append", partition_by=["season"])
        update()
    found = growing_profile.merged_profile(update(), "season", f"{root}/sketches")
    found = found.select(*[F.col(c) for c in found.columns if c in ("column_name", "count", "null_count",
                                                                    "min", "max")],
                         F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"),
                         F.array("q25", "q50", "q75").alias("q"), "distinct")
    columns = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                        for c in GROWING])
    values = m.select(F.inline(columns)).where("v IS NOT NULL")
    ranks = [F.sum((F.col("v") < F.col("q")[k]).cast("long")).alias(f"below{k}") for k in range(3)] \
        + [F.sum((F.col("v") <= F.col("q")[k]).cast("long")).alias(f"upto{k}") for k in range(3)]
    exact = (values.join(found.select("column_name", "q"), "column_name").groupBy("column_name")
             .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("v").alias("d"), *ranks))
    close = [(F.col(f"below{k}") <= (p + 0.02) * F.col("n")) & (F.col(f"upto{k}") >= (p - 0.02) * F.col("n"))
             for k, p in enumerate((0.25, 0.5, 0.75))]
    return found.join(exact, "column_name").select(
        "column_name", "count", "null_count", "mean", "std", "min", "max",
        (close[0] & close[1] & close[2]).alias("quartiles_close"),
        (F.abs(F.col("distinct") - F.col("d")) <= 0.06 * F.col("d")).alias("distinct_close"))


@register("drop_null_rows", O.with_star(
    "SELECT * FROM match WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in MATCH_VIEW_COLUMNS),
    tables=["match"]))
def q_drop_null_rows(spark, sf_dir):
    """``dropna()``."""
    return PR.drop_null_rows(star.match(spark, sf_dir))


@register("first_rows", O.with_star("SELECT * FROM match ORDER BY id LIMIT 5", tables=["match"]))
def q_first_rows(spark, sf_dir):
    """L1: ``head()`` -- the first five rows by id (a top-k, the feature itself)."""
    return PR.first_rows(star.match(spark, sf_dir), "id", 5)


def _pandas_dtype_sql() -> str:
    rows = []
    for i, (c, t) in enumerate(zip(MATCH_VIEW_COLUMNS, MATCH_VIEW_TYPES)):
        if t in ("bigint", "int"):
            plain = "int64" if t == "bigint" else "int32"
            dtype = f"CASE WHEN nulls > 0 THEN 'float64' ELSE '{plain}' END"
        elif t == "double":
            dtype = "'float64'"
        else:
            dtype = "'object'"
        rows.append(f"SELECT '{c}' AS column_name, {i + 1} AS position, {dtype} AS pandas_dtype "
                    f"FROM (SELECT count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM match) n")
    spark_of = ("WHEN 'int64' THEN 'bigint' WHEN 'int32' THEN 'int' "
                "WHEN 'float64' THEN 'double' WHEN 'object' THEN 'string'")
    union = "\nUNION ALL\n".join(rows)
    return O.with_star(f"""SELECT column_name, position, pandas_dtype,
       CASE pandas_dtype {spark_of} END AS spark_type
FROM (
{union}
) d""", tables=["match"])


@register("dtype_mapping", _pandas_dtype_sql())
def q_dtype_mapping(spark, sf_dir):
    """F7 + S7: the dtype pandas gives each Match column when it reads the
    table, and the Spark type the dtype rule maps it to; one aggregate over
    the table decides which integer columns read as float64."""
    from matchlake.operators.dtype_profile import pandas_dtypes

    return pandas_dtypes(star.match(spark, sf_dir))


# =============================================================================
# Indexed export
# =============================================================================

def _indexed_sql(where: str = "") -> str:
    return O.with_star(f"SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) "
                       f"AS {INDEX_COLUMN}, * FROM match) i {where}", tables=["match"])


@register("indexed_export", _indexed_sql(
    "WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in MATCH_VIEW_COLUMNS)))
def q_indexed_export(spark, sf_dir):
    """K2 after P8: rows numbered from 0 in id order, NULL rows dropped, then
    written as ',' text with the index first: the index keeps its gaps."""
    m = star.match(spark, sf_dir)
    indexed = PR.drop_null_rows(with_row_index(m, "id", INDEX_COLUMN))
    path = work_dir(spark, "indexed-match")
    files.write_indexed(m, path, index=indexed)
    return read_indexed(spark, path, m.schema, keep_index=True)


@register("indexed_csv_read", O.with_star("SELECT * FROM match", tables=["match"]))
def q_indexed_csv_read(spark, sf_dir):
    """A ',' file with a leading index column read back without the index."""
    m = star.match(spark, sf_dir)
    path = work_dir(spark, "indexed-match-all")
    files.write_indexed(m, path, "id")
    return read_indexed(spark, path, m.schema)


# =============================================================================
# Extract of all tables
# =============================================================================

# Order-free content check: per row the first 32 bits of the MD5 of its cells as text,
# summed over the table.  Doubles count in hundredths, so both engines print them alike.
CONTENT = {
    "Country": [("id", "n"), ("name", "t")],
    "League": [("id", "n"), ("country_id", "n"), ("name", "t")],
    "Team": [("id", "n"), ("team_api_id", "n"), ("team_fifa_api_id", "d"), ("team_long_name", "t"),
             ("team_short_name", "t")],
    "Team_Attributes": [("id", "n"), ("team_fifa_api_id", "n"), ("team_api_id", "n"), ("date", "t"),
                        ("buildUpPlaySpeed", "d"), ("buildUpPlaySpeedClass", "t"),
                        ("buildUpPlayPassing", "d"), ("buildUpPlayPassingClass", "t")],
    "Player": [("id", "n"), ("player_api_id", "n"), ("player_name", "t"),
               ("player_fifa_api_id", "n"), ("birthday", "t"), ("height", "d"), ("weight", "d")],
    "Player_Attributes": [("id", "n"), ("player_fifa_api_id", "n"), ("player_api_id", "n"),
                          ("date", "t"), ("overall_rating", "d"), ("potential", "d"),
                          ("preferred_foot", "t"), ("attacking_work_rate", "t")],
    "Match": [(c, "t" if t == "string" else "n")
              for c, t in zip(MATCH_VIEW_COLUMNS, MATCH_VIEW_TYPES)],
    "Point": [("match_api_id", "n"), ("home_team_goal", "n"), ("away_team_goal", "n"),
              ("season", "t"), ("result", "t"), ("name", "t")],
}


def _cells(table: str, text: str, cast: str) -> str:
    cells = {"n": "CAST({c} AS %s)" % text, "t": "{c}",
             "d": "CAST(CAST(round({c} * 100) AS %s) AS %s)" % (cast, text)}
    return ", '|', ".join("coalesce(%s, '~')" % cells[k].format(c=c) for c, k in CONTENT[table])


def table_contents(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, content) of every table, one aggregate each."""
    out = None
    for n, df in tables.items():
        row = f"conv(substr(md5(concat({_cells(n, 'STRING', 'BIGINT')})), 1, 8), 16, 10)"
        part = df.selectExpr(f"CAST({row} AS BIGINT) AS h").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("h").alias("content")) \
            .select(F.lit(n).alias("table_name"), "row_count", "content")
        out = part if out is None else out.unionByName(part)
    return out


def _contents_rows(names: list[str], views: dict[str, str], more: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {more}'{n}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(CAST("
        f"'0x' || substr(md5(concat({_cells(n, 'VARCHAR', 'BIGINT')})), 1, 8) AS BIGINT)) "
        f"AS BIGINT) AS content FROM {views[n]}" for n in names)


def _contents_sql(names: list[str]) -> str:
    return O.with_star(_contents_rows(names, CHILD_VIEW), POINT_CTE)


def _extracted(spark, sf_dir, fmt: str) -> DataFrame:
    paths = jobs.extract_tables(star.star_tables(spark, sf_dir), work_dir(spark, "extract"), fmt)
    read = read_staged if fmt == "csv" else read_parquet
    return table_contents({n: read(spark, p, TABLES[n].schema) for n, p in paths.items()})


@register("extract_parquet", _contents_sql(STAR_NAMES))
def q_extract_parquet(spark, sf_dir):
    """All seven tables landed as Parquet; rows and contents of what was landed."""
    return _extracted(spark, sf_dir, "parquet")


@register("extract_text", _contents_sql(STAR_NAMES))
def q_extract_text(spark, sf_dir):
    """All seven tables landed as ';' text, read back by the staged load."""
    return _extracted(spark, sf_dir, "csv")


# =============================================================================
# Refresh: partitions, stream, whole warehouse
# =============================================================================

STAGE_POINTS_SCHEMA = T.StructType([
    T.StructField("league_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("team_api_id", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in P.STAGE_METRICS],
    T.StructField("season", T.StringType()), T.StructField("stage", T.IntegerType()),
])


@register("stage_refresh", O.with_star("SELECT * FROM tsp", O.TEAM_ROWS_CTE, O.TEAM_STAGE_CTE,
                                       tables=LEAGUE_MATCH))
def q_stage_refresh(spark, sf_dir):
    """D4 + K10: points per team and stage in a table partitioned by (season, stage).
    First the last stage of every season is stored with other scores; the refresh
    replaces just those partitions, so nothing of the other scores may be left."""
    m, lg = star.match(spark, sf_dir), star.league(spark, sf_dir)
    path = work_dir(spark, "stage-points")
    last = jobs.latest_stage_matches(m)
    wrong = last.withColumn("home_team_goal", F.coalesce("home_team_goal", F.lit(0)) + 3)
    before = m.join(last.select("id"), "id", "left_anti").unionByName(wrong)
    files.write_parquet(P.team_stage_points(before, lg), path, partition_by=jobs.STAGE_PARTITIONS,
                        cluster=True)
    jobs.refresh_stage_points(last, lg, path)
    return spark.read.schema(STAGE_POINTS_SCHEMA).parquet(path)


@register("carried_league_table", O.with_star(O.LEAGUE_TABLE_SQL, O.TEAM_ROWS_CTE,
                                              O.TEAM_STAGE_CTE, tables=LEAGUE_MATCH))
def q_carried_league_table(spark, sf_dir):
    """D3 carried forward: stages 1-9 are stored, stage 5 with other scores; then stage 5 is
    corrected and stages 10-12 come in, and the tables are computed from stage 5 on."""
    m = star.match(spark, sf_dir)
    root = work_dir(spark, "carried")
    wrong = F.when(F.col("stage") == 5, F.coalesce("home_team_goal", F.lit(0)) + 3) \
        .otherwise(F.col("home_team_goal"))
    carried_standings.update_standings(
        m.where("stage <= 9").withColumn("home_team_goal", wrong.cast("int")), root)
    carried_standings.update_standings(m.where("stage = 5 OR stage >= 10"), root)
    return carried_standings.read_standings(spark, root, star.league(spark, sf_dir))


@register("streaming_league_table", O.with_star(O.LEAGUE_TABLE_SQL, O.TEAM_ROWS_CTE,
                                                O.TEAM_STAGE_CTE, tables=LEAGUE_MATCH))
def q_streaming_league_table(spark, sf_dir):
    """D4 as a stream: match files land, each micro-batch refreshes the
    standings of the (league, season) pairs it touched."""
    m = star.match(spark, sf_dir).select(*stage_refresh.MATCH_COLUMNS.fieldNames())
    root = work_dir(spark, "stream")
    for part in ("stage <= 6", "stage > 6"):  # as the table is partitioned, in two landings
        files.write_parquet(m.where(part), f"{root}/landing", mode="append")
    landed = len(spark.read.schema(m.schema).parquet(f"{root}/landing").inputFiles())
    q = stage_refresh.start(spark, f"{root}/landing", star.league(spark, sf_dir),
                            f"{root}/processed", f"{root}/standings", f"{root}/checkpoint",
                            files_per_trigger=-(-landed // 2))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return stage_refresh.read_standings(spark, f"{root}/standings")


# What has landed in the end: late results for the missing goals of stages up to 6, then
# some results annulled and some matches moved to the stage before.
CORRECTED_CTE = """corrected AS (
  SELECT * REPLACE (
    CASE WHEN id % 500 = 7 THEN NULL WHEN stage <= 6 THEN coalesce(home_team_goal, 0)
         ELSE home_team_goal END AS home_team_goal,
    CASE WHEN id % 500 = 11 AND stage > 1 THEN stage - 1 ELSE stage END AS stage)
  FROM match),
complete AS (
  SELECT league_id, season, stage FROM corrected GROUP BY league_id, season, stage
  HAVING count(*) = count(home_team_goal + away_team_goal))"""
COMPLETE_SQL = f"""SELECT t.* FROM tsp t JOIN complete USING (league_id, season, stage)"""


@register("completed_stages", O.with_star(
    COMPLETE_SQL, CORRECTED_CTE, O.TEAM_ROWS_CTE.replace("FROM match", "FROM corrected"),
    O.TEAM_STAGE_CTE, tables=LEAGUE_MATCH))
def q_completed_stages(spark, sf_dir):
    """Points per team of the stages of which every match has its score, by a stream
    with keyed state; results come late, some are annulled, some matches move."""
    m, lg = star.match(spark, sf_dir), star.league(spark, sf_dir)
    root = work_dir(spark, "completed")
    names = stage_completion.MATCH_COLUMNS.fieldNames()
    late = m.where("stage <= 6 AND home_team_goal IS NULL").withColumn(
        "home_team_goal", F.lit(0).cast("int"))
    changed = m.where("id % 500 IN (7, 11)").withColumn("home_team_goal", F.expr(
        "CASE WHEN id % 500 = 7 THEN NULL WHEN stage <= 6 THEN coalesce(home_team_goal, 0) "
        "ELSE home_team_goal END")).withColumn(
        "stage", F.expr("CASE WHEN id % 500 = 11 AND stage > 1 THEN stage - 1 ELSE stage END"))
    for landing in (m, late, changed):
        files.write_parquet(landing.select(*names), f"{root}/landing", mode="append")
        q = stage_completion.start(spark, f"{root}/landing", lg, f"{root}/matches",
                                   f"{root}/totals", f"{root}/published", f"{root}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return stage_completion.read_published(spark, f"{root}/published")


@register("full_refresh", _contents_sql([*STAR_NAMES, "Point"]))
def q_full_refresh(spark, sf_dir):
    """W3 + S8: stage every star table as ';' text under one root, build the
    points Parquet, refresh the whole warehouse twice in load order with
    checks; rows and contents per table are those of one run."""
    from matchlake.sources.paths import table_path

    root = work_dir(spark, "full-refresh")
    staged = jobs.extract_tables(star.star_tables(spark, sf_dir), root, "csv")
    points = table_path(root, "lake", "points")
    jobs.points_job(spark, staged["Match"], staged["League"], points)
    wh = Warehouse(spark, location=table_path(root, "warehouse"))
    for _ in range(2):
        jobs.full_refresh(spark, wh, staged, points)
    return table_contents({n: wh.table(n) for n in STAR_NAMES + ["Point"]})


EARLY_VIEW = CHILD_VIEW | {
    "Match": "(SELECT * FROM match WHERE stage <= 6) m",
    "Point": "(SELECT * FROM point WHERE match_api_id IN "
             "(SELECT match_api_id FROM match WHERE stage <= 6)) p"}


@register("published_refresh", O.with_star("\nUNION ALL\n".join(
    _contents_rows([*STAR_NAMES, "Point"], view, f"'{moment}' AS moment, ")
    for moment, view in [("before", EARLY_VIEW), ("after failure", EARLY_VIEW),
                         ("after success", CHILD_VIEW)]), POINT_CTE))
def q_published_refresh(spark, sf_dir):
    """A warehouse that holds the first stages; a refresh whose new Match repeats keys
    fails its checks and changes nothing; a right one switches all eight tables."""
    tables = _tables_with_points(spark, sf_dir)
    m, lg = tables["Match"], tables["League"]
    early = m.where(F.col("stage") <= 6)

    def conformed(match: DataFrame) -> dict[str, DataFrame]:
        new = tables | {"Match": match, "Point": P.points_result(match, lg)}
        return {n: jobs.conform(df, TABLES[n].schema) for n, df in new.items()}

    wh = VersionedWarehouse(spark)
    moments = {}

    def look(moment: str) -> None:
        moments[moment] = table_contents({n: wh.table(n) for n in [*STAR_NAMES, "Point"]}) \
            .withColumn("moment", F.lit(moment))

    jobs.checked_refresh(wh, conformed(early))
    look("before")
    try:
        jobs.checked_refresh(wh, conformed(m.unionAll(m.where(F.col("id") % 5 == 0))))
    except jobs.FailedConstraint:
        look("after failure")
    jobs.checked_refresh(wh, conformed(m))
    look("after success")
    return reduce(DataFrame.unionByName, moments.values())


# Two extracts of Match: in some stretches of ids matches went, came and changed their score.
SNAPSHOT_CTE = """old AS (
  SELECT * FROM match WHERE NOT (id // 500 % 6 = 1 AND id % 10 = 2)),
new AS (
  SELECT * REPLACE (CASE WHEN id // 500 % 6 = 1 AND id % 10 = 4
                         THEN CASE WHEN home_team_goal IS NULL THEN 1 END
                         ELSE home_team_goal END AS home_team_goal)
  FROM match WHERE NOT (id // 500 % 6 = 1 AND id % 10 = 3)),
diff AS (
  SELECT *, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old)
  UNION ALL
  SELECT *, CAST(-1 AS BIGINT) AS copies FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new))"""


@register("snapshot_changes", O.with_star(
    "SELECT *, CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'changed' "
    "WHEN copies > 0 THEN 'added' ELSE 'removed' END AS change FROM diff",
    SNAPSHOT_CTE, tables=["match"]))
def q_snapshot_changes(spark, sf_dir):
    """Rows added, changed and removed between two extracts of Match; only key
    ranges whose hash differs are read again."""
    m, root = star.match(spark, sf_dir), work_dir(spark, "snapshots")
    touched = "floor(id / 500) % 6 = 1"
    old = m.where(f"NOT ({touched} AND id % 10 = 2)")
    new = m.where(f"NOT ({touched} AND id % 10 = 3)").withColumn("home_team_goal", F.expr(
        f"CASE WHEN {touched} AND id % 10 = 4 THEN CASE WHEN home_team_goal IS NULL THEN 1 END "
        "ELSE home_team_goal END"))
    snapshot.write_snapshot(old, f"{root}/old", "id", 500)
    snapshot.write_snapshot(new, f"{root}/new", "id", 500)
    return snapshot.snapshot_changes(spark, f"{root}/old", f"{root}/new", m.schema, "id")


@register("batch_append", O.with_star(O.POINTS_SQL, tables=LEAGUE_MATCH))
def q_batch_append(spark, sf_dir):
    """K7/K8 append with a batch ledger: the first batch arrives three times (two retries),
    the second once; the table holds each once."""
    wh = VersionedWarehouse(spark)
    pts = P.points_result(star.match(spark, sf_dir), star.league(spark, sf_dir))
    first, second = (pts.where(F.col("match_api_id") % 3 == 0),
                     pts.where(F.col("match_api_id") % 3 != 0))
    for rows, batch in [(first, "week 1"), (first, "week 1"), (second, "week 2"),
                        (first, "week 1")]:
        wh.append(rows, "Point", batch)
    return wh.table("Point")


@register("warehouse_constraints", _constraint_sql())
def q_warehouse_constraints(spark, sf_dir):
    """W3 + C1-C3: the declared constraints of a warehouse after its refresh."""
    root = work_dir(spark, "checked-refresh")
    staged = jobs.extract_tables(star.star_tables(spark, sf_dir), root, "csv")
    jobs.points_job(spark, staged["Match"], staged["League"], f"{root}/points")
    wh = Warehouse(spark, location=f"{root}/warehouse")
    jobs.full_refresh(spark, wh, staged, f"{root}/points")
    return jobs.check_constraints(wh)


# =============================================================================
# Data dictionary (K11 with A3)
# =============================================================================

# Written out, not taken from the schema that the query reads.
PLAYER_DICTIONARY = [
    ("id", "bigint", "Number of the player row."),
    ("player_api_id", "bigint", "Key of the player in the match feed."),
    ("player_name", "string", "Full name as printed on the team sheet."),
    ("player_fifa_api_id", "bigint", "Key of the player in the ratings feed."),
    ("birthday", "string", "Day of birth, as text."),
    ("height", "double", "Body height in centimetres."),
    ("weight", "double", "Body weight in pounds."),
]


def _dictionary_sql() -> str:
    return O.with_star("\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, '{comment}' AS comment, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM player"
        for c, t, comment in PLAYER_DICTIONARY), tables=["player"])


@register("column_comments", _dictionary_sql())
def q_column_comments(spark, sf_dir):
    """Player created with its column comments, loaded from the customer
    table; the comments are read back from the table definition next to each
    column's NULL count over the loaded rows."""
    wh = Warehouse(spark)
    wh.create("Player")
    wh.load(star.player(spark, sf_dir), "Player")
    return wh.dictionary("Player")
