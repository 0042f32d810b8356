"""Jobs: the points job (W1), extracts (W2), the full warehouse refresh
and the per-stage refresh of the standings (D4, K10).

Each job is a function of a session and paths; its steps are DataFrame plans
and distributed writes.  Only check reports (one small row per check) reach
the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.rules import quote_name
from matchlake.operators.load import Warehouse
from matchlake.operators.points import points_result, team_stage_points
from matchlake.operators.quality import (Check, constraint_report, non_empty_checks,
                                         run_checks)
from matchlake.operators.versions import VersionedWarehouse
from matchlake.schemas import LOAD_LEVELS, POINT, TABLES
from matchlake.sinks.files import overwrite_partitions, write_delimited, write_parquet
from matchlake.sources.csv import EXTRACT, Dialect, read_staged
from matchlake.sources.parquet import read_parquet


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of ``schema`` in its order; columns ``df`` lacks are NULL."""
    have = set(df.columns)
    return df.selectExpr(*[
        f"CAST({quote_name(f.name) if f.name in have else 'NULL'} AS "
        f"{f.dataType.simpleString()}) AS {quote_name(f.name)}"
        for f in schema.fields
    ])


# --- W1 ---------------------------------------------------------------------------

def points_job(spark: SparkSession, match_path: str, league_path: str, out_path: str,
               source: str = "csv", dialect: Dialect = EXTRACT) -> DataFrame:
    """Read Match and League, label each match, write the points table as Parquet."""
    if source == "csv":
        match, league = (read_staged(spark, path, TABLES[t].schema, dialect, TABLES[t].text_lengths)
                         for t, path in (("Match", match_path), ("League", league_path)))
    else:
        match = read_parquet(spark, match_path)
        league = read_parquet(spark, league_path)
    write_parquet(points_result(match, league), out_path)
    return read_parquet(spark, out_path, POINT)


# --- W2 ---------------------------------------------------------------------------

def extract_table(df: DataFrame, out_path: str, fmt: str = "parquet",
                  dialect: Dialect = EXTRACT) -> None:
    """One source table, from any reader -> one landing dataset: Parquet, or with
    ``fmt="csv"`` the ';' text that the staged load reads."""
    if fmt == "csv":
        write_delimited(df, out_path, dialect)
    elif fmt == "parquet":
        write_parquet(df, out_path)
    else:
        raise ValueError(f"unknown landing format {fmt!r}")


def extract_tables(tables: dict[str, DataFrame], root: str, fmt: str = "parquet",
                   dialect: Dialect = EXTRACT, max_parallel: int = 4) -> dict[str, str]:
    """All given tables, conformed to their warehouse schemas, landed under
    ``root`` as concurrent Spark jobs.  Returns each table's path."""
    from matchlake.sources.paths import table_path

    paths = {name: table_path(root, fmt, name) for name in tables}

    def land(name: str) -> None:
        extract_table(conform(tables[name], TABLES[name].schema), paths[name], fmt, dialect)

    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        for future in [pool.submit(land, n) for n in tables]:
            future.result()
    return paths


# --- W3 ---------------------------------------------------------------------------

def _load_levels(tables: set[str], load_one: Callable[[str], None],
                 max_parallel: int) -> list[str]:
    """``load_one`` for every table, level by level, the tables of a level side by side."""
    loaded = []
    for level in LOAD_LEVELS:
        names = [n for n in level if n in tables]
        with ThreadPoolExecutor(max_workers=max_parallel) as pool:
            for future in [pool.submit(load_one, n) for n in names]:
                future.result()  # re-raises the first failure of this level
        loaded += names
    return loaded


class FailedConstraint(ValueError):
    """A declared constraint that must hold does not hold in the new rows."""


def checked_refresh(warehouse: VersionedWarehouse, tables: dict[str, DataFrame],
                    checks: list[Check] | None = None,
                    must_hold: tuple[str, ...] = ("primary key", "unique"),
                    max_parallel: int = 4) -> int:
    """Publish after the checks: load the given tables into the next version, run the
    checks (Q1-Q5) and the declared constraints (C1-C3) on it, then switch all tables
    at once.  Returns the number of the new version.

    A failed load, check or constraint of a kind in ``must_hold`` raises, and every
    table still reads the version before.  Tables that are not given stay as they are.
    ``sql`` checks see the new tables as temp views under their names.
    """
    refresh = warehouse.begin()
    loaded = _load_levels(set(tables), lambda n: refresh.load(tables[n], n), max_parallel)
    new = {n: refresh.table(n) for n in refresh.next().folders}
    checks = checks if checks is not None else non_empty_checks(loaded)
    for name in {c.table for c in checks if c.kind == "sql"}:
        new[name].createOrReplaceTempView(name)
    run_checks(warehouse.spark, new, checks)
    for r in constraint_report(new).collect():  # one row per declared constraint
        if r.bad_keys and r.constraint in must_hold:
            raise FailedConstraint(f"{r.table_name}: {r.constraint} {r.column_name} is broken by "
                                   f"{r.bad_keys} keys in {r.bad_rows} rows")
    return refresh.publish()


def full_refresh(spark: SparkSession, warehouse: Warehouse, staged: dict[str, str],
                 points_path: str | None = None, dialect: Dialect = EXTRACT,
                 checks: list[Check] | None = None, raise_on_failure: bool = True,
                 max_parallel: int = 4) -> list[dict]:
    """Create the tables, replace the rows of every staged table level by level
    (dimensions, then attribute and fact tables, then Point from Parquet),
    then run the checks.  ``check_constraints`` on the warehouse's tables tells
    afterwards which declared keys and references do not hold.

    The tables of one level are loaded as concurrent Spark jobs on the same
    session (one thread each submits its job), so small dimension loads do
    not leave the cluster idle; a level starts only when the one before it
    is complete, and a failed load stops the refresh before the next level.
    """
    warehouse.create_all()

    def load_one(name: str) -> None:
        if name == "Point":
            df = read_parquet(spark, points_path, POINT)
        else:
            df = read_staged(spark, staged[name], TABLES[name].schema, dialect,
                             TABLES[name].text_lengths)
        warehouse.load(df, name)

    loaded = _load_levels({*staged} | ({"Point"} if points_path else set()), load_one, max_parallel)
    checks = checks if checks is not None else non_empty_checks(loaded)
    tables = {n: warehouse.table(n) for n in {c.table for c in checks if c.kind != "sql"}}
    return run_checks(spark, tables, checks, raise_on_failure=raise_on_failure)


def check_constraints(warehouse: Warehouse, tables: list[str] | None = None) -> DataFrame:
    """The declared constraints of the loaded tables, one row each (``constraint_report``)."""
    return constraint_report({n: warehouse.table(n) for n in tables or list(TABLES)})


# --- D4, K10 ----------------------------------------------------------------------

STAGE_PARTITIONS = ["season", "stage"]


def latest_stage_matches(match: DataFrame) -> DataFrame:
    """Matches of the last stage of each season (the stage that just finished).

    Matches without a season are a season of their own.
    """
    last = match.groupBy(F.col("season").alias("_season")).agg(F.max("stage").alias("_stage"))
    return match.join(last, F.col("season").eqNullSafe(F.col("_season"))
                      & F.col("stage").eqNullSafe(F.col("_stage")), "left_semi")


def refresh_stage_points(match_changed: DataFrame, league: DataFrame, path: str) -> None:
    """Recompute team points for the (season, stage) partitions present in
    ``match_changed`` and replace only those partitions of the table at ``path``.

    ``match_changed`` must hold every match of each stage it touches.
    """
    overwrite_partitions(team_stage_points(match_changed, league), path, STAGE_PARTITIONS,
                         cluster=True)
