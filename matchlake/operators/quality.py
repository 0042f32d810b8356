"""Data checks: counts against expected values (Q1-Q5) and key constraints.

A check report is a DataFrame, one row per check, so all checks run and the
report is complete; ``run_checks(..., raise_on_failure=True)`` then names the
first failing check in list order, as the post-load check step does.

Scale notes:

* Checks on the same table share one aggregate, so a table is scanned once
  however many checks name it.
* Key checks group by the key with a map-side partial aggregate: a hot key
  (one value holding a third of the rows) is collapsed to one row per task
  before the shuffle.
* Reference checks read the child once for all its references: rows are
  unpivoted into (column, key) pairs and counted per pair before the shuffle, so
  a hot key is one row per task when it is shuffled.
* The parents' keys go into the same count, marked as known.  A join would be planned
  by the tables' sizes, and a key taken from a wide table of mostly empty columns
  looks so small there that millions of keys were broadcast through the driver.
* Nothing runs when a check is built.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.schemas import TABLES, TableDef

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Check:
    """One data check: a metric of ``table`` compared with ``expected``.

    kind: ``row_count`` (COUNT(*) = expected), ``null_count`` (rows where
    ``column`` IS NULL = expected), ``non_empty`` (COUNT(*) > 0) or ``sql``
    (first cell of ``sql`` = expected; no row is a failure of its own).
    """

    table: str
    expected: int
    kind: str = "row_count"
    column: str | None = None
    sql: str | None = None

    @property
    def comparison(self) -> str:
        return ">" if self.kind == "non_empty" else "="

    @property
    def check_sql(self) -> str:
        if self.kind == "sql":
            return self.sql or ""
        if self.kind == "null_count":
            return f"SELECT COUNT(*) FROM {self.table} WHERE {self.column} IS NULL"
        return f"SELECT COUNT(*) FROM {self.table}"


# The post-load checks of the source pipeline
# (League 11 rows, no NULL League.id, Country 11 rows, no NULL Country.id,
# Player_Attributes 183978 rows).
REFERENCE_CHECKS = [
    Check("League", 11),
    Check("League", 0, "null_count", "id"),
    Check("Country", 11),
    Check("Country", 0, "null_count", "id"),
    Check("Player_Attributes", 183978),
]


def non_empty_checks(tables: list[str]) -> list[Check]:
    """Every loaded table must hold at least one row (Q5)."""
    return [Check(t, 0, "non_empty") for t in tables]


REPORT_COLUMNS = [
    "check_id", "table_name", "check_sql", "comparison", "expected", "actual", "passed", "message",
]


def _metric(check: Check) -> Column:
    if check.kind in ("row_count", "non_empty"):
        return F.count(F.lit(1))
    if check.kind == "null_count":
        return F.count_if(F.col(check.column).isNull())
    raise ValueError(f"unknown check kind {check.kind!r}")


def _report_row(check_id: int, check: Check, actual: Column) -> Column:
    return F.struct(
        F.lit(check_id).alias("check_id"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.check_sql).alias("check_sql"),
        F.lit(check.comparison).alias("comparison"),
        F.lit(check.expected).cast("bigint").alias("expected"),
        actual.cast("bigint").alias("actual"),
    )


def check_report(spark: SparkSession, tables: dict[str, DataFrame],
                 checks: list[Check]) -> DataFrame:
    """All checks as one DataFrame (``REPORT_COLUMNS``), one row per check."""
    by_table: dict[str, list[tuple[int, Check]]] = {}
    parts: list[DataFrame] = []
    for i, c in enumerate(checks, start=1):
        if c.kind == "sql":
            result = spark.sql(c.sql).limit(1)
            first = result.agg(F.first(F.col(result.columns[0])).alias("_v"))
            parts.append(first.select(F.inline(F.array(_report_row(i, c, F.col("_v"))))))
        else:
            by_table.setdefault(c.table, []).append((i, c))
    for table, items in by_table.items():
        row = tables[table].agg(*[_metric(c).alias(f"_m{i}") for i, c in items])
        parts.append(row.select(F.inline(F.array(
            *[_report_row(i, c, F.col(f"_m{i}")) for i, c in items]
        ))))
    report = reduce(DataFrame.unionByName, parts)
    passed = (
        F.when(F.col("actual").isNull(), F.lit(False))
        .when(F.col("comparison") == ">", F.col("actual") > F.col("expected"))
        .otherwise(F.col("actual") == F.col("expected"))
    )
    text = [F.col(c).cast("string") for c in ("actual", "expected")]
    message = (
        F.when(F.col("actual").isNull(),
               F.concat(F.col("table_name"), F.lit(": the check query gave no row")))
        .when(passed, F.concat(F.col("table_name"), F.lit(": ok, "), text[0]))
        .otherwise(F.concat(F.col("table_name"), F.lit(": found "), text[0], F.lit(", wanted "),
                            F.col("comparison"), F.lit(" "), text[1]))
    )
    return report.select(*REPORT_COLUMNS[:6], passed.alias("passed"), message.alias("message"))


def run_checks(spark: SparkSession, tables: dict[str, DataFrame], checks: list[Check],
               raise_on_failure: bool = True) -> list[dict]:
    """Run the checks; raise ``ValueError`` naming the first failure in list order.

    The collected report has one small row per check, never table data.
    """
    rows = sorted((r.asDict() for r in check_report(spark, tables, checks).collect()),
                  key=lambda r: r["check_id"])
    for r in rows:
        if r["passed"]:
            log.info(r["message"])
        elif raise_on_failure:
            raise ValueError(r["message"])
    return rows


# --- counts (A1, A2) ------------------------------------------------------------

def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def null_key_counts(tables: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """One row per table: rows whose key is NULL, next to the row count (one pass each)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"),
                    F.count_if(F.col(key).isNull()).alias("null_keys"))
             .select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"),
                     "row_count", "null_keys")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


# --- key constraints (C1-C3) ----------------------------------------------------

def _key_text(keys: list[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


ROWS_PER_TASK = 500_000


def key_tasks(df: DataFrame) -> int:
    """Tasks for the keys of ``df`` (one count; of a file scan it reads the footers only)."""
    return max(1, -(-df.count() // ROWS_PER_TASK))


def _counted(source: DataFrame, tasks: int) -> DataFrame:
    """Different rows of ``source`` with their number ``n_rows``, dealt to ``tasks``.

    Rows are counted per Arrow batch before the shuffle, so a hot key is a row per batch
    there, and no task holds the keys of a whole file split.
    """
    names = source.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.Table.from_batches([batch]).group_by(names, use_threads=False) \
                .aggregate([([], "count_all")])
            yield from got.select([*names, "count_all"]) \
                .rename_columns([*names, "n_rows"]).to_batches()

    schema = T.StructType([*source.schema.fields, T.StructField("n_rows", T.LongType())])
    return (source.mapInArrow(run, schema).repartition(tasks, *names)
            .groupBy(*names).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")))


def key_violations(df: DataFrame, table: str, keys: list[str] | tuple[str, ...],
                   primary: bool = True, tasks: int | None = None) -> DataFrame:
    """Key values held by more than one row; for a primary key also NULL keys.

    Returns (table_name, key_columns, key_value, n_rows).  A unique key (not
    primary) allows any number of rows with a NULL in the key.  With ``tasks``
    (``key_tasks``) the keys of atomic types are dealt to that many tasks, so the memory
    of one does not grow with the table; without, the session's shuffle decides.
    """
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    source = df.select(*keys)
    if not primary:
        source = source.where(~any_null)
    grouped = _counted(source, tasks) if tasks else \
        source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = (F.col("n_rows") > 1) | any_null if primary else F.col("n_rows") > 1
    return grouped.where(bad).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        _key_text(keys).alias("key_value"),
        "n_rows",
    )


def pk_violations(df: DataFrame, table: str, keys, tasks: int | None = None) -> DataFrame:
    return key_violations(df, table, keys, primary=True, tasks=tasks)


def unique_violations(df: DataFrame, table: str, keys, tasks: int | None = None) -> DataFrame:
    return key_violations(df, table, keys, primary=False, tasks=tasks)


def _counted_keys(cells: DataFrame, parents: DataFrame | None) -> DataFrame:
    """Different rows of ``cells`` with their number and whether ``parents``, which has the
    same columns, knows them (NULL if not)."""
    rows = cells.withColumns({"n_rows": F.lit(1).cast("bigint"),
                              "known": F.lit(None).cast("boolean")})
    if parents is not None:
        rows = rows.unionByName(parents.withColumns({"n_rows": F.lit(0).cast("bigint"),
                                                     "known": F.lit(True)}))
    return (rows.groupBy(*cells.columns)
            .agg(F.sum("n_rows").alias("n_rows"), F.max("known").alias("known"))
            .where(F.col("n_rows") > 0))


@dataclass(frozen=True)
class Reference:
    column: str
    parent: DataFrame
    parent_table: str
    parent_column: str


def fk_orphans(child: DataFrame, child_table: str, references: list[Reference]) -> DataFrame:
    """Child key values (not NULL) with no parent row, with their row counts.

    Returns (child_table, child_column, parent_table, parent_column,
    key_value, n_rows).  One scan of the child serves every reference.
    """
    types = {child.schema[r.column].dataType for r in references}
    key_type = types.pop() if len(types) == 1 else None

    def as_key(c: Column) -> Column:
        return c if key_type is not None else c.cast("string")

    keys = child.select(F.inline(F.array(*[
        F.struct(F.lit(r.column).alias("child_column"), as_key(F.col(r.column)).alias("key"))
        for r in references
    ]))).where(F.col("key").isNotNull())
    by_parent: dict[tuple[str, str], list[Reference]] = {}
    for r in references:  # a parent that several columns name is read once
        by_parent.setdefault((r.parent_table, r.parent_column), []).append(r)
    parents = reduce(DataFrame.unionByName, [
        rs[0].parent.select(
            F.explode(F.array(*[F.lit(r.column) for r in rs])).alias("child_column"),
            as_key(F.col(rs[0].parent_column)).alias("key")).where(F.col("key").isNotNull())
        for rs in by_parent.values()
    ])
    orphans = _counted_keys(keys, parents).where(F.col("known").isNull())

    def lookup(attr: str) -> Column:
        out = F.lit(None).cast("string")
        for r in reversed(references):
            out = F.when(F.col("child_column") == r.column, F.lit(getattr(r, attr))).otherwise(out)
        return out

    return orphans.select(
        F.lit(child_table).alias("child_table"),
        "child_column",
        lookup("parent_table").alias("parent_table"),
        lookup("parent_column").alias("parent_column"),
        F.col("key").cast("string").alias("key_value"),
        "n_rows",
    )


# --- all declared constraints -----------------------------------------------------

CONSTRAINT_COLUMNS = ["table_name", "constraint", "column_name", "parent", "bad_keys", "bad_rows"]


@dataclass(frozen=True)
class _Constraint:
    number: int
    kind: str
    columns: tuple[str, ...]
    parent_table: str | None = None
    parent_column: str | None = None

    @property
    def label(self) -> str | None:
        return f"{self.parent_table}.{self.parent_column}" if self.parent_table else None

    def cell(self) -> Column:
        """(number, key, no_key) of a row: the key as text, and whether a part of it is NULL."""
        missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns])
        return F.struct(F.lit(self.number).alias("number"), _key_text(list(self.columns)).alias("key"),
                        missing.alias("no_key"))


def _constraints(tables: dict[str, DataFrame], t: TableDef) -> list[_Constraint]:
    have = set(tables[t.name].columns)
    found = [("primary key", t.primary_key), *(("unique", (u,)) for u in t.unique)]
    found = [(kind, key, None, None) for kind, key in found if key and set(key) <= have]
    found += [("reference", (r.column,), r.parent, r.parent_column) for r in t.references
              if r.enabled and r.parent in tables and r.column in have]
    return [_Constraint(i, *c) for i, c in enumerate(found)]


def constraint_report(tables: dict[str, DataFrame],
                      definitions: dict[str, TableDef] | None = None) -> DataFrame:
    """Every declared primary key, unique column and enabled reference of the given tables.

    One row per constraint (``CONSTRAINT_COLUMNS``): how many key values break it
    and how many rows hold them.

    A table is read once for all its constraints: its rows become (constraint, key)
    cells, which a partial aggregate counts, so a hot key is one row per task.  A parent
    is read once per child table.
    """
    definitions = definitions or TABLES
    parts: list[DataFrame] = []
    for name, df in tables.items():
        constraints = _constraints(tables, definitions[name])
        if not constraints:
            continue
        cells = df.select(F.inline(F.array(*[c.cell() for c in constraints])))
        references = [c for c in constraints if c.kind == "reference"]
        by_parent: dict[str, list[_Constraint]] = {}
        for c in references:
            by_parent.setdefault(c.parent_table, []).append(c)
        parents = [
            tables[p].select(F.inline(F.array(*[
                F.struct(F.lit(c.number).alias("number"),
                         F.col(c.parent_column).cast("string").alias("key"),
                         F.lit(False).alias("no_key")) for c in cs])))
            .where(F.col("key").isNotNull()) for p, cs in by_parent.items()]
        keys = _counted_keys(cells, reduce(DataFrame.unionByName, parents) if parents else None)

        def numbers(kind: str) -> list[int]:
            return [c.number for c in constraints if c.kind == kind]

        number, no_key, repeated = F.col("number"), F.col("no_key"), F.col("n_rows") > 1
        bad = (F.when(number.isin(numbers("primary key")), repeated | no_key)
               .when(number.isin(numbers("unique")), repeated & ~no_key)
               .otherwise(~no_key & F.col("known").isNull()))
        found = keys.where(bad).groupBy("number").agg(
            F.count(F.lit(1)).alias("bad_keys"), F.sum("n_rows").alias("bad_rows"))
        labels = df.sparkSession.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(c.number).alias("number"), F.lit(name).alias("table_name"),
                     F.lit(c.kind).alias("constraint"),
                     F.lit(",".join(c.columns)).alias("column_name"),
                     F.lit(c.label).cast("string").alias("parent")) for c in constraints])))
        parts.append(labels.join(found, "number", "left").select(
            "table_name", "constraint", "column_name", "parent",
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("bad_keys", "bad_rows")]))
    return reduce(DataFrame.unionByName, parts).select(*CONSTRAINT_COLUMNS)
