"""Warehouse tables: create (K5, K11), empty (K6), load (K7, K8), name (K9).

Tables are Parquet tables in a database whose folder lives in the shared
work area.  Loads are positional (``insertInto``), as the warehouse COPY and
``INSERT INTO t (cols) SELECT ...`` are.  A refresh is ``INSERT OVERWRITE``:
the old rows stay readable until the new ones are committed, so a failed
load never leaves an empty table (a DELETE then COPY would).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.rules import quote_name
from matchlake.schemas import TABLES, TableDef, ddl
from matchlake.session import work_dir


def positional(df: DataFrame, schema: T.StructType, fields: list[str]) -> DataFrame:
    """``df``, whose columns are ``fields`` by position, in the columns and types of ``schema``;
    columns not in ``fields`` are NULL."""
    if len(fields) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns given for {len(fields)} fields")
    source = dict(zip(fields, df.columns))
    return df.selectExpr(*[
        f"CAST({quote_name(source[f.name]) if f.name in source else 'NULL'} AS "
        f"{f.dataType.simpleString()}) AS {quote_name(f.name)}"
        for f in schema.fields
    ])


class Warehouse:
    def __init__(self, spark: SparkSession, database: str | None = None,
                 location: str | None = None):
        self.spark = spark
        self.database = database or f"matchlake_{uuid.uuid4().hex[:10]}"
        self.location = location or work_dir(spark, "warehouse")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
                  f"LOCATION '{self.location}'")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    # K5 + K11
    def create(self, table: str | TableDef, partition_by: list[str] | None = None,
               distribute_by: str | None = None, buckets: int = 0) -> str:
        """With ``partition_by`` the table's folders follow those columns; with
        ``distribute_by`` its rows are dealt to ``buckets`` by a hash of that key and sorted
        by it, so tables with one distribution key join on it without a shuffle.

        One bucket is read by one task: choose a key without hot values, and buckets
        for files of a few hundred MB.
        """
        t = TABLES[table] if isinstance(table, str) else table
        layout = f" PARTITIONED BY ({', '.join(map(quote_name, partition_by))})" \
            if partition_by else ""
        if distribute_by:
            key = quote_name(distribute_by)
            layout += f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(t.name)} ({ddl(t.schema, t.comments)}) "
            f"USING parquet{layout}"
        )
        return self.name(t.name)

    def create_all(self, tables: list[str] | None = None) -> None:
        for t in tables or list(TABLES):
            self.create(t)

    # K6
    def truncate(self, table: str) -> None:
        self.spark.sql(f"TRUNCATE TABLE {self.name(table)}")

    def drop(self) -> None:
        """Remove the database and its tables."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")

    # K7 = K8
    def load(self, df: DataFrame, table: str, fields: list[str] | None = None,
             append_only: bool = False) -> None:
        """``INSERT [OVERWRITE] INTO table (fields) <df>``, by position.

        Without ``append_only`` the table's rows are replaced; with it the new
        rows are added.  Table columns not in ``fields`` get NULL.
        """
        target = self.spark.table(self.name(table))  # partition columns stand last in it
        declared = TABLES[table].columns if table in TABLES else target.columns
        rows = positional(df, target.schema, list(fields) if fields else declared)
        rows.write.insertInto(self.name(table), overwrite=not append_only)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def analyze(self, table: str, columns: list[str] | None = None) -> None:
        """Statistics of the table and of ``columns`` (unless given, its keys and references)
        into the catalog: row count, size, distinct values, and histograms where the session
        asks for them.  A load makes them void, so run it after each.
        """
        t = TABLES.get(table)
        if columns is None:
            names = [*t.primary_key, *t.unique, *(r.column for r in t.references if r.enabled)] \
                if t else self.table(table).columns
            columns = list(dict.fromkeys(names))
        what = f"FOR COLUMNS {', '.join(map(quote_name, columns))}" if columns else ""
        self.spark.sql(f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS {what}")

    def analyzed_rows(self, table: str) -> int | None:
        """A1 without a scan: the row count of the last ``analyze``, None if a load came since."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}") \
            .where("col_name = 'Statistics'").collect()
        found = re.search(r"(\d+) rows", rows[0].data_type) if rows else None
        return int(found.group(1)) if found else None

    def comments(self, table: str) -> DataFrame:
        """The data dictionary, read back from the table definition."""
        return self.spark.sql(f"DESCRIBE TABLE {self.name(table)}")

    def dictionary(self, table: str) -> DataFrame:
        """Each column with its type and comment (from the table definition)
        and its NULL count over the loaded rows (one aggregate).

        Returns (column_name, data_type, comment, null_count).  The join is
        between two tables of one row per column.
        """
        from matchlake.operators.profile import null_profile

        described = self.comments(table).select(
            F.col("col_name").alias("column_name"), F.col("data_type"), F.col("comment"))
        nulls = null_profile(self.table(table), table).select("column_name", "null_count")
        return described.join(nulls, "column_name", "inner").select(
            "column_name", "data_type", "comment", "null_count")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """K9: make ``df`` queryable by name from SQL text."""
    df.createOrReplaceTempView(name)
    return df
