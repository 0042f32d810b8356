"""Delimited text readers (S3, S4, S5) with one dialect object for both sides.

The same ``Dialect`` writes and reads a file (``matchlake.sinks.files``), so a
file written with ';' is never read back with ','.  Schemas are always given:
no inference pass.  Parsing is positional: header names are skipped, not
matched, as the warehouse COPY does.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchlake.functions.rules import load_rule_sql, quote_name


@dataclass(frozen=True)
class Dialect:
    sep: str = ";"
    header: bool = True
    quote: str = '"'
    # Quotes inside a field are doubled (""), as pandas writes them.  Spark's
    # default backslash escape would cut such a field at the separator.
    escape: str = '"'
    # A cell may hold line breaks, so records are not cut at every line end.  Such a
    # file is read by one task, but a dataset is a folder of many part files.
    multiline: bool = True
    encoding: str = "UTF-8"

    def options(self) -> dict[str, str]:
        return {
            "sep": self.sep,
            "header": str(self.header).lower(),
            "quote": self.quote,
            "escape": self.escape,
            "multiLine": str(self.multiline).lower(),
            "encoding": self.encoding,
            # Spark's writer trims cells by default; a blank cell must survive
            # the file so the load rules can see it.
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }

    def with_(self, **kw) -> "Dialect":
        return replace(self, **kw)


# Extract files: ';'-separated with a header, no index column.
EXTRACT = Dialect(sep=";")
# Notebook files: ','-separated with a header and a leading unnamed index column.
NOTEBOOK = Dialect(sep=",")


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   dialect: Dialect = EXTRACT, mode: str = "FAILFAST") -> DataFrame:
    """Typed read by position; a malformed line fails the read (``FAILFAST``)."""
    return (spark.read.options(**dialect.options())
            .option("mode", mode)
            .option("enforceSchema", "true")
            .schema(schema)
            .csv(path))


def text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_staged(spark: SparkSession, path: str | list[str], schema: T.StructType,
                dialect: Dialect = EXTRACT, text_lengths: dict[str, int] | None = None,
                blanks_as_null: bool = True) -> DataFrame:
    """Read a staged file the way the warehouse COPY loads it.

    Cells are read as text by position, then: blank and empty -> NULL,
    text of a column with a given length cut to it, other cells parsed to the
    column type (a cell that does not parse fails the load).
    """
    raw = read_delimited(spark, path, text_schema(schema), dialect)
    if not blanks_as_null:
        return raw.selectExpr(*[f"CAST({quote_name(f.name)} AS {f.dataType.simpleString()}) "
                                f"AS {quote_name(f.name)}" for f in schema.fields])
    return apply_load_rules(raw, schema, text_lengths)


def apply_load_rules(raw: DataFrame, schema: T.StructType,
                     text_lengths: dict[str, int] | None = None) -> DataFrame:
    """Text columns of ``raw`` -> typed columns of ``schema`` under the load rules
    (one ``selectExpr``: the projection is built on the JVM side in one call)."""
    lengths = text_lengths or {}
    return raw.selectExpr(*[load_rule_sql(f.name, f.dataType, lengths.get(f.name))
                            for f in schema.fields])


INDEX_COLUMN = "_index"


def read_indexed(spark: SparkSession, path: str | list[str], schema: T.StructType,
                 dialect: Dialect = NOTEBOOK, keep_index: bool = False) -> DataFrame:
    """Read a comma file whose first column is an unnamed row index.

    Cells pass the same load rules as a staged file, so a column of whole
    numbers that pandas wrote as "1.0" because of a NULL loads as such.
    """
    with_index = T.StructType([T.StructField(INDEX_COLUMN, T.LongType(), True)] + schema.fields)
    df = read_staged(spark, path, with_index, dialect)
    return df if keep_index else df.drop(INDEX_COLUMN)
