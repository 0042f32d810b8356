"""The dtype pandas gives every column of a table, and its Spark type by the dtype rule.

The source pipeline reads each table into pandas and maps the resulting
dtypes to Spark types (F7).  The only thing about the data that decides a
dtype is whether an integer column holds a NULL (pandas then reads it as
float64), so one JVM aggregate over the table is enough; the table is never
converted to pandas.  The dtype and the mapped type are Column expressions
from the rules of ``matchlake.functions.dtypes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.dtypes import read_dtype, spark_type


def _dtype_expr(dt: T.DataType, nulls: Column) -> Column:
    with_nulls, without = read_dtype(dt, True), read_dtype(dt, False)
    if with_nulls == without:
        return F.lit(without)
    return F.when(nulls > 0, F.lit(with_nulls)).otherwise(F.lit(without))


def _type_expr(dt: T.DataType, nulls: Column) -> Column:
    with_nulls, without = (spark_type(read_dtype(dt, n)).simpleString() for n in (True, False))
    return F.when(nulls > 0, F.lit(with_nulls)).otherwise(F.lit(without))


def pandas_dtypes(df: DataFrame) -> DataFrame:
    """(column_name, position, pandas_dtype, spark_type) for every column of ``df``."""
    fields = df.schema.fields
    nulls = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}")
                     for i, f in enumerate(fields)])
    rows = nulls.select(F.inline(F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i + 1).alias("position"),
            _dtype_expr(f.dataType, F.col(f"_n{i}")).alias("pandas_dtype"),
            _type_expr(f.dataType, F.col(f"_n{i}")).alias("spark_type"),
        )
        for i, f in enumerate(fields)
    ])))
    return rows
