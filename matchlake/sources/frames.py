"""In-memory pandas frame -> DataFrame with the dtype rule.

For small driver-side inputs only (a lookup list, a test fixture); table data
never passes through the driver.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.dtypes import spark_type


def pandas_schema(pdf: pd.DataFrame) -> T.StructType:
    return T.StructType([T.StructField(str(c), spark_type(t)) for c, t in zip(pdf.columns, pdf.dtypes)])


def pandas_to_spark(pdf: pd.DataFrame, spark: SparkSession) -> DataFrame:
    """DataFrame with one field per pandas column, typed by the dtype rule.

    pandas marks a missing float as NaN; Spark keeps NaN as a value, so NaN in
    float columns is turned into NULL, which is what it stood for.
    """
    schema = pandas_schema(pdf)
    df = spark.createDataFrame(pdf, schema=schema)
    return df.select(*[
        F.when(F.isnan(F.col(f"`{f.name}`")), F.lit(None)).otherwise(F.col(f"`{f.name}`"))
        .cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in schema.fields
    ])
