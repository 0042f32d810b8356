"""Spark type of a pandas column (F7), by the kind and width of its dtype."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import types as T

# Spark types of dates, whole numbers of 64 and 32 bits, and floats.
# Floats are 64-bit: a 32-bit one turns 1.73 into 1.7300000190734863.
DATE_TYPE, LONG_TYPE, INT_TYPE, FLOAT_TYPE = (T.TimestampType(), T.LongType(), T.IntegerType(),
                                              T.DoubleType())

# numpy kind letter and bytes -> Spark type; narrower integers fit the 32-bit type,
# unsigned ones of 32 bits need the 64-bit one.  Kinds not listed are text.
_BY_KIND = {("i", 8): LONG_TYPE, ("i", 4): INT_TYPE, ("i", 2): INT_TYPE, ("i", 1): INT_TYPE,
            ("u", 4): LONG_TYPE, ("u", 2): INT_TYPE, ("u", 1): INT_TYPE,
            ("f", 8): FLOAT_TYPE, ("f", 4): FLOAT_TYPE, ("f", 2): FLOAT_TYPE,
            ("b", 1): T.BooleanType()}


def spark_type(dtype) -> T.DataType:
    """Spark type of a dtype or its name; pandas' nullable dtypes ("Int64") and time zones too."""
    dtype = pd.api.types.pandas_dtype(dtype)
    if dtype.kind == "M":
        return DATE_TYPE
    plain = getattr(dtype, "numpy_dtype", dtype)
    return _BY_KIND.get((dtype.kind, getattr(plain, "itemsize", 0)), T.StringType())


def read_dtype(data_type: T.DataType, has_nulls: bool) -> str:
    """The dtype pandas gives a column of ``data_type`` when it reads it.

    Whole numbers that hold a NULL come back as floats (NaN marks the gap), and
    so do floats; truth values with a NULL as objects.
    """
    if isinstance(data_type, T.BooleanType):
        return "object" if has_nulls else "bool"
    if isinstance(data_type, T.IntegralType):
        width = {"bigint": 64, "int": 32, "smallint": 16, "tinyint": 8}[data_type.simpleString()]
        return "float64" if has_nulls else f"int{width}"
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        return "float64"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "datetime64[ns]"
    return "object"
