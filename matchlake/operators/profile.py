"""Table profiles: shape, types, NULLs, repeated rows, numeric spread, first rows.

Each profile is one aggregate over the table (never one job per column) and
is returned in long form: one row per column, built with ``inline`` from the
single aggregated row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.operators.quantiles import exact_quantiles, long_values

COPIES_PER_ROW = 10_000  # copies of one row that a task writes out in one step of repeated_rows


def _is_float(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def _missing(c: Column, dt: T.DataType) -> Column:
    """NULL, and for floating columns also NaN (pandas counts both as missing)."""
    return c.isNull() | F.isnan(c) if _is_float(dt) else c.isNull()


# --- A6, A7 ------------------------------------------------------------------------

def shape(df: DataFrame, table: str) -> DataFrame:
    """(table_name, n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(table).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


# --- A3 ----------------------------------------------------------------------------

def null_profile(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, position, data_type, null_count), one pass."""
    fields = df.schema.fields
    counts = df.agg(*[
        F.count_if(_missing(F.col(f"`{f.name}`"), f.dataType)).alias(f"_n{i}")
        for i, f in enumerate(fields)
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.lit(i + 1).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_n{i}").alias("null_count"),
        )
        for i, f in enumerate(fields)
    ])))


# --- A4, P7 ------------------------------------------------------------------------

def _hash_input(df: DataFrame) -> list[Column]:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if _is_float(f.dataType):  # -0.0 groups with 0.0, so it must hash with it too
            c = F.when(c == 0, F.lit(0.0).cast(f.dataType)).otherwise(c)
        out.append(c)
    return out


def repeated_groups(df: DataFrame) -> DataFrame:
    """Distinct rows that occur more than once, with ``n_copies``.

    NULLs (and NaNs) compare equal, as in pandas ``duplicated``.

    Hash first: every row is reduced to two independent 32/64-bit hashes and
    only (hash, count) pairs are shuffled.  Hash groups with one row cannot
    hold a repeat, so only rows of the other groups are grouped on their real
    columns (a hash collision is split apart there).  The planner picks the
    semi-join at run time; both groupings aggregate before they shuffle.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = df.select(*cols, F.xxhash64(*_hash_input(df)).alias("_h1"),
                       F.hash(*_hash_input(df)).alias("_h2"))
    candidates = (hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
                  .where(F.col("_n") > 1).select("_h1", "_h2"))
    source = hashed.join(candidates, ["_h1", "_h2"], "left_semi").select(*cols)
    grouped = source.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_copies"))
    return grouped.where(F.col("n_copies") > 1)


def repeated_rows(df: DataFrame) -> DataFrame:
    """The second and later copies of every row (``df[df.duplicated()]``), as rows.

    Copies are written out in two steps with a shuffle between them, so the
    copies of one hot row are spread over the tasks.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    extra = F.col("n_copies") - 1
    last = ((extra - 1) / COPIES_PER_ROW).cast("bigint")
    parts = repeated_groups(df).select(
        *cols, extra.alias("_extra"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_part"))
    size = F.least(F.lit(COPIES_PER_ROW).cast("bigint"),
                   F.col("_extra") - F.col("_part") * COPIES_PER_ROW)
    spread = parts.repartition(F.xxhash64(*_hash_input(df)), "_part")
    return spread.select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy")) \
        .select(*cols)


def duplicate_rows(df: DataFrame, table: str) -> DataFrame:
    """(table_name, row_count, duplicate_rows): count of second and later copies."""
    total = df.agg(F.count(F.lit(1)).alias("_v")).select(F.lit("row_count").alias("_k"), "_v")
    extra = repeated_groups(df).agg(
        F.coalesce(F.sum(F.col("n_copies") - 1), F.lit(0)).cast("bigint").alias("_v")
    ).select(F.lit("duplicate_rows").alias("_k"), "_v")
    both = total.unionByName(extra)
    return both.agg(
        F.max(F.when(F.col("_k") == "row_count", F.col("_v"))).alias("row_count"),
        F.max(F.when(F.col("_k") == "duplicate_rows", F.col("_v"))).alias("duplicate_rows"),
    ).select(F.lit(table).alias("table_name"), "row_count", "duplicate_rows")


# --- A5 ----------------------------------------------------------------------------

PROFILE_STATS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def numeric_profile(df: DataFrame, table: str, columns: list[str] | None = None,
                    digits: int | None = None) -> DataFrame:
    """``describe()``: count, mean, std (sample), min, quartiles, max per numeric column.

    The columns become rows (column number, value), so the plan stays as small
    for a hundred columns as for one.  Quartiles are exact and interpolate
    linearly between ranks, as pandas does.  NaN counts as missing, like NULL;
    infinities sort at the ends.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)
             and (columns is None or f.name in columns)]
    values = long_values(df, names)
    moments = values.groupBy("c").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    quarters = exact_quantiles(values, [0.25, 0.5, 0.75])
    labels = F.array(*[F.lit(n) for n in names]) if names else F.array(F.lit(""))
    columns_of = df.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias("c"),
        F.element_at(labels, F.col("id").cast("int") + 1).alias("column_name"))

    def r(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    return columns_of.join(moments, "c", "left").join(quarters, "c", "left").select(
        F.lit(table).alias("table_name"), "column_name",
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        *[r(F.col(c)).alias(c) for c in ("mean", "std", "min")],
        *[r(F.col("q")[k]).alias(n) for k, n in enumerate(("q25", "q50", "q75"))],
        r(F.col("max")).alias("max"))


# --- P8, L1 ------------------------------------------------------------------------

def drop_null_rows(df: DataFrame) -> DataFrame:
    """``dropna()``: drop rows with a NULL (or NaN) in any column."""
    return df.na.drop(how="any")


def first_rows(df: DataFrame, order_by: str | list[str] = "id", n: int = 5) -> DataFrame:
    """``head()``: Spark rows have no file order, so a key orders them.

    ``orderBy().limit()`` plans as a distributed top-k (TakeOrderedAndProject):
    each task keeps its ``n`` best rows, no global sort.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)
