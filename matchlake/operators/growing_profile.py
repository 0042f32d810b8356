"""Profile of a growing table from sketches kept per folder (A3, A5).

For every folder of a partitioned table and every numeric column the store keeps
count, NULLs, moments, extremes, a KLL quantile sketch and a HyperLogLog distinct
sketch.  Bringing the store up to date reads only folders whose files changed;
a profile merges the stored rows, a few per folder, and reads no table row.

A folder is known by the names of its files, which Spark never uses twice.  Quantiles
have a rank error of about 1.65 / ``KLL_K`` * 1.33 (under 1 % of the rows with the
value here), distinct counts a relative standard error of about
1.04 / 2 ** (``HLL_BITS`` / 2), under 2 %.  For exact quartiles see ``numeric_profile``.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.operators.quantiles import long_values
from matchlake.sinks.files import overwrite_partitions

KLL_K = 400
HLL_BITS = 12
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a NULL
STORE = T.StructType([
    T.StructField("column_name", T.StringType()), T.StructField("count", T.LongType()),
    T.StructField("null_count", T.LongType()), T.StructField("mean", T.DoubleType()),
    T.StructField("m2", T.DoubleType()), T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()), T.StructField("quantiles", T.BinaryType()),
    T.StructField("distinct", T.BinaryType()), T.StructField("files", T.StringType()),
    T.StructField("folder", T.StringType())])


def _folders(table: DataFrame, by: str) -> dict[str, str]:
    """Folder key ("=" and its value, "none" for NULL) -> digest of the names of its files, from the
    file listing alone."""
    found: dict[str, list[str]] = {}
    for path in table.inputFiles():
        value = next(part for part in path.split("/") if part.startswith(f"{by}="))
        value = unquote(unquote(value[len(by) + 1:]))  # escaped in the name, and in the URI
        found.setdefault("none" if value == NO_VALUE else f"={value}", []) \
            .append(path.rsplit("/", 1)[1])
    return {v: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()
            for v, names in found.items()}


def _stored(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(store)


def _among(c: Column, keys: list[str]) -> Column:
    named = c.cast("string").isin([k[1:] for k in keys if k != "none"])
    return named | c.isNull() if "none" in keys else named


def update_profile(table: DataFrame, by: str, store: str) -> list[str]:
    """Bring the store up to date with a table that lies in folders of ``by``; the keys of the
    folders that were read."""
    spark = table.sparkSession
    spark.createDataFrame([], STORE).write.mode("append").partitionBy("folder").parquet(store)
    now = _folders(table, by)
    known = {r.folder: r.files for r in _stored(spark, store).select("folder", "files")
             .distinct().collect()}  # a row per folder
    changed = sorted(v for v, files in now.items() if known.get(v) != files)
    if not changed:
        return []
    names = [f.name for f in table.schema.fields
             if isinstance(f.dataType, T.NumericType) and f.name != by]
    rows = table.where(_among(F.col(f"`{by}`"), changed))
    folder = F.coalesce(F.concat(F.lit("="), F.col(f"`{by}`").cast("string")), F.lit("none"))
    sizes = rows.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("rows"))
    values = long_values(rows, names, folder.alias("folder"))
    v = F.col("v")
    seen = values.groupBy("folder", "c").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("min"),
        F.max("v").alias("max"), F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias("quantiles"),
        F.hll_sketch_agg(F.xxhash64(v), F.lit(HLL_BITS)).alias("distinct"))
    columns = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(n).alias("column_name"))
                        for i, n in enumerate(names)])
    digests = F.create_map(*[F.lit(x) for v in changed for x in (v, now[v])])
    out = (sizes.select("folder", "rows", F.inline(columns))
           .join(seen, ["folder", "c"], "left")
           .withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
           .withColumn("null_count", F.col("rows") - F.col("count"))
           .withColumn("files", digests[F.col("folder")]))
    overwrite_partitions(out.select(*STORE.fieldNames()), store, ["folder"], cluster=True)
    return changed


def merged_profile(table: DataFrame, by: str, store: str) -> DataFrame:
    """(column_name, count, null_count, mean, std, min, q25, q50, q75, max, distinct) of the
    table's present folders, from the store alone."""
    now = sorted(_folders(table, by))
    rows = _stored(table.sparkSession, store).where(F.col("folder").isin(now))
    n, mean = F.col("count"), F.col("mean")
    got = rows.groupBy("column_name").agg(
        F.sum(n).alias("count"), F.sum("null_count").alias("null_count"),
        (F.sum(mean * n) / F.sum(n)).alias("mean"),
        F.sum(F.col("m2") + n * mean * mean).alias("_squares"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles").alias("_quantiles"),
        F.hll_union_agg("distinct").alias("_distinct"))
    spread = F.greatest(F.col("_squares") - n * mean * mean, F.lit(0.0))
    quantile = [F.kll_sketch_get_quantile_double("_quantiles", F.lit(p)).alias(f"q{int(p * 100)}")
                for p in (0.25, 0.5, 0.75)]
    full = F.col("count") > 0
    return got.select(
        "column_name", "count", "null_count", "mean",
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"), "min",
        *[F.when(full, q).alias(f"q{p}") for q, p in zip(quantile, (25, 50, 75))], "max",
        F.when(full, F.hll_sketch_estimate("_distinct")).otherwise(0).alias("distinct"))
