"""Exact quantiles of many columns at once, without any value on the driver.

Values are counted per (column, value) with a partial aggregate, so a hot value
is one row per task, and range-partitioned by (column, value): the one shuffle
of the data.  The sorted counts are checkpointed to the shared folder (both
passes below must see the same partitions, also after an executor loss).  One
small row per partition and column gives each partition's first rank; only the
partitions that hold a wanted rank are read again to find its value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.session import ensure_checkpoint_dir


def long_values(df: DataFrame, names: list[str], *keep: Column) -> DataFrame:
    """(``keep``, c, v): one row per value that is neither NULL nor NaN, c the column's number."""
    if not names:
        return df.sparkSession.createDataFrame([], "c int, v double")
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cells = []
    for i, n in enumerate(names):
        c = F.col(f"`{n}`")
        v = F.when(~F.isnan(c), c) if isinstance(types[n], (T.FloatType, T.DoubleType)) else c
        cells.append(F.struct(F.lit(i).alias("c"), v.cast("double").alias("v")))
    return df.select(*keep, F.inline(F.array(*cells))).where(F.col("v").isNotNull())


def exact_quantiles(values: DataFrame, probs: list[float]) -> DataFrame:
    """(c, v) -> (c, q): per column its quantiles in the order of ``probs``.

    Linear interpolation between the two neighbouring ranks.  A column without
    values gives no row.
    """
    ensure_checkpoint_dir(values.sparkSession)
    counts = (values.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
              .repartitionByRange("c", "v").sortWithinPartitions("c", "v")
              .withColumn("part", F.spark_partition_id()).checkpoint(eager=True))
    sizes = counts.groupBy("part", "c").agg(F.sum("n").alias("n"))
    ordered = Window.partitionBy("c").orderBy("part")
    ranges = sizes.select(
        "part", "c", "n", (F.sum("n").over(ordered) - F.col("n")).alias("first"),
        F.sum("n").over(Window.partitionBy("c")).alias("total"))

    wanted = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(p)).alias("p"))
                       for k, p in enumerate(probs)])
    ranks = (ranges.select("part", "c", "n", "first", "total", F.inline(wanted))
             .withColumn("at", (F.col("total") - 1) * F.col("p"))
             .withColumn("rank", F.explode(F.array_distinct(
                 F.array(F.floor("at"), F.ceil("at")))))
             .where((F.col("rank") >= F.col("first"))
                    & (F.col("rank") < F.col("first") + F.col("n")))
             .select("part", "c", "first", "k", "at", "rank"))

    # Running counts inside the few partitions that hold a wanted rank.
    inside = Window.partitionBy("part", "c").orderBy("v")
    needed = ranks.select("part", "c", "first").distinct()
    spans = (counts.join(needed, ["part", "c"]).select(
        "part", "c", "v", (F.col("first") + F.sum("n").over(inside)).alias("end"), "n"))
    found = (ranks.join(spans, ["part", "c"])
             .where((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n"))))
    pairs = found.groupBy("c", "k").agg(F.min("v").alias("low"), F.max("v").alias("high"),
                                        F.max(F.col("at") - F.floor("at")).alias("share"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        F.col("low") + (F.col("high") - F.col("low")) * F.col("share"))
    entries = F.array_sort(F.collect_list(F.struct("k", value.alias("v"))))
    return pairs.groupBy("c").agg(F.transform(entries, lambda e: e["v"]).alias("q"))
