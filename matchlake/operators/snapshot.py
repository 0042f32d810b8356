"""Difference of two snapshots of a table by a hash tree over key ranges.

A snapshot is written once, in folders by key range, together with a tree of
hashes: a leaf per range, and above it nodes over ``FANOUT`` children each.  Two
snapshots are compared from the root down, following only nodes that differ, so
equal snapshots cost one row and a few changes a few nodes.  Only ranges whose
hash differs are read again; a filter on the folder names leaves the others out.

The hash of a range is the wrapping sum of the row hashes (order-free, so a partial
aggregate does it), next to the row count; repeated rows count as often as they
occur.  Two independent 64-bit row hashes are summed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FANOUT = 64
RANGE = "_range"
NODE = T.StructType([T.StructField("node", T.LongType()), T.StructField("n", T.LongType()),
                     T.StructField("one", T.LongType()), T.StructField("two", T.LongType()),
                     T.StructField("level", T.IntegerType())])


def _row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two hashes of all columns.  Each value travels with a mark for NULL, which the hash
    functions would skip."""
    cells = [c for name in df.columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    return F.xxhash64(F.lit(1), *cells), F.xxhash64(F.lit(2), *cells)


def _wrapping_sum(c: Column) -> Column:
    """Sum modulo 2**64, as a long."""
    total = F.sum(c.cast("decimal(38,0)"))
    half = F.lit(str(2 ** 63)).cast("decimal(38,0)")
    wrapped = F.pmod(total, half + half)
    return F.when(wrapped >= half, wrapped - half - half).otherwise(wrapped).cast("long")


def _node_hashes(df: DataFrame) -> list[Column]:
    return [F.sum("n").alias("n"), _wrapping_sum(F.col("one")).alias("one"),
            _wrapping_sum(F.col("two")).alias("two")]


def write_snapshot(df: DataFrame, path: str, key: str, width: int) -> None:
    """``df`` in folders of ``width`` keys each under ``path``/rows (rows without a key in one
    of their own), and its hash tree under ``path``/tree.

    The rows are written with their own partitioning; choose ``width`` for folders of a
    few hundred MB.
    """
    spark = df.sparkSession
    placed = df.withColumn(RANGE, F.floor(F.col(f"`{key}`") / width).cast("long"))
    placed.write.partitionBy(RANGE).parquet(f"{path}/rows")
    rows = read_rows(spark, path, df.schema)
    one, two = _row_hashes(df)
    nodes = (rows.select(F.col(RANGE).alias("node"), F.lit(1).alias("n"), one.alias("one"),
                         two.alias("two")).groupBy("node").agg(*_node_hashes(rows)))
    level = 0
    while True:
        nodes.select(F.col("node"), "n", "one", "two", F.lit(level).alias("level")) \
            .write.mode("append").partitionBy("level").parquet(f"{path}/tree")
        below = read_nodes(spark, path, level)
        if below.limit(2).count() < 2 and level:  # the root, or no row at all
            return
        # A child counts with its place, so equal hashes cannot change places unseen.
        # All ranges end up under node 0 or -1; the topmost node takes both, and the rows
        # without a key.
        last = below.agg(F.max(F.abs("node")).alias("m")).first().m
        up = F.lit(0) if (last or 0) < FANOUT else F.floor(F.col("node") / FANOUT)
        placed = F.coalesce(F.col("node").cast("string"), F.lit("none"))
        nodes = below.select(
            up.cast("long").alias("node"), "n", F.xxhash64(placed, "one", "n").alias("one"),
            F.xxhash64(placed, "two", "n").alias("two")).groupBy("node").agg(*_node_hashes(below))
        level += 1


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a snapshot with their range."""
    placed = T.StructType([*schema.fields, T.StructField(RANGE, T.LongType())])
    return spark.read.schema(placed).parquet(f"{path}/rows")


def read_nodes(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.schema(NODE).parquet(f"{path}/tree").where(F.col("level") == level)


def _levels(spark: SparkSession, path: str) -> int:
    return spark.read.schema(NODE).parquet(f"{path}/tree").agg(F.max("level").alias("m")).first().m \
        or 0


def _among(c: Column, values: list[int | None]) -> Column:
    named = c.isin([v for v in values if v is not None])
    return named | c.isNull() if None in values else named


def changed_ranges(spark: SparkSession, old: str, new: str) -> list[int | None]:
    """Ranges whose rows differ (None: the rows without a key).

    Like a listing of folders, this holds one number per differing range on the driver,
    never a row.  Snapshots of different height are compared leaf by leaf.
    """
    top = _levels(spark, old)
    level, parents = (top, None) if top == _levels(spark, new) else (0, None)
    while True:
        sides = []
        for path, tag in ((old, "a"), (new, "b")):
            nodes = read_nodes(spark, path, level)
            if parents is not None and level + 1 < top:
                nodes = nodes.where(_among(F.floor(F.col("node") / FANOUT), parents))
            sides.append(nodes.select("node", F.struct("n", "one", "two").alias(tag)))
        a, b = sides
        differ = (a.join(b, a.node.eqNullSafe(b.node), "full_outer")
                  .where(~F.col("a").eqNullSafe(F.col("b")))
                  .select(F.when(F.col("a").isNotNull(), a.node).otherwise(b.node).alias("node")))
        parents = [r.node for r in differ.collect()]
        if not parents or not level:
            return parents
        level -= 1


def snapshot_changes(spark: SparkSession, old: str, new: str, schema: T.StructType,
                     key: str) -> DataFrame:
    """The difference of two snapshots written with one ``width``, from the changed ranges.

    Returns the columns of ``schema``, ``copies`` and ``change``: a row with positive
    ``copies`` came so many times, one with negative ``copies`` went.  ``change`` is
    ``changed`` for a key (null-safe) with rows of both kinds, else ``added`` or
    ``removed``.  Taking the old rows, less those that went, plus those that came, gives
    the new ones, repeated rows included.
    """
    ranges = changed_ranges(spark, old, new)
    names = schema.fieldNames()
    sides = [read_rows(spark, path, schema).where(_among(F.col(RANGE), ranges))
             .select(*[F.col(f"`{n}`") for n in names], F.lit(sign).alias("copies"))
             for path, sign in ((old, -1), (new, 1))]
    rows = (reduce(DataFrame.unionAll, sides).groupBy(*[F.col(f"`{n}`") for n in names])
            .agg(F.sum("copies").alias("copies")).where(F.col("copies") != 0))
    # Rows that stayed are gone by now, so what is grouped by key is the change itself;
    # it is counted per key before the join, so a hot key is one row there.
    kinds = rows.groupBy(F.col(f"`{key}`").alias("_key")).agg(
        (F.max("copies") > 0).alias("_came"), (F.min("copies") < 0).alias("_went"))
    change = F.when(F.col("_came") & F.col("_went"), "changed") \
        .when(F.col("_came"), "added").otherwise("removed")
    return rows.join(kinds, rows[key].eqNullSafe(kinds["_key"])).select(
        *[F.col(f"`{n}`") for n in names], "copies", change.alias("change"))
