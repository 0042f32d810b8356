"""One file read by many tasks equals the read by one."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from matchlake import catalog
from matchlake.plans import star
from matchlake.session import work_dir
from matchlake.sinks.files import write_delimited
from matchlake.sources.csv import EXTRACT, NOTEBOOK, read_staged
from matchlake.sources.split_csv import read_split_records, read_split_staged


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("dialect", [EXTRACT, NOTEBOOK, EXTRACT.with_(header=False)])
def test_many_tasks_read_one_file_like_one_task(spark, small_splits, dialect):
    m = catalog._awkward(star.match(spark, SF_SMALL)).limit(400)
    path = work_dir(spark, "one-file")
    write_delimited(m.coalesce(1), path, dialect)
    got = read_split_staged(spark, path, m.schema, dialect)
    assert read_split_records(spark, path, dialect).rdd.getNumPartitions() > 20
    assert same(got, read_staged(spark, path, m.schema, dialect)) and same(got, m)


def test_cells_longer_than_several_splits(spark, small_splits):
    rng = random.Random(4)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    texts = ["".join(rng.choice('ab";\n\r,é') for _ in range(rng.choice([1, 30, 3000])))
             for _ in range(60)] + ["id;t", "x\n" * 1500]
    df = spark.createDataFrame(list(enumerate(["q" + t + "q" for t in texts])), schema).coalesce(2)
    path = work_dir(spark, "long-cells")
    write_delimited(df, path)
    assert same(read_split_staged(spark, path, schema), df)


def test_bad_cells_and_other_quoting_fail(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    path = work_dir(spark, "bad-cells")
    write_delimited(spark.createDataFrame([("x", "y")], "id string, t string"), path)
    with pytest.raises(Exception, match="cannot load column id"):
        read_split_staged(spark, path, schema).collect()
    with pytest.raises(ValueError, match="doubled quotes"):
        read_split_records(spark, path, EXTRACT.with_(escape="\\"))


def test_empty_folder_and_header_only(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    path = work_dir(spark, "no-rows")
    write_delimited(spark.createDataFrame([], schema), path)
    assert read_split_staged(spark, path, schema).count() == 0
