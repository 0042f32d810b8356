"""Sketch profiles: only changed folders are read again, and how far off they are."""

import math

import numpy as np
from pyspark.sql import functions as F

from matchlake.operators import growing_profile as G
from matchlake.session import work_dir
from matchlake.sinks.files import overwrite_partitions, write_parquet


def frame(spark, rows):
    return spark.createDataFrame(rows, "a int, b double, t string, season string")


def table(spark, path):
    return spark.read.schema("a int, b double, t string, season string").parquet(path)


def profile(spark, path, store):
    return {r.column_name: r for r in
            G.merged_profile(table(spark, path), "season", store).collect()}


def test_only_changed_folders_are_read_again(spark):
    rng = np.random.default_rng(1)
    path, store = work_dir(spark, "grow"), work_dir(spark, "grow-store")
    rows = [(int(rng.integers(0, 5000)) if i % 7 else None, float(rng.normal()) if i % 11 else math.nan,
             "x", ["2008/2009", "2009/2010", None, "a b%2F"][i % 4]) for i in range(8000)]
    write_parquet(frame(spark, rows), path, partition_by=["season"])
    assert G.update_profile(table(spark, path), "season", store) == sorted(
        ["=2008/2009", "=2009/2010", "none", "=a b%2F"])
    assert G.update_profile(table(spark, path), "season", store) == []
    more = [(i, float(i), "y", "2009/2010") for i in range(1000)] + [(None, None, "z", "2010/2011")]
    write_parquet(frame(spark, more), path, mode="append", partition_by=["season"])
    assert G.update_profile(table(spark, path), "season", store) == ["=2009/2010", "=2010/2011"]
    rows += more
    check(profile(spark, path, store), rows)
    # A replaced folder counts anew; its old rows are gone.
    less = [(5, 1.0, "q", "2008/2009")]
    overwrite_partitions(frame(spark, less), path, ["season"])
    assert G.update_profile(table(spark, path), "season", store) == ["=2008/2009"]
    check(profile(spark, path, store), [r for r in rows if r[3] != "2008/2009"] + less)


def check(got, rows):
    for k, name in enumerate("ab"):
        values = np.array([r[k] for r in rows if r[k] is not None and not math.isnan(r[k])], float)
        r = got[name]
        assert (r["count"], r.null_count) == (len(values), len(rows) - len(values))
        assert np.isclose(r.mean, values.mean()) and np.isclose(r.std, values.std(ddof=1))
        assert (r.min, r.max) == (values.min(), values.max())
        for p, q in ((.25, r.q25), (.5, r.q50), (.75, r.q75)):
            assert (values < q).mean() - 0.01 <= p <= (values <= q).mean() + 0.01
        assert abs(r.distinct - len(set(values))) <= 0.06 * len(set(values))


def test_changed_folders_are_a_filter_on_the_scan(spark):
    from conftest import plan_text
    path = work_dir(spark, "grow-plan")
    write_parquet(frame(spark, [(1, 1.0, "", "x"), (2, 2.0, "", "y")]), path, partition_by=["season"])
    read = table(spark, path).where(G._among(F.col("season"), ["=x"]))
    filters = plan_text(read, "extended").split("PartitionFilters: ")[1]
    assert filters.startswith("[") and "season" in filters.split("]")[0]
    assert read.select(F.input_file_name()).distinct().count() == 1


def test_empty_columns(spark):
    path, store = work_dir(spark, "grow-null"), work_dir(spark, "grow-null-store")
    write_parquet(frame(spark, [(None, None, "t", "s")]), path, partition_by=["season"])
    G.update_profile(table(spark, path), "season", store)
    r = profile(spark, path, store)["a"]
    assert (r["count"], r.null_count, r.distinct, r.q50, r.std) == (0, 1, 0, None, None)
