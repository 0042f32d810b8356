"""Hand-written literal cases for the semantics the driver tables cannot show
(they hold no NULL, blank or malformed cell)."""

import math
import re

import pandas as pd
import pytest
from conftest import plan_text
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions.results import match_result
from matchlake.operators.points import points_result
from matchlake.operators.profile import drop_null_rows, null_profile
from matchlake.operators.load import Warehouse
from matchlake.operators.quality import Check, check_report, run_checks
from matchlake.schemas import TABLES
from matchlake.session import work_dir
from matchlake.sinks.files import write_delimited
from matchlake.sources.csv import read_delimited, read_indexed, read_staged
from matchlake.sources.frames import pandas_to_spark

GOALS = T.StructType([T.StructField("h", T.IntegerType()), T.StructField("a", T.IntegerType())])


def _labels(spark, rows, strict):
    df = spark.createDataFrame(rows, GOALS)
    return [r[0] for r in df.select(match_result(F.col("h"), F.col("a"), strict)).collect()]


def test_result_labels(spark):
    assert _labels(spark, [(2, 1), (1, 2), (1, 1)], False) == ["Home", "Away", "Tie"]


def test_null_goal_is_tie_unless_strict(spark):
    rows = [(None, 1), (1, None), (None, None)]
    assert _labels(spark, rows, False) == ["Tie", "Tie", "Tie"]
    assert _labels(spark, rows, True) == [None, None, None]


def test_unknown_or_null_league_dropped(spark):
    match = spark.createDataFrame(
        [(1, 1, 0, "2008/2009", 1), (2, 1, 0, "2008/2009", 99), (3, 2, 2, "2008/2009", None)],
        "match_api_id long, home_team_goal int, away_team_goal int, season string, league_id long")
    league = spark.createDataFrame([(1, 1, "L1")], "id long, country_id long, name string")
    out = points_result(match, league).collect()
    assert [(r.match_api_id, r.result, r.name) for r in out] == [(1, "Home", "L1")]


def _stage(tmp_dir, text):
    import os

    os.makedirs(tmp_dir, exist_ok=True)
    with open(f"{tmp_dir}/part-0.csv", "w", newline="") as fh:
        fh.write(text)
    return tmp_dir


NAMES = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_empty_quoted_empty_and_blank_cells_load_as_null(spark, tmp_dir):
    path = _stage(tmp_dir, 'id;name\n1;\n2;""\n3;"   "\n4;\t \n5;  kept\n')
    rows = {r.id: r.name for r in read_staged(spark, path, NAMES).collect()}
    assert rows == {1: None, 2: None, 3: None, 4: None, 5: "  kept"}


def test_long_text_is_cut_without_error(spark, tmp_dir):
    path = _stage(tmp_dir, "id;name\n1;abcdefghij\n2;abc\n")
    rows = {r.id: r.name for r in read_staged(spark, path, NAMES, text_lengths={"name": 5}).collect()}
    assert rows == {1: "abcde", 2: "abc"}


def test_separator_quote_and_line_break_round_trip(spark, tmp_dir):
    values = [(1, "a;b"), (2, 'say "hi"'), (3, "two\nlines"), (4, ""), (5, None), (6, "\r\n"),
              (7, '";\n"'), (8, "back\\"), (9, ' "\\" '), (10, "\n"), (11, "#x"), (12, "é\u2028x")]
    first = T.StructType(list(reversed(NAMES.fields)))
    for schema, rows in ((NAMES, values), (first, [(b, a) for a, b in values])):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        path = f"{tmp_dir}/{schema.fields[0].name}"
        write_delimited(df, path)
        back = {r.id: r.name for r in read_delimited(spark, path, schema).collect()}
        assert back.pop(4) is None and back.pop(5) is None
        assert back == {i: t for i, t in values if i not in (4, 5)}


def test_header_names_are_ignored_columns_map_by_position(spark, tmp_dir):
    path = _stage(tmp_dir, "name;id\n7;x\n")
    schema = T.StructType([T.StructField("id", T.LongType()),
                           T.StructField("code", T.StringType())])
    (row,) = read_staged(spark, path, schema).collect()
    assert (row.id, row.code) == (7, "x")


def test_not_a_number_in_int_column_fails_the_load(spark, tmp_dir):
    path = _stage(tmp_dir, "id;name\nabc;x\n")
    with pytest.raises(Exception, match="cannot load column id"):
        read_staged(spark, path, NAMES).collect()


def test_whole_numbers_written_as_decimals_load(spark, tmp_dir):
    path = _stage(tmp_dir, 'id;name\n1.0;x\n -2.000 ;x\n3.;x\n9007199254740993.0;x\n')
    assert [r.id for r in read_staged(spark, path, NAMES).collect()] == [1, -2, 3, 9007199254740993]


@pytest.mark.parametrize("cell", ["1.5", "1e3", "1.0x", "99999999999999999999.0"])
def test_other_decimals_fail_an_integer_column(spark, tmp_dir, cell):
    path = _stage(tmp_dir, f"id;name\n{cell};x\n")
    with pytest.raises(Exception, match="cannot load column id"):
        read_staged(spark, path, NAMES).collect()


def test_pandas_index_file_with_decimal_integers_loads(spark, tmp_dir):
    import os

    os.makedirs(tmp_dir)
    pd.DataFrame({"id": [7, None, 9], "name": ["a", "b\nc", None]}).to_csv(f"{tmp_dir}/part-0.csv")
    rows = read_indexed(spark, tmp_dir, NAMES, keep_index=True).collect()
    assert [tuple(r) for r in rows] == [(0, 7, "a"), (1, None, "b\nc"), (2, 9, None)]


def test_long_text_is_kept_whole_without_a_length(spark, tmp_dir):
    path = _stage(tmp_dir, f"id;name\n1;{'x' * 10_000}\n")
    assert len(read_staged(spark, path, NAMES).first().name) == 10_000


def test_blank_number_cell_is_null_not_an_error(spark, tmp_dir):
    path = _stage(tmp_dir, "id;name\n  ;x\n")
    (row,) = read_staged(spark, path, NAMES).collect()
    assert row.id is None


def test_nan_and_null_both_count_as_missing_and_are_dropped(spark):
    pdf = pd.DataFrame({"id": [1, 2, 3], "w": [1.5, float("nan"), None]})
    df = pandas_to_spark(pdf, spark)
    assert dict(df.dtypes) == {"id": "bigint", "w": "double"}
    prof = {r.column_name: r.null_count for r in null_profile(df, "t").collect()}
    assert prof == {"id": 0, "w": 2}
    assert [r.id for r in drop_null_rows(df).collect()] == [1]


def test_nan_kept_as_value_is_still_counted_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "id long, w double")
    prof = {r.column_name: r.null_count for r in null_profile(df, "t").collect()}
    assert prof["w"] == 2
    assert drop_null_rows(df).count() == 1


def test_dtype_rule(spark):
    pdf = pd.DataFrame({
        "i64": pd.Series([1], dtype="int64"), "i32": pd.Series([1], dtype="int32"),
        "f64": [1.73], "s": ["x"], "ts": pd.to_datetime(["2008-08-17"]),
    })
    df = pandas_to_spark(pdf, spark)
    assert dict(df.dtypes) == {"i64": "bigint", "i32": "int", "f64": "double",
                               "s": "string", "ts": "timestamp"}
    assert df.first().f64 == 1.73  # a 32-bit float would give 1.7300000190734863


@pytest.mark.parametrize("dtype, want", [
    ("int64", "bigint"), ("int32", "int"), ("int8", "int"), ("uint32", "bigint"), ("Int64", "bigint"),
    ("float64", "double"), ("float32", "double"), ("Float64", "double"), ("bool", "boolean"),
    ("boolean", "boolean"), ("object", "string"), ("datetime64[ns]", "timestamp"),
    ("datetime64[us]", "timestamp"), ("datetime64[ns, UTC]", "timestamp"), ("category", "string")])
def test_dtype_by_kind_and_width(dtype, want):
    from matchlake.functions.dtypes import spark_type

    assert spark_type(dtype).simpleString() == want


def test_load_twice_overwrite_and_append(spark):
    wh = Warehouse(spark)
    wh.create("Point")
    df = spark.createDataFrame([(1, 2, 1, "2008/2009", "Home", "L")],
                               TABLES["Point"].schema)
    wh.load(df, "Point")
    wh.load(df, "Point")
    assert wh.table("Point").count() == 1
    wh.load(df, "Point", append_only=True)
    assert wh.table("Point").count() == 2


def test_check_expecting_11_on_10_rows_fails_naming_the_table(spark):
    tables = {"League": spark.range(10).withColumnRenamed("id", "id")}
    with pytest.raises(ValueError, match="League: found 10, wanted = 11"):
        run_checks(spark, tables, [Check("League", 11)])


def test_first_failure_in_list_order_is_raised(spark):
    tables = {"A": spark.range(3), "B": spark.range(0)}
    checks = [Check("A", 3), Check("B", 0, "non_empty"), Check("A", 5)]
    with pytest.raises(ValueError, match="B: found 0"):
        run_checks(spark, tables, checks)


def test_check_returning_no_row_fails_with_its_own_message(spark):
    spark.range(5).createOrReplaceTempView("five")
    checks = [Check("five", 0, "sql", sql="SELECT id FROM five WHERE id > 100")]
    report = check_report(spark, {}, checks).collect()
    assert report[0].actual is None and report[0].passed is False
    assert report[0].message.endswith("the check query gave no row")
    with pytest.raises(ValueError, match="gave no row"):
        run_checks(spark, {}, checks)


def test_checks_on_one_table_share_one_scan(spark):
    df = spark.range(4).withColumn("id", F.when(F.col("id") == 0, None).otherwise(F.col("id")))
    checks = [Check("T", 4), Check("T", 1, "null_count", "id"), Check("T", 0, "non_empty")]
    report = check_report(spark, {"T": df}, checks)
    plan = plan_text(report, "simple")
    assert plan.count("Range (") == 1
    assert all(r.passed for r in report.collect())


def test_pandas_nan_float_becomes_null(spark):
    pdf = pd.DataFrame({"x": [float("nan"), 2.0]})
    rows = [r.x for r in pandas_to_spark(pdf, spark).collect()]
    assert rows[0] is None and rows[1] == 2.0 and not any(
        isinstance(v, float) and math.isnan(v) for v in rows)


def test_long_texts_are_spread_over_files_of_bounded_size(spark):
    """162 MB of names out of one small customer file; a file is read by one task."""
    from matchlake import catalog

    sizes = [r.length for r in spark.read.format("binaryFile").load(
        catalog.QUERIES["long_text_load"](spark, "/root/testdata/sf0.1").inputFiles())
        .select("length").collect()]
    assert sum(sizes) > 160_000_000 and max(sizes) < 64_000_000


def test_load_rules_of_a_wide_table_are_compiled(spark):
    """The JVM interprets methods of over 8,000 bytes for good."""
    path, schema = work_dir(spark, "wide"), TABLES["Player_Attributes"].schema
    write_delimited(spark.createDataFrame([], schema), path)
    code = plan_text(read_staged(spark, path, schema), "codegen")
    assert all(int(n) <= 8_000 for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
