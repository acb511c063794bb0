import datetime

from pyspark.sql import functions as F

from shelfmark.operators import reconcile

SCHEMA = "id int, name string, price double"


def test_canonical_rows(spark):
    df = spark.createDataFrame(
        [(True, 2.0, 2.346, " a\t", None, datetime.datetime(2020, 1, 2, 3, 4, 5), datetime.datetime(2020, 1, 2, 3, 4, 5, 600))],
        "Flag boolean, Whole double, Part double, Text string, Gone string, At timestamp, Micro timestamp",
    )
    out = reconcile.canonical_rows(df)
    assert out.columns == ["flag", "whole", "part", "text", "gone", "at", "micro"]
    assert tuple(out.first()) == (1, 2.0, 2.35, "a", None, "2020-01-02T03:04:05", "2020-01-02T03:04:05.000600")


def test_row_count_match(spark):
    same = reconcile.row_count_match({"a": spark.range(3), "b": spark.range(3)}).first()
    assert tuple(same) == (2, 3, 3, True, True)
    other = reconcile.row_count_match({"a": spark.range(3), "b": spark.range(4)}).first()
    assert (other["min_rows"], other["max_rows"], other["row_count_match"]) == (3, 4, False)
    assert reconcile.row_count_match({"a": spark.range(3)}).first()["comparable"] is False


def test_field_diff_sees_all_rows(spark, rows):
    left = spark.createDataFrame([('{"a": 1}',), ('{"a": 1, "late": null}',)], ["row"])
    right = spark.createDataFrame([('{"a": {"x": 1}, "b": [1]}',)], ["row"])
    assert rows(reconcile.field_diff(left, right, "row")) == [("b", "right"), ("late", "left")]


def test_cell_diff(spark, rows):
    left = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 1.0), (3, "c", 1.0), (4, "d", None), (5, "e", 1.0), (6, None, None)], SCHEMA
    )
    right = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 1.009), (3, "C", 1.02), (4, "d", 0.0), (6, None, None), (7, "g", 1.0)], SCHEMA
    ).withColumn("extra", F.lit(1))
    assert rows(reconcile.cell_diff(left, right, "id")) == [
        (3, "name", "c", "C", "value"),
        (3, "price", "1.0", "1.02", "value"),
        (4, "price", None, "0.0", "value"),
        (5, None, None, None, "missing_right"),
        (7, None, None, None, "missing_left"),
    ]
    assert reconcile.column_diff(left, right) == {"left": [], "right": ["extra"]}


def test_cell_diff_by_position(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (1, "x")], "k int, v string")
    assert rows(reconcile.cell_diff_by_position(left, right, ["k", "v"])) == [
        (1, "v", "a", "x", "value"),
        (2, None, None, None, "missing_right"),
    ]


def test_compare_results(spark):
    ref = spark.createDataFrame([(1, " a ", 1.0)], "ID int, Name string, price double")
    same = spark.createDataFrame([(1, "a", 1.004)], SCHEMA)
    wrong = spark.createDataFrame([(1, "b", 9.0)], SCHEMA)
    out = {r["compared_result"]: r for r in reconcile.compare_results({"r": ref, "s": same, "w": wrong}, "id").collect()}
    assert out["s"]["match"] and out["s"]["row_count_match"] and out["s"]["fields_match"]
    assert out["w"]["differing_cells"] == 2 and not out["w"]["match"]


def test_overall_verdict(spark, rows):
    checks = spark.createDataFrame(
        [("ok", "a", 3, True), ("ok", "b", 3, True), ("rows", "a", 3, True), ("rows", "b", 4, True),
         ("data", "a", 3, True), ("data", "b", 3, False), ("one", "a", 3, True)],
        "test_name string, result string, row_count int, data_match boolean",
    )
    assert rows(reconcile.overall_verdict(checks), "test_name", "verdict") == [
        ("data", "mismatch"), ("ok", "match"), ("one", "not comparable"), ("rows", "mismatch"),
    ]


def test_cell_diff_with_nan_null_and_repeated_keys(spark, rows):
    nan = float("nan")
    left = spark.createDataFrame([(1, nan, "a"), (None, 1.0, "n"), (2, 5.0, "x"), (2, 6.0, "y")], "id int, v double, s string")
    same = spark.createDataFrame([(2, 6.0, "y"), (2, 5.0, "x"), (None, 1.0, "n"), (1, nan, "a")], "id int, v double, s string")
    assert reconcile.cell_diff(left, same, "id").count() == 0
    other = spark.createDataFrame([(1, 0.0, "a"), (2, 5.0, "x"), (3, 1.0, "z")], "id int, v double, s string")
    got = rows(reconcile.cell_diff(left, other, "id"), "id", "field", "difference")
    assert sorted(got, key=repr) == sorted(
        [(1, "v", "value"), (None, None, "missing_right"), (2, None, "missing_right"), (3, None, "missing_left")], key=repr
    )
    empty = reconcile.cell_diff(left.where("id is null"), left.where("id is null").limit(0), "id")
    assert rows(empty, "id", "difference") == [(None, "missing_right")]
    assert reconcile.compare_results({"only": left}, "id").count() == 0
