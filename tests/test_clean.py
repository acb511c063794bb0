import pytest
from pyspark.sql import functions as F

from shelfmark.functions.literals import parse_literal
from shelfmark.operators import clean

LISTS = {
    "['Action', \"Baldur's\"]": ["Action", "Baldur's"],
    "['it\\'s \"q\"']": ['it\'s "q"'],
    "[]": [],
    "": None,
    None: None,
    "['a', None]": ["a", None],
    "[True, None, 1]": ["true", None, "1"],
    "['None', None, \"True, None\"]": ["None", None, "True, None"],
    "not a literal": None,
}
MAPS = {"{'FPS': 12, 'Co-op': 3}": {"FPS": 12, "Co-op": 3}, "{'A': None}": {"A": None}, "[]": None, "": None, None: None}


@pytest.mark.parametrize("cases,ddl", [(LISTS, "array<string>"), (MAPS, "map<string,int>")])
def test_parse_literal(spark, cases, ddl):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", parse_literal(F.col("t"), ddl).alias("v")).collect()}
    assert got == dict(enumerate(cases.values()))


def test_unparsed_rows_are_quarantined(spark, rows):
    df = spark.createDataFrame(
        [(1, "['a']", "{'x': 1}"), (2, "not a literal", "[]"), (3, "", "{'x'"), (4, None, None)],
        "id int, genres string, tags string",
    )
    bad = clean.unparsed_rows(df, {"genres": "array<string>", "tags": "map<string,int>"}, "id")
    assert rows(bad) == [(2, "genres", "not a literal"), (3, "tags", "{'x'")]


def test_rename_and_drop(spark):
    df = spark.createDataFrame([(0, 5, "x")], ["_c0", "author.steamid", "review"])
    out = clean.drop_index_column(clean.rename_columns(df, clean.AUTHOR_COLUMNS))
    assert out.columns == ["author_steamid", "review"]


def test_epoch_to_timestamp(spark):
    df = spark.createDataFrame([(1, 86400, "1970-01-03 00:00:00"), (2, None, None)], "id int, s bigint, t string")
    out = clean.epoch_to_timestamp(clean.epoch_to_timestamp(df, ["s", "absent"]), ["t"], unit=None)
    assert [r["s"] for r in out.select(F.col("s").cast("string")).collect()] == ["1970-01-02 00:00:00", None]
    assert [r["t"] for r in out.select(F.col("t").cast("string")).collect()] == ["1970-01-03 00:00:00", None]


def test_sort_and_limit(spark):
    df = spark.createDataFrame([(3,), (1,), (2,), (None,)], ["k"])
    assert [r.k for r in clean.sort_by_column(df, "k").collect()] == [1, 2, 3, None]
    assert clean.first_records(df, "k", 3).count() == 3 and clean.first_records(df, "k", 4).count() == 4
    assert [r.k for r in clean.limit_records(clean.sort_by_column(df, "k"), 2).collect()] == [1, 2]
    assert clean.limit_records(df, 0).count() == 4
    assert clean.sort_by_column(df, "absent") is df


def duplicated(spark):
    """Key 1 is hot and has exact copies; the null key counts as a key."""
    hot = [(1, i // 3, f"v{i // 3}") for i in range(3000)]
    others = [(k, 0, "only") for k in range(2, 500)] + [(None, 2, "b"), (None, 1, "a")]
    return spark.createDataFrame(hot + others, "k int, ord int, v string").repartition(7)


def test_dedup_keeps_the_first_and_reports_the_rest(spark, rows):
    df = duplicated(spark)
    kept = clean.dedup_keep_first(df, ["k"], ["ord", "v"])
    removed = clean.duplicate_rows(df, ["k"], ["ord", "v"])
    assert kept.where("k = 1").collect() == [(1, 0, "v0")]
    assert kept.where("k is null").collect() == [(None, 1, "a")]
    assert kept.count() == 500
    assert rows(kept.unionByName(removed)) == rows(df)
    assert rows(clean.top_duplicate_keys(df, "k")) == [(1, 2999)]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.5, 2), (None, 3)], "x double, n int")
    assert [r.x for r in clean.nan_to_null(df).orderBy("n").collect()] == [None, 2.5, None]


def test_column_profile_survives_nulls_and_nan(spark):
    df = spark.createDataFrame(
        [(1, 3_000_000_000, "ab", float("nan"), None), (2, None, None, 1.5, None)],
        "i int, b bigint, s string, d double, e string",
    )
    profile = {r["column_name"]: r for r in clean.column_profile(df).collect()}
    assert (profile["i"]["min_value"], profile["i"]["fits_int32"]) == (1.0, True)
    assert (profile["b"]["max_value"], profile["b"]["fits_int32"]) == (3e9, False)
    assert (profile["s"]["max_length"], profile["s"]["non_null"]) == (2, 1)
    assert profile["d"]["max_value"] == 1.5
    assert profile["e"]["max_length"] is None


def test_dataset_shape(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], ["x", "y"])
    assert tuple(clean.dataset_shape(df, "t").first()) == ("t", 2, 2, "x,y")


def test_nested_to_json(spark):
    df = spark.sql("select array('a') plain, array(named_struct('u', 1)) deep, map('k', 2) tags, array() none")
    assert tuple(clean.nested_to_json(df).select("plain", "deep", "tags").first()) == (["a"], '[{"u":1}]', '{"k":2}')


def test_dedup_limits_hot_keys_before_the_shuffle(spark, monkeypatch, rows):
    df = duplicated(spark)
    few = clean.dedup_keep_first(df, ["k"], ["ord", "v"])
    monkeypatch.setattr(clean, "BROADCAST_ROWS", 1)
    many = clean.dedup_keep_first(df, ["k"], ["ord", "v"])
    assert rows(few) == rows(many)
    assert rows(many.unionByName(clean.duplicate_rows(df, ["k"], ["ord", "v"]))) == rows(df)
    plan = many._jdf.queryExecution().executedPlan().toString()
    # Plans print from the last step to the first: limit, exchange, limit.
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_dedup_leaves_unique_keys_alone(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert clean.dedup_keep_first(df, ["k"], ["k"]) is df
    assert clean.duplicate_rows(df, ["k"], ["k"]).count() == 0


def test_first_records(spark, rows):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.lit("x").alias("v")).repartition(5)
    expected = [(i, "x") for i in range(250)]
    assert sorted(rows(clean.first_records(df, "k", 250))) == expected
    assert clean.first_records(df, "k", 5000).count() == 1000
    assert clean.first_records(df, "k", 0) is df
