"""Registered ids over several loads, and JSON paths."""

import os

from shelfmark.operators import normalize, reconcile, registry


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def _ids(df):
    return {r["name"]: r["developer_id"] for r in df.collect()}


def test_ids_are_dense_and_stay(spark, tmp_path):
    path = str(tmp_path / "r")
    first = _ids(registry.register_names(_names(spark, "b", "d", "b", None, ""), path, "developer_id", "one"))
    assert first == {"b": 1, "d": 2}
    both = _ids(registry.register_names(_names(spark, "c", "a", "b"), path, "developer_id", "two"))
    assert both == {"b": 1, "d": 2, "a": 3, "c": 4}
    again = registry.register_names(_names(spark, "zz"), path, "developer_id", "one")  # a complete load isn't written again
    assert _ids(again) == both
    assert _ids(registry.register_names(_names(spark, "a"), path, "developer_id", "three")) == both
    later = registry.registered_dimension(_names(spark, "d", "e"), path, "developer_id", "four")
    assert _ids(later) == {"d": 2, "e": 5}
    copies = {"one": again, "two": registry.read_registry(spark, path, "developer_id").where("developer_id <= 4")}
    assert {r["verdict"] for r in normalize.id_consistency(copies, "developer_id").collect()} == {"MATCH"}


def test_a_load_that_was_cut_off_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "r")
    registry.register_names(_names(spark, "b"), path, "developer_id", "one")
    registry.register_names(_names(spark, "a", "c"), path, "developer_id", "two")
    os.remove(tmp_path / "r" / "two" / "_SUCCESS")
    assert _ids(registry.read_registry(spark, path, "developer_id")) == {"b": 1}
    assert _ids(registry.register_names(_names(spark, "a", "c"), path, "developer_id", "two")) == {"b": 1, "a": 2, "c": 3}


def test_json_paths_and_their_difference(spark, rows):
    left = spark.createDataFrame([('{"x":{"y":1},"l":[{"a":1},{"b":[true]}],"n":null}',), ('{"x":3,"odd.name":1.5}',), ("no json",), (None,)], "row string")
    right = spark.createDataFrame([('{"x":{"z":1},"l":[],"n":"text","odd.name":2}',)], "row string")
    assert dict(rows(reconcile.json_paths(left, "row"), "path", "path")).keys() >= {"$", "$.x", "$.x.y", "$.l[*].a", "$.l[*].b[*]", "$.odd.name"}
    assert rows(reconcile.path_diff(left, right, "row"), "path", "present_in") == sorted(
        [("$.x.y", "left"), ("$.x.z", "right"), ("$.l[*]", "left"), ("$.l[*].a", "left"), ("$.l[*].b", "left"), ("$.l[*].b[*]", "left"), ("$.x", "both")], key=repr
    )
    assert reconcile.path_diff(left, left, "row").count() == 0
    assert reconcile.path_diff(left.limit(0), left.limit(0), "row").count() == 0


def test_rows_of_one_type_are_taken_apart_once(spark, rows, monkeypatch):
    stored = {}

    def counted(df, label, store=reconcile.materialise):
        out = store(df, label)
        stored.setdefault(label, out.count())
        return out

    monkeypatch.setattr(reconcile, "materialise", counted)
    texts = ['{"a": %d}' % i for i in range(50)] + ['{"b": [1, {"c": %d}, "x"]}' % i for i in range(3)] + ["{", None, "3"]
    paths = reconcile.json_paths(spark.createDataFrame([(t,) for t in texts], "row string"), "row")
    assert {r["path"] for r in paths.collect()} == {"$", "$.a", "$.b", "$.b[*]", "$.b[*].c"}
    assert stored["json-types"] == 1 + 3 + 1
