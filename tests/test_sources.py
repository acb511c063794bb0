import os

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import clean
from shelfmark.plans.store import open_store
from shelfmark.session import build_session, scratch_root
from shelfmark.sources import csv_files, sinks
from shelfmark.sources.datasets import DATASETS, NESTED_GAME_COLUMNS

REVIEW_CSV = ',app_id,author.steamid,review\n0,5,900,"two ""quoted""\nlines, really"\n1,6,901,plain\n2,,,\n'


@pytest.mark.parametrize("reader", [csv_files.read_csv, csv_files.read_large_csv])
def test_csv_scan_and_cleaning(spark, tmp_path, rows, reader):
    path = tmp_path / "reviews.csv"
    path.write_text(REVIEW_CSV)
    df = reader(spark, str(path), DATASETS["reviews"].types)
    assert dict(df.dtypes) == {"_c0": "string", "app_id": "int", "author.steamid": "bigint", "review": "string"}
    out = clean.drop_index_column(clean.rename_columns(df, clean.AUTHOR_COLUMNS))
    assert out.columns == ["app_id", "author_steamid", "review"]
    assert rows(out) == [(5, 900, 'two "quoted"\nlines, really'), (6, 901, "plain"), (None, None, None)]


def test_large_csv_equals_the_whole_file_scan(spark, tmp_path, rows):
    """Tiny blocks: records span several of them, and blocks start inside text."""
    for part in range(2):
        lines = ["id,text,n"]
        for i in range(400):
            text = f"r{part}-{i} " + "\n".join(f'line {j}, "{j}"' for j in range(i % 9)) + "x" * (i % 50)
            if i % 100 == 50:
                text += "\n" + "\n".join("long" * 40 for _ in range(60))
            lines.append(f'{i},"{text.replace(chr(34), chr(34) * 2)}",{i * 2}')
        (tmp_path / f"part{part}.csv").write_text("\n".join(lines) + ("\n" if part else ""))
    types = {"id": "int", "text": "string", "n": "int"}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        split = csv_files.read_large_csv(spark, str(tmp_path), types)
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
        got = rows(split)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert blocks > 50
    assert len(got) == 800
    assert got == rows(csv_files.read_csv(spark, str(tmp_path), types))


def test_windows_line_ends(spark, tmp_path, rows):
    path = tmp_path / "w.csv"
    path.write_bytes(b'id,text\r\n1,"a\r\nb"\r\n2,c\r\n')
    assert rows(csv_files.read_large_csv(spark, str(path), {"id": "int", "text": "string"})) == [(1, "a\r\nb"), (2, "c")]


def test_datasets():
    assert {d.name: d.key for d in DATASETS.values()} == {"games": "appid", "reviews": "review_id", "hltb": "game_game_id"}
    assert [len(DATASETS[n].types) for n in ("games", "reviews", "hltb")] == [47, 22, 6]
    assert set(NESTED_GAME_COLUMNS) <= set(DATASETS["games"].types)


def test_prepared_is_built_once_per_limit(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    root = str(tmp_path)
    assert sinks.load_prepared(spark, root, "reviews", 10) is None
    assert sinks.prepared(spark, root, "reviews", build, 10).count() == 1
    assert sinks.prepared(spark, root, "reviews", build, 10).count() == 1
    assert sinks.prepared(spark, root, "reviews", build, 20).count() == 2
    assert sinks.prepared(spark, root, "reviews", build, 10, use_cache=False).count() == 3
    assert sorted(os.listdir(tmp_path)) == ["reviews_10_prepared", "reviews_20_prepared"]


def test_tables_append_truncate_drop(spark, rows):
    df = spark.sql("select 1 id, array('a', 'b') names")
    assert sinks.tables_empty(spark, ["shelf_t"])
    sinks.append_table(df, "shelf_t", json_columns=["names"])
    sinks.append_table(df, "shelf_t", json_columns=["names"])
    assert rows(spark.table("shelf_t")) == [(1, '["a","b"]')] * 2
    assert not sinks.tables_empty(spark, ["shelf_t", "absent"])
    sinks.truncate_tables(spark, ["shelf_t", "absent"])
    assert spark.catalog.tableExists("shelf_t") and sinks.tables_empty(spark, ["shelf_t"])
    sinks.drop_tables(spark, ["shelf_t", "absent"])
    assert not spark.catalog.tableExists("shelf_t")


def test_bucketed_tables_join_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sinks.write_bucketed(spark.range(1000).withColumnRenamed("id", "k"), "shelf_a", "k", 4)
        sinks.write_bucketed(spark.range(0, 1000, 3).withColumnRenamed("id", "k"), "shelf_b", "k", 4)
        joined = spark.table("shelf_a").join(spark.table("shelf_b"), "k")
        assert joined.count() == 334
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        sinks.drop_tables(spark, ["shelf_a", "shelf_b"])


def test_documents_and_reports(spark, tmp_path, rows):
    games = spark.sql("select 1 appid, array('a') genres, map('t', 2) tags union all select 2, array(), null")
    sinks.write_documents(games, str(tmp_path / "docs"), batch_size=1)
    assert rows(spark.read.schema(games.schema).json(str(tmp_path / "docs"))) == rows(games)
    log = spark.createDataFrame([("t", "a", 1.5), ("t", "b", None)], "test_name string, database string, mean_ms double")
    sinks.write_reports(log, log, str(tmp_path / "report"))
    assert rows(spark.read.schema(log.schema).csv(str(tmp_path / "report/statistics"), header=True)) == rows(log)
    (doc,) = spark.read.json(str(tmp_path / "report/test_results")).collect()
    assert doc["name"] == "t" and len(doc["results"]) == 2


def test_row_count_audit(spark, rows):
    assert rows(sinks.row_count_audit({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_scratch_lies_in_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark).startswith(configured)


def test_sql_text_over_the_store(spark, rows):
    """Reports can be written as SQL over the registered views."""
    store = open_store(spark, "/root/testdata/sf0.001")
    store.register_views("shelf_")
    text = spark.sql(
        """WITH shares AS (SELECT genre_id, COUNT(DISTINCT game_appid) AS titles, AVG(price) AS mean_price
           FROM shelf_game_genres INNER JOIN shelf_games ON appid = game_appid GROUP BY ALL)
           SELECT name, titles, ROUND(mean_price, 2) AS mean_price FROM shares NATURAL JOIN shelf_genres"""
    )
    links = store.table("game_genres").join(store.table("games"), F.col("appid") == F.col("game_appid"))
    means = links.groupBy("genre_id").agg(F.countDistinct("appid"), F.round(F.avg("price"), 2))
    assert rows(text) == rows(store.table("genres").select("genre_id", "name").join(means, "genre_id").drop("genre_id"))


def test_files_with_headers_in_another_order(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,n,extra\n1,2.0,x\n7,9,y\n")
    (tmp_path / "b.csv").write_text("n,id\n5,3\n,4\nabc,6\n8\n")
    df = csv_files.read_large_csv(spark, str(tmp_path), {"id": "int", "n": "int"}, "place", "bad")
    got = {r["id"]: (r["n"], r["extra"], [(c["column"], c["text"]) for c in r["bad"]]) for r in df.collect()}
    assert got == {
        1: (2, "x", []), 7: (9, "y", []), 3: (5, None, []), 4: (None, None, []), 6: (None, None, [("n", "abc")]), None: (8, None, [(None, "8")]),
    }
    ordered = [r["id"] for r in df.orderBy("place").collect()]
    assert ordered == [1, 7, 3, 4, 6, None]


def test_build_session_returns_the_tuned_session(spark):
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"


def test_a_stray_quote_goes_to_the_quarantine(spark, tmp_path):
    path = tmp_path / "stray.csv"
    lines = [f"{i},text {i}" for i in range(4000)]
    lines[2000] = '2000,"opened and never closed'
    path.write_text("id,text\n" + "\n".join(lines) + "\n")
    for block in ("2k", "1m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = csv_files.read_large_csv(spark, str(path), {"id": "INT", "text": "STRING"}, "place", "bad", record_limit=500).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        read = sorted((r.id, r.text) for r in got if r.id is not None)
        assert read == [(i, f"text {i}") for i in range(2000)]
        (bad,) = [r.bad for r in got if r.id is None]
        assert bad[0].column is None and bad[0].text.startswith('2000,"opened') and len(bad[0].text) <= csv_files.SHOWN


def test_records_below_the_limit_stay_whole(spark, tmp_path):
    path = tmp_path / "long.csv"
    texts = ["a" * 30, "b\n" * 40 + "end", "c" * 99, "d\n" * 200]
    path.write_text("id,text\n" + "".join(f'{i},"{t}"\n' for i, t in enumerate(texts)))
    got = {r.id: r.text for r in csv_files.read_large_csv(spark, str(path), {"id": "INT", "text": "STRING"}, None, "bad", record_limit=120).collect()}
    assert got == {0: texts[0], 1: texts[1], 2: texts[2], None: None}


def test_run_logs_with_line_breaks_stay_one_run(spark, tmp_path):
    rows = [("t", "a", 1, 1.5, 3, 'two lines\nand "quotes"', "now"), ("t", "a", 2, 2.5, 3, None, "now")]
    log = spark.createDataFrame(rows, "test_name string, database string, run_number long, execution_time_ms double, row_count long, error string, timestamp string")
    sinks.write_csv(log, str(tmp_path / "log"))
    types = dict(log.dtypes)
    assert sorted(tuple(r) for r in csv_files.read_large_csv(spark, str(tmp_path / "log"), types).collect()) == sorted(rows)
