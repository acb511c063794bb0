"""CSV files to prepared tables, normalised tables and reports."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import relational
from shelfmark.plans import prepare
from shelfmark.plans.store import build_normalised

GAMES = """appid,name,price,developers,publishers,genres,categories,tags,metacritic_score,positive,negative,average_playtime_forever,discount,detailed_description
10,Alpha,59.99,"['Dev A', ""Bob's""]",['Pub'],"['Action', 'RPG']",['Single'],"{'FPS': 12, 'Co-op': 3}",80,10,1,60,0,"first line
second ""line"", end"
20,Beta,35.5,['Dev A'],['Pub'],['RPG'],[],[],70,5,2,30,10,plain
30,Gamma,0.0,[],,[],not a list,,n/a,,,,,
20,Aardvark,35.5,['Dev A'],['Pub'],['RPG'],[],[],70,5,2,30,10,zz later copy
"""
REVIEWS = """,app_id,app_name,review_id,language,review,timestamp_created,timestamp_updated,recommended,votes_helpful,steam_purchase,written_during_early_access,author.steamid,author.num_games_owned,author.num_reviews,author.playtime_forever,author.playtime_at_review,author.last_played
0,10,Alpha,103,english,"good
game",1600000000,1600000001,True,4,True,False,900,5,1,10.5,8.0,1600000002.0
1,10,Alpha,101,polish,ok,1600000000,1600000001,False,0,False,False,900,6,1,11.5,9.0,
2,20,Beta,102,english,fine,1600000000,1600000001,True,1,True,True,901,7,2,1.5,1.0,1600000002.0
10,10,Alpha,103,english,"later copy",1600000000,1600000001,True,4,True,False,900,5,1,10.5,8.0,1600000002.0
4,20,Beta,104,english,late,1600000000,1600000001,True,1,True,True,902,7,2,1.5,1.0,1600000002.0
"""


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "games.csv").write_text(GAMES)
    (folder / "reviews.csv").write_text(REVIEWS)
    return folder


@pytest.fixture(scope="module")
def prepared(spark, files):
    root = str(files / "prepared")
    games = prepare.prepare_games(
        spark, str(files / "games.csv"), root, duplicates_path=str(files / "games-duplicates"), quarantine_path=str(files / "games-bad")
    )
    reviews = prepare.prepare_reviews(
        spark, str(files / "reviews.csv"), root, limit=3, duplicates_path=str(files / "reviews-duplicates")
    )
    return games, reviews


def test_games(spark, files, prepared):
    games = {r["appid"]: r for r in prepared[0].collect()}
    assert sorted(games) == [10, 20, 30]
    assert games[10]["developers"] == ["Dev A", "Bob's"]
    assert games[10]["tags"] == {"FPS": "12", "Co-op": "3"}
    assert games[20]["name"] == "Beta"  # the first in the file, not the smallest
    assert games[10]["detailed_description"] == 'first line\nsecond "line", end'
    assert games[20]["detailed_description"] == "plain"
    assert games[20]["tags"] is None and games[30]["publishers"] is None
    removed = spark.read.csv(str(files / "games-duplicates"), header=True, escape='"')
    assert [r["detailed_description"] for r in removed.collect()] == ["zz later copy"]


def test_unreadable_cells_go_to_the_quarantine(spark, files, prepared):
    bad = spark.read.csv(str(files / "games-bad"), header=True, escape='"')
    assert sorted((r["column"], r["text"]) for r in bad.collect()) == [("categories", "not a list"), ("metacritic_score", "n/a")]


def test_all_reviews_are_kept_by_default(spark, files):
    everything = prepare.prepare_reviews(spark, str(files / "reviews.csv"), str(files / "all"))
    assert sorted(r["review_id"] for r in everything.collect()) == [101, 102, 103, 104]


def test_reviews(spark, files, prepared):
    reviews = {r["review_id"]: r for r in prepared[1].withColumn("at", F.col("timestamp_created").cast("string")).collect()}
    assert sorted(reviews) == [101, 102, 103]
    assert reviews[103]["review"] == "good\ngame"
    assert reviews[103]["at"] == "2020-09-13 12:26:40"
    assert reviews[101]["author_last_played"] is None
    assert "_c0" not in prepared[1].columns and "author_steamid" in prepared[1].columns


def test_cached_table_is_read_back(spark, files, prepared):
    again = prepare.prepare_games(spark, "/nowhere.csv", str(files / "prepared"), use_cache=True)
    assert again.count() == 3


def test_completion_times(spark, files):
    (files / "hltb.csv").write_text("game_game_id,game_game_name,game_comp_main,extra\n1,A,60,x\n1,A,70,y\n2,B,,\n")
    out = prepare.prepare_completion_times(spark, str(files / "hltb.csv"), str(files / "prepared"))
    assert sorted((r["game_game_id"], r["game_comp_main"], r["extra"]) for r in out.collect()) == [(1, 60, "x"), (2, None, None)]


def test_normalised_tables_answer_the_reports(prepared, rows):
    games, reviews = prepared
    t = build_normalised(games, reviews)
    assert rows(t["developers"]) == [(1, "Bob's"), (2, "Dev A")]
    found = relational.games_with_developers(games, t["game_developers"], t["developers"], 30)
    assert [tuple(r) for r in found.collect()] == [(10, "Alpha", "Bob's"), (10, "Alpha", "Dev A"), (20, "Beta", "Dev A")]
    stats = relational.review_stats_by_game(games, reviews)
    assert [tuple(r) for r in stats.collect()] == [(10, 2, 1, 2.0), (20, 1, 1, 1.0)]
    top = relational.developer_statistics(t["developer_stats"], t["developers"], 2)
    assert [tuple(r) for r in top.collect()] == [(2, "Dev A", 2, 47.75, 15, 3)]
    assert rows(t["user_profiles"], "author_steamid", "num_games_owned", "negative_review_count") == [(900, 6, 1), (901, 7, 0)]
    assert t["game_price_history"].count() == 26
