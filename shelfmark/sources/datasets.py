"""Dataset definitions: name, key and declared column types."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Columns and types of the three source tables.
GAMES = """
appid INT, name STRING, release_date DATE, required_age INT, price DOUBLE, dlc_count INT,
detailed_description STRING, about_the_game STRING, short_description STRING, reviews STRING,
header_image STRING, website STRING, support_url STRING, support_email STRING,
windows BOOLEAN, mac BOOLEAN, linux BOOLEAN, metacritic_score INT, metacritic_url STRING,
achievements INT, recommendations INT, notes STRING, supported_languages STRING,
full_audio_languages STRING, packages STRING, developers STRING, publishers STRING,
categories STRING, genres STRING, screenshots STRING, movies STRING, user_score INT,
score_rank STRING, positive INT, negative INT, estimated_owners STRING,
average_playtime_forever INT, average_playtime_2weeks INT, median_playtime_forever INT,
median_playtime_2weeks INT, discount INT, peak_ccu INT, tags STRING, pct_pos_total INT,
num_reviews_total INT, pct_pos_recent INT, num_reviews_recent INT
"""
REVIEWS = """
app_id INT, app_name STRING, review_id BIGINT, language STRING, review STRING,
timestamp_created BIGINT, timestamp_updated BIGINT, recommended BOOLEAN, votes_helpful BIGINT,
votes_funny BIGINT, weighted_vote_score DOUBLE, comment_count INT, steam_purchase BOOLEAN,
received_for_free BOOLEAN, written_during_early_access BOOLEAN, author.steamid BIGINT,
author.num_games_owned BIGINT, author.num_reviews BIGINT, author.playtime_forever DOUBLE,
author.playtime_last_two_weeks DOUBLE, author.playtime_at_review DOUBLE, author.last_played DOUBLE
"""
COMPLETION_TIMES = """
game_game_id INT, game_game_name STRING, game_comp_main INT, game_comp_plus INT,
game_comp_100 INT, game_comp_all_count INT
"""

# Nested columns of the games table and the types they parse to.
NESTED_GAME_COLUMNS = {
    "supported_languages": "array<string>",
    "full_audio_languages": "array<string>",
    "packages": "array<map<string,string>>",
    "developers": "array<string>",
    "publishers": "array<string>",
    "categories": "array<string>",
    "genres": "array<string>",
    "screenshots": "array<string>",
    "movies": "array<string>",
    "tags": "map<string,string>",  # votes may be no integers
}

# Time columns of the reviews table, in epoch seconds.
REVIEW_TIMES = ("timestamp_created", "timestamp_updated", "author_last_played")


def column_types(ddl: str) -> dict[str, str]:
    """``name TYPE, ...`` as a mapping; names may hold dots."""
    return dict(part.split() for part in ddl.replace("\n", " ").split(","))


@dataclass(frozen=True)
class Dataset:
    """A source table: its name, its key and the declared types of its columns."""

    name: str
    key: str
    types: Mapping[str, str] = field(default_factory=dict)


DATASETS = {
    "games": Dataset("games", "appid", column_types(GAMES)),
    "reviews": Dataset("reviews", "review_id", column_types(REVIEWS)),
    "hltb": Dataset("hltb", "game_game_id", column_types(COMPLETION_TIMES)),
}
