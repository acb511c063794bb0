"""The registered queries as SQL over the given tables.

Written against the tables alone: no text here is shared with the DataFrame
code, so a mistake has to be made twice to go unnoticed.
"""

from __future__ import annotations

import re

K = "CAST(json_extract(props, '$.k') AS INTEGER)"


def r(x: str, digits: int = 2) -> str:
    """Half-up rounding with the same bits on every engine."""
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"CAST(FLOOR(({x})*{scale}+CAST(0.5 AS DOUBLE)) AS DOUBLE)/{scale}"


def mean(x: str, where: str = "TRUE") -> str:
    return (
        f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) FILTER (WHERE {where}) AS DOUBLE)"
        f"/CAST(COUNT({x}) FILTER (WHERE {where}) AS DOUBLE)"
    )


def variance(x: str, where: str = "TRUE") -> str:
    n = f"CAST(COUNT({x}) FILTER (WHERE {where}) AS DOUBLE)"
    t = f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) FILTER (WHERE {where}) AS DOUBLE)"
    q = f"CAST(SUM(CAST(CAST({x} AS DECIMAL(18,6))*CAST({x} AS DECIMAL(18,6)) AS DECIMAL(28,6))) FILTER (WHERE {where}) AS DOUBLE)"
    return f"CASE WHEN {n} > 1 THEN GREATEST({q} - {t}*{t}/{n}, CAST(0 AS DOUBLE))/({n} - CAST(1 AS DOUBLE)) END"


# Views over the tables, by name; a view may use the ones before it.
VIEWS = {
    "games": """SELECT p_partkey AS appid, p_name AS name, p_retailprice AS price, p_size AS metacritic_score,
        CASE WHEN p_size % 3 <> 0 THEN p_size END AS positive, p_size % 10 AS negative,
        p_size * 60 AS average_playtime_forever, p_size % 4 * 5 AS discount FROM part""",
    "genre_entries": """SELECT p_partkey AS game_appid, unnest(string_split(p_name, ' ')) AS name
        FROM part WHERE p_size % 7 <> 0""",
    "category_entries": """SELECT p_partkey AS game_appid, p_brand AS name FROM part WHERE p_size % 5 <> 0
        UNION ALL SELECT p_partkey, p_type FROM part WHERE p_size % 5 <> 0""",
    "publisher_entries": """SELECT p_partkey AS game_appid, p_brand || ' ' || p_type AS name
        FROM part WHERE p_size % 11 <> 0""",
    "developer_entries": """SELECT DISTINCT l_partkey AS game_appid, s_name AS name
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "tag_entries": """SELECT l_partkey AS game_appid, l_returnflag AS name, COUNT(*) AS vote_count
        FROM lineitem GROUP BY l_partkey, l_returnflag""",
    "developers": """SELECT row_number() OVER (ORDER BY name) AS developer_id, name
        FROM (SELECT DISTINCT name FROM developer_entries)""",
    "publishers": """SELECT row_number() OVER (ORDER BY name) AS publisher_id, name
        FROM (SELECT DISTINCT name FROM publisher_entries)""",
    "genres": """SELECT row_number() OVER (ORDER BY name) AS genre_id, name, CAST(NULL AS VARCHAR) AS description
        FROM (SELECT DISTINCT name FROM genre_entries)""",
    "categories": """SELECT row_number() OVER (ORDER BY name) AS category_id, name, CAST(NULL AS VARCHAR) AS description
        FROM (SELECT DISTINCT name FROM category_entries)""",
    "tags": """SELECT row_number() OVER (ORDER BY name) AS tag_id, name, total_votes
        FROM (SELECT name, CAST(SUM(vote_count) AS BIGINT) AS total_votes FROM tag_entries GROUP BY name)""",
    "game_developers": "SELECT game_appid, developer_id FROM developer_entries JOIN developers USING (name)",
    "game_publishers": "SELECT game_appid, publisher_id FROM publisher_entries JOIN publishers USING (name)",
    "game_genres": "SELECT game_appid, genre_id FROM genre_entries JOIN genres USING (name)",
    "game_categories": "SELECT game_appid, category_id FROM category_entries JOIN categories USING (name)",
    "game_tags": "SELECT game_appid, tag_id, vote_count FROM tag_entries JOIN tags USING (name)",
    "reviews": """SELECT l_orderkey * 10 + l_linenumber AS review_id, l_partkey AS app_id,
        l_returnflag <> 'R' AS recommended, l_quantity AS votes_helpful,
        l_extendedprice AS author_playtime_at_review, l_linestatus AS language, l_discount > 0 AS steam_purchase,
        l_tax = 0 AS written_during_early_access, l_shipdate AS timestamp_created FROM lineitem""",
    "review_lines": "SELECT *, l_orderkey * 10 + l_linenumber AS review_id FROM lineitem",
    "ranked_lines": """SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY l_orderkey, l_partkey, l_suppkey,
        l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS place
        FROM review_lines""",
    "user_reviews": f"""SELECT event_id AS review_id, user_id AS author_steamid, ts AS timestamp_created,
        event_type IN ('purchase', 'signup') AS recommended, props AS review,
        CAST(TRUNC(value) AS BIGINT) AS votes_helpful,
        CASE WHEN {K} % 10 <> 0 THEN {K} END AS author_num_games_owned,
        CASE WHEN {K} % 10 <> 0 THEN {K} + 1 END AS author_num_reviews,
        CASE WHEN {K} % 10 <> 0 THEN {K} * CAST(1.5 AS DOUBLE) END AS author_playtime_forever FROM events""",
    "log": f"""SELECT event_type AS test_name, 'engine_' || CAST(user_id % 4 AS VARCHAR) AS database,
        event_id AS run_number, CASE WHEN {K} % 10 <> 0 THEN value ELSE 0 END AS execution_time_ms,
        CAST({K} AS BIGINT) AS row_count,
        CASE WHEN {K} % 10 = 0 THEN 'failed with ' || CAST({K} AS VARCHAR) END AS error,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, {K} % 10 <> 0 AS success FROM events""",
    "modal_languages": """SELECT app_id, language AS most_common_language FROM (
        SELECT app_id, language, row_number() OVER (PARTITION BY app_id ORDER BY COUNT(*) DESC, language) AS place
        FROM reviews GROUP BY app_id, language) WHERE place = 1""",
    "game_review_summary": f"""SELECT app_id AS game_appid, COUNT(review_id) AS total_reviews,
        COUNT(*) FILTER (WHERE recommended) AS positive_reviews,
        COUNT(*) FILTER (WHERE NOT recommended) AS negative_reviews,
        {mean("author_playtime_at_review")} AS avg_playtime_at_review,
        median(author_playtime_at_review) AS median_playtime_at_review,
        {mean("votes_helpful")} AS avg_helpful_votes, any_value(most_common_language) AS most_common_language,
        CAST(COUNT(*) FILTER (WHERE steam_purchase) AS DOUBLE)/CAST(COUNT(*) AS DOUBLE) AS steam_purchase_ratio,
        COUNT(*) FILTER (WHERE written_during_early_access) AS early_access_review_count
        FROM reviews JOIN modal_languages USING (app_id) GROUP BY app_id""",
    "genre_lists": """SELECT p_partkey AS appid, CASE WHEN p_size % 7 = 0 THEN [] ELSE string_split(p_name, ' ') END
        AS genres FROM part""",
    "modal_genres": """SELECT developer_id, genres[1] AS most_common_genre FROM (
        SELECT developer_id, genres, row_number() OVER (PARTITION BY developer_id ORDER BY COUNT(*) DESC, genres) AS place
        FROM game_developers JOIN genre_lists ON game_appid = appid GROUP BY developer_id, genres) WHERE place = 1""",
    "developer_stats": f"""SELECT developer_id, COUNT(game_appid) AS total_games, {mean("price")} AS avg_game_price,
        {mean("metacritic_score")} AS avg_metacritic_score,
        CAST(COALESCE(SUM(positive), 0) AS BIGINT) AS total_positive_reviews,
        CAST(COALESCE(SUM(negative), 0) AS BIGINT) AS total_negative_reviews,
        {mean("average_playtime_forever")} AS avg_playtime, any_value(most_common_genre) AS most_common_genre
        FROM game_developers LEFT JOIN games ON game_appid = appid JOIN modal_genres USING (developer_id)
        GROUP BY developer_id""",
    "node_list": """SELECT 'Game' AS label, appid AS key FROM games UNION ALL
        SELECT 'GameDeveloper', developer_id FROM developers UNION ALL SELECT 'GameGenre', genre_id FROM genres""",
    "edge_list": """SELECT DISTINCT 'Game' AS src_label, game_appid AS src, 'DEVELOPED_BY_NORM' AS rel_type,
        'GameDeveloper' AS dst_label, developer_id AS dst FROM game_developers UNION ALL
        SELECT DISTINCT 'Game', game_appid, 'HAS_GENRE_NORM', 'GameGenre', genre_id FROM game_genres""",
    "perturbed": f"""SELECT CASE WHEN appid % 101 = 0 THEN -appid ELSE appid END AS appid,
        CASE WHEN appid % 83 <> 0 THEN name END AS name,
        {r("CASE WHEN appid % 97 = 0 THEN price + CAST(0.02 AS DOUBLE) WHEN appid % 89 = 0 THEN price + CAST(0.009 AS DOUBLE) ELSE price END", 3)} AS price,
        metacritic_score FROM games WHERE appid % 79 <> 0""",
}


def sql(body: str) -> str:
    """Prefix the views a statement uses, in order of definition."""
    used: set[str] = set()
    open_names = [n for n in VIEWS if re.search(rf"\b{n}\b", body)]
    while open_names:
        name = open_names.pop()
        if name not in used:
            used.add(name)
            open_names += [n for n in VIEWS if n != name and re.search(rf"\b{n}\b", VIEWS[name])]
    views = ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in used)
    return f"WITH {views} {body}" if views else body


LINE_COLUMNS = """review_id, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate"""

SIMPLE_SELECT = "SELECT appid, name, price FROM games WHERE price > 910 ORDER BY price DESC, appid LIMIT 100"

COUNT_BY_GENRE = """WITH words AS (SELECT unnest(string_split(p_name, ' ')) AS genre FROM part WHERE p_size % 7 <> 0)
    SELECT genre, COUNT(*) AS game_count FROM words GROUP BY genre ORDER BY 2 DESC, 1 LIMIT 100"""

GAMES_WITH_DEVELOPERS = """SELECT p_partkey AS appid, any_value(p_name) AS game_name, s_name AS developer
    FROM lineitem, part, supplier WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey AND p_retailprice > 910
    GROUP BY p_partkey, s_name ORDER BY 1, 3 LIMIT 100"""

REVIEW_STATS = f"""WITH early AS (SELECT p_partkey FROM part WHERE p_retailprice > 0 ORDER BY p_partkey LIMIT 20)
    SELECT l_partkey AS app_id, COUNT(*) AS total_reviews, COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS positive_reviews,
    {r(mean("l_quantity"))} AS avg_helpful_votes FROM lineitem SEMI JOIN early ON l_partkey = p_partkey
    GROUP BY l_partkey ORDER BY 2 DESC, 1"""

DEVELOPER_STATISTICS = f"""WITH supplied AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
    SELECT dense_rank() OVER (ORDER BY s_name) AS developer_id, s_name AS developer_name, COUNT(*) AS total_games,
    {r(mean("p_retailprice"))} AS avg_price,
    CAST(COALESCE(SUM(p_size) FILTER (WHERE p_size % 3 <> 0), 0) AS BIGINT) AS total_positive_reviews,
    CAST(SUM(p_size % 10) AS BIGINT) AS total_negative_reviews
    FROM supplied JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_name QUALIFY COUNT(*) >= 500 ORDER BY 3 DESC, 2 LIMIT 100"""

PRICE_HISTORY = f"""SELECT l_partkey AS game_appid, COUNT(*) AS price_points, {r("MIN(l_extendedprice)")} AS min_price,
    {r("MAX(l_extendedprice)")} AS max_price, {r(mean("l_extendedprice"))} AS avg_price FROM lineitem
    GROUP BY l_partkey ORDER BY price_points DESC, game_appid LIMIT 100"""

DETAILS_ALL = """SELECT p_partkey AS appid, p_name AS game_name, de.name AS developer, genre, category FROM (
    SELECT p_partkey, p_name, unnest(CASE WHEN p_size % 7 = 0 THEN [NULL] ELSE string_split(p_name, ' ') END) AS genre,
    CASE WHEN p_size % 5 = 0 THEN [NULL] ELSE [p_brand, p_type] END AS pair
    FROM part WHERE p_retailprice BETWEEN 905 AND 915) CROSS JOIN unnest(pair) AS u(category)
    LEFT JOIN developer_entries de ON de.game_appid = p_partkey"""
DETAIL_ORDER = "ORDER BY appid, COALESCE(developer, ''), COALESCE(genre, ''), COALESCE(category, '') LIMIT 100"
DETAILS = f"SELECT * FROM ({DETAILS_ALL}) {DETAIL_ORDER}"
# The graph form has one edge per pair of nodes, so repeated links collapse.
DETAILS_GRAPH = f"SELECT * FROM (SELECT DISTINCT * FROM ({DETAILS_ALL})) {DETAIL_ORDER}"


def profile(table: str, columns: list[tuple[str, str]]) -> str:
    """One row per column of a table."""
    parts = []
    for name, kind in columns:
        numeric = kind in ("int", "bigint", "double")
        lo = f"CAST(MIN({name}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        hi = f"CAST(MAX({name}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        fits = f"MIN({name}) >= -2147483648 AND MAX({name}) <= 2147483647" if numeric else "CAST(NULL AS BOOLEAN)"
        longest = f"CAST(MAX(length({name})) AS BIGINT)" if kind == "string" else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, COUNT({name}) AS non_null, "
            f"{lo} AS min_value, {hi} AS max_value, {fits} AS fits_int32, {longest} AS max_length FROM {table}"
        )
    return " UNION ALL ".join(parts)




def cell_diff(left: str, right: str, key: str, fields: list[tuple[str, bool]]) -> str:
    joined = f"FROM ({left}) a FULL OUTER JOIN ({right}) b ON a.{key} = b.{key}"
    parts = [
        f"SELECT COALESCE(a.{key}, b.{key}) AS {key}, CAST(NULL AS VARCHAR) AS field, CAST(NULL AS VARCHAR) AS left_value, "
        f"CAST(NULL AS VARCHAR) AS right_value, CASE WHEN a.{key} IS NULL THEN 'missing_left' ELSE 'missing_right' END "
        f"AS difference {joined} WHERE a.{key} IS NULL OR b.{key} IS NULL"
    ]
    for field, numeric in fields:
        test = (
            f"COALESCE(abs(CAST(a.{field} AS DOUBLE) - CAST(b.{field} AS DOUBLE)) > CAST(0.01 AS DOUBLE), "
            f"(a.{field} IS NULL) <> (b.{field} IS NULL))"
            if numeric
            else f"a.{field} IS DISTINCT FROM b.{field}"
        )
        parts.append(
            f"SELECT a.{key}, '{field}', CAST(a.{field} AS VARCHAR), CAST(b.{field} AS VARCHAR), 'value' "
            f"{joined} WHERE a.{key} IS NOT NULL AND b.{key} IS NOT NULL AND {test}"
        )
    return " UNION ALL ".join(parts)


STD = f"CASE WHEN COUNT(*) FILTER (WHERE success) = 1 THEN 0.0 ELSE {r('SQRT(' + variance('execution_time_ms', 'success') + ')', 6)} END"

AUDITED = ("developers", "publishers", "genres", "categories", "tags", "game_developers", "game_publishers", "game_genres",
           "game_categories", "game_tags", "game_review_summary", "developer_stats")

_STATEMENTS: dict[str, str] = {
    # sources and sinks
    "csv_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "checkpoint_roundtrip": "SELECT * REPLACE (strftime(timestamp_created, '%Y-%m-%d %H:%M:%S.%f') AS timestamp_created) FROM reviews",
    "append_table": """SELECT appid, name, price, CASE WHEN metacritic_score % 7 = 0 THEN '[]'
        ELSE '["' || replace(name, ' ', '","') || '"]' END AS genres FROM games""",
    "append_loads": "SELECT appid, name, price, CASE WHEN price <= 910 THEN 'cheap' ELSE 'other' END AS load_id FROM games",
    "checkpoint_fingerprint": """SELECT step, step NOT IN ('again', 'files again') AS built,
        COUNT(*) FILTER (WHERE p_partkey % 2 = 0 OR step IN ('files', 'files again')) AS row_count
        FROM part, (SELECT unnest(['first', 'again', 'parameter', 'files', 'files again']) AS step) GROUP BY step""",
    "document_sink": """SELECT p_partkey AS appid, p_name AS name, p_retailprice AS price,
        CASE WHEN p_size % 7 = 0 THEN '' ELSE replace(p_name, ' ', '|') END AS genres,
        CASE WHEN p_size % 5 <> 0 THEN p_brand || '|' || p_type END AS categories FROM part""",
    "report_sink": """SELECT test_name, database, MIN(execution_time_ms) FILTER (WHERE success) AS min_ms,
        MAX(execution_time_ms) FILTER (WHERE success) AS max_ms, COUNT(*) FILTER (WHERE success) AS successes,
        COUNT(*) FILTER (WHERE NOT success) AS failures, COUNT(*) AS logged_runs,
        COUNT(*) OVER (PARTITION BY test_name) AS results FROM log GROUP BY test_name, database""",
    "dataset_definitions": """SELECT CAST(p_partkey AS INTEGER) AS game_game_id, p_name AS game_game_name,
        p_size AS game_comp_main FROM part""",
    "table_lifecycle": """SELECT step, step IN ('loaded', 'truncated') AS present, step <> 'loaded' OR n = 0 AS is_empty,
        CASE WHEN step = 'loaded' THEN n ELSE 0 END AS row_count FROM (SELECT COUNT(*) AS n FROM part),
        (SELECT unnest(['absent', 'loaded', 'truncated', 'dropped']) AS step)""",
    "targets_empty": """SELECT target, target NOT IN (SELECT 'games' FROM part UNION SELECT label FROM node_list) AS is_empty
        FROM (SELECT unnest(['games', 'lost', 'absent', 'Game', 'GameGenre', 'GameTag']) AS target)""",
    "row_count_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in AUDITED
    )
    + """ UNION ALL SELECT 'user_profiles', COUNT(DISTINCT user_id) FROM events
        UNION ALL SELECT 'game_price_history', 13 * COUNT(*) FROM part WHERE p_retailprice > 0""",
    # cleaning
    "rename_columns": """SELECT review_id, author_steamid, author_num_games_owned, author_num_reviews,
        author_playtime_forever FROM user_reviews""",
    "drop_index_column": "SELECT event_id, event_type, value FROM events",
    "parse_nested_columns": """SELECT p_partkey AS appid,
        CASE WHEN p_size % 7 = 0 THEN '' ELSE replace(p_name, ' ', '|') END AS genres,
        CASE WHEN p_size % 5 <> 0 THEN p_brand || '|' || p_type END AS categories,
        CASE WHEN p_size % 7 <> 0 THEN string_split(p_name, ' ')[1] || '|rated' END AS tag_names,
        CASE WHEN p_size % 7 <> 0 THEN CAST(p_partkey AS VARCHAR) || '|none' END AS tag_votes FROM part""",
    "parse_literal_forms": """SELECT p_partkey, CASE WHEN p_partkey % 5 <> 4 THEN replace(p_name, ' ', '|') END AS words,
        CAST(p_size AS BIGINT) * 10 AS tens, CAST(p_size AS BIGINT) AS hex, CAST(p_size AS BIGINT) AS first, p_partkey % 5 = 4 AS unread FROM part""",
    "epoch_to_timestamp": "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS created FROM events",
    "sort_then_limit": "SELECT review_id, author_steamid, votes_helpful FROM user_reviews ORDER BY review_id LIMIT 1000",
    "first_records": "SELECT review_id, author_steamid, votes_helpful FROM user_reviews QUALIFY row_number() OVER (ORDER BY review_id) <= 1000",
    "unparsed_rows": "SELECT event_id, 'props' AS column, props AS text FROM events",
    "csv_quarantine": """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, CASE WHEN p_size % 7 <> 0 THEN p_size END AS p_size,
        CASE WHEN p_size % 7 = 0 THEN 'p_size' END AS bad_column, CASE WHEN p_size % 7 = 0 THEN 'n/a' END AS bad_text FROM part""",
    "dedup_file_order": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_size FROM part",
    "duplicates_report": f"SELECT {LINE_COLUMNS} FROM ranked_lines WHERE place > 1",
    "dedup_keep_first": f"SELECT {LINE_COLUMNS} FROM ranked_lines WHERE place = 1",
    "duplicate_rows": f"SELECT {LINE_COLUMNS} FROM ranked_lines WHERE place > 1",
    "top_duplicate_keys": """SELECT review_id, COUNT(*) - 1 AS removed_rows FROM review_lines GROUP BY review_id
        HAVING COUNT(*) > 1 ORDER BY removed_rows DESC, review_id LIMIT 10""",
    "frequent_keys": "SELECT app_id, COUNT(*) AS review_count FROM reviews GROUP BY app_id ORDER BY review_count DESC, app_id LIMIT 20",
    "nan_to_null": f"SELECT event_id, CASE WHEN {K} % 10 <> 0 THEN value END AS value FROM events",
    "column_profile": " UNION ALL ".join(
        [
            profile("part", [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
                             ("p_size", "int"), ("p_retailprice", "double")]),
            profile("documents", [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                                  ("n_chars", "bigint")]),
            profile("events", [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
                               ("event_type", "string"), ("value", "double"), ("props", "string")]),
        ]
    ),
    "dataset_shape": """SELECT 'lineitem' AS dataset, COUNT(*) AS row_count, CAST(11 AS BIGINT) AS column_count,
        'l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate'
        AS columns FROM lineitem""",
    "nested_to_json": """SELECT p_partkey AS appid, CASE WHEN p_size % 7 = 0 THEN '' ELSE replace(p_name, ' ', '|') END AS genres,
        '[{"title":"' || p_name || '","percent":' || CAST(p_size % 4 * 5 AS VARCHAR) || '}]' AS packages, tags
        FROM part JOIN (SELECT game_appid, '{' || string_agg('"' || name || '":' || CAST(vote_count AS VARCHAR), ',' ORDER BY name)
        || '}' AS tags FROM tag_entries GROUP BY game_appid) ON p_partkey = game_appid""",
    # normalisation
    "dim_developers": "SELECT * FROM developers",
    "dim_publishers": "SELECT * FROM publishers",
    "dim_genres": "SELECT * FROM genres",
    "dim_categories": "SELECT * FROM categories",
    "dim_tags": "SELECT * FROM tags",
    "bridge_developers": "SELECT * FROM game_developers",
    "bridge_publishers": "SELECT * FROM game_publishers",
    "bridge_genres": "SELECT * FROM game_genres",
    "bridge_categories": "SELECT * FROM game_categories",
    "bridge_tags": "SELECT * FROM game_tags",
    "id_consistency": """SELECT developer_id, CASE WHEN developer_id % 31 <> 0
        AND (developer_id % 97 <> 0 OR name = upper(name)) THEN 'MATCH' ELSE 'MISMATCH' END AS verdict FROM developers""",
    "id_registry": """SELECT row_number() OVER (ORDER BY NOT early, name) AS publisher_id, name, early, 'MATCH' AS verdict
        FROM (SELECT name, bool_or(game_appid % 2 = 0) AS early FROM publisher_entries GROUP BY name)""",
    "dim_game_count": """SELECT g.genre_id, g.name, COUNT(DISTINCT gg.game_appid) AS game_count FROM genres g
        LEFT JOIN game_genres gg ON g.genre_id = gg.genre_id GROUP BY g.genre_id, g.name""",
    # summaries and series
    "user_profiles": """SELECT author_steamid, arg_min(author_num_games_owned, review_id) FILTER (WHERE author_num_games_owned IS NOT NULL)
        AS num_games_owned, arg_min(author_num_reviews, review_id) FILTER (WHERE author_num_reviews IS NOT NULL) AS num_reviews,
        arg_min(author_playtime_forever, review_id) FILTER (WHERE author_playtime_forever IS NOT NULL) AS total_playtime_minutes,
        strftime(MIN(timestamp_created), '%Y-%m-%d') AS first_review_date,
        strftime(MAX(timestamp_created), '%Y-%m-%d') AS last_review_date,
        COUNT(*) FILTER (WHERE recommended) AS positive_review_count,
        COUNT(*) FILTER (WHERE NOT recommended) AS negative_review_count,
        CAST(SUM(length(review)) AS DOUBLE)/COUNT(review) AS avg_review_length,
        CAST(SUM(votes_helpful) AS BIGINT) AS helpful_votes_received FROM user_reviews GROUP BY author_steamid""",
    "game_review_summary": "SELECT * FROM game_review_summary",
    "developer_stats": "SELECT * FROM developer_stats",
    "mode_language": "SELECT * FROM modal_languages",
    "snapshot_spine": """SELECT item * 13 + step AS history_id, appid AS game_appid, price,
        discount AS discount_percent, strftime(DATE '2024-06-30' - CAST(30 * (12 - step) AS INTEGER), '%Y-%m-%d') AS recorded_date
        FROM (SELECT *, row_number() OVER (ORDER BY appid) - 1 AS item FROM games WHERE price > 0),
        (SELECT unnest(range(13)) AS step)""",
    # analytical queries
    "simple_select": SIMPLE_SELECT,
    "count_by_genre": COUNT_BY_GENRE,
    "games_with_developers": GAMES_WITH_DEVELOPERS,
    "review_stats_by_game": REVIEW_STATS,
    "developer_statistics": DEVELOPER_STATISTICS,
    "price_history_analysis": PRICE_HISTORY,
    "multi_join_details": DETAILS,
    "multi_join_details_all": DETAILS_ALL,
    "games_by_genre_and_dev": """SELECT e.game_appid, p_name AS game_name, e.name AS genre, de.name AS developer, p_retailprice AS price
        FROM genre_entries e JOIN developer_entries de USING (game_appid) JOIN part ON p_partkey = e.game_appid
        WHERE e.name = 'red' OR e.name = 'gear' ORDER BY 1, 3, 4 LIMIT 100""",
    "games_with_summary": """SELECT p_partkey AS appid, any_value(p_name) AS name, any_value(p_retailprice) AS price,
        COUNT(*) AS total_reviews, COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS positive_reviews,
        COUNT(*) FILTER (WHERE l_returnflag = 'R') AS negative_reviews FROM part JOIN lineitem ON l_partkey = p_partkey
        GROUP BY p_partkey HAVING COUNT(*) > 30 ORDER BY 1 LIMIT 100""",
    "most_reviewed": """SELECT p_partkey AS appid, p_name AS name,
        (SELECT COUNT(*) FROM lineitem WHERE l_partkey = p_partkey) AS review_count FROM part ORDER BY 3 DESC, 1 LIMIT 20""",
    "semi_join_reviews": """SELECT review_id, app_id, language, votes_helpful FROM reviews SEMI JOIN part
        ON p_partkey = app_id AND p_retailprice > 910""",
    "not_null_filter": """SELECT review_id, author_steamid, author_num_games_owned FROM user_reviews
        WHERE author_num_games_owned IS NOT NULL""",
    # document form
    "lookup_nest": """SELECT appid, COUNT(genre_id) AS link_count,
        COALESCE(string_agg(CAST(genre_id AS VARCHAR), ',' ORDER BY genre_id), '') AS genre_ids
        FROM games LEFT JOIN game_genres ON appid = game_appid GROUP BY appid""",
    "lookup_summary": """SELECT appid, COUNT(genre_id) AS link_count, MIN(genre_id) AS first_genre_id
        FROM games LEFT JOIN game_genres ON appid = game_appid GROUP BY appid""",
    "unwind": "SELECT game_appid AS appid, name AS genres FROM genre_entries",
    "unwind_outer": "SELECT appid, c.name AS categories FROM games LEFT JOIN category_entries c ON appid = game_appid",
    "array_first": """SELECT p_partkey AS appid, CASE WHEN p_size % 7 <> 0 THEN string_split(p_name, ' ')[1] END
        AS main_genre FROM part""",
    "array_size": "SELECT p_partkey AS appid, CAST(CASE WHEN p_size % 5 <> 0 THEN 2 ELSE 0 END AS BIGINT) AS category_count FROM part",
    # graph form
    "graph_match": "SELECT DISTINCT game_appid AS appid, name AS genre FROM genre_entries",
    "graph_optional_match": """SELECT DISTINCT appid, c.name AS category FROM games
        LEFT JOIN category_entries c ON appid = game_appid""",
    "graph_group": PRICE_HISTORY,
    "count_by_genre_graph": """SELECT name AS genre, COUNT(DISTINCT game_appid) AS game_count FROM genre_entries
        GROUP BY name ORDER BY game_count DESC, genre LIMIT 100""",
    "multi_join_details_graph": DETAILS_GRAPH,
    # graph tables
    "node_upsert": """SELECT appid,
        CASE WHEN appid % 2 = 0 THEN (CASE WHEN appid % 10 <> 0 THEN upper(name) END) ELSE name END AS name,
        CASE WHEN appid % 4 = 0 THEN NULL ELSE price END AS price,
        CASE WHEN appid % 3 <> 0 THEN metacritic_score END AS metacritic_score,
        CASE WHEN appid % 4 = 0 THEN 2 WHEN appid % 2 = 0 THEN 1 END AS batch
        FROM games WHERE appid % 3 <> 0 OR appid % 2 = 0""",
    "edges_from_list": """SELECT DISTINCT game_appid AS src, 'HAS_CATEGORY' AS rel_type, name AS dst FROM category_entries""",
    "edges_from_bridge": """SELECT DISTINCT game_appid AS src, 'DEVELOPED_BY_NORM' AS rel_type, developer_id AS dst
        FROM game_developers""",
    "edge_targets": "SELECT DISTINCT name FROM category_entries",
    "edges_with_property": """SELECT game_appid AS src, 'HAS_TAG_NORM' AS rel_type, tag_id AS dst, vote_count FROM game_tags""",
    "edges_from_fk": "SELECT DISTINCT review_id AS src, 'REVIEWED' AS rel_type, app_id AS dst FROM reviews JOIN games ON app_id = appid",
    "name_match_link": """SELECT l.p_name AS match_name, COUNT(DISTINCT l.p_partkey) AS left_nodes,
        COUNT(DISTINCT h.p_partkey) AS right_nodes, COUNT(*) AS links FROM part l JOIN part h
        ON l.p_name = h.p_name GROUP BY l.p_name""",
    "name_match_edges": """SELECT side, CAST(p_partkey AS VARCHAR) AS node, 'HAS_PLAYTIME_DATA' AS rel_type, p_name AS hub
        FROM part, (SELECT unnest(['left', 'right']) AS side)""",
    "label_counts": "SELECT label, COUNT(*) AS node_count FROM node_list GROUP BY label",
    "detach_delete": """SELECT label AS name, key AS src, CAST(NULL AS BIGINT) AS dst FROM node_list WHERE label <> 'GameGenre'
        UNION ALL SELECT rel_type, src, dst FROM edge_list WHERE src_label <> 'GameGenre' AND dst_label <> 'GameGenre'""",
    "dangling_edges": """SELECT *, 'src' AS missing_end FROM edge_list WHERE src % 50 = 0
        UNION ALL SELECT *, 'dst' FROM edge_list WHERE dst_label = 'GameDeveloper' AND dst % 20 = 0""",
    "uniqueness_check": "SELECT review_id, COUNT(*) AS copies FROM review_lines GROUP BY review_id HAVING COUNT(*) > 1",
    # reconciliation
    "canonical_rows": f"""SELECT event_id, CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS is_purchase,
        {r("value/CAST(8 AS DOUBLE)")} AS share, CASE WHEN {K} % 10 <> 0 THEN CAST({K} AS DOUBLE) END AS whole,
        event_type AS kind, CASE WHEN {K} % 2 = 0 OR epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS at FROM events""",
    "row_count_match": """SELECT CAST(3 AS BIGINT) AS results, LEAST(a, b) AS min_rows, GREATEST(a, b) AS max_rows, TRUE AS comparable,
        a = b AS row_count_match FROM (SELECT COUNT(*) AS a FROM genre_entries),
        (SELECT COUNT(*) AS b FROM (SELECT DISTINCT game_appid, name FROM genre_entries))""",
    "field_diff": "SELECT * FROM (VALUES ('event_type', 'left'), ('kind', 'right')) AS t(field, present_in)",
    "cell_diff": cell_diff(
        "SELECT appid, name, price, metacritic_score FROM games", "SELECT * FROM perturbed", "appid",
        [("name", False), ("price", True), ("metacritic_score", True)],
    ),
    "cell_diff_by_position": cell_diff(
        "SELECT row_number() OVER (ORDER BY appid) - 1 AS row_no, appid, name, price FROM games",
        "SELECT row_number() OVER (ORDER BY appid) - 1 AS row_no, appid, name, price FROM perturbed",
        "row_no", [("appid", True), ("name", False), ("price", True)],
    ),
    "path_diff": """SELECT * FROM (VALUES ('$.detail.kind', 'left'), ('$.detail.type', 'right'), ('$.detail.value', 'both'),
        ('$.items[*].late', 'right')) AS t(path, present_in)""",
    "range_report": """SELECT COUNT(*) AS left_rows, COUNT(*) FILTER (WHERE app_id % 101 <> 0) AS right_rows,
        bool_or(app_id % 101 = 0) AS differs FROM reviews""",
    "compare_results": """SELECT 'first' AS reference_result, 'renamed' AS compared_result, TRUE AS row_count_match,
        TRUE AS fields_match, CAST(0 AS BIGINT) AS differing_cells, TRUE AS match UNION ALL
        SELECT 'first', 'changed', COUNT(*) FILTER (WHERE appid % 79 = 0) = 0, TRUE, CAST(SUM(CASE WHEN appid % 79 = 0 THEN 1
        WHEN appid % 101 = 0 THEN 2 ELSE (appid % 83 = 0)::INT + (appid % 97 = 0)::INT END) AS BIGINT),
        SUM(CASE WHEN appid % 79 = 0 OR appid % 101 = 0 OR appid % 83 = 0 OR appid % 97 = 0 THEN 1 ELSE 0 END) = 0 FROM games""",
    "overall_verdict": """SELECT test_name, results, row_count_match, data_match,
        CASE WHEN results < 2 THEN 'not comparable' WHEN row_count_match AND data_match THEN 'match' ELSE 'mismatch' END AS verdict
        FROM (SELECT test_name, COUNT(*) AS results, COUNT(DISTINCT rows_seen) = 1 AS row_count_match, bool_and(ok) AS data_match
        FROM (SELECT test_name, database, MAX(row_count) AS rows_seen, bool_and(run_number <> 97) AS ok FROM log
        GROUP BY test_name, database) GROUP BY test_name)""",
    # run statistics
    "run_log": "SELECT * FROM log",
    "run_statistics": f"""SELECT test_name, database, {mean("execution_time_ms", "success")} AS mean_ms,
        median(execution_time_ms) FILTER (WHERE success) AS median_ms, {STD} AS std_ms,
        MIN(execution_time_ms) FILTER (WHERE success) AS min_ms, MAX(execution_time_ms) FILTER (WHERE success) AS max_ms,
        COUNT(*) FILTER (WHERE success) AS successes, COUNT(*) FILTER (WHERE NOT success) AS failures,
        CAST(COUNT(*) FILTER (WHERE success) AS DOUBLE)/CAST(COUNT(*) AS DOUBLE) AS success_rate,
        COALESCE({mean("row_count", "success")}, 0) AS avg_row_count FROM log GROUP BY test_name, database""",
    "run_cv": f"""SELECT database, mean_ms, {r("sd", 6)} AS std_ms, {r("sd/mean_ms*CAST(100 AS DOUBLE)", 6)} AS cv_percent FROM (
        SELECT database, {mean("execution_time_ms")} AS mean_ms, SQRT({variance("execution_time_ms")}) AS sd
        FROM log WHERE success GROUP BY database)""",
    "effect_size": f"""SELECT test_name, {r("(m1-m2)/SQRT(((n1-1)*v1+(n2-1)*v2)/(n1+n2-2)*(1/n1+1/n2))", 6)} AS t_statistic,
        {r("(m1-m2)/SQRT((v1+v2)/2)", 6)} AS cohens_d FROM (SELECT test_name,
        CAST(COUNT(*) FILTER (WHERE database = 'engine_0') AS DOUBLE) AS n1,
        CAST(COUNT(*) FILTER (WHERE database = 'engine_1') AS DOUBLE) AS n2,
        {mean("execution_time_ms", "database = 'engine_0'")} AS m1, {mean("execution_time_ms", "database = 'engine_1'")} AS m2,
        {variance("execution_time_ms", "database = 'engine_0'")} AS v1, {variance("execution_time_ms", "database = 'engine_1'")} AS v2
        FROM log WHERE success GROUP BY test_name)""",
    "anova_f": f"""SELECT test_name, CAST(k AS BIGINT) AS engines, CAST(n AS BIGINT) AS runs,
        {r("((shares - total*total/n)/(k-1))/((squares - shares)/(n-k))", 6)} AS f_statistic FROM (
        SELECT test_name, CAST(COUNT(*) AS DOUBLE) AS k, CAST(SUM(n) AS DOUBLE) AS n, CAST(SUM(total) AS DOUBLE) AS total,
        CAST(SUM(squares) AS DOUBLE) AS squares, SUM(CAST(total AS DOUBLE)*CAST(total AS DOUBLE)/n) AS shares FROM (
        SELECT test_name, database, COUNT(*) AS n, SUM(CAST(execution_time_ms AS DECIMAL(18,6))) AS total,
        SUM(CAST(CAST(execution_time_ms AS DECIMAL(18,6))*CAST(execution_time_ms AS DECIMAL(18,6)) AS DECIMAL(28,6))) AS squares
        FROM log WHERE success GROUP BY test_name, database) GROUP BY test_name)""",
    "describe_by_group": f"""SELECT test_name, database, COUNT(execution_time_ms) AS count, {mean("execution_time_ms")} AS mean,
        {r("SQRT(" + variance("execution_time_ms") + ")", 6)} AS std, MIN(execution_time_ms) AS min,
        {r("quantile_cont(execution_time_ms, 0.25)", 6)} AS p25, {r("quantile_cont(execution_time_ms, 0.5)", 6)} AS p50,
        {r("quantile_cont(execution_time_ms, 0.75)", 6)} AS p75, MAX(execution_time_ms) AS max FROM log GROUP BY test_name, database""",
    "histogram_bins": """SELECT test_name, CAST(LEAST(FLOOR((execution_time_ms - lo)*CAST(30 AS DOUBLE)/(hi - lo)), 29) AS BIGINT) + 1 AS bin,
        COUNT(*) AS values FROM log JOIN (SELECT test_name, MIN(execution_time_ms) AS lo, MAX(execution_time_ms) AS hi
        FROM log GROUP BY test_name) USING (test_name) GROUP BY ALL""",
    "step_times": f"""SELECT event_type AS step, COUNT(*) AS runs,
        {r("CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE)", 6)} AS total_seconds FROM events GROUP BY event_type""",
}
for _name, _same in {
    "simple_select": SIMPLE_SELECT,
    "games_with_developers": GAMES_WITH_DEVELOPERS,
    "review_stats_by_game": REVIEW_STATS,
    "developer_statistics": DEVELOPER_STATISTICS,
}.items():
    _STATEMENTS[f"{_name}_documents"] = _same
    _STATEMENTS[f"{_name}_graph"] = _same
_STATEMENTS["build_normalised"] = _STATEMENTS["row_count_audit"]
_STATEMENTS["merge_partitions"] = _STATEMENTS["node_upsert"]
_STATEMENTS["merged_run_statistics"] = _STATEMENTS["run_statistics"]
_STATEMENTS["range_diff"] = _STATEMENTS["cell_diff"]
_STATEMENTS["count_by_genre_documents"] = COUNT_BY_GENRE
_STATEMENTS["price_history_analysis_documents"] = PRICE_HISTORY
_STATEMENTS["multi_join_details_documents"] = DETAILS

ORACLE: dict[str, str] = {name: sql(body) for name, body in _STATEMENTS.items()}
