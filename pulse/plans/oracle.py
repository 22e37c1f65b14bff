"""DuckDB SQL equal to each registered query, over the same parquet tables.

``STATUSES`` rebuilds the status records as flat columns (lists for arrays)
with the same rules as ``pulse.sources.statuses``; each query appends to it.
"""

from __future__ import annotations

STATUSES = """
WITH statuses AS (
 SELECT e.event_id AS id, e.ts AS created_at, d.lang AS lang, d.text AS text,
  length(d.text) > 280 AS truncated,
  e.event_type = 'error' AS possibly_sensitive,
  CAST(e.event_id % 11 AS INTEGER) AS favorite_count, e.event_id % 11 = 0 AS favorited,
  CAST(e.event_id % 6 AS INTEGER) AS retweet_count, FALSE AS retweeted,
  CASE WHEN e.event_id % 8 = 0 THEN concat('User_', e.user_id % 13) END AS in_reply_to_screen_name,
  CASE WHEN e.event_id % 8 = 0 THEN e.event_id - 1 ELSE -1 END AS in_reply_to_status_id,
  CASE WHEN e.event_id % 8 = 0 THEN e.user_id % 13 ELSE -1 END AS in_reply_to_user_id,
  CASE WHEN e.event_id % 9 = 0 THEN concat('quoted ', e.event_id % 100) END AS quoted_status_text,
  CASE WHEN e.event_id % 9 = 0 THEN e.event_id % 100 ELSE -1 END AS quoted_status_id,
  CASE WHEN e.event_id % 7 = 0 THEN d.text END AS rt_text,
  CASE WHEN e.event_id % 7 = 0 THEN CASE WHEN e.user_id % 2 = 0 THEN 'BTS_twt'
       ELSE concat('User_', e.user_id % 10) END END AS rt_screen_name,
  CASE WHEN e.event_id % 5 <> 0
       THEN [upper(e.event_type), concat('Tag', CAST(floor(e.value) AS BIGINT) % 20)]
       ELSE CAST([] AS VARCHAR[]) END AS hashtags,
  CASE WHEN e.event_id % 6 = 0 THEN [concat('https://media.example.com/', e.event_id)]
       ELSE CAST([] AS VARCHAR[]) END AS media,
  CASE WHEN e.event_id % 4 = 0 THEN ((e.event_id * 7) % 18001) / CAST(100 AS DOUBLE) - 90 END AS latitude,
  CASE WHEN e.event_id % 4 = 0 THEN ((e.event_id * 13) % 36001) / CAST(100 AS DOUBLE) - 180 END AS longitude,
  CASE WHEN e.event_id % 3 = 0 THEN concat('p', na.n_nationkey) END AS place_id,
  CASE WHEN e.event_id % 3 = 0 THEN r.r_name END AS place_country,
  CASE WHEN e.event_id % 3 = 0 THEN CASE WHEN r.r_name = 'AMERICA' THEN 'US'
       ELSE substring(r.r_name, 1, 2) END END AS place_country_code,
  CASE WHEN e.event_id % 3 = 0 THEN concat(na.n_name, ', ', r.r_name) END AS place_full_name,
  CASE WHEN e.event_id % 3 = 0 THEN na.n_name END AS place_name,
  CASE WHEN e.event_id % 3 = 0 THEN 'city' END AS place_type,
  CASE WHEN e.event_id % 3 = 0 THEN concat('https://place.example.com/', na.n_nationkey) END AS place_url,
  e.user_id AS user_id, concat('User_', e.user_id) AS user_screen_name,
  concat('Name ', e.user_id) AS user_name,
  CASE WHEN e.user_id % 2 = 0 THEN concat('bio ', e.user_id) END AS user_description,
  CASE WHEN e.user_id % 3 = 0 THEN na.n_name END AS user_location,
  CASE WHEN e.user_id % 4 = 0 THEN concat('https://u.example.com/', e.user_id) END AS user_url,
  CASE WHEN e.user_id % 9 = 0 THEN ['DE', 'FR'] ELSE CAST([] AS VARCHAR[]) END AS user_withheld,
  CAST(e.user_id * 3 + e.event_id % 10 AS INTEGER) AS user_followers_count,
  CAST(e.event_id AS INTEGER) AS user_statuses_count, e.user_id % 10 = 0 AS user_verified,
  CAST(e.user_id % 50 AS INTEGER) AS user_favourites_count,
  CAST(e.user_id % 40 AS INTEGER) AS user_friends_count,
  CAST(e.user_id % 30 AS INTEGER) AS user_listed_count
 FROM events e
 JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
 LEFT JOIN nation na ON na.n_nationkey = e.event_id % 25
 LEFT JOIN region r ON r.r_regionkey = na.n_regionkey),
en AS (SELECT * FROM statuses WHERE lang = 'en'),
us AS (SELECT * FROM en WHERE place_id IS NOT NULL AND place_country_code = 'US'),
tags AS (
 SELECT id, created_at, lower(t.tag) AS tag, CAST(t.pos - 1 AS INTEGER) AS pos
 FROM us, unnest(hashtags) WITH ORDINALITY AS t(tag, pos)),
rts AS (SELECT * FROM statuses WHERE rt_text IS NOT NULL AND lower(rt_screen_name) = 'bts_twt'),
lexicon(ord, word, score) AS (VALUES (1,'that',2),(2,'with',1),(3,'this',3),(4,'from',-2),
 (5,'than',-3),(6,'thre',-1),(7,'and',1),(8,'of',-1),(9,'eriner',4),(10,'rely',-4),(11,'that',-5)),
lex AS (SELECT word, arg_min(score, ord) AS score FROM lexicon GROUP BY word),
track_a AS (SELECT * FROM en WHERE contains(lower(text), 'attion') OR contains(lower(text), 'thble')
 OR contains(lower(text), 'eriner')),
track_b AS (SELECT * FROM en WHERE contains(lower(text), 'eriner') OR contains(lower(text), 'rely')),
words_a AS (
 SELECT id, w.word, CAST(w.pos - 1 AS INTEGER) AS pos
 FROM track_a, unnest(string_split(lower(text), ' ')) WITH ORDINALITY AS w(word, pos)),
words_b AS (
 SELECT id, w.word FROM track_b, unnest(string_split(lower(text), ' ')) AS w(word)),
senti_a AS (
 SELECT CAST(t.id AS VARCHAR) AS id, CAST(coalesce(s.rating, 0) AS INTEGER) AS rating, t.text
 FROM track_a t LEFT JOIN (
  SELECT w.id, sum(l.score) AS rating FROM words_a w JOIN lex l USING (word) GROUP BY w.id) s
 ON s.id = t.id),
senti_b AS (
 SELECT CAST(t.id AS VARCHAR) AS id, CAST(coalesce(s.rating, 0) AS INTEGER) AS rating, t.text
 FROM track_b t LEFT JOIN (
  SELECT w.id, sum(l.score) AS rating FROM words_b w JOIN lex l USING (word) GROUP BY w.id) s
 ON s.id = t.id),
user_iv AS (
 SELECT date_trunc('hour', created_at) AS window_start,
        date_trunc('hour', created_at) + INTERVAL 1 HOUR AS window_end,
        user_screen_name AS "user", count(*) AS "count"
 FROM en GROUP BY 1, 2, 3),
tag_iv AS (
 SELECT date_trunc('hour', created_at) AS window_start,
        date_trunc('hour', created_at) + INTERVAL 1 HOUR AS window_end,
        tag AS tags, count(*) AS freq
 FROM tags GROUP BY 1, 2, 3),
rt_iv AS (
 SELECT date_trunc('hour', created_at) AS window_start,
        date_trunc('hour', created_at) + INTERVAL 1 HOUR AS window_end,
        user_screen_name AS top_user, count(*) AS retweeted
 FROM rts GROUP BY 1, 2, 3),
delivered AS (
 SELECT *, 1 AS delivery_no FROM en
 UNION ALL
 SELECT * REPLACE (favorite_count + 1 AS favorite_count, retweet_count + 1 AS retweet_count), 2 AS delivery_no
 FROM en WHERE favorited)
"""

_CREATED = "strftime({c}, '%a %b %d %H:%M:%S UTC %Y')"

_STATUS_ROW = f"""
 id,
 CAST(coalesce(longitude, 181.0) AS FLOAT) AS longitude,
 CAST(coalesce(latitude, 91.0) AS FLOAT) AS latitude,
 {_CREATED.format(c="created_at")} AS created_at,
 array_to_string(hashtags, ',') AS entities,
 array_to_string(media, ',') AS extended_entities,
 favorite_count, favorited, in_reply_to_screen_name, in_reply_to_status_id, in_reply_to_user_id,
 lang, place_id, possibly_sensitive, quoted_status_text AS quoted_status, quoted_status_id,
 retweet_count, retweeted, rt_text AS retweeted_status, text, truncated, user_id
"""

_USER_ROW = f"""
 user_id AS id, FALSE AS contributors_enabled,
 {_CREATED.format(c="TIMESTAMP '2020-01-01 00:00:00'")} AS created_at,
 TRUE AS default_profile, FALSE AS default_profile_image, user_description AS description,
 user_favourites_count AS favourites_count, FALSE AS follow_request_sent,
 user_followers_count AS followers_count, user_friends_count AS friends_count,
 TRUE AS geo_enabled, 'en' AS lang, user_listed_count AS listed_count,
 user_location AS location, user_name AS name,
 concat('https://img.example.com/', user_id) AS profile_image_url, FALSE AS protected,
 user_screen_name AS screen_name, user_statuses_count AS statuses_count, user_url AS url,
 user_verified AS verified, array_to_string(user_withheld, ',') AS withheld_in_countries
"""

_PLACE_ROW = """
 coalesce(place_id, CAST(id AS VARCHAR)) AS id, place_country AS country,
 place_country_code AS country_code, place_full_name AS full_name, place_name AS name,
 place_type, place_url AS url
"""

_UPSERT_USERS = f"""
SELECT * EXCLUDE (rn) FROM (
 SELECT {_USER_ROW}, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS rn
 FROM en) WHERE rn = 1
"""

_UPSERT_PLACES = f"""
SELECT * EXCLUDE (rn) FROM (
 SELECT {_PLACE_ROW},
        row_number() OVER (PARTITION BY coalesce(place_id, CAST(id AS VARCHAR))
                           ORDER BY created_at DESC, id DESC) AS rn
 FROM en) WHERE rn = 1
"""

_UPSERT_STATUSES = f"""
SELECT * EXCLUDE (rn) FROM (
 SELECT {_STATUS_ROW}, row_number() OVER (PARTITION BY id ORDER BY delivery_no DESC) AS rn
 FROM delivered) WHERE rn = 1
"""

_HASHTAG_COUNTS = "SELECT tag AS tags, count(*) AS freq FROM tags GROUP BY tag"
_RETWEETER_COUNTS = "SELECT user_screen_name AS top_user, count(*) AS retweeted FROM rts GROUP BY 1"
_USER_COUNTS = 'SELECT user_screen_name AS "user", count(*) AS "count" FROM en GROUP BY 1'

_STATUS_USER_PLACE = f"""
SELECT s.id, s.user_id, u.screen_name, u.followers_count, s.place_id, p.full_name AS place_full_name
FROM ({_UPSERT_STATUSES}) s
LEFT JOIN ({_UPSERT_USERS}) u ON s.user_id = u.id
LEFT JOIN ({_UPSERT_PLACES}) p ON s.place_id = p.id"""

_Q: dict[str, str] = {
    "status_scan": """
SELECT id, created_at, lang, text, truncated, possibly_sensitive, favorite_count, favorited,
 retweet_count, retweeted, in_reply_to_screen_name, in_reply_to_status_id, in_reply_to_user_id,
 quoted_status_text, quoted_status_id, rt_text, rt_screen_name,
 array_to_string(hashtags, ',') AS hashtags_csv, array_to_string(media, ',') AS media_csv,
 latitude, longitude, place_id, place_country, place_country_code, place_full_name, place_name,
 place_type, place_url, user_id, user_screen_name, user_name, user_description, user_location,
 user_url, array_to_string(user_withheld, ',') AS user_withheld_csv, user_followers_count,
 user_statuses_count, user_verified
FROM statuses""",
    "lang_filter": "SELECT id, lang, created_at FROM en",
    "status_ids": "SELECT id FROM en",
    "status_total": "SELECT count(*) AS n_statuses FROM en",
    "preview_100": "SELECT id, user_screen_name AS screen_name, created_at FROM en ORDER BY id LIMIT 100",
    "user_counts": _USER_COUNTS,
    "user_counts_by_interval": "SELECT * FROM user_iv",
    "running_user_counts": """
SELECT *, CAST(sum("count") OVER (PARTITION BY "user" ORDER BY window_start
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_count
FROM user_iv""",
    "distinct_user_total": "SELECT count(DISTINCT user_screen_name) AS n_users FROM en",
    "top_100_users": _USER_COUNTS + ' ORDER BY "count" DESC, "user" ASC LIMIT 100',
    "counter_user": 'SELECT "user", CAST(sum("count") AS BIGINT) AS "count" FROM user_iv GROUP BY 1',
    "us_statuses": "SELECT id, place_id, place_country_code AS country_code FROM us",
    "hashtag_explode": "SELECT id, pos, tag FROM tags",
    "hashtag_counts": _HASHTAG_COUNTS,
    "hashtag_counts_by_interval": "SELECT * FROM tag_iv",
    "ranked_hashtags": f"SELECT tags, freq, rank() OVER (ORDER BY freq DESC) AS rank FROM ({_HASHTAG_COUNTS})",
    "top_hashtag": _HASHTAG_COUNTS + " ORDER BY freq DESC, tags ASC LIMIT 1",
    "top_hashtags_by_interval": """
SELECT * FROM (
 SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY freq DESC, tags ASC) AS rank
 FROM tag_iv) WHERE rank <= 3""",
    "counter_hashtag": "SELECT tags, CAST(sum(freq) AS BIGINT) AS freq FROM tag_iv GROUP BY 1",
    "counter_bump": """
SELECT tags, CAST(sum(freq) AS BIGINT) AS freq FROM (
 SELECT tags, freq FROM tag_iv UNION ALL SELECT 'ncaa' AS tags, 2 AS freq) GROUP BY 1""",
    "retweets": "SELECT id, rt_screen_name FROM statuses WHERE rt_text IS NOT NULL",
    "retweeter_counts": _RETWEETER_COUNTS,
    "retweeter_counts_by_interval": "SELECT * FROM rt_iv",
    "ranked_retweeters": f"SELECT top_user, retweeted, rank() OVER (ORDER BY retweeted DESC) AS rank FROM ({_RETWEETER_COUNTS})",
    "counter_retweeter": "SELECT top_user, CAST(sum(retweeted) AS BIGINT) AS retweeted FROM rt_iv GROUP BY 1",
    "geo_points": """
SELECT id, CAST(longitude AS FLOAT) AS longitude, CAST(latitude AS FLOAT) AS latitude
FROM statuses WHERE latitude IS NOT NULL""",
    "track_a": "SELECT id FROM track_a",
    "track_b": "SELECT id FROM track_b",
    "word_scores": "SELECT w.id, w.pos, w.word, coalesce(l.score, 0) AS score FROM words_a w LEFT JOIN lex l USING (word)",
    "sentiment_a": "SELECT * FROM senti_a",
    "sentiment_b": "SELECT * FROM senti_b",
    "ranked_sentiment": "SELECT id, rating, rank() OVER (ORDER BY rating DESC) AS rank FROM senti_a",
    "place_rows": f"SELECT {_PLACE_ROW} FROM en",
    "user_rows": f"SELECT {_USER_ROW} FROM en",
    "status_rows": f"SELECT {_STATUS_ROW} FROM en",
    "created_at_text": f"SELECT id, {_CREATED.format(c='created_at')} AS created_at_text FROM statuses",
    "upsert_statuses": _UPSERT_STATUSES,
    "upsert_users": _UPSERT_USERS,
    "upsert_places": _UPSERT_PLACES,
    "sql_view_scan": f"""
SELECT 'tweet' AS table_name, count(*) AS n_rows, CAST(sum(id) AS BIGINT) AS checksum FROM en
UNION ALL SELECT 'distinct_user', count(DISTINCT "user"), CAST(sum("count") AS BIGINT) FROM user_iv
UNION ALL SELECT 'hashtag', count(DISTINCT tags), CAST(sum(freq) AS BIGINT) FROM tag_iv
UNION ALL SELECT 'toptweeter', count(DISTINCT top_user), CAST(sum(retweeted) AS BIGINT) FROM rt_iv
UNION ALL SELECT 'location', count(*), CAST(sum(id) AS BIGINT) FROM statuses WHERE latitude IS NOT NULL
UNION ALL SELECT 'trump_sentiment', count(*), CAST(sum(rating) AS BIGINT) FROM senti_b
UNION ALL SELECT 'russia_sentiment', count(*), CAST(sum(rating) AS BIGINT) FROM senti_a
UNION ALL SELECT 'status_hifi', count(*), CAST(sum(favorite_count) AS BIGINT) FROM ({_UPSERT_STATUSES})
UNION ALL SELECT 'user_hifi', count(*), CAST(sum(followers_count) AS BIGINT) FROM ({_UPSERT_USERS})
UNION ALL SELECT 'place_hifi', count(*), CAST(sum(length(full_name)) AS BIGINT) FROM ({_UPSERT_PLACES})""",
    "status_user_place": _STATUS_USER_PLACE,
    "bucketed_status_user_place": _STATUS_USER_PLACE,
    "heavy_hashtags": f"SELECT tags, freq FROM ({_HASHTAG_COUNTS}) WHERE freq * 20 >= (SELECT count(*) FROM tags)",
    "distinct_users_by_span": """
SELECT d AS span_start, CAST(d + INTERVAL 7 DAY AS DATE) AS span_end, count(DISTINCT user_screen_name) AS n_users, TRUE AS within_bound
FROM (SELECT DISTINCT CAST(created_at AS DATE) AS d FROM en)
JOIN en ON CAST(created_at AS DATE) >= d AND CAST(created_at AS DATE) < d + INTERVAL 7 DAY
GROUP BY 1, 2""",
    "tracks_many": """
SELECT keyword, count(*) AS n_statuses FROM us JOIN (
 SELECT DISTINCT keyword FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS keyword FROM documents)
 WHERE length(keyword) >= 4 ORDER BY md5(keyword) LIMIT 2000) ON contains(lower(text), keyword)
GROUP BY keyword""",
    "filter_report": """
SELECT 'lang' AS step, (SELECT count(*) FROM statuses) AS rows_in, (SELECT count(*) FROM en) AS kept,
 (SELECT count(*) FROM statuses) - (SELECT count(*) FROM en) AS dropped
UNION ALL SELECT 'place', count(*), count(place_id), count(*) - count(place_id) FROM en
UNION ALL SELECT 'country', count(place_id), (SELECT count(*) FROM us), count(place_id) - (SELECT count(*) FROM us) FROM en""",
    "raw_status_rows": f"SELECT {_STATUS_ROW} FROM en",
}


# The status table after a feed that delivers every third status twice.
_UPSERT_REDELIVERED = f"""
SELECT {_STATUS_ROW} FROM (
 SELECT * REPLACE (CAST(favorite_count + CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS favorite_count,
  CAST(retweet_count + CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS retweet_count) FROM en)
"""


def oracle_sql() -> dict[str, str]:
    from pulse.streaming.replay_queries import STREAM_ORACLE

    out = {k: STATUSES + v for k, v in _Q.items()}
    for stream_key, batch_key in STREAM_ORACLE.items():
        out[stream_key] = STATUSES + _UPSERT_REDELIVERED if batch_key == "upsert_redelivered" else out[batch_key]
    return out
