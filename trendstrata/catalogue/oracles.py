"""Name to DuckDB SQL over the same tables, written independently of the Spark plans.

Sums become integers and rounding is spelled out in integer arithmetic, so both
sides are exact.
"""

from __future__ import annotations

from trendstrata.catalogue.queries import NOW

ORACLES: dict[str, str] = {}


def _long(text: str) -> str:
    return (
        f"try_cast(CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+([.][0-9]*)?')"
        f" THEN regexp_extract(trim({text}), '^([+-]?[0-9]+)', 1) END AS bigint)"
    )


def _flag(text: str) -> str:
    return f"CASE WHEN lower({text}) = 'true' THEN true WHEN lower({text}) = 'false' THEN false END"


def _half_up(top: str, bottom: str, scale: int) -> str:
    """Non-negative ratio rounded half-up; NULL for a zero bottom."""
    shift = 10**scale
    return (
        f"CASE WHEN {bottom} > 0 THEN (2 * CAST({top} AS hugeint) * {shift} + {bottom})"
        f" // (2 * CAST({bottom} AS hugeint)) / {shift}.0 END"
    )


def _mean_ratio(name: str) -> str:
    units = f"sum(CAST(round({name} * 10000) AS hugeint))"
    return f"((2 * {units} + count({name})) // (2 * count({name}))) / 10000.0"


def _sum(name: str, alias: str) -> str:
    return f"CAST(sum({name}) AS bigint) AS {alias}"


EVENT_RAW = """
event_raw AS (
  SELECT event_id AS seq,
    CASE WHEN event_id % 101 <> 0 THEN 'v' || user_id END AS video_id,
    CASE WHEN event_id % 53 = 1 THEN 'not-a-date'
         WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d')
         ELSE strftime(ts, '%y.%d.%m') END AS trending_date,
    CASE WHEN event_id % 23 <> 0 THEN 'title ' || event_id END AS title,
    'ch' || (user_id % 17) AS channel_title,
    CASE WHEN event_id % 37 = 0 THEN 'x' ELSE CAST(user_id % 30 AS varchar) END AS category_id,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS publish_time,
    event_type AS tags,
    CASE WHEN event_id % 11 = 0 THEN NULL
         WHEN event_id % 13 = 0 THEN '0'
         WHEN event_id % 59 = 0 THEN '12.7'
         WHEN event_id % 61 = 0 THEN 'abc'
         ELSE CAST(CAST(floor(value * 100) AS bigint) AS varchar) END AS views,
    json_extract_string(props, '$.k') AS likes,
    CAST(event_id % 3 AS varchar) AS dislikes,
    CAST(event_id % 5 AS varchar) AS comment_count,
    'img/' || event_id AS thumbnail_link,
    'False' AS comments_disabled,
    CASE WHEN event_id % 7 = 0 THEN 'True' ELSE 'False' END AS ratings_disabled,
    CASE WHEN event_id % 19 = 0 THEN 'maybe' ELSE 'False' END AS video_error_or_removed,
    props AS description,
    CASE WHEN event_id % 97 = 0 THEN ''
         WHEN event_id % 5 = 0 THEN ' ' || upper(event_type) || ' '
         ELSE event_type END AS region
  FROM events)"""

EVENT_ENFORCED = f"""
event_enforced AS (
  SELECT seq, video_id, trending_date, title, channel_title, {_long('category_id')} AS category_id,
    publish_time, tags, {_long('views')} AS views, {_long('likes')} AS likes, {_long('dislikes')} AS dislikes,
    {_long('comment_count')} AS comment_count, thumbnail_link, {_flag('comments_disabled')} AS comments_disabled,
    {_flag('ratings_disabled')} AS ratings_disabled, {_flag('video_error_or_removed')} AS video_error_or_removed,
    description, region
  FROM event_raw)"""

_DATE = r"""CASE WHEN regexp_full_match(trending_date, '\d{2}\.\d{2}\.\d{2}')
      THEN CAST(try_strptime('20' || trending_date, '%Y.%d.%m') AS date)
      ELSE try_cast(trending_date AS date) END"""

_RATIOS = """CASE WHEN views > 0 THEN round(likes / views * 100, 4) ELSE 0.0 END AS like_ratio,
    CASE WHEN views > 0 THEN round((likes + dislikes + comment_count) / views * 100, 4)
         ELSE 0.0 END AS engagement_rate"""

EVENT_TYPED = f"""
event_typed AS (
  SELECT * REPLACE (lower(trim(region)) AS region, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
      coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count),
    {_DATE} AS trending_date_parsed
  FROM event_enforced)"""

EVENT_SILVER = f"""
event_silver AS (
  SELECT * EXCLUDE (nth), {_RATIOS}
  FROM (SELECT *, row_number() OVER (
          PARTITION BY video_id, region, trending_date_parsed ORDER BY seq DESC) AS nth
        FROM event_typed WHERE video_id IS NOT NULL AND region <> '')
  WHERE nth = 1)"""

STAR_SILVER = f"""
star_raw AS (
  SELECT 'v' || l_partkey AS video_id, lower(substr(r_name, 1, 2)) AS region,
    CAST(date_trunc('month', o_orderdate) AS date) AS trending_date_parsed,
    p_name AS title, s_name AS channel_title, CAST(p_size AS bigint) AS category_id,
    CAST(floor(l_extendedprice) AS bigint) AS views, CAST(floor(l_quantity) AS bigint) AS likes,
    CAST(l_linenumber AS bigint) AS dislikes, CAST(round(l_discount * 100) AS bigint) AS comment_count,
    l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN part ON l_partkey = p_partkey),
star_silver AS (
  SELECT * EXCLUDE (nth), {_RATIOS}
  FROM (SELECT *, row_number() OVER (
          PARTITION BY video_id, region, trending_date_parsed
          ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS nth
        FROM star_raw)
  WHERE nth = 1)"""

TEXT_ROWS = """
text_docs AS (
  SELECT doc_id, lang, text, source,
    'raw/' || CASE WHEN doc_id % 3 = 0 THEN 'Region=' || upper(lang) || '/' ELSE '' END
      || lang || '_category_id_' || doc_id || '.json' AS _source_file
  FROM documents),
text_lines AS (
  SELECT doc_id, lang, source, _source_file, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS position
  FROM text_docs WHERE doc_id % 50 NOT IN (0, 1)),
text_items AS (
  SELECT * FROM text_lines
  QUALIFY row_number() OVER (PARTITION BY doc_id, length(line) % 30 ORDER BY position DESC) = 1),
text_rows AS (
  SELECT 'line' AS kind, md5(line) AS etag, CAST(length(line) % 30 AS varchar) AS id, line AS snippet_title,
    length(line) > 40 AS snippet_assignable, source AS "snippet_channelId", lang AS region, _source_file
  FROM text_items
  UNION ALL
  SELECT 'document', md5(text), NULL, NULL, NULL, NULL, lang, _source_file FROM text_docs WHERE doc_id % 50 = 1)"""

_EVENT = f"WITH {EVENT_RAW},{EVENT_ENFORCED},{EVENT_TYPED},{EVENT_SILVER}"
_STAR = f"WITH {STAR_SILVER}"
_TEXT = f"WITH {TEXT_ROWS}"

_CALENDAR = "strftime(trending_date_parsed, '%Y-%m-%d')"


# --- statistics ----------------------------------------------------------------

ORACLES["schema_enforcement"] = f"{_EVENT} SELECT * FROM event_enforced"
ORACLES["normalised_region"] = f"{_EVENT} SELECT seq, lower(trim(region)) AS region FROM event_raw"
ORACLES["parse_date"] = f"{_EVENT} SELECT seq, trending_date, {_CALENDAR} AS trending_date_parsed FROM event_typed"
ORACLES["filled_counters"] = f"{_EVENT} SELECT seq, views, likes, dislikes, comment_count FROM event_typed"
ORACLES["ratios"] = f"{_EVENT} SELECT seq, {_RATIOS} FROM event_typed"
ORACLES["valid_rows"] = f"""{_EVENT} SELECT seq, video_id, region FROM event_typed
  WHERE video_id IS NOT NULL AND region <> ''"""
ORACLES["latest_per_key"] = f"""{_EVENT}
  SELECT video_id, region, {_CALENDAR} AS trending_date_parsed, max(seq) AS seq FROM event_typed
  WHERE video_id IS NOT NULL AND region <> '' GROUP BY ALL"""
ORACLES["event_silver"] = f"""{_EVENT}
  SELECT * REPLACE ({_CALENDAR} AS trending_date_parsed), publish_time AS _processed_at, 'events' AS _job_name
  FROM event_silver"""
ORACLES["star_silver"] = f"{_STAR} SELECT * REPLACE ({_CALENDAR} AS trending_date_parsed) FROM star_silver"

_WARNINGS = """count(*) FILTER (video_id IS NULL) AS null_video_id, count(*) FILTER (title IS NULL) AS null_title,
  count(*) FILTER (channel_title IS NULL) AS null_channel_title, count(*) FILTER (views IS NULL) AS null_views,
  count(*) FILTER (views < 0) AS negative_views"""
ORACLES["stage_metrics"] = f"""{_EVENT}
  SELECT (SELECT count(*) FROM events) AS rows_read, CAST(0 AS bigint) AS rows_corrupt, count(*) AS rows_clean,
    (SELECT count(*) FROM events) - count(*) AS rows_removed, {_WARNINGS} FROM event_silver"""
ORACLES["silver_warnings"] = f"{_EVENT} SELECT {_WARNINGS} FROM event_silver"

# --- files ---------------------------------------------------------------------

_CSV_KEPT = """
raw AS (
  SELECT 'd' || (doc_id // 3) AS video_id, lang AS region,
    make_date(2024, 1, CAST(doc_id // 3 % 7 + 1 AS integer)) AS trending_date_parsed,
    'the "text", ' || doc_id AS title, source AS channel_title, n_chars % 30 AS category_id, n_chars AS views,
    n_chars % 100 AS likes, n_chars % 7 AS dislikes, n_chars % 13 AS comment_count, true AS ratings_disabled,
    md5(text) AS description_md5
  FROM documents),
kept AS (
  SELECT * FROM raw QUALIFY row_number() OVER (
    PARTITION BY video_id, region, trending_date_parsed
    ORDER BY views DESC, likes DESC, comment_count DESC, dislikes DESC, title DESC) = 1)"""
ORACLES["csv_round_trip"] = f"""
WITH {_CSV_KEPT}
SELECT * REPLACE ({_CALENDAR} AS trending_date_parsed), {_RATIOS} FROM kept"""
ORACLES["csv_rejects"] = """
SELECT lang AS region, count(*) FILTER (n_chars % 10 NOT IN (3, 7)) AS good_rows,
  count(*) FILTER (n_chars % 10 IN (3, 7)) AS rejected_rows
FROM documents GROUP BY lang"""
# The lines as they were written, of rows that lack their last column or have one more.
_FIELDS = ["'d' || (doc_id // 3)", "'24.' || lpad(CAST(doc_id // 3 % 7 + 1 AS varchar), 2, '0') || '.01'",
           "'the \"text\", ' || doc_id", "source", "n_chars % 30", "'2024-01-31 00:00:00'", "lang", "n_chars", "n_chars % 100",
           "n_chars % 7", "n_chars % 13", "'img/' || doc_id", "'False'", "'True'", "'False'"]
_QUOTED = [f"""'"' || replace(CAST({f} AS varchar), '"', '""') || '"'""" for f in [*_FIELDS, "text", "'x'"]]
_LINE = f"""CASE n_chars % 10 WHEN 3 THEN {" || ',' || ".join(_QUOTED[:15])}
  WHEN 7 THEN {" || ',' || ".join(_QUOTED)} END"""
ORACLES["rejects_table"] = f"""
SELECT lang AS region, md5({_LINE}) AS text_md5, count(*) AS rows FROM documents WHERE n_chars % 10 IN (3, 7) GROUP BY ALL"""
ORACLES["run_accounts"] = f"""
WITH read AS (
  SELECT 'd' || (doc_id // 3) AS video_id, lang AS region, {_LINE} AS text FROM documents),
good AS (SELECT DISTINCT video_id, region FROM read WHERE text IS NULL)
SELECT count(*) AS rows_read, count(text) AS rows_corrupt, (SELECT count(*) FROM good) AS rows_clean,
  count(*) - (SELECT count(*) FROM good) AS rows_removed, (SELECT count(*) FROM good) AS rows,
  count(DISTINCT region || text) AS rejects FROM read"""
ORACLES["split_round_trip"] = ORACLES["csv_round_trip"]
ORACLES["incremental_silver"] = ORACLES["csv_round_trip"]
ORACLES["path_region"] = "SELECT page_id, CAST(page_id % 7 AS varchar) AS region FROM pages"

ORACLES["decoded_key"] = "SELECT page_id, url || ' a+b=ü%' AS key FROM pages"

# --- category documents --------------------------------------------------------

ORACLES["reference_flatten"] = f"{_TEXT} SELECT * EXCLUDE (region) FROM text_rows"
ORACLES["reference_rejects"] = f"{_TEXT} SELECT _source_file FROM text_docs WHERE doc_id % 50 = 0"
ORACLES["key_region"] = f"{_TEXT} SELECT _source_file, lang AS region FROM text_docs"
ORACLES["flattened_names"] = """
SELECT conv_id, turn, role AS said_role, CAST(length(text) AS integer) AS said_text_size_chars FROM conversations"""
_NEWEST = "_source_file IN (SELECT max(_source_file) FROM text_rows GROUP BY region)"
ORACLES["newest_file"] = f"""{_TEXT}
  SELECT region, _source_file, id, snippet_title FROM text_rows WHERE {_NEWEST}"""
ORACLES["reference_silver"] = f"""{_TEXT}
  SELECT *, strftime(TIMESTAMP '{NOW}', '%Y-%m-%dT%H:%M:%S.000000+00:00') AS _ingestion_timestamp
  FROM text_rows WHERE {_NEWEST}"""
ORACLES["reference_round_trip"] = f"{_TEXT} SELECT * EXCLUDE (_source_file) FROM text_rows"
ORACLES["reference_evolution"] = """
SELECT CAST(turn AS varchar) AS id, role AS kind, text AS snippet_title,
  CASE WHEN turn = 0 THEN conv_id END AS snippet_thread FROM conversations"""
ORACLES["json_many_documents"] = """
SELECT lang AS region, CAST(doc_id AS varchar) AS id, text AS snippet_title FROM documents"""
_KEY = "'raw/' || lang || '_category_id_' || doc_id || '.json' AS _source_file"
ORACLES["json_trailing_content"] = f"""
SELECT {_KEY}, CASE WHEN doc_id % 5 > 2 THEN source END AS source,
  CASE WHEN doc_id % 5 < 3 THEN 'not a readable document' END AS error
FROM documents, range(2) AS copies(n) WHERE n = 0 OR doc_id % 5 = 3"""
ORACLES["odd_items"] = f"""
SELECT {_KEY}, CASE WHEN doc_id % 3 = 0 THEN source END AS kind,
  CASE WHEN doc_id % 3 > 0 THEN CAST(doc_id AS varchar) END AS id,
  CASE WHEN doc_id % 3 > 0 THEN CAST(n_chars AS bigint) END AS size,
  CASE WHEN doc_id % 3 = 0 THEN lang END AS items_lang,
  CASE WHEN doc_id % 3 > 0 THEN text END AS snippet_title,
  CASE WHEN doc_id % 3 > 0 AND doc_id % 2 = 1 THEN true END AS snippet_assignable FROM documents"""
ORACLES["empty_json_documents"] = f"""
SELECT {_KEY}, CASE WHEN doc_id % 4 = 2 THEN 'not a readable document'
  ELSE 'no category rows in the document' END AS error FROM documents WHERE doc_id % 4 < 3"""
ORACLES["duplicate_keys"] = f"""
SELECT {_KEY}, CAST(doc_id AS varchar) AS id, CASE WHEN doc_id % 3 > 0 THEN CAST(n_chars AS bigint) END AS size,
  text AS snippet_title FROM documents"""
ORACLES["reference_type_drift"] = """
SELECT lang AS region, CAST(doc_id AS varchar) AS id, CASE lang WHEN 'de' THEN n_chars || '.0' WHEN 'fr' THEN n_chars || '.5'
  WHEN 'en' THEN NULL ELSE 'about ' || n_chars END AS size FROM documents"""
ORACLES["one_named_file"] = "SELECT CAST(doc_id AS varchar) AS id, source AS kind, text AS snippet_title FROM documents"
ORACLES["relanded_reference"] = """
SELECT 'r' || c_nationkey AS region, CAST(c_nationkey AS varchar) AS id, 'new ' || count(*) AS snippet_title
FROM customer GROUP BY c_nationkey"""
ORACLES["stream_reference"] = """
SELECT 'r' || c_nationkey AS region, CAST(c_nationkey AS varchar) AS id,
  CASE WHEN c_nationkey % 2 = 0 THEN 'again ' ELSE 'last ' END || count(*) AS snippet_title
FROM customer GROUP BY c_nationkey"""

# --- names and gold ------------------------------------------------------------

ORACLES["text_lookup"] = f"""{_TEXT}
  SELECT CAST(id AS bigint) AS category_id, min(snippet_title) AS category_name
  FROM text_rows WHERE id IS NOT NULL GROUP BY 1"""
_NAMED = "LEFT JOIN nation ON category_id = n_nationkey"
_NAME = "coalesce(n_name, 'Unknown')"
ORACLES["category_join"] = f"""{_EVENT}
  SELECT seq, category_id, {_NAME} AS category_name FROM event_silver {_NAMED}"""
ORACLES["category_unknown"] = f"{_EVENT} SELECT seq, 'Unknown' AS category_name FROM event_silver"


def _trending(prefix: str, silver: str) -> str:
    return f"""{prefix}
  SELECT region, {_CALENDAR} AS trending_date_parsed, count(video_id) AS total_videos,
    {_sum('views', 'total_views')}, {_sum('likes', 'total_likes')}, {_sum('dislikes', 'total_dislikes')},
    {_sum('comment_count', 'total_comments')}, {_half_up('sum(views)', 'count(views)', 2)} AS avg_views_per_video,
    {_mean_ratio('like_ratio')} AS avg_like_ratio, {_mean_ratio('engagement_rate')} AS avg_engagement_rate,
    max(views) AS max_views, count(DISTINCT channel_title) AS unique_channels,
    count(DISTINCT category_id) AS unique_categories
  FROM {silver} GROUP BY region, trending_date_parsed"""


def _channel(prefix: str, silver: str) -> str:
    return f"""{prefix},
  channels AS (
    SELECT channel_title, region, count(DISTINCT video_id) AS total_videos, {_sum('views', 'total_views')},
      {_sum('likes', 'total_likes')}, {_sum('comment_count', 'total_comments')},
      {_half_up('sum(views)', 'count(views)', 2)} AS avg_views_per_video,
      {_mean_ratio('engagement_rate')} AS avg_engagement_rate, max(views) AS peak_views,
      count(trending_date_parsed) AS times_trending,
      strftime(min(trending_date_parsed), '%Y-%m-%d') AS first_trending,
      strftime(max(trending_date_parsed), '%Y-%m-%d') AS last_trending,
      string_agg(DISTINCT {_NAME}, '|' ORDER BY {_NAME}) AS categories
    FROM {silver} {_NAMED} GROUP BY channel_title, region)
  SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title) AS integer)
    AS rank_in_region FROM channels"""


def _category(prefix: str, silver: str) -> str:
    return f"""{prefix},
  categories AS (
    SELECT {_NAME} AS category_name, category_id, region, trending_date_parsed, count(video_id) AS video_count,
      {_sum('views', 'total_views')}, {_sum('likes', 'total_likes')}, {_sum('comment_count', 'total_comments')},
      {_mean_ratio('engagement_rate')} AS avg_engagement_rate, count(DISTINCT channel_title) AS unique_channels
    FROM {silver} {_NAMED} GROUP BY 1, 2, 3, 4),
  days AS (SELECT *, sum(total_views) OVER (PARTITION BY region, trending_date_parsed) AS day_views FROM categories)
  SELECT * EXCLUDE (day_views) REPLACE ({_CALENDAR} AS trending_date_parsed),
    {_half_up('total_views * 100', 'day_views', 2)} AS view_share_pct FROM days"""


ORACLES["trending_analytics"] = _trending(_EVENT, "event_silver")
ORACLES["channel_analytics"] = _channel(_EVENT, "event_silver")
ORACLES["category_analytics"] = _category(_EVENT, "event_silver")
ORACLES["star_trending"] = _trending(_STAR, "star_silver")
ORACLES["star_channel"] = _channel(_STAR, "star_silver")
ORACLES["star_category"] = _category(_STAR, "star_silver")
ORACLES["channel_rank"] = f"""{_STAR}
  SELECT region, channel_title, {_sum('views', 'total_views')}, CAST(row_number() OVER (
    PARTITION BY region ORDER BY sum(views) DESC, channel_title) AS integer) AS rank_in_region
  FROM star_silver GROUP BY region, channel_title"""
ORACLES["customer_rank"] = """
WITH titled AS (SELECT o_orderstatus AS region, CAST(o_orderkey AS varchar) AS channel_title,
  CAST(floor(o_totalprice) AS bigint) AS total_views FROM orders)
SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title) AS integer)
  AS rank_in_region FROM titled"""
ORACLES["view_share"] = f"""{_STAR},
  sums AS (SELECT category_id, region, trending_date_parsed, {_sum('views', 'total_views')}
    FROM star_silver GROUP BY ALL),
  days AS (SELECT *, sum(total_views) OVER (PARTITION BY region, trending_date_parsed) AS day_views FROM sums)
  SELECT category_id, region, {_CALENDAR} AS trending_date_parsed, total_views,
    {_half_up('total_views * 100', 'day_views', 2)} AS view_share_pct FROM days"""
ORACLES["top_days"] = f"""SELECT * FROM ({_trending(_EVENT, 'event_silver')}) WHERE region = 'click'
  ORDER BY avg_views_per_video DESC, trending_date_parsed NULLS FIRST LIMIT 10"""
ORACLES["top_channels"] = f"""{_STAR}
  SELECT channel_title, {_sum('views', 'total_views')} FROM star_silver
  GROUP BY channel_title ORDER BY total_views DESC, channel_title LIMIT 20"""
ORACLES["category_counts"] = f"""
SELECT category_name, region, count(*) AS trending_count
FROM ({_category(_EVENT, 'event_silver')}) GROUP BY category_name, region"""

ORACLES["run_to_gold"] = f"""
SELECT * REPLACE ('Unknown' AS categories)
FROM ({_channel(f"WITH {_CSV_KEPT}, rated AS (SELECT *, {_RATIOS} FROM kept)", "rated")})"""

_RATED = f"WITH {_CSV_KEPT}, rated AS (SELECT *, {_RATIOS} FROM kept)"
ORACLES["gold_increment"] = ORACLES["run_to_gold"]
ORACLES["whole_run"] = _category(_RATED, "rated")
ORACLES["aggregated_at"] = f"""{_EVENT}
SELECT region, {_CALENDAR} AS trending_date_parsed, '{NOW}' AS _aggregated_at FROM event_silver GROUP BY ALL"""
ORACLES["region_leaves_the_feed"] = f"""{_RATED}, kept_regions AS (SELECT * FROM rated WHERE region <> 'de')
SELECT 'clean_statistics' AS "table", region, count(*) AS rows FROM kept_regions GROUP BY ALL
UNION ALL SELECT 'trending_analytics', region, count(DISTINCT trending_date_parsed) FROM kept_regions GROUP BY ALL
UNION ALL SELECT 'channel_analytics', region, count(DISTINCT channel_title) FROM kept_regions GROUP BY ALL
UNION ALL SELECT 'category_analytics', region, count(DISTINCT (category_id, trending_date_parsed)) FROM kept_regions GROUP BY ALL"""
ORACLES["empty_feed"] = f"""WITH {_CSV_KEPT}
SELECT CAST(0 AS bigint) AS rows_of_nothing, CAST(0 AS bigint) AS gold_of_nothing, count(*) AS rows FROM kept"""

# --- data quality --------------------------------------------------------------


def _statistics_checks(silver: str, max_null: float) -> list[str]:
    null_rules = [
        f"""SELECT 'null_pct' AS "check", 'clean_statistics' AS "table", '{c}' AS "column",
    round_even(count(*) FILTER ({c} IS NULL) / count(*) * 100, 2) AS value, {max_null} AS threshold,
    NULL AS negative_count, NULL AS extreme_count, NULL AS missing_columns,
    count(*) FILTER ({c} IS NULL) / count(*) * 100 <= {max_null} AS passed FROM {silver}"""
        for c in ("video_id", "title", "channel_title", "views", "region")
    ]
    return [
        *null_rules,
        f"""SELECT 'row_count', 'clean_statistics', NULL, CAST(count(*) AS double), 10.0, NULL, NULL, NULL,
    count(*) >= 10 FROM {silver}""",
        "SELECT 'schema', 'clean_statistics', NULL, NULL, NULL, NULL, NULL, '', true",
        f"""SELECT 'value_range', 'clean_statistics', 'views', NULL, NULL, count(*) FILTER (views < 0),
    count(*) FILTER (views > 50000000000), NULL,
    count(*) FILTER (views < 0 OR views > 50000000000) = 0 FROM {silver}""",
    ]


def _event_checks(max_null: float) -> list[str]:
    fresh = f"""SELECT 'freshness', 'clean_statistics', NULL, NULL, NULL, NULL, NULL, NULL,
    max(publish_time) >= strftime(TIMESTAMP '{NOW}' - INTERVAL 48 HOUR, '%Y-%m-%d %H:%M:%S') FROM event_silver"""
    return [*_statistics_checks("event_silver", max_null), fresh]


_REFERENCE_CHECKS = [
    """SELECT 'row_count', 'clean_reference_data', NULL, CAST(count(*) AS double), 10.0, NULL, NULL, NULL,
    count(*) >= 10 FROM text_rows""",
    """SELECT 'null_pct', 'clean_reference_data', 'id', round_even(count(*) FILTER (id IS NULL) / count(*) * 100, 2),
    4.0, NULL, NULL, NULL, count(*) FILTER (id IS NULL) / count(*) * 100 <= 4.0 FROM text_rows""",
    """SELECT 'null_pct', 'clean_reference_data', 'region', 0.0, 4.0, NULL, NULL, NULL, true""",
    "SELECT 'schema', 'clean_reference_data', NULL, NULL, NULL, NULL, NULL, '', true",
    "SELECT 'freshness', 'clean_reference_data', NULL, NULL, NULL, NULL, NULL, NULL, true",
]
_CHECKED = f"""{_EVENT},{TEXT_ROWS},
  checked AS ({' UNION ALL '.join([*_event_checks(4.0), *_REFERENCE_CHECKS])})"""
ORACLES["dq_results"] = f"""{_CHECKED} SELECT "check", "table", "column", value, threshold,
  CAST(negative_count AS bigint) AS negative_count, CAST(extreme_count AS bigint) AS extreme_count,
  CAST(missing_columns AS varchar) AS missing_columns, passed FROM checked"""
ORACLES["dq_verdict"] = f"""{_CHECKED} SELECT bool_and(passed) AS quality_passed,
  count(*) FILTER (passed) AS checks_passed, count(*) AS checks_total FROM checked"""
ORACLES["dq_alerts"] = f"""{_CHECKED} SELECT 'run' AS run_id, "check", "table", "column", value
  FROM checked WHERE NOT passed"""
_SHARE = "count(*) FILTER ({0} IS NULL) / count(*) * 100"
_BROKEN_NULLS = " UNION ALL ".join(
    f"SELECT 'null_pct' AS \"check\", '{c}' AS \"column\", round_even({_SHARE.format(c)}, 2) AS value, NULL AS negative_count,"
    f" NULL AS extreme_count, NULL AS missing_columns, {_SHARE.format(c)} <= 1.0 AS passed FROM broken"
    for c in ("video_id", "channel_title", "views", "region")
)
ORACLES["dq_failures"] = f"""{_EVENT}, broken AS (
  SELECT * EXCLUDE (title) REPLACE (CASE seq % 10 WHEN 0 THEN -views - 1 WHEN 1 THEN views + 50000000001 ELSE views END AS views)
  FROM event_silver),
failed AS ({_BROKEN_NULLS}
  UNION ALL SELECT 'null_pct', 'title', NULL, NULL, NULL, NULL, false
  UNION ALL SELECT 'row_count', NULL, CAST(count(*) AS double), NULL, NULL, NULL, count(*) >= 1000000000 FROM broken
  UNION ALL SELECT 'schema', NULL, NULL, NULL, NULL, 'title', false
  UNION ALL SELECT 'value_range', 'views', NULL, count(*) FILTER (views < 0), count(*) FILTER (views > 50000000000), NULL,
    count(*) FILTER (views < 0 OR views > 50000000000) = 0 FROM broken
  UNION ALL SELECT 'freshness', NULL, NULL, NULL, NULL, NULL,
    max(publish_time) >= strftime(TIMESTAMP '{NOW}' + INTERVAL 8 DAY, '%Y-%m-%d %H:%M:%S') FROM broken)
SELECT "check", "column", value, CAST(negative_count AS bigint) AS negative_count, CAST(extreme_count AS bigint) AS extreme_count,
  CAST(missing_columns AS varchar) AS missing_columns, passed FROM failed"""
_STAR_CHECKS = [
    *_statistics_checks("star_silver", 5.0),
    "SELECT 'freshness', 'clean_statistics', NULL, NULL, NULL, NULL, NULL, NULL, true",
]
ORACLES["star_quality"] = f"""{_STAR}, checked AS ({' UNION ALL '.join(_STAR_CHECKS)})
  SELECT "check", "table", "column", value, CAST(negative_count AS bigint) AS negative_count,
    CAST(extreme_count AS bigint) AS extreme_count, passed FROM checked"""
ORACLES["gate_open"] = f"""
SELECT built.* FROM ({_trending(_EVENT, 'event_silver')}) AS built
WHERE (SELECT bool_and(passed) FROM ({_EVENT}, checked AS ({' UNION ALL '.join(_event_checks(5.0))})
  SELECT passed FROM checked))"""
ORACLES["gate_shut"] = f"""{_EVENT}, checked AS ({' UNION ALL '.join(_event_checks(1.0))})
  SELECT "check", "table", "column", passed FROM checked WHERE NOT passed
  UNION ALL SELECT 'read_table', 'absent', NULL, false"""

# --- tables, landing, ledger ---------------------------------------------------

ORACLES["table_round_trip"] = f"""{_EVENT}
  SELECT seq, video_id, region, {_CALENDAR} AS trending_date_parsed, views, like_ratio FROM event_silver"""
ORACLES["partition_overwrite"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
  o_orderstatus FROM orders"""
ORACLES["replace_survives_failure"] = "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders"
ORACLES["written_rows"] = "SELECT count(*) AS rows_reported, count(*) AS rows_stored FROM lineitem"
ORACLES["schema_evolution"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority, o_orderstatus
FROM orders"""
_ITEMS = "CASE WHEN doc_id % 50 IN (0, 1) THEN 0 ELSE len(string_split(text, chr(10))) END"
ORACLES["landing_envelope"] = f"""
SELECT doc_id, lang AS region, strftime(TIMESTAMP '{NOW}', '%Y-%m-%d') AS date,
  strftime(TIMESTAMP '{NOW}', '%H') AS hour, strftime(TIMESTAMP '{NOW}', '%Y%m%d_%H%M%S') AS ingestion_id,
  CAST({_ITEMS} AS bigint) AS video_count, 'test tables' AS source FROM documents"""
ORACLES["landed_documents"] = f"""
SELECT lang AS region, strftime(TIMESTAMP '{NOW}', '%Y-%m-%d') AS date, 0 AS hour, count(*) AS documents,
  CAST(sum({_ITEMS}) AS bigint) AS items FROM documents GROUP BY lang"""

_LANDED = """WITH landed AS (
    SELECT 'r' || user_id AS region, CASE WHEN value > 100 THEN 'categories' ELSE 'trending' END AS kind FROM events),
  expected AS (SELECT 'r' || c_custkey AS region FROM customer)"""
ORACLES["landing_check"] = f"""{_LANDED},
  state AS (SELECT region,
      CASE WHEN region NOT IN (SELECT region FROM landed WHERE kind = 'trending') THEN 'trending'
           WHEN region NOT IN (SELECT region FROM landed WHERE kind = 'categories') THEN 'categories'
      END AS failed_kind FROM expected)
  SELECT region, CASE WHEN failed_kind IS NULL THEN 'success' ELSE 'failed' END AS status, failed_kind FROM state"""
ORACLES["regions_missing"] = f"{_LANDED} SELECT region FROM expected WHERE region NOT IN (SELECT region FROM landed)"
ORACLES["regions_present"] = f"{_LANDED} SELECT region FROM expected WHERE region IN (SELECT region FROM landed)"
ORACLES["ledger"] = f"""{_TEXT}
  SELECT 'run' AS run_id, 'reference' AS stage, _source_file AS source, region, count(*) AS rows_written,
    'silver/region=' || region AS path, CAST(NULL AS varchar) AS error FROM text_rows GROUP BY ALL
  UNION ALL
  SELECT 'run', 'reference', _source_file, NULL, NULL, NULL, 'no category rows in the document'
  FROM text_docs WHERE doc_id % 50 = 0"""
