"""DuckDB SQL for each query in :mod:`querytrail.plans.catalog`.

Same tables, same column names and types; written independently of the
Spark code so the two can disagree.  ``events.ts`` is microseconds while
the wire format carries whole seconds, hence ``date_trunc('second', ts)``.
"""

from __future__ import annotations

# The EVENT wire mapping of ``events`` in SQL (FIXTURES §2).
_WIRE = """
    SELECT CAST(user_id AS INTEGER) AS user_id,
           event_type AS search,
           'NATION_' || CAST(user_id % 25 AS VARCHAR) AS region,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
           date_trunc('second', ts) AS timestamp_dt
    FROM events
"""

_LOG = """
    SELECT p_name AS search,
           CAST(1704067200000 + p_partkey * 1000 AS BIGINT) AS timestamp,
           p_brand AS region
    FROM part
"""

_WINDOWS = f"""
    SELECT time_bucket(INTERVAL '30 minutes', timestamp_dt) AS start_time,
           time_bucket(INTERVAL '30 minutes', timestamp_dt) + INTERVAL '30 minutes' AS end_time,
           search,
           count(*) AS count
    FROM ({_WIRE}) w
    WHERE timestamp_dt IS NOT NULL
    GROUP BY 1, 2, 3
"""


def _top(source: str, key: str, k: int = 10) -> str:
    return f"""
    SELECT {key}, count(*) AS count FROM ({source}) s
    GROUP BY {key}
    ORDER BY count DESC, {key} ASC NULLS FIRST
    LIMIT {k}
"""


_PIVOT_TERMS = ("click", "error", "purchase", "signup", "view")

SQL: dict[str, str] = {
    "decode_events": _WIRE,
    "replace_event_time": """
    SELECT CAST(user_id AS INTEGER) AS user_id,
           event_type AS search,
           'NATION_' || CAST(user_id % 25 AS VARCHAR) AS region,
           date_trunc('second', ts) AS timestamp
    FROM events
""",
    "decode_logs": f"""
    SELECT search, timestamp, region,
           make_timestamp(timestamp * 1000) AS timestamp_dt
    FROM ({_LOG}) l
""",
    "encode_events": """
    SELECT '{"user_id":' || CAST(user_id AS VARCHAR)
        || ',"search":"' || event_type
        || '","region":"NATION_' || CAST(user_id % 25 AS VARCHAR)
        || '","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS message
    FROM events
""",
    "count_events": "SELECT count(*) AS count FROM events",
    "top_regions": _top(_WIRE, "region"),
    "top_searches": _top(_WIRE, "search"),
    "top_users": _top(_WIRE, "user_id"),
    "top_log_searches": _top(_LOG, "search"),
    "top_log_regions": _top(_LOG, "region"),
    "top_log_overview": f"""
    SELECT dimension, value, count, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY dimension
                                          ORDER BY count DESC, value ASC NULLS FIRST) AS INTEGER) AS rank
        FROM (
            SELECT 'region' AS dimension, region AS value, count(*) AS count FROM ({_LOG}) a GROUP BY region
            UNION ALL
            SELECT 'search' AS dimension, search AS value, count(*) AS count FROM ({_LOG}) b GROUP BY search
        ) u
    ) r WHERE rank <= 10
""",
    "user_term_counts": f"""
    SELECT user_id, search, count(*) AS count FROM ({_WIRE}) w GROUP BY user_id, search
""",
    "user_pivot": "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (WHERE search = '{t}') AS \"{t}\"" for t in _PIVOT_TERMS)
    + f" FROM ({_WIRE}) w GROUP BY user_id",
    "trending_30min": _WINDOWS,
    "trending_topk": f"""
    SELECT start_time, end_time, search, count, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY start_time, end_time
                                          ORDER BY count DESC, search ASC NULLS FIRST) AS INTEGER) AS rank
        FROM ({_WINDOWS}) c
    ) r WHERE rank <= 3
""",
    "hourly_counts": f"""
    SELECT CAST(extract(hour FROM timestamp_dt) AS INTEGER) AS hour, count(*) AS count
    FROM ({_WIRE}) w GROUP BY 1
""",
    "user_top_terms": f"""
    SELECT user_id, search, count, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY user_id
                                          ORDER BY count DESC, search ASC NULLS FIRST) AS INTEGER) AS rank
        FROM (SELECT user_id, search, count(*) AS count FROM ({_WIRE}) w GROUP BY 1, 2) c
    ) r WHERE rank <= 3
""",
    "keyword_events": f"""
    SELECT user_id, search, region, timestamp, timestamp_dt
    FROM ({_WIRE}) w WHERE contains(lower(search), lower('SiGn'))
""",
    "keyword_documents": """
    SELECT doc_id, lang, source, n_chars, text FROM documents
    WHERE contains(lower(text), lower('Über')) OR contains(lower(text), lower('été'))
""",
    "job_top_searches": f"""
    SELECT 'top_10_sehirler' AS output, value, count FROM (
        SELECT region AS value, count(*) AS count FROM ({_LOG}) a
        GROUP BY region ORDER BY count DESC, value ASC NULLS FIRST LIMIT 10) r
    UNION ALL
    SELECT 'top_10_aramalar' AS output, value, count FROM (
        SELECT search AS value, count(*) AS count FROM ({_LOG}) b
        GROUP BY search ORDER BY count DESC, value ASC NULLS FIRST LIMIT 10) s
""",
    "job_user_pivot": "SELECT COALESCE(user_id, 0) AS user_id, "
    + ", ".join(f"count(*) FILTER (WHERE search = '{t}') AS \"{t}\"" for t in _PIVOT_TERMS)
    + f" FROM ({_WIRE}) w GROUP BY user_id",
    "job_user_terms": f"""
    SELECT user_id, search, count(*) AS count FROM ({_WIRE}) w GROUP BY user_id, search
""",
    "job_trending": _WINDOWS,
    "stream_keyword": f"""
    SELECT user_id, search, region, timestamp, timestamp_dt
    FROM ({_WIRE}) w WHERE contains(lower(search), lower('SiGn'))
""",
    "job_keyword_stream": f"""
    SELECT user_id, search, region, timestamp, timestamp_dt
    FROM ({_WIRE}) w WHERE contains(lower(search), lower('SiGn'))
""",
    "append_table": f"""
    SELECT user_id, search, region, timestamp, timestamp_dt
    FROM ({_WIRE}) w WHERE contains(lower(search), lower('SiGn'))
""",
    "stream_decode": _WIRE,
    "live_trending": _WINDOWS,
    "live_trending_update": _WINDOWS,
    "stream_user_pivot": "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (WHERE search = '{t}') AS \"{t}\"" for t in _PIVOT_TERMS)
    + f" FROM ({_WIRE}) w GROUP BY user_id",
    "replace_table": f"""
    SELECT user_id, search, region, timestamp, timestamp_dt
    FROM ({_WIRE}) w WHERE contains(lower(search), lower('SiGn'))
""",
    "append_replayed": f"""
    SELECT user_id, search, region, timestamp, timestamp_dt
    FROM ({_WIRE}) w WHERE contains(lower(search), lower('SiGn'))
""",
    "job_top_searches_incremental": f"""
    SELECT 'top_10_sehirler' AS output, value, count FROM (
        SELECT region AS value, count(*) AS count FROM ({_LOG}) a
        GROUP BY region ORDER BY count DESC, value ASC NULLS FIRST LIMIT 10) r
    UNION ALL
    SELECT 'top_10_aramalar' AS output, value, count FROM (
        SELECT search AS value, count(*) AS count FROM ({_LOG}) b
        GROUP BY search ORDER BY count DESC, value ASC NULLS FIRST LIMIT 10) s
""",
    "job_user_pivot_incremental": "SELECT user_id, "
    + ", ".join(f"count(*) FILTER (WHERE search = '{t}') AS \"{t}\"" for t in _PIVOT_TERMS)
    + f" FROM ({_WIRE}) w GROUP BY user_id",
    "job_user_terms_incremental": f"""
    SELECT user_id, search, count(*) AS count FROM ({_WIRE}) w GROUP BY user_id, search
""",
    "job_trending_incremental": _WINDOWS,
    "live_topk": f"""
    SELECT start_time, end_time, search, count, rank FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY start_time, end_time
                                          ORDER BY count DESC, search ASC NULLS FIRST) AS INTEGER) AS rank
        FROM ({_WINDOWS}) c
    ) r WHERE rank <= 3
""",
    "stream_deduplicated": """
    SELECT CAST(user_id AS INTEGER) AS user_id, event_type AS search,
           'NATION_' || CAST(user_id % 25 AS VARCHAR) AS region,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, event_id,
           date_trunc('second', ts) AS timestamp_dt
    FROM events
""",
    "trending_daily_sketch": f"""
    SELECT start_time, start_time + INTERVAL '1 day' AS end_time, search, count, largest_error, rank FROM (
        SELECT *, CAST(0 AS BIGINT) AS largest_error,
               CAST(row_number() OVER (PARTITION BY start_time ORDER BY count DESC, search ASC NULLS FIRST) AS INTEGER) AS rank
        FROM (SELECT date_trunc('day', timestamp_dt)::TIMESTAMP AS start_time, search, count(*) AS count
              FROM ({_WIRE}) w WHERE timestamp_dt IS NOT NULL GROUP BY 1, 2) c
    ) r WHERE rank <= 3
""",
    "quarantine": f"""
    SELECT outcome, search, count(*) AS count FROM (
        SELECT CASE user_id % 7 WHEN 0 THEN 'not json' WHEN 1 THEN 'not an object' WHEN 2 THEN 'bad fields' ELSE 'good' END AS outcome,
               CASE WHEN user_id % 7 > 2 THEN search END AS search
        FROM ({_WIRE}) w
    ) o GROUP BY outcome, search
""",
}
