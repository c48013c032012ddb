"""Collects named queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cratedig.session import ensure_small_tasks, ensure_utc

Query = Callable[[SparkSession, str], DataFrame]

BESIDE = "(c_custkey + c_custkey % 10 * 1000000000)"  # ids of rows beside those of the base tables

# The catalog and log tables as SQL over the base tables, for the check side only.
VIEWS = {
    "artists": f"""SELECT id AS artist_id, name, CAST(id % 101 AS INT) AS popularity, genre,
        CASE WHEN id % 5 = 0 THEN TIMESTAMP '2001-08-01 23:30:00'
             WHEN id % 5 = 1 THEN TIMESTAMP '2001-08-01 12:00:00'
             ELSE TIMESTAMP '2001-07-20 00:00:00' END AS created_at FROM (
          SELECT c_custkey AS id, c_name AS name, c_mktsegment AS genre FROM customer UNION ALL
          SELECT {BESIDE}, concat(c_name, ' again'), c_mktsegment FROM customer WHERE c_custkey % 10 IN (1, 2, 3))""",
    "albums": f"""SELECT id AS album_id, artist_id, CAST(day AS DATE) AS release_date, day AS updated_at,
        CASE WHEN id % 4 = 0 THEN NULL ELSE CAST(id % 8 AS INT) END AS total_tracks FROM (
          SELECT o_orderkey AS id, o_custkey AS artist_id, o_orderdate AS day FROM orders UNION ALL
          SELECT {BESIDE}, {BESIDE}, TIMESTAMP '2001-07-01 00:00:00' FROM customer WHERE c_custkey % 10 IN (2, 3, 6))""",
    "tracks": f"""SELECT l_orderkey * 10 + l_linenumber AS track_id, l_orderkey AS album_id, MIN(p_name) AS name,
        CAST(MAX(l_quantity) AS INT) AS popularity, MAX(l_shipdate) AS updated_at
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 UNION ALL
        SELECT {BESIDE} * 10 + 1, {BESIDE}, 'beside', 7, TIMESTAMP '2001-07-02 00:00:00' FROM customer WHERE c_custkey % 10 IN (3, 4)""",
    "producers": """SELECT s_suppkey AS producer_id, s_name AS name,
        CASE WHEN s_suppkey % 20 = 0 THEN TIMESTAMP '2001-07-01 00:00:00' ELSE NULL END AS enriched_at
        FROM supplier""",
    "track_producers": f"""SELECT l_orderkey * 10 + l_linenumber AS track_id, l_suppkey AS producer_id,
        MAX(1 - l_discount) AS confidence, MIN(l_returnflag) AS source, MIN(l_shipdate) AS created_at
        FROM lineitem GROUP BY 1, 2 UNION ALL
        SELECT {BESIDE} * 10 + 1, {BESIDE}, 0.5, 'X', TIMESTAMP '2001-07-03 00:00:00' FROM customer WHERE c_custkey % 10 = 5""",
    "messages": """SELECT event_id AS msg_id, event_type AS queue_name, ts AS enqueued_at,
        CAST(event_id % 5 AS INT) AS read_ct, CASE WHEN event_id % 3 = 0 THEN ts ELSE NULL END AS vt,
        user_id, value, props AS message FROM events""",
    "work_metrics": """SELECT event_id,
        CASE WHEN event_type IN ('click', 'purchase') THEN 'queue_processing' ELSE 'api_call' END AS metric_name,
        value AS metric_value, ts, concat('q', CAST(user_id % 5 AS VARCHAR)) AS queue,
        event_type <> 'error' AS success, CAST(event_id % 20 AS INT) AS batch_size,
        CAST(event_id % 3 AS INT) AS error_count FROM events""",
    "entity_events": """SELECT event_id, concat('T', CAST(user_id % 4 AS VARCHAR)) AS entity_type,
        user_id AS entity_id, ts,
        CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'IN_PROGRESS'
          WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED' ELSE 'DEAD_LETTER' END AS state FROM events""",
    "worker_issues": """SELECT event_id, concat('worker_', CAST(user_id % 5 AS VARCHAR)) AS worker_name,
        concat('type_', CAST(event_id % 3 AS VARCHAR)) AS issue_type, props AS message,
        event_id % 2 = 0 AS resolved, ts AS created_at FROM events WHERE event_type = 'error'""",
    "entity_status": """SELECT entity_type, entity_id, arg_max(state, event_id) AS state,
        max(ts) AS last_processed_at, CAST(count(*) AS BIGINT) AS attempts FROM entity_events GROUP BY 1, 2""",
}
NEEDS = {"entity_status": ["entity_events"]}

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def with_views(sql: str, uses: str) -> str:
    names: list[str] = []
    for name in uses.split():
        for dep in [*NEEDS.get(name, []), name]:
            if dep not in names:
                names.append(dep)
    head = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.strip()
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain column types: doubles of fixed precision and zone-less timestamps."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, uses: str = "", sql: str | None = None, digits: int = 6):
    """Registers a query; ``uses`` names the derived tables its check SQL reads."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_small_tasks(ensure_utc(spark))
            return tidy(fn(spark, sf_dir), digits)

        run.__doc__ = fn.__doc__
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = with_views(sql, uses)
        return fn

    return add
