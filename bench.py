"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cratedig import session  # noqa: E402
from cratedig.plans.catalogue import QUERIES  # noqa: E402

HEADLINE = [
    "producer_popularity",
    "producer_collaborations",
    "search_producers",
    "artist_stats",
    "artist_progress",
    "catalog_chain_left",
    "find_stalled_artists",
    "catalog_status_summary",
    "representative_track",
    "rollup_hourly",
    "api_metrics_hourly",
    "queue_summary",
    "failure_streaks",
    "rate_audit_sliding",
    "state_transition_audit",
    "latest_entity_state",
    "system_health",
    "active_queue_monitoring",
    "dedup_db_fallback",
    "dedup_ttl",
    "extract_producers_text",
    "validate_spotify_artist",
    "link_track_producers",
    "upsert_tracks",
    "process_track_batch",
    "stage_chain",
    "stream_stage",
    "stream_rollup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start the executors
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
