"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from finloom.catalog import QUERIES
from finloom.session import build_session

HEADLINE = (
    "earnings_digest_rows",
    "news_window",
    "events_today_pre",
    "events_digest_lines",
    "digest_text",
    "mail_text",
    "fanout_groups",
    "insert_if_absent",
    "replace_by_keys",
    "update_join",
    "upsert_latest",
    "dim_upsert_first_wins",
    "fact_key_resolve",
    "fact_change_merge",
    "latest_per_partition",
    "star_earnings",
    "parse_value_cells",
    "event_unit_rule",
    "tz_shift",
    "page_body_text",
    "page_fields",
    "event_rows",
    "earning_rows",
    "article_rows",
    "partition_window_scan",
    "nested_flat_roundtrip",
    "swap_publish",
    "stream_ingest",
    "stream_revision",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["load_count"](spark, sf_dir).collect()  # starts the session's threads and file listing
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
