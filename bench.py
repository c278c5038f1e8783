"""Time the headline queries on one folder of tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import build_session  # noqa: E402
from tidemark.plans import QUERIES  # noqa: E402

HEADLINE = (
    "emit_on_update", "emit_on_update_stream", "emit_running", "emit_on_update_batched", "emit_periodic",
    "win_eps", "win_tumble", "expire_all", "trace_groups", "alert_batches", "join_lookup",
    "join_keyed_table", "join_two_tier", "join_full_latest", "merge_columns", "agg_basic", "agg_p90",
    "agg_latest", "agg_group_array", "keyed_upsert", "keyed_versioned", "dedup_latest", "frame_header",
    "frame_varint", "route_counts", "fanout_orders", "json_typed_rows", "json_pairs_raw", "src_log_records",
    "rename_chain", "rep_socket_p90", "rep_backpressure", "rep_leader_distribution", "rep_compression_column",
)
RATES = {
    "emit_on_update": "events", "expire_all": "events", "join_full_latest": "events",
    "keyed_upsert": "orders", "fanout_orders": "events", "emit_running": "events", "join_lookup": "lineitem",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(min(run(name) for _ in range(repeats)), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(RATES.values())}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {q: round(sizes[t] / seconds[q]) for q, t in RATES.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
