"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blockloom.catalog import load, plain, query, runner  # noqa: E402
from blockloom.plans import metrics as M  # noqa: E402
from blockloom.session import local_session  # noqa: E402
from blockloom.sources.star_schema import Star  # noqa: E402

HEADLINES = [
    "metric_tx_count", "metric_fees_paid", "metric_max_tps", "metric_active_addresses", "metric_cumulative_addresses", "all_metrics_one_pass",
    "token_volume_by_week", "balance_view", "balance_top_holders", "normalize_txs", "normalize_traces", "normalize_logs", "validator_refunds",
    "subnet_fee_stats", "quality_duplicates_txs", "quality_missing_blocks", "window_running_sum", "join_sum_in_span", "stream_count_by_hour",
]


@query("all_metrics_one_pass", "M1-M21")
def all_metrics_one_pass(star: Star):
    tables = {"raw_txs": star.raw_txs(), "raw_blocks": star.raw_blocks(), "raw_traces": star.raw_traces(), "raw_logs": star.message_logs()}
    return plain(M.metric_batch(tables))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "bench")
    catalog = load()
    only = sys.argv[1:] or HEADLINES
    runner(catalog["filter_signatures"])(spark, folder).write.format("noop").mode("overwrite").save()  # start-up
    times = {}
    for name in only:
        start = time.perf_counter()
        runner(catalog[name])(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    out = {"metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}
    print(json.dumps({**out, "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
