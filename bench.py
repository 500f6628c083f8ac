"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every query runs once to warm up and
is then timed twice; the better time counts. Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import time

from outfall.plans.catalog import QUERIES
from outfall.session import local_session

HEADLINE = [
    "rendered_fan_out",
    "join1_fan_out",
    "join1_fan_out_salted",
    "rank7_bounded_buffer",
    "agg2_egress",
    "rfc12_framed_messages",
    "src2_batch_flatten",
    "flt2_validation_chain",
    "rank1_two_workers_each",
    "rank3_stable_rebalance",
    "rank5_failed_fetch_changes_nothing",
    "rank6_worker_cap",
    "join4_snapshot_diff",
    "agg10_pulse",
    "str1_stateless_stream",
    "snk5_delivery_with_retries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "outfall-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(min(run(name), run(name)), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    messages = QUERIES["rendered_fan_out"](spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "envelopes": events,
                "messages": messages,
                "messages_per_sec": round(messages / times["rendered_fan_out"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
