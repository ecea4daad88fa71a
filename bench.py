"""Headline benchmark: prints one JSON line.

``BENCH_SF_DIR`` is the folder of test tables, ``BENCH_CPUS`` the local cores. Each query runs once to
warm up and then three times; its median counts. ``BENCH_ALL=1`` measures every acceptance query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from acceptance.catalog import QUERIES  # noqa: E402
from dwellrank.session import build_session  # noqa: E402

HEADLINES = (
    "mart_stay_score",
    "score_minmax_inverted",
    "score_composite",
    "score_log1p",
    "events_score",
    "agg_size_by_category",
    "agg_count_two_keys",
    "agg_median_by_group",
    "agg_median_exact",
    "join_inner_broadcast",
    "join_left",
    "join_left_chain_using",
    "join_lookup_broadcast",
    "group_total_attach",
    "spatial_within",
    "spatial_within_shuffled",
    "win_rank_distributed",
    "win_row_number_distributed",
    "nested_feed_explode",
    "punctuality_snapshot",
    "punctuality_by_group",
    "json_flatten_events",
    "src_csv_gz_multiline",
    "job_clean_listings",
    "geo_area",
    "stream_snapshot",
    "stream_tumbling",
)


def measure(spark, folder: str, name: str, runs: int = 3) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return statistics.median(times[1:])


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else list(HEADLINES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: round(measure(spark, folder, name), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
