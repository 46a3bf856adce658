"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8): a warm-up pass over all queries, then
``$BENCH_REPEATS`` (default 5) interleaved timed rounds; each query reports
its median.  A run executes the whole plan into
Spark's ``noop`` sink, so nothing is collected to the driver.  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagweave.plans import registry  # noqa: E402
from tagweave.session import get_session  # noqa: E402

HEADLINE = [
    "wide_pivot",            # flagship: all tags -> wide table (single-shuffle pivot)
    "wide_pivot_preagg",     # same result, with the optional (uid, tag, value) pre-aggregation
    "wide_map",              # same result, map form used for many-tag catalogs
    "tag_rule_case",         # value mapping as CASE
    "tag_rule_join",         # value mapping as broadcast join
    "tag_multi_value",       # multi-valued tag collected per user
    "bitmap_build",          # unpivot + bitmap aggregate
    "bitmap_cardinality",    # audience sizes from bitmaps
    "audience_and",          # AND of two tag values, decoded to uids
    "export_sorted",         # range-partitioned, sorted serving copy
    "tag_write_partition",   # the daily path: tag days written and replaced
    "wide_write",            # all tag days, then the stored wide table
    "bitmap_write_partition",  # stored bitmaps of the day, one table a value type
    "wide_heavy_users",      # the stored day merged with its busiest users in pieces
    "audience_window",       # bitmaps of four stored days, three of them united
    "tag_backfill",          # five days of a tag replaced by one job
    "ml_end_to_end",         # encode, split, fit 4-stage pipeline, predict, label back
]


def _run(spark, key: str, sf: str) -> float:
    t0 = time.perf_counter()
    df = registry.QUERIES[key](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    keys = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app_name="tagweave-bench",
                        shuffle_partitions=int(cpus) * 2,
                        extra_conf={"spark.driver.memory": "16g"})
    for key in keys:  # warm-up pass over every query (JIT, file metadata)
        _run(spark, key, sf)
    times: dict[str, list[float]] = {key: [] for key in keys}
    for r in range(repeats):  # interleaved rounds, rotated so no query owns a fixed slot
        for key in keys[r % len(keys):] + keys[:r % len(keys)]:
            times[key].append(_run(spark, key, sf))
    results = {key: round(statistics.median(ts), 3) for key, ts in times.items()}
    sf_name = os.path.basename(sf.rstrip("/"))
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf_name.replace("sf", "") if sf_name.startswith("sf") else sf_name,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
