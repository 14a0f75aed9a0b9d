"""Time the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default the sf0.1 tables) on local[BENCH_CPUS]. The feeds are
first derived from the tables and landed as Parquet, which is timed on its own
(``land_feeds``), and so is the building of the stored facts (``build_facts``) and of the
tiers made of them (``build_tiers``), which the series and checks read. Every query then runs over its whole input, and all its
rows are produced into a sink that discards them. ``mart_lmps`` and ``mart_load`` build
the facts anew.
"""

from __future__ import annotations

import json
import os
import re
import time

from acceptance.feeds import DERIVED, landed
from acceptance.queries import all_queries, stored_fact, stored_tiers
from gridmarts.session import local_session

HEADLINE = [
    "stg_da",
    "stg_forecast_latest",
    "dim_pnode",
    "dim_calendar",
    "mart_lmps",
    "mart_load",
    "lmp_daily",
    "load_daily",
    "tier_recent_rt",
    "tier_half_year",
    "lmp_series_intraday",
    "lmp_series_hourly",
    "lmp_series_daily",
    "load_series_daily",
    "price_duration_curve",
    "upsert_lmps",
    "dq_unique",
    "normalise_csv_flat",
    "unwrap_pages",
    "stream_upsert",
]


def run(spark, name: str, sf_dir: str) -> float:
    began = time.time()
    all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, partitions=8, memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    began = time.time()
    for feed in DERIVED:
        landed(spark, sf_dir, feed)
    seconds = {"land_feeds": round(time.time() - began, 3)}
    began = time.time()
    for fact in ("mart_lmps", "mart_load"):
        stored_fact(spark, sf_dir, fact)
    seconds["build_facts"] = round(time.time() - began, 3)
    began = time.time()
    stored_tiers(spark, sf_dir)
    seconds["build_tiers"] = round(time.time() - began, 3)
    seconds |= {name: round(run(spark, name, sf_dir), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
