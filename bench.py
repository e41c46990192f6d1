"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Each query runs once to warm up, then three times; its figure is the median of whole runs,
planning and intermediate tables included.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from folio.registry import QUERIES
from folio.session import build_session, drop_work

HEADLINE = (
    "curate_books",
    "genre_top29",
    "sample_2000",
    "cover_url_extract",
    "cover_url_strict",
    "cover_probe",
    "scrape_outcomes",
    "run_progress",
    "covers_store",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "folio-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR"},
    )
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    drop_work(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
