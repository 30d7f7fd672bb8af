"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from checks.queries import QUERIES
from gleanery.session import local_session

HEADLINE = [
    "load_normalise",
    "accepted",
    "rejects",
    "field_stats",
    "cleaning_summary",
    "html_to_text",
    "numbers_detect",
    "number_mentions",
    "dictionary_build",
    "non_english_detect",
    "entity_frequency",
    "frequency_bands",
    "rare_detect",
    "sample_numbers",
    "run_report",
    "curate_cleaned",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    with tempfile.TemporaryDirectory(prefix="bench-") as dealt:
        times = run(spark, dealt_tables(spark, folder, dealt, int(cores)))
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(folder)}
        )
    )
    spark.stop()


def dealt_tables(spark, folder: str, dealt: str, cores: int) -> str:
    """The tables in as many files as a cluster would have; the given ones have one row group each, which one task reads."""
    for name in ("documents", "pages", "conversations"):
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(2 * cores).write.parquet(f"{dealt}/{name}.parquet")
    return dealt


def run(spark, folder: str) -> dict[str, float]:
    times = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - started, 3)
    return times


if __name__ == "__main__":
    main()
