"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
cores (default 8), BENCH_RUNS the timed runs per query (default 3, median).
Every query runs once before it is timed. With BENCH_SQL=1 the line also holds
the seconds the same SQL takes in the in-process checking database.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from glob import glob
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierlake.queries import ORACLES, QUERIES  # noqa: E402
from tierlake.session import local_session  # noqa: E402

HEADLINE = [
    "gold_user_profile", "gold_city_analysis", "gold_global_kpis",
    "silver_users", "silver_posts_text", "silver_todos_status",
    "dedup_keep_first", "record_hash", "title_case", "word_count",
    "dq_suite_users", "dq_suite_posts", "dq_suite_profile", "dq_referential", "dq_unique", "dq_summary",
    "bronze_partition_roundtrip", "raw_to_processed",
]


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="tierlake-bench")

    def consume(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timed = {}
    for name in names:
        consume(name)
        timed[name] = round(statistics.median(seconds(lambda: consume(name)) for _ in range(runs)), 3)
    line = {
        "metric": "total_seconds", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if os.environ.get("BENCH_SQL"):
        line["sql"] = sql_seconds(sf_dir, names, runs)
    print(json.dumps(line), flush=True)
    spark.stop()


def sql_seconds(sf_dir: str, names: list[str], runs: int) -> dict[str, float]:
    import duckdb

    database = duckdb.connect()
    database.execute(f"SET threads = {int(os.environ.get('BENCH_CPUS', '8'))}")
    for path in glob(f"{sf_dir}/*.parquet"):
        database.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")

    def consume(name: str) -> None:
        database.execute(ORACLES[name]).to_arrow_table()

    return {
        name: round(statistics.median(seconds(lambda: consume(name)) for _ in range(runs)), 3)
        for name in names
    }


if __name__ == "__main__":
    main()
