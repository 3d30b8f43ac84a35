"""``python -m tierlake RAW OUT``: landed JSON to a processed lake."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from tierlake.plans import medallion
from tierlake.run import RunInfo
from tierlake.sources.entities import landed


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tierlake", description=__doc__)
    parser.add_argument("raw", help="folder with one folder of JSON files per entity")
    parser.add_argument("out", help="base folder of the lake")
    parser.add_argument("--job-name", default="medallion")
    parser.add_argument("--arrays", action="store_true", help="the files hold JSON arrays that span lines")
    chosen = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(chosen.job_name).getOrCreate()
    specs = landed(chosen.raw, multi_line=chosen.arrays)
    lake = medallion.run(spark, chosen.raw, chosen.out, RunInfo.now(job_name=chosen.job_name), specs)
    lake.summary().show(truncate=False)
    lake.kpis().show(truncate=False)


if __name__ == "__main__":
    main()
