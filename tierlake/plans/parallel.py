"""Independent writes side by side, so a small table does not idle a cluster."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

#: A driver thread only waits for Spark; more of them than jobs that fit a cluster gain nothing.
MOST_AT_ONCE = 16


def side_by_side(spark: SparkSession, steps: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run the steps on a few threads; all finish before any error is raised."""
    with ThreadPoolExecutor(min(max(len(steps), 1), MOST_AT_ONCE)) as pool:
        inherit = inheritable_thread_target(spark)
        running = {name: pool.submit(inherit(step)) for name, step in steps.items()}
    return {name: step.result() for name, step in running.items()}
