"""Claims: who may change a path of the lake just now.

A claim is a small file made by exclusive create, next to no data. Whoever finds it
taken waits. A claim that outlived its run (the driver died) is taken over once it is
older than any publish takes; whoever takes it over first mends what was left.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

from tierlake.run import RunInfo
from tierlake.sources import files

log = logging.getLogger(__name__)

#: Seconds to wait for a claim, between two looks at it, and until it counts as abandoned.
PATIENCE, LOOK, ABANDONED = 600.0, 0.2, 3600.0
#: Seconds until a small file that is being made has its content.
WRITTEN = 5.0


class ClaimedError(RuntimeError):
    """Another run has the claim."""


@dataclass(frozen=True)
class Claim:
    spark: SparkSession
    path: str
    owner: str

    def held(self) -> bool:
        """Whether the claim is still this one's: a run that slept too long may have lost it."""
        return _owner(self.spark, self.path) == self.owner

    def check(self) -> None:
        if not self.held():
            raise ClaimedError(f"{self.path} was taken over by another run")


def _owner(spark: SparkSession, path: str) -> str:
    try:
        return json.loads(files.read_text(spark, path))["owner"]
    except (ValueError, KeyError):
        return ""


@contextmanager
def claimed(spark: SparkSession, path: str, mend: Callable[[], None] = lambda: None) -> Iterator[Claim]:
    """Hold the claim inside the block; `mend` runs first, as an earlier holder may have died in the middle."""
    claim = Claim(spark, path, uuid.uuid4().hex)
    content = json.dumps({"owner": claim.owner, "application": spark.sparkContext.applicationId})
    until = time.monotonic() + PATIENCE
    while not files.create(spark, path, content):
        found = _owner(spark, path)
        if files.age(spark, path) > ABANDONED:
            _take_away(spark, path, found, claim.owner)
        elif time.monotonic() > until:
            raise ClaimedError(f"{path} is held by another run")
        else:
            time.sleep(LOOK)
    try:
        mend()
        yield claim
    finally:
        if claim.held():
            files.remove(spark, path)


def _take_away(spark: SparkSession, path: str, expected: str, owner: str) -> None:
    """Move an abandoned claim out of the way; one that was renewed meanwhile goes back."""
    aside = f"{path}.abandoned-{owner}"
    try:
        files.move(spark, path, aside)
    except OSError:
        return
    if _owner(spark, aside) != expected:
        files.move(spark, aside, path)
        return
    log.warning("%s: taken over from a run that left it", path)
    files.remove(spark, aside)


def stamped(spark: SparkSession, folder: str, run: RunInfo) -> RunInfo:
    """The run with a stamp that no other run has in this folder: its own, or the next free one.

    A stamp is claimed for good by a small file that holds the run's identity, so a
    repeated run finds its stamp again.
    """
    for number in range(10_000):
        tried = replace(run, suffix=f"_{number:02d}" if number else "")
        path = f"{folder}/{tried.stamp}"
        if files.create(spark, path, run.identity):
            return tried
        until = time.monotonic() + WRITTEN
        while not (known := files.read_text(spark, path)) and time.monotonic() < until:
            time.sleep(LOOK)
        if known == run.identity:
            return tried
    raise ClaimedError(f"{folder} has no free stamp for {run.stamp}")
