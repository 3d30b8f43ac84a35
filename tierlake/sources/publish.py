"""Putting a finished folder in the place of another one, so that no run loses a day.

Runs that publish to one target take turns by a claim. By `rename` the old folder is
moved aside, next to the claim and never below a staging folder, the new one is moved
in, and only then is the old one deleted; a refused move puts the old one back. Where a
rename would copy, the checked folder is written again (`rewrite`), and it is kept, with
a note beside the claim, until that is done. Whatever a dead driver left is mended by the
next run of that target, before it does anything else.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tierlake.sources import files
from tierlake.sources.claims import Claim, claimed

log = logging.getLogger(__name__)

#: Write the folder `staged` again at the target.
Rewrite = Callable[[str], None]


@dataclass(frozen=True)
class Place:
    """A target folder and the paths beside its claim, all below the lake's base."""

    spark: SparkSession
    target: str
    claim: str

    @property
    def replaced(self) -> str:
        return f"{self.claim}.replaced"

    @property
    def pending(self) -> str:
        return f"{self.claim}.pending"

    def unfinished(self) -> bool:
        return any(files.exists(self.spark, path) for path in (self.replaced, self.pending))

    def mend(self, rewrite: Rewrite) -> None:
        """Finish or undo what a run that died has begun; the claim must be held."""
        spark = self.spark
        if files.exists(spark, self.replaced):
            if files.exists(spark, self.target):
                files.remove(spark, self.replaced)
            else:
                log.warning("%s: put back as it was before an interrupted publish", self.target)
                files.move(spark, self.replaced, self.target)
        if files.exists(spark, self.pending):
            staged = json.loads(files.read_text(spark, self.pending) or "{}").get("staged", "")
            if staged and files.exists(spark, staged):
                log.warning("%s: written again after an interrupted publish", self.target)
                rewrite(staged)
                files.remove(spark, staged)
            files.remove(spark, self.pending)

    def recover(self, rewrite: Rewrite) -> None:
        """Mend the target if a run left it unfinished."""
        if self.unfinished():
            with claimed(self.spark, self.claim, lambda: self.mend(rewrite)):
                pass

    def publish_by_rename(self, staged: str, rewrite: Rewrite) -> None:
        """Move the staged folder to the target."""
        with claimed(self.spark, self.claim, lambda: self.mend(rewrite)) as claim:
            self._swap(staged, claim)

    def _swap(self, staged: str, claim: Claim) -> None:
        spark = self.spark
        moved = files.exists(spark, self.target)
        if moved:
            files.move(spark, self.target, self.replaced)
        try:
            claim.check()
            files.move(spark, staged, self.target)
            self._check_not_nested(staged)
        except BaseException:
            if moved and not files.exists(spark, self.target):
                files.move(spark, self.replaced, self.target)
            raise
        files.remove(spark, self.replaced)

    def _check_not_nested(self, staged: str) -> None:
        """A folder that another writer made at the target meanwhile takes the moved one into itself."""
        inside = f"{self.target}/{staged.rstrip('/').rsplit('/', 1)[-1]}"
        if files.exists(self.spark, inside):
            files.move(self.spark, inside, f"{self.claim}.refused")
            files.remove(self.spark, f"{self.claim}.refused")
            raise OSError(f"{self.target} was written by something that holds no claim; its data is left as it is")

    def publish_by_rewrite(self, staged: str, rewrite: Rewrite) -> None:
        """Write the staged folder again at the target; the note says from where until that is done."""
        with claimed(self.spark, self.claim, lambda: self.mend(rewrite)) as claim:
            files.create(self.spark, self.pending, json.dumps({"staged": staged}))
            claim.check()
            rewrite(staged)
            files.remove(self.spark, self.pending)
