"""The identity of one pipeline run, decided once and passed everywhere."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone


# The forms of a run's stamp and date, and the pipeline's version.
STAMP, DATE, VERSION = "%Y%m%d_%H%M%S", "%Y-%m-%d", "v1.0"


@dataclass(frozen=True)
class RunInfo:
    """Run time, job name and pipeline version.

    Nothing in the library reads the clock, so a run that straddles midnight
    still carries one date and a repeated run gives the same rows.
    """

    started_at: datetime
    job_name: str = "medallion"
    pipeline_version: str = VERSION
    #: What tells this run from others that began in the same second; equal for a repeated run.
    identity: str = ""
    #: What a run adds to its stamp when another run has that already.
    suffix: str = ""

    def __post_init__(self) -> None:
        if self.started_at.tzinfo is None:
            raise ValueError("started_at must carry a time zone")
        object.__setattr__(self, "started_at", self.started_at.astimezone(timezone.utc))
        if not self.identity:
            object.__setattr__(self, "identity", f"{self.job_name} {self.started_at.isoformat()}")

    @classmethod
    def now(cls, **fields: str) -> RunInfo:
        """A run that begins now; no other run has its identity."""
        return cls(datetime.now(timezone.utc), **{"identity": uuid.uuid4().hex, **fields})

    @property
    def stamp(self) -> str:
        return self.started_at.strftime(STAMP) + self.suffix

    @property
    def date(self) -> str:
        return self.started_at.strftime(DATE)
