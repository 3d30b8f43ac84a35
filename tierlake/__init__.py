"""Layered (bronze, silver, gold) lakes with declarative data quality, on Spark."""

from tierlake.run import RunInfo
from tierlake.sources.entities import EntitySpec

__all__ = ["EntitySpec", "RunInfo"]
