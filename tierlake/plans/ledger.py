"""What a run has finished: a row per table it wrote, stored as the run goes on.

A row is a small file made when the table is whole, below the run's own folder, so rows
of one run never meet those of another. Together they are a table keyed by run, which any
later session reads: for counts, and to go on after the last finished table.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.run import RunInfo
from tierlake.sources import files

#: Layers in the order in which a run writes them.
LAYERS = ("bronze", "silver", "gold", "quality_reports")
STORED = "layer string, name string, path string, folder string, rows bigint, partition map<string,string>, schema string"


@dataclass(frozen=True)
class Entry:
    """A finished table: where it is, the folder of its version, its rows, its partition and its schema."""

    layer: str
    name: str
    path: str
    rows: int | None = None
    folder: str = ""
    partition: dict[str, str] | None = None
    schema: str = ""

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Ledger:
    """The finished tables of one run."""

    spark: SparkSession
    base: str
    stamp: str

    @classmethod
    def of(cls, spark: SparkSession, base: str, run: RunInfo) -> Ledger:
        return cls(spark, base, run.stamp)

    @property
    def path(self) -> str:
        return f"{self.base}/_runs/run={self.stamp}"

    def _file(self, layer: str, name: str) -> str:
        return f"{self.path}/{layer}.{name}.json"

    def record(self, entry: Entry) -> None:
        """Note a table as finished; one that the run made again takes the place of the earlier note."""
        path = self._file(entry.layer, entry.name)
        files.remove(self.spark, path)
        if not files.create(self.spark, path, json.dumps(asdict(entry)) + "\n"):
            raise RuntimeError(f"{path}: two runs with one stamp are at work")

    def entries(self) -> dict[tuple[str, str], Entry]:
        """The finished tables by layer and name; a note that is half written is none."""
        found = {}
        for name in files.children(self.spark, self.path):
            try:
                entry = Entry(**json.loads(files.read_text(self.spark, f"{self.path}/{name}")))
            except (ValueError, TypeError):
                continue
            found[entry.layer, entry.name] = entry
        return found

    def forget(self, first: str) -> None:
        """Take back the notes of a layer and of all that follow from it."""
        if first not in LAYERS:
            raise ValueError(f"a layer is one of {', '.join(LAYERS)}, not {first}")
        for layer, name in self.entries():
            if LAYERS.index(layer) >= LAYERS.index(first):
                files.remove(self.spark, self._file(layer, name))


def runs(spark: SparkSession, base: str) -> list[str]:
    """Stamps of all runs that finished a table here, oldest first."""
    return [name.removeprefix("run=") for name in files.children(spark, f"{base}/_runs") if name.startswith("run=")]


def stored(spark: SparkSession, base: str) -> DataFrame:
    """The ledgers of all runs as a table: run, and the columns of an entry."""
    path = f"{base}/_runs"
    if not runs(spark, base):
        return spark.createDataFrame([], f"{STORED}, run string")
    kinds = T.StructType([*T._parse_datatype_string(STORED).fields, T.StructField("run", T.StringType())])
    return spark.read.schema(kinds).option("basePath", path).json(path)


def counts(ledgers: DataFrame) -> DataFrame:
    """run, entity, and rows ingested, kept in silver and removed, as the writes of each run counted them."""
    by_entity = ledgers.where(F.col("layer").isin("bronze", "silver")).groupBy("run", F.col("name").alias("entity"))
    rows = by_entity.pivot("layer", ["bronze", "silver"]).agg(F.first("rows"))
    rows = rows.where(F.col("bronze").isNotNull()).select("run", "entity", F.col("bronze").alias("ingested"), F.col("silver").alias("kept"))
    return rows.withColumn("removed", F.col("ingested") - F.col("kept"))
