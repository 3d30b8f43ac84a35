"""Whitening of vectors by a bidiagonal qd solver.

1. One pass sums every dimension, in whole numbers.
2. Blockwise QR: every task centres its rows and reduces them block by block to one
   triangle; triangles are stacked and reduced in groups until one is left. It has the
   singular values and right singular vectors of all centred rows, so the covariance is
   never formed, which would square what rounding loses.
3. `bidiagonal.right_singular` brings the triangle to bidiagonal form, finds its singular
   values by dqds and the whitening directions by twisted factorisations.
4. A pass measures the covariance of the whitened rows, the last one writes them.

Entries are put on a grid first: floor(grid * entry) + offset as long.

* Rows whose vector is null, empty or holds null or non-finite entries are dropped, and
  so are entries that are no long on the grid. Vectors of another length than most of
  the table has are dropped too; of equally frequent lengths the longest counts.
* Null and repeated identifiers are kept as they are; repeated rows count each.
* Directions in which the rows do not vary (a singular value below RANK of the largest)
  can't be scaled to one; they have no component. A lone row has none, so no rows.
* `deviation` is null where it does not fit into a long.
* An empty table gives an empty table. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.bidiagonal import right_singular
from tierlake.llm.common import ship, stored
from tierlake.llm.vectors import matrix, usable

#: Rows that are centred and reduced together; rows of the result built at once.
TOGETHER, WRITTEN = 4096, 1 << 16
#: Bytes of triangles that meet in a task, and in the driver.
TRIANGLE_BYTES = 32 << 20
#: Singular values below this share of the largest are taken for none.
RANK = 1e-10


@dataclass(frozen=True)
class Grid:
    """How entries become whole numbers."""

    scale: float = 64.0
    offset: int = 1_000_000

    def numbers(self, entries: pa.Array, width: int) -> np.ndarray:
        """A row of whole numbers per vector."""
        return np.floor(self.scale * matrix(entries, width)).astype(np.int64) + self.offset

    @property
    def most(self) -> float:
        """Entries from here on are no long."""
        return (2.0**62 - abs(self.offset)) / self.scale


@dataclass(frozen=True)
class Whitening:
    """What was learned: the mean as sums over n rows, directions as columns, and their variances, falling."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.directions / np.sqrt(self.variances)


def scaled_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums as whole numbers, long where that is enough."""
    base = sums // n
    near, rest = x - base.astype(np.int64), (sums - n * base).astype(np.int64)
    if n * (float(np.max(np.abs(near), initial=0)) + 1) < 2.0**62:
        return near * n - rest
    return near.astype(object) * n - rest.astype(object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return scaled_deviations(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum of squares of n * x - sums by row; None beyond a long."""
    apart = scaled_deviations(x, n, sums)
    if apart.dtype != object:
        if float(np.max(np.abs(apart), initial=0)) ** 2 * max(apart.shape[1], 1) < 2.0**62:
            return (apart * apart).sum(axis=1).tolist()
        apart = apart.astype(object)
    found = (apart * apart).sum(axis=1).tolist()
    return [value if value < 1 << 63 else None for value in found]


def column_sums(rows: DataFrame, width: int, grid: Grid) -> tuple[int, np.ndarray]:
    """How many rows there are, and the sum of each dimension, exact."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, np.int64)
        for batch in batches:
            x = grid.numbers(batch.column(0), width)
            n, sums = n + len(x), sums + x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tolist()])], names=["n", "sums"])

    parts = rows.select("vector").mapInArrow(read, "n bigint, sums array<bigint>")
    totals = parts.select("n", F.posexplode("sums")).groupBy("pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(38,0)")).alias("total")
    ).orderBy("pos").collect()
    return int(totals[0]["n"]), np.array([int(row["total"]) for row in totals], object)


def reduced(rows: np.ndarray) -> np.ndarray:
    """A triangle with the same singular values and right singular vectors."""
    width = rows.shape[1]
    if len(rows) < width:
        rows = np.vstack([rows, np.zeros((width - len(rows), width))])
    return np.linalg.qr(rows, mode="r")


def triangle(rows: DataFrame, width: int, grid: Grid, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangle of all centred rows, by a tree of QR steps."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((width, width))
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                x = grid.numbers(batch.column(0).slice(start, TOGETHER), width)
                r = reduced(np.vstack([r, centred(x, n, sums)]))
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def merge(found: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [found["part"].iloc[0]], "r": [merged(found["r"])]})

    def merged(packed) -> bytes:
        r = np.zeros((width, width))
        for one in packed:
            r = reduced(np.vstack([r, np.frombuffer(one).reshape(width, width)]))
        return r.tobytes()

    at_once = max(2, TRIANGLE_BYTES // (8 * width * width))
    parts = rows.select("vector").mapInArrow(read, "r binary").withColumn("part", F.spark_partition_id())
    parts = stored(parts.select("part", "r"), "whitening-triangles")
    while parts.count() > at_once:
        parts = parts.withColumn("part", F.floor(F.col("part") / at_once).cast("int"))
        parts = stored(parts.groupBy("part").applyInPandas(merge, "part int, r binary"), "whitening-triangles")
    return np.frombuffer(merged(row["r"] for row in parts.orderBy("part").collect())).reshape(width, width)


def learn(rows: DataFrame, width: int, grid: Grid, components: int) -> Whitening:
    """The mean, and the directions of largest variance that are not empty."""
    n, sums = column_sums(rows, width, grid)
    r = triangle(rows, width, grid, n, sums)
    squares, directions = right_singular(r)
    rank = int(np.sum(squares > RANK * RANK * max(float(squares[0]), 0.0)))
    kept = min(components, rank)
    return Whitening(n, sums, directions[:, :kept], squares[:kept] / n, squares[:kept] / float(np.sum(r * r) or 1.0))


def identity_error(rows: DataFrame, width: int, grid: Grid, learned: Whitening) -> float:
    """How far the covariance of the whitened rows is from the identity, measured on all of them."""
    kept = len(learned.variances)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((kept + 1, kept))
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                w = learned.whitened(grid.numbers(batch.column(0).slice(start, TOGETHER), width))
                moments[:kept] += w.T @ w
                moments[kept] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([moments.ravel().tolist()], pa.list_(pa.float64()))], names=["moments"])

    parts = rows.select("vector").mapInArrow(read, "moments array<double>")
    sums = parts.select(F.posexplode("moments")).groupBy("pos").agg(F.sum("col").alias("total")).orderBy("pos").collect()
    moments = np.array([row["total"] for row in sums]).reshape(kept + 1, kept) / learned.n
    covariance = moments[:kept] - np.outer(moments[kept], moments[kept])
    return float(np.max(np.abs(covariance - np.eye(kept))))


def whiten(
    vectors: DataFrame, identifier: str = "vec_id", vector: str = "embedding", grid: Grid = Grid(), components: int = 32
) -> DataFrame:
    """A row per vector and component, numbered from 1 by falling variance."""
    spark = vectors.sparkSession
    ship(spark)
    rows, width = usable(vectors, identifier, vector, grid.most)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    learned = learn(rows, width, grid, components) if width else None
    if learned is None or not len(learned.variances):
        return spark.createDataFrame([], schema)
    kept = len(learned.variances)
    error = identity_error(rows, width, grid, learned)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, WRITTEN // kept)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                x, count = grid.numbers(part.column(1), width), part.num_rows
                each = pa.array(np.repeat(np.arange(count), kept))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * kept, learned.n, np.int64)),
                    pa.array(deviations(x, learned.n, learned.sums), pa.int64()).take(each),
                    pa.array(learned.whitened(x).ravel()),
                    pa.array(np.tile(learned.explained, count)),
                    pa.array(np.full(count * kept, error)),
                ], names=names)

    return rows.mapInArrow(write, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
