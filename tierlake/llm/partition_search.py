"""Nearest neighbours by inner product over learned partitions.

Fitting takes a bounded sample, the FIT distinct vectors of least hash: its neighbour
graph is cut into balanced parts, and a small classifier learns the parts of a vector's
neighbours. Every vector of the table is indexed in its likeliest part. A query goes to
its several likeliest parts, where all vectors are compared with it.

How many parts a query visits is measured: CHECKED further vectors are compared with
the whole table in blocks, and the least number of parts that hold the wanted share of
their true neighbours is taken. On data without neighbourhoods that may be most parts.
Each query visits more if those parts hold fewer vectors than it asks for.

Equal vectors are indexed once, with the least identifiers that any query can need, so a
vector that a third of all rows have costs no more than another. Parts are dealt out in
blocks of vectors and of queries, so no task holds a part. Scores that decide are summed
entry by entry in double precision: equal vectors have equal scores.

* Vectors that are null, zero, or hold null or non-finite entries (or such of LARGEST or
  more, whose products could overflow), or are of another length than most, take no
  part. Neither do rows without an identifier: no result could name them.
* Rows of the query's identifier are its own. Rows equal in identifier and vector count
  once; an identifier with several vectors is a query for each, ranked on its own.
* With fewer candidates than asked for, all are returned. An empty table gives an empty
  table. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import ship, stored
from tierlake.llm.neighbour_graph import Classifier, learned_parts
from tierlake.llm.vectors import matrix, usable

#: Distinct vectors that the partition is learned from, and those it is checked with.
FIT, CHECKED = 16_384, 256
#: Most parts, and least vectors of the sample in each.
PARTS, LEAST_IN_PART = 32, 64
#: Vectors, and queries, of a block.
TOGETHER = 2048
LARGEST = 1e150


@dataclass(frozen=True)
class Index:
    """The classifier, how many vectors each part has, and how many parts a query visits."""

    classifier: Classifier
    sizes: np.ndarray
    probes: int
    recall: float

    def routes(self, x: np.ndarray, least: int) -> list[np.ndarray]:
        """The parts that each query visits, likeliest first; together they hold `least` vectors if all do."""
        order = np.argsort(-self.classifier.scores(x), axis=1, kind="stable")
        held = np.cumsum(self.sizes[order], axis=1)
        enough = np.argmax(held >= min(least, int(self.sizes.sum())), axis=1) + 1
        return [row[: max(n, self.probes)] for row, n in zip(order, enough.tolist(), strict=True)]


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """key, vector and ids: the vectors, each with its least identifiers."""
    # Spark keeps the first rows of a vector in each task before it brings them together.
    order = Window.partitionBy("vector").orderBy("vec_id")
    least = rows.dropDuplicates(["vec_id", "vector"]).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= ids)
    grouped = least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return stored(grouped.select(F.xxhash64("vector").alias("key"), "vector", "ids"), "search-vectors")


def sampled(points: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors to learn from and those to check with."""
    rows = points.orderBy("key", "vector").limit(FIT + CHECKED).select("vector").toArrow().column(0).combine_chunks()
    x = matrix(rows, width)
    checked = min(CHECKED, len(x) // 4)
    return x[checked:], x[:checked]


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of the rows, summed from the first entry to the last."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def visited(points: DataFrame, width: int, classifier: Classifier, checked: np.ndarray, nearest: int, recall: float) -> tuple[int, float]:
    """The least number of parts that hold the share `recall` of the checked vectors' neighbours, and the share they hold."""
    parts = len(classifier.second_bias)
    if not len(checked) or parts == 1:
        return parts, 1.0
    order = np.argsort(-classifier.scores(checked), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    shared = points.sparkSession.sparkContext.broadcast((classifier, checked, place))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, wanted, places = shared.value
        scores, found = np.full((len(wanted), 0), 0.0), np.full((len(wanted), 0), 0)
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                x = matrix(batch.column(0).slice(start, TOGETHER), width)
                own = wanted @ x.T
                # A vector is no neighbour of itself.
                for k, j in zip(*np.nonzero(own >= np.sum(wanted * wanted, axis=1)[:, None] * (1 - 1e-9)), strict=True):
                    if np.array_equal(wanted[k], x[j]):
                        own[k, j] = -np.inf
                scores = np.hstack([scores, own])
                found = np.hstack([found, places[:, np.argmax(model.scores(x), axis=1)]])
                if scores.shape[1] > nearest:
                    kept = np.argpartition(-scores, nearest - 1, axis=1)[:, :nearest]
                    scores, found = np.take_along_axis(scores, kept, 1), np.take_along_axis(found, kept, 1)
        real = np.isfinite(scores)
        query = np.broadcast_to(np.arange(len(wanted))[:, None], scores.shape)
        columns = [pa.array(query[real]), pa.array(scores[real]), pa.array(found[real])]
        yield pa.RecordBatch.from_arrays(columns, names=["query", "score", "place"])

    near = points.select("vector").mapInArrow(search, "query bigint, score double, place bigint")
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "place"))
    near = near.withColumn("_n", first).where(F.col("_n") <= nearest).groupBy("place").count().collect()
    held = np.zeros(parts)
    for row in near:
        held[row["place"]] = row["count"]
    held = np.cumsum(held) / max(held.sum(), 1)
    probes = int(np.argmax(held >= recall)) + 1 if held[-1] >= recall else parts
    return probes, float(held[probes - 1])


def indexed(points: DataFrame, width: int, classifier: Classifier) -> DataFrame:
    """The distinct vectors with their part, as bytes."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            part = np.argmax(classifier.scores(x), axis=1).astype(np.int32)
            columns = [batch.column(0), pa.array(part), pa.array([row.tobytes() for row in x], pa.binary()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "part", "packed", "ids"])

    found = points.select("key", "vector", "ids").mapInArrow(assign, "key bigint, part int, packed binary, ids array<bigint>")
    return stored(found, "search-index")


def fit(points: DataFrame, width: int, nearest: int, recall: float) -> tuple[Index, DataFrame]:
    """The index and the indexed vectors."""
    learning, checked = sampled(points, width)
    parts = max(1, min(PARTS, 1 << max(len(learning) // LEAST_IN_PART, 1).bit_length() - 1))
    classifier = learned_parts(points.sparkSession, learning, parts) if len(learning) > 1 else Classifier(
        np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)
    )
    table = indexed(points, width, classifier)
    sizes = np.zeros(len(classifier.second_bias), np.int64)
    for row in table.groupBy("part").count().collect():
        sizes[row["part"]] = row["count"]
    return Index(classifier, sizes, *visited(points, width, classifier, checked, nearest, recall)), table


def routed(queries: DataFrame, width: int, index: Index, least: int) -> DataFrame:
    """query_id, key, packed and part: every query in each part that it visits."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            parts = pa.array([row.tolist() for row in index.routes(x, least)], pa.list_(pa.int32()))
            columns = [batch.column(0), batch.column(2), pa.array([row.tobytes() for row in x], pa.binary()), parts]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "key", "packed", "parts"])

    rows = queries.select("vec_id", "vector", F.xxhash64("vector").alias("key"))
    found = rows.mapInArrow(route, "query_id bigint, key bigint, packed binary, parts array<int>")
    return stored(found.select("query_id", "key", "packed", F.explode("parts").alias("part")), "search-routes")


def block_search(queries: pd.DataFrame, points: pd.DataFrame, nearest: int) -> pd.DataFrame:
    """The nearest identifiers of each query among the points of one block; ties go to the smaller."""
    names = ["query_id", "key", "vec_id", "score"]
    if not len(queries) or not len(points):
        return pd.DataFrame({name: np.empty(0, float if name == "score" else np.int64) for name in names})
    q, p = (np.frombuffer(b"".join(rows["packed"])).reshape(len(rows), -1) for rows in (queries, points))
    counts = points["ids"].map(len).to_numpy()
    ids, starts = np.concatenate(points["ids"].to_numpy()).astype(np.int64), np.r_[0, np.cumsum(counts)[:-1]]
    wanted, out = min(nearest + 1, len(p)), []
    for start in range(0, len(q), 256):
        part = q[start : start + 256]
        scores = part @ p.T
        last = np.partition(scores, -wanted, axis=1)[:, -wanted]
        # Rounding of the product must not part what is equal.
        room = 1e-12 * np.linalg.norm(part, axis=1) * np.max(np.linalg.norm(p, axis=1))
        a, b = np.nonzero(scores >= (last - room)[:, None])
        each = np.repeat(np.arange(len(a)), counts[b])
        place = np.arange(len(each)) - np.repeat(np.cumsum(counts[b]) - counts[b], counts[b])
        found = pd.DataFrame({"a": a[each] + start, "score": exact_scores(part[a], p[b])[each], "vec_id": ids[starts[b[each]] + place]})
        found["query_id"], found["key"] = (queries[name].to_numpy()[found["a"]] for name in ("query_id", "key"))
        found = found[found["vec_id"] != found["query_id"]].sort_values(["a", "score", "vec_id"], ascending=[True, False, True])
        out.append(found[found.groupby("a").cumcount() < nearest][names])
    return pd.concat(out, ignore_index=True)


def dealt(sizes: np.ndarray) -> Column:
    """How many blocks the part in `part` has."""
    return F.element_at(F.array(*(F.lit(max(1, -(-int(size) // TOGETHER))) for size in sizes)), F.col("part") + 1)


def search(
    vectors: DataFrame, wanted: Column, nearest: int = 20, recall: float = 0.95,
    identifier: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows of every row for which `wanted`, over vec_id, holds."""
    spark = vectors.sparkSession
    ship(spark)
    rows, width = usable(vectors, identifier, vector, LARGEST)
    rows = rows.where(F.col("vec_id").isNotNull() & F.exists("vector", lambda c: c != 0)).withColumn("vec_id", F.col("vec_id").cast("bigint"))
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not width:
        return spark.createDataFrame([], schema)
    points = distinct_vectors(rows, nearest + 1)
    if points.isEmpty():
        return spark.createDataFrame([], schema)
    index, table = fit(points, width, nearest, recall)
    visits = routed(rows.where(wanted).dropDuplicates(["vec_id", "vector"]), width, index, nearest + 1)
    asked = np.zeros(len(index.sizes), np.int64)
    for row in visits.groupBy("part").count().collect():
        asked[row["part"]] = row["count"]
    chunks, groups = dealt(index.sizes), dealt(asked)
    left = visits.withColumn("group", F.pmod(F.xxhash64("query_id", "key"), groups).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), chunks - 1))
    )
    right = table.withColumn("chunk", F.pmod(F.xxhash64("key"), chunks).cast("int")).withColumn(
        "group", F.explode(F.sequence(F.lit(0), groups - 1))
    )
    keys = ["part", "chunk", "group"]
    met = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(
        lambda q, p: block_search(q, p, nearest), "query_id bigint, key bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
