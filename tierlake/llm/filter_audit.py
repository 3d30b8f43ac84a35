"""Audit of filters that remove documents one after another, in every order.

A table-driven transducer reads the bytes of every text once (see `transducer`). From
what it counts, each document gets a bit per filter that it fails; whether a smaller
identifier has the same text is looked up by SHA-256. What a step of any order keeps
and removes depends on these bits alone, so a part of the corpus shrinks to a count for
each set of bits, and all orders are read off those counts.

* Null texts are empty texts; a null part is the part with the empty name.
* Repeated rows count each. Of rows that share the smallest identifier of a text none
  fails as a copy, as no identifier is smaller. A row without an identifier is nobody's
  copy, has no copies and no labels.
* A document that is labelled several times is good or toxic if any label says so;
  null labels say nothing.
* An empty table has no parts, so it gives an empty table. Columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import plain_text, ship, stored
from tierlake.llm.transducer import measure

COUNTED = ("words", "distinct", "capitals", "points", "symbols")


@dataclass(frozen=True)
class Filter:
    """A letter and the condition, over the counts and `copy`, that makes a document fail."""

    letter: str
    fails: Column


def default_filters() -> list[Filter]:
    return [
        Filter("A", F.col("words") < 200),
        Filter("B", 100 * F.col("distinct") < 50 * F.col("words")),
        Filter("C", 100 * F.col("capitals") > 2 * F.col("points")),
        Filter("D", F.col("symbols") > 0),
        Filter("E", F.col("copy")),
    ]


def measured(docs: DataFrame, identifier: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, digest and the counts of every document."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(identifier).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.encode(plain_text(text), "UTF-8"), 256)).alias("digest"),
        F.encode(plain_text(text), "UTF-8").alias("content"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = measure(batch.column(3).to_pylist())
            columns = [*batch.columns[:3], *(pa.array(getattr(counts, name)) for name in COUNTED)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "digest", *COUNTED])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(read, f"doc_id {kind}, part string, digest binary, " + ", ".join(f"{x} bigint" for x in COUNTED))


def with_copies(rows: DataFrame) -> DataFrame:
    """The measured rows and `copy`: whether a smaller identifier has the same text."""
    # A hot text comes down to a row per task before its identifiers meet.
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_most"))
    repeated = least.where("_least < _most").select("digest", "_least")
    smaller = F.coalesce(F.col("_least") < F.col("doc_id"), F.lit(False))
    return rows.join(repeated, "digest", "left").withColumn("copy", smaller).drop("_least")


def with_labels(rows: DataFrame, labels: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """The rows with `good` and `toxic` as their labels say, else false."""
    told = labels.where(F.col(identifier).isNotNull()).groupBy(F.col(identifier).alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("_good"), F.max(F.col("toxic") == 1).alias("_toxic")
    )
    named = {name: F.coalesce(F.col(f"_{name}"), F.lit(False)) for name in ("good", "toxic")}
    return rows.join(told, "doc_id", "left").withColumns(named).drop("_good", "_toxic")


def failures(rows: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """part, bits, n, good and toxic: how many documents fail a set of filters, a bit for each."""
    bits = sum((F.when(one.fails, 1 << k).otherwise(0) for k, one in enumerate(filters)), F.lit(0))
    return rows.select("part", bits.alias("bits"), "good", "toxic").groupBy("part", "bits").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )


def by_step(counts: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """Every row once per order of the filters and step in it, with the bit of its filter and those of earlier ones."""
    letters = [one.letter for one in filters]
    orders = F.split(F.lit(",".join("".join(order) for order in permutations(letters))), ",")
    spread = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.lit([*range(1, len(letters) + 1)])))

    def bits(part: Column) -> Column:
        return sum((F.when(F.contains(part, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(letters)), F.lit(0))

    return spread.withColumns({
        "own": bits(F.substring("filter_order", F.col("step"), F.lit(1))),
        "before": bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)),
    })


def audit(
    docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] | None = None,
    identifier: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """A row per part, order of the filters and step: what the step keeps and removes, and what it costs."""
    filters = default_filters() if filters is None else list(filters)
    rows = stored(measured(docs, identifier, text, part), "audit-counts")
    counts = failures(with_labels(with_copies(rows), labels, identifier), filters)
    own, before = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    # Each filter of a set is the first of them in as many orders.
    firsts = F.lit(factorial(len(filters))) / F.greatest(F.bit_count("bits"), F.lit(1))

    def total(of: Column, chosen: Column) -> Column:
        return F.sum(F.when(chosen, of).otherwise(0)).cast("bigint")

    n = F.col("n")
    return by_step(counts, filters).groupBy("part", "filter_order", "step").agg(
        total(n, ~own & ~before).alias("kept"),
        total(n, own & ~before).alias("removed"),
        total(n, own & before).alias("redundant"),
        total(n, F.col("bits") == F.col("own")).alias("unique_fails"),
        total(F.col("good"), own & ~before).alias("good_lost"),
        total(F.col("toxic"), own & ~before).alias("toxic_lost"),
        total(n * firsts.cast("bigint"), own).alias("shapley"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = r"""
WITH measured AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS content,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), told AS (
    SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(content, '[^A-Z]', '', 'g')) > 2 * length(content) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(content, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
    FROM measured LEFT JOIN told USING (doc_id)
), counted AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), placed AS (
    SELECT filter_order, step::INT AS step, filter_order[step] AS own, left(filter_order, step - 1) AS before
    FROM orders, range(1, 6) AS steps(step)
), met AS (
    SELECT *, contains(fails, own) AS is_own, regexp_matches(fails, '[' || before || '-]') AS is_before FROM counted, placed
), told_by_step AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (NOT is_own AND NOT is_before), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (is_own AND NOT is_before), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (is_own AND is_before), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (is_own AND NOT is_before), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (is_own AND NOT is_before), 0)::BIGINT AS toxic_lost
    FROM met GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM told_by_step
"""
