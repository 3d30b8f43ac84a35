"""Homomorphic fingerprints of documents: sums of wide vectors hashed from paragraphs.

Every paragraph, cut after the ends of its sentences, is hashed into a wide vector
and the vectors of a document are added up modulo powers of two. The order of the
pieces doesn't count, how often each occurs does, and pieces are added to or taken
from a fingerprint without the rest of the document. The vector has

* a count of the pieces, modulo 2 ** 32;
* eight dense lanes modulo 2 ** 32, in which any difference shows;
* ten levels of sparse lanes modulo 2 ** 8, in which a piece touches one lane of
  one level, deeper levels being rarer by 8: from the lanes that two fingerprints
  share, the number of distinct pieces that differ is estimated. The deepest level
  is not full before 10 ** 10 pieces, more than a text can have;
* 64 stable lanes modulo 2 ** 32, in which a piece adds a draw of the Cauchy
  distribution in halves: over the lanes, differences of two fingerprints are Cauchy
  draws whose scale is the number of pieces that differ, each as often as it does.

From the larger of the two estimates and the counts follows the Jaccard similarity
of the two multisets. The scale is off by 18 percent (a standard deviation).

Null texts count as empty, an empty text is one empty piece. Equal texts have
equal fingerprints and likeness 1, and so have texts of the same pieces in another order. The next document is the one
of the next lower identifier; null identifiers come last, and rows of one
identifier follow by file and row. A table of one row is its own next document,
an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from base64 import b64decode, b64encode
from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import located, plain_text, ship, spelled, stored

LEVELS, LANES, DENSE, STABLE = 10, 48, 8, 64
#: Pieces whose stable lanes are drawn at once.
CHUNK = 4096
PIECE = re.compile(r"\n|(?<=[.!?]) ")
DRAWS = np.dtype([("dense", "<u4", DENSE), ("level", "<u8"), ("lane", "<u8"), ("value", "<u8"), ("stable", "<u8")])


def stable_draws(seeds: np.ndarray) -> np.ndarray:
    """The sums of Cauchy draws in halves, modulo 2 ** 32; only exactly rounded operations, so machines agree."""
    sums = np.zeros(STABLE, np.uint64)
    for start in range(0, len(seeds), CHUNK):
        # SplitMix64, one word for two lanes.
        words = seeds[start : start + CHUNK, None] + np.arange(1, STABLE // 2 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        words = (words ^ (words >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        words = (words ^ (words >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        words ^= words >> np.uint64(31)
        bits = np.concatenate([words >> np.uint64(32), words & np.uint64(0xFFFFFFFF)], axis=1)
        angle = ((bits >> np.uint64(1)).astype(np.float64) + 0.5) * (np.pi / 2**32)
        # The cotangent by its series, within 0.003 of it on this quarter of the circle.
        square = angle * angle
        cotangent = 1 / angle - angle * (1 / 3 + square * (1 / 45 + square * (2 / 945 + square / 4725)))
        halves = np.rint(2 * cotangent).astype(np.int64)
        sums += np.where(bits & np.uint64(1), halves, -halves).sum(0).astype(np.uint64)
    return sums.astype(np.uint32)


def scale(draws: np.ndarray) -> float:
    """The likeliest scale of Cauchy draws around 0."""
    squares = draws * draws
    found = float(np.median(squares))
    if not found:
        return 0.0
    # Newton steps on the logarithm of the squared scale, from the median.
    for _ in range(8):
        shares = squares / (squares + found)
        step = (shares.sum() - len(shares) / 2) / (shares * (1 - shares)).sum()
        found *= math.exp(min(max(step, -1.0), 1.0))
        if abs(step) < 1e-6:
            break
    return math.sqrt(found)


class Vector:
    """The sum of the vectors of some pieces."""

    def __init__(self, packed: bytes | None = None):
        packed = packed or bytes(4 + 4 * (DENSE + STABLE) + LEVELS * LANES)
        self.wide = np.frombuffer(packed, "<u4", 1 + DENSE + STABLE).copy()
        self.sparse = np.frombuffer(packed, np.uint8, LEVELS * LANES, 4 + 4 * (DENSE + STABLE)).copy()

    def add(self, pieces: Iterable[str], sign: int = 1) -> Vector:
        """The pieces added, or taken out with sign -1."""
        digests = b"".join([blake2b(piece.encode("utf-8", "surrogatepass")).digest() for piece in pieces])
        draws = np.frombuffer(digests, DRAWS)
        wide = np.r_[np.uint32(len(draws)), draws["dense"].sum(0, dtype=np.uint32), stable_draws(draws["stable"])].astype(np.uint32)
        level = np.zeros(len(draws), np.int64)
        for deeper in range(1, LEVELS):
            level += draws["level"] & np.uint64(8**deeper - 1) == 0
        sparse = np.zeros(LEVELS * LANES, np.uint8)
        np.add.at(sparse, level * LANES + (draws["lane"] % np.uint64(LANES)).astype(np.int64), (draws["value"] & np.uint64(255)).astype(np.uint8) | np.uint8(1))
        self.wide = self.wide + wide if sign > 0 else self.wide - wide
        self.sparse = self.sparse + sparse if sign > 0 else self.sparse - sparse
        return self

    def packed(self) -> bytes:
        return self.wide.astype("<u4").tobytes() + self.sparse.tobytes()

    def text(self) -> str:
        return b64encode(self.packed()).decode()

    @classmethod
    def from_text(cls, text: str) -> Vector:
        return cls(b64decode(text))


def pieces(text: str) -> list[str]:
    return PIECE.split(text)


def fingerprint(text: str) -> Vector:
    return Vector().add(pieces(text))


def likeness(a: Vector, b: Vector) -> float:
    """1 if equal, else an estimate below 1 of the Jaccard similarity of the pieces."""
    if np.array_equal(a.wide, b.wide) and np.array_equal(a.sparse, b.sparse):
        return 1.0
    count_a, count_b = int(a.wide[0]), int(b.wide[0])
    same = (a.sparse == b.sparse).reshape(LEVELS, LANES).sum(1)
    differ = 0.0
    for level in range(LEVELS):
        share = 8.0**-level * (7 / 8 if level < LEVELS - 1 else 1)
        differ = np.log(max(same[level], 0.5) / LANES) / np.log(1 - 1 / LANES) / share
        if same[level] >= LANES / 6:
            break
    often = scale((a.wide - b.wide)[1 + DENSE :].view(np.int32) / 2)
    differ = min(max(differ, often, abs(count_a - count_b), 1), count_a + count_b)
    return float((count_a + count_b - differ) / (count_a + count_b + differ))


def edited(text: str, other: str) -> str:
    """The last half of the code points replaced by the first as many of the other text."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compared(doc_id, text: str, own: Vector, other: str, next_one: Vector) -> tuple:
    changed = edited(text, other)
    new = fingerprint(changed)
    digest = sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own.packed(), new.packed(), likeness(own, new), likeness(own, next_one)


def fingerprints(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprint of every document and of its edited text, with their likenesses."""
    spark = docs.sparkSession
    ship(spark)
    rows = located(docs)
    kind = rows.frame.schema[identifier].dataType.simpleString()
    ends = ["part", "head", "tail"]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs of neighbours of a sorted partition; its first text and its last document wait for its neighbours."""
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for doc_id, content in zip(batch["doc_id"], batch["content"], strict=True):
                own = fingerprint(content)
                if held is None:
                    out.append((*[None] * len(COLUMNS), part, content, None))
                else:
                    out.append((*compared(*held, content, own), None, None, None))
                held = doc_id, content, own
            yield pd.DataFrame(out, columns=COLUMNS + ends)
        if held is not None:
            yield pd.DataFrame([(held[0], *[None] * (len(COLUMNS) - 1), part, None, held[1])], columns=COLUMNS + ends)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                compared(doc_id, tail, fingerprint(tail), head, fingerprint(head))
                for doc_id, tail, head in batch[["doc_id", "tail", "head"]].itertuples(index=False)
            ]
            yield pd.DataFrame(out, columns=COLUMNS)

    ordered = rows.frame.select(
        spelled(identifier), plain_text(text).alias("content"),
        F.col(identifier).alias("id"), F.col(rows.file).alias("file"), F.col(rows.row).alias("row"),
    )
    order = [F.desc("id"), F.col("file"), F.col("row")]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    walked = stored(ordered.mapInPandas(walk, f"doc_id string, {TYPES}, part int, head string, tail string"), "fingerprints")
    # A row per partition from here on.
    heads = walked.where("head is not null").select("part", "head")
    follows = heads.select("part").select(
        "part",
        F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next"),
    )
    tails = walked.where("tail is not null").select("doc_id", "part", "tail").join(follows, "part")
    tails = tails.join(heads.withColumnRenamed("part", "next"), "next")
    last = tails.select("doc_id", "tail", "head").mapInPandas(meet, f"doc_id string, {TYPES}")
    found = walked.where("part is null").select(*COLUMNS).unionByName(last)
    return found.withColumns({
        "doc_id": F.col("doc_id").cast(kind),
        # Spark may break lines.
        **{name: F.translate(F.base64(name), "\r\n", "") for name in ("fingerprint", "edited_fingerprint")},
    })


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
