"""Removal of word sequences that occur more than once, found by difference-cover anchors.

A difference cover of a period has, for any two positions, a shift below the
period that takes both onto it. So if only windows of `anchor` words that start at
cover positions are hashed, any two equal windows of anchor + period - 1 words or
more share an anchor at the same place within them. Documents without an anchor
that occurs again are done. Around the others the match is extended: each longer
window that holds such an anchor is hashed as a whole, wherever it starts, and
counted. Those that occur again are removed, judged on the input.

No pairs of occurrences are formed: an anchor or a window only has to occur again.

* Null texts have no words; texts shorter than a window lose none.
* Repeated rows are occurrences of their own, so copies remove each other.
* Identifiers may repeat or be null; an empty table gives an empty table. Other
  columns are not read.
* Windows are compared by 64-bit hashes of their words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import Located, numbered, plain_text, ship, spelled, stored
from tierlake.llm.postings import PACKED, buckets_for, pack, shared_postings
from tierlake.llm.shingles import windows, word_hashes

#: Documents whose texts and marks a task holds at once.
TOGETHER = 64
MARKS = "part bigint, marks binary"


@dataclass(frozen=True)
class Cover:
    """Window length in words, and a cover in which all differences modulo the period occur."""

    window: int = 35
    period: int = 21
    cover: tuple[int, ...] = (0, 1, 4, 14, 16)

    def __post_init__(self):
        differences = {(a - b) % self.period for a in self.cover for b in self.cover}
        if len(differences) != self.period or self.window < self.period:
            raise ValueError("this is no difference cover for the window")

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1

    def positions(self, count: int) -> np.ndarray:
        """Positions below count that lie on the cover."""
        at = np.arange(count)
        return at[np.isin(at % self.period, self.cover)]

    def around(self, anchors: np.ndarray, words: int) -> np.ndarray:
        """Starts of the windows that hold one of the anchors among their first `period` positions."""
        change = np.zeros(words + 2, np.int64)
        np.add.at(change, np.maximum(anchors - self.period + 1, 0), 1)
        np.add.at(change, anchors + 1, -1)
        return np.flatnonzero(np.cumsum(change)[: max(words - self.window + 1, 0)] > 0)


@dataclass(frozen=True)
class Places:
    """Documents by number and positions in them, packed into one number."""

    shift: int

    @classmethod
    def of(cls, rows: Located, longest: int) -> Places:
        shift = max(longest, 1).bit_length()
        if shift + rows.total.bit_length() > 63:
            raise ValueError("documents and positions don't fit into 63 bits")
        return cls(shift)

    def packed(self, number: int, positions: np.ndarray) -> np.ndarray:
        return (positions + (number << self.shift)).astype(np.uint64)

    def parts(self, places: np.ndarray) -> np.ndarray:
        """Numbers of the parts of the corpus that the places are in."""
        return (places >> np.uint64(self.shift)).astype(np.int64) // TOGETHER

    def by_document(self, numbers: pd.Series, marks: pd.Series) -> Iterator[np.ndarray]:
        """The marked positions of each document of a part."""
        places = np.unique(np.frombuffer(b"".join(marks), np.uint64)).astype(np.int64)
        for number in numbers:
            start, end = np.searchsorted(places, [number << self.shift, (number + 1) << self.shift])
            yield places[start:end] - (number << self.shift)


def packed_texts(rows: Located, identifier: str, text: str) -> DataFrame:
    """part, rid, doc_id and the compressed text, which is what travels."""
    pack_text = F.pandas_udf(
        lambda texts: pd.Series([zstandard.compress(x.encode("utf-8", "surrogatepass")) for x in texts]), "binary"
    )
    return rows.frame.select(
        F.floor(F.col(rows.row) / TOGETHER).alias("part"), F.col(rows.row).alias("rid"),
        spelled(identifier), pack_text(plain_text(text)).alias("packed"),
    )


def marked(packed: DataFrame, places: Places) -> DataFrame:
    """part and marks: places whose hash occurs again, by parts of the corpus; some may come twice."""

    def unpack(keys: np.ndarray, found: np.ndarray, _: np.ndarray) -> pd.DataFrame:
        found = np.sort(found)
        parts = places.parts(found)
        starts = np.flatnonzero(np.r_[True, parts[1:] != parts[:-1]]) if len(parts) else np.empty(0, np.int64)
        ends = [*starts[1:], len(parts)]
        return pd.DataFrame({
            "part": parts[starts], "marks": [found[start:end].tobytes() for start, end in zip(starts, ends, strict=False)],
        })

    return shared_postings(packed, np.uint64, np.dtype(np.uint64), unpack, MARKS)


def repeated_windows(rows: Located, text: str, cover: Cover) -> tuple[Places, DataFrame]:
    """part and marks: the starts of windows that occur again."""
    chars, longest = rows.frame.agg(F.sum(F.length(text)), F.max(F.length(text))).first()
    places = Places.of(rows, longest or 0)
    buckets = buckets_for(rows.frame, (chars or 0) / 5 * len(cover.cover) / cover.period)

    def gathered(found: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        empty = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
        keys, at = (np.concatenate(column) for column in zip(*(found or empty), strict=True))
        return pack(keys, at, buckets)

    def anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for rid, content in zip(batch["rid"], batch["content"], strict=True):
                words = word_hashes(content.encode("utf-8", "surrogatepass"))
                if len(words) >= cover.window:
                    hashes = windows(words, cover.anchor)
                    at = cover.positions(len(hashes))
                    found.append((hashes[at], places.packed(rid, at)))
            yield gathered(found)

    def extensions(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        found = []
        for rid, packed, near in zip(texts["rid"], texts["packed"], places.by_document(texts["rid"], marks["marks"]), strict=True):
            if len(near):
                words = word_hashes(zstandard.decompress(packed))
                at = cover.around(near, len(words))
                found.append((windows(words, cover.window)[at], places.packed(rid, at)))
        return gathered(found)

    texts = rows.frame.select(F.col(rows.row).alias("rid"), plain_text(text).alias("content"))
    near = marked(texts.mapInPandas(anchors, PACKED), places).groupBy("part")
    around = packed_texts(rows, rows.row, text).groupBy("part").cogroup(near).applyInPandas(extensions, PACKED)
    return places, stored(marked(around, places), "substring-windows")


def covered(starts: np.ndarray, words: int, window: int) -> np.ndarray:
    """Whether each word lies in a window from one of the starts."""
    change = np.zeros(words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change)[:words] > 0


def cleaned(docs: DataFrame, identifier: str = "doc_id", text: str = "text", cover: Cover = Cover(), with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if wanted, the kept text of every document."""
    ship(docs.sparkSession)
    rows = numbered(docs)
    places, starts = repeated_windows(rows, text, cover)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text

    def remove(texts: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, packed, begun in zip(texts["doc_id"], texts["packed"], places.by_document(texts["rid"], marks["marks"]), strict=True):
            words = kept = zstandard.decompress(packed).split()
            if len(begun):
                gone = covered(begun, len(words), cover.window)
                kept = [word for word, drop in zip(words, gone.tolist(), strict=True) if not drop]
            content = b" ".join(kept)
            shown = [content.decode("utf-8", "surrogatepass")] * with_text
            out.append((doc_id, len(words), len(words) - len(kept), sha256(content).hexdigest(), *shown))
        return pd.DataFrame(out, columns=names)

    kind = rows.frame.schema[identifier].dataType.simpleString()
    schema = "doc_id string, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text
    texts = packed_texts(rows, identifier, text).groupBy("part")
    found = texts.cogroup(starts.groupBy("part")).applyInPandas(remove, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH texts AS MATERIALIZED (
    SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
    SELECT rid, begun, array_to_string(words[begun:begun + 34], ' ') AS content
    FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 34, 0) + 1)) AS begun FROM texts)
), again AS (
    SELECT rid, begun FROM (SELECT rid, begun, count(*) OVER (PARTITION BY content) AS n FROM starts) WHERE n > 1
), gone AS (
    SELECT DISTINCT rid, begun + k AS place FROM again, range(35) AS shifts(k)
), flat AS (
    SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), kept AS (
    SELECT rid, string_agg(word, ' ' ORDER BY place) AS content, count(*) AS n FROM flat ANTI JOIN gone USING (rid, place) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(content, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (rid)
"""
