"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Documents become pieces of at most `capacity` tokens. Only how many pieces there
are of each length goes to the driver, at most `capacity` counts. On these counts
sets that provably dominate all alternatives are fixed for good:

* a piece that nothing else fits beside fills a sequence alone;
* two pieces that fill a sequence exactly;
* a piece and the longest that fits beside it, where no two others fit beside it,
  or where three don't and no two others fill it better than that one.

The rest is packed best-fit, longest first, all pieces of a length at once. The
plan says which ranks among the pieces of a length go where; ranks are taken from
a sorted table, so a length that a third of all pieces have is dealt over tasks.

* Null texts count as empty; an empty text is the end token alone.
* Repeated rows and repeated or null identifiers are pieces of their own.
* An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import located, plain_text, ranked, ship, spelled, stored
from tierlake.llm.tokens import token_ids


@dataclass
class Bins:
    """Equal sequences: how many, and the lengths in each as (length, times)."""

    count: int
    content: list[tuple[int, int]]
    room: int


@dataclass
class Lengths:
    """How many pieces are left of each length, with the lengths in order."""

    counts: dict[int, int]
    order: list[int] = field(init=False)

    def __post_init__(self):
        self.counts = {length: n for length, n in self.counts.items() if n > 0}
        self.order = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.pop(bisect.bisect_left(self.order, length))

    def longest(self, room: int, without: int = 0) -> int:
        """The longest length up to room, 0 if none; one piece of length `without` is set aside."""
        at = bisect.bisect_right(self.order, room) - 1
        if at >= 0 and self.order[at] == without and self.counts[without] == 1:
            at -= 1
        return self.order[at] if at >= 0 else 0

    def shortest(self, n: int, without: int) -> list[int]:
        """The n shortest pieces, one piece of length `without` set aside."""
        found: list[int] = []
        for length in self.order:
            found += [length] * min(n - len(found), self.counts[length] - (length == without))
            if len(found) == n:
                break
        return found

    def best_pair(self, room: int, without: int) -> int:
        """The largest sum of two pieces up to room, 0 if none."""
        left = {length: self.counts[length] - (length == without) for length in self.order}
        own = [length for length, n in left.items() if n and length < room]
        best, low, high = 0, 0, len(own) - 1
        while low <= high:
            if own[low] + own[high] > room:
                high -= 1
                continue
            if low < high or left[own[low]] > 1:
                best = max(best, own[low] + own[high])
            low += 1
        return best


def reduce(left: Lengths, capacity: int) -> list[Bins]:
    """Sequences that some best packing has; their pieces are taken out."""
    fixed: list[Bins] = []
    changed = True
    while changed:
        changed = False
        for length in sorted(left.counts, reverse=True):
            while left.counts.get(length):
                room = capacity - length
                partner = left.longest(room, length)
                if not partner:
                    n = left.counts[length]
                    fixed.append(Bins(n, [(length, 1)], room))
                    left.take(length, n)
                elif partner == room or dominates(left, length, partner, room):
                    # What dominates still does with fewer others left, so all such pairs are fixed at once.
                    n = left.counts[length] // 2 if partner == length else min(left.counts[length], left.counts[partner])
                    fixed.append(Bins(n, [(length, 2)] if partner == length else [(length, 1), (partner, 1)], room - partner))
                    left.take(length, n * (2 if partner == length else 1))
                    if partner != length:
                        left.take(partner, n)
                else:
                    break
                changed = True
    return fixed


def dominates(left: Lengths, length: int, partner: int, room: int) -> bool:
    shortest = left.shortest(3, length)
    if len(shortest) < 2 or shortest[0] + shortest[1] > room:
        return True
    return (len(shortest) < 3 or sum(shortest) > room) and left.best_pair(room, length) <= partner


def best_fit(left: Lengths, capacity: int) -> list[Bins]:
    """Best fit, longest first; each piece goes where the least room stays."""
    by_room: dict[int, list[Bins]] = {}
    rooms: list[int] = []

    def put(bins: Bins) -> None:
        if bins.room not in by_room:
            by_room[bins.room] = []
            bisect.insort(rooms, bins.room)
        by_room[bins.room].append(bins)

    for length in reversed(left.order):
        n = left.counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            else:
                room, bins = capacity, Bins(n, [], capacity)
            each = room // length
            if n < each:
                used, each = 1, n
            else:
                used = min(bins.count, n // each)
            if bins.content and bins.count > used:
                put(Bins(bins.count - used, bins.content, room))
            put(Bins(used, [*bins.content, (length, each)], room - each * length))
            n -= used * each
    return [bins for group in by_room.values() for bins in group]


def plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """length, rank (the first of a run), each (pieces per sequence), sequence (the first), offset."""
    left = Lengths(dict(counts))
    rows, taken, sequence = [], dict.fromkeys(counts, 0), 0
    for bins in [*reduce(left, capacity), *best_fit(left, capacity)]:
        offset = 0
        for length, each in bins.content:
            rows.append((length, taken[length], each, sequence, offset))
            taken[length] += bins.count * each
            offset += length * each
        sequence += bins.count
    table = pd.DataFrame(rows, columns=["length", "rank", "each", "sequence", "offset"], dtype="int64")
    return table.sort_values(["length", "rank"], ignore_index=True)


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1,
    identifier: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and the row's place; with_ids adds the packed ids."""
    ship(docs.sparkSession)
    rows = located(docs)
    names = ["doc_id", "file", "row", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = np.array([end], "<u4")
        for batch in batches:
            out = []
            for doc_id, file, row, content in batch.itertuples(index=False):
                ids = np.concatenate([token_ids(content, tokenizer), last])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    packed = part.tobytes()
                    out.append((doc_id, file, row, piece, start, len(part), zlib.crc32(packed), *[packed] * with_ids))
            yield pd.DataFrame(out, columns=names)

    kind = rows.frame.schema[identifier].dataType.simpleString()
    schema = "doc_id string, file string, row bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    found = rows.frame.select(
        spelled(identifier), F.col(rows.file).alias("file"), F.col(rows.row).alias("row"),
        plain_text(text).alias("content"),
    ).mapInPandas(cut, schema + ", ids binary" * with_ids)
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, **options) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = stored(pieces(docs, tokenizer, capacity, **options), "packing-pieces")
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    table = plan(counts, capacity)
    placed = ranked(cut, ["length"], ["doc_id", "piece", "file", "row"], "rank", "packing-ranks")
    # One number orders runs by length and rank; ranks stay below 2 ** 48.
    starts = (table["length"].to_numpy() << 48) + table["rank"].to_numpy()
    ranks, each, first, offset = (table[c].to_numpy() for c in ("rank", "each", "sequence", "offset"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, length = batch.pop("rank").to_numpy(np.int64), batch["length"].to_numpy(np.int64)
            run = np.searchsorted(starts, (length << 48) + rank, side="right") - 1
            at = rank - ranks[run]
            yield batch.assign(
                sequence_id=first[run] + at // each[run], offset=offset[run] + at % each[run] * length
            )

    kind = cut.schema["doc_id"].dataType
    placed = placed.drop("file", "row").withColumn("doc_id", spelled("doc_id"))
    shown = [field for field in placed.schema if field.name != "rank"]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in shown)
    found = placed.mapInPandas(place, f"{schema}, sequence_id bigint, offset bigint")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
