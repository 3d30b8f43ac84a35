"""Exact self-join of documents by Jaccard similarity of word shingles, as a metric-space join.

1 - Jaccard is a metric. The join works in three steps, each exact:

1. Cells. The first pivots are single shingles. All sets that hold a shingle are
   equally far from it, so ties go by one order of all shingles, and the cell of
   a set is that of its first shingle. Sets within the radius of a set miss too
   little of it to have none of its first n - ceil(t * n) + 1 shingles, so that
   window is where the set is replicated; two sets that link share a cell.
   Shingles that many documents share come last in the order, which keeps cells
   small; the order never changes the result. Cells of the same sets, as copies with
   edits have by the hundred, are one cell that counts as many.
2. Regions, round by round. The pivot of a crowded cell is its most central document,
   the one that meets most others in all its cells: of copies of a text with edits, that
   is the text itself. Every set goes to the pivot it shares most cells with, its Voronoi
   region, and its exact distance to it is computed. Sets within the radius are linked to
   the pivot and share its label, so no pair among them has to be looked at. Of what is
   left, sets that too few others share anything with can't link and leave the cell; the
   rest of the cells that still hold several labels are divided again by other pivots.
3. Differences. What is still crowded then is joined again region by region, by what its
   sets differ in from their pivot: |a xor b| follows from |a xor p|, |b xor p| and what
   these two share. Two sets whose differences share nothing can only link if both link
   with the pivot. So only sets that differ in the same way meet, however many are close
   to one pivot; shingles in which the same sets differ count as one of some weight. The
   rarest shingle that two sets share must leave both enough behind it for what they need.
4. Boundaries. Sets of different labels and regions that are left in a cell are paired,
   unless their distances to any pivot that both were compared with differ by more than
   the radius (triangle inequality), or the cells they share are too few for the overlap
   they need. The pairs that are left are verified on the whole sets.

Equal sets are one node with as many rows as there are. A pair may stay untried
only if its nodes are already connected, so components are exact.

* Null texts and texts without words have an empty set, link with nothing and are
  a component of their own; texts of fewer words than a shingle are one shingle.
* Null identifiers never name a component unless it has no other, and a row without one
  is kept only if its group has no other.
* Repeated rows are rows of their own. An empty table gives an empty table.
* Shingles are compared by 64-bit hashes, whole sets by 96 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import Located, discard, numbered, plain_text, settings, ship, spelled, stored
from tierlake.llm.components import components
from tierlake.llm.postings import PACKED, buckets_for, pack, shared_postings
from tierlake.llm.shingles import set_name, shingle_set

#: Bits of the table that marks common shingles; its size is the same for any input.
COMMON_BITS = 1 << 23
#: Most shingles that are put last in the order, and the least count for that.
COMMON_MOST, COMMON_LEAST = 1 << 19, 8
#: Shingles that are counted together in a task, postings that leave it together, and shingles of rows that do.
COUNTED, POSTED, KEPT = 1 << 21, 1 << 18, 1 << 20
#: Rounds in which sets outside their region are given to another pivot, at most.
ROUNDS = 2

#: Batches that go to Python stay small, as a row may hold two whole sets; a finished step's shuffle files go at once.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": f"{16 << 20}",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

NODE = np.dtype([("node", "V12"), ("n", "<i4")])


@dataclass(frozen=True)
class Rule:
    """Shingle width, and similarity in per cent from which sets link."""

    width: int = 5
    percent: int = 75

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def prefix_column(self, n: Column) -> Column:
        return n - F.ceil(n * self.percent / 100) + 1

    def similar_sizes(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def may_link(self, a: Column, b: Column, cells: Column) -> Column:
        """Whether sets of sizes a and b that share so many cells can reach the overlap they need.

        What both hold up to the end of the shorter window are shared cells; beyond
        it lies at most the rest of that set. One is allowed for cells that merge.
        """
        needed = F.ceil((a + b) * self.percent / (100 + self.percent))
        beyond = F.greatest(a - self.prefix_column(a), b - self.prefix_column(b))
        return cells + 1 + beyond >= needed


PROFILE = ["rid", "doc_id", "n", "node", "low", "common", "counts"]


def profiles(rows: Located, identifier: str, text: str, rule: Rule) -> DataFrame:
    """rid, doc_id, n and node (the set's name) of every row; other rows hold counts of repeated shingles.

    `low` are the lower halves of the set's shingles in ascending order of the whole, in
    the first rows of a task that have it.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, names, size = [], set(), 0

        def repeated() -> pd.DataFrame:
            values, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.empty(0, np.uint64),) * 2
            often = counts > 1
            packed = values[often].tobytes(), counts[often].astype(np.int64).tobytes()
            return pd.DataFrame([(None, None, None, None, None, *packed)], columns=PROFILE)

        for batch in batches:
            out, kept = [], 0
            for rid, doc_id, content in zip(batch["rid"], batch["doc_id"], batch["content"], strict=True):
                shingles = shingle_set(content, rule.width)
                node, low = set_name(shingles), None
                if node not in names:
                    names.add(node)
                    held.append(shingles)
                    size += len(shingles)
                    kept += len(shingles)
                    low = shingles.astype(np.uint32).tobytes()
                out.append((rid, doc_id, len(shingles), node, low, None, None))
                if kept > KEPT:
                    yield pd.DataFrame(out, columns=PROFILE)
                    out, kept = [], 0
                if size > COUNTED:
                    yield repeated()
                    held, names, size = [], set(), 0
            if out:
                yield pd.DataFrame(out, columns=PROFILE)
        if held:
            yield repeated()

    texts = rows.frame.select(F.col(rows.row).alias("rid"), spelled(identifier), plain_text(text).alias("content"))
    kind = rows.frame.schema[identifier].dataType.simpleString()
    found = texts.mapInPandas(read, "rid bigint, doc_id string, n bigint, node binary, low binary, common binary, counts binary")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def common_table(profile: DataFrame) -> np.ndarray:
    """Packed bits by hash: which shingles come last in the order."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for common, counts in zip(batch["common"], batch["counts"], strict=True):
                yield pd.DataFrame({"shingle": np.frombuffer(common, np.int64), "n": np.frombuffer(counts, np.int64)})

    counts = profile.where("common is not null").select("common", "counts").mapInPandas(unpack, "shingle bigint, n bigint")
    often = counts.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON_LEAST)
    top = often.orderBy(F.desc("n"), "shingle").limit(COMMON_MOST).select("shingle")
    bits = np.zeros(COMMON_BITS, bool)
    for batch in top.toArrow().to_batches():
        bits[batch.column(0).to_numpy().astype(np.uint64) % np.uint64(COMMON_BITS)] = True
    return np.packbits(bits)


def cells(profile: DataFrame, rule: Rule, common: np.ndarray, buckets: int) -> DataFrame:
    """cell, node and n of every set in every cell of its window that other sets share."""
    table = profile.sparkSession.sparkContext.broadcast(common)

    def window(low: np.ndarray, bits: np.ndarray) -> np.ndarray:
        last = bits[low % np.uint32(COMMON_BITS)]
        first, most = low[~last], rule.prefix(len(low))
        return np.unique(first[:most] if len(first) >= most else np.concatenate([first, low[last][: most - len(first)]]))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(table.value).view(bool)
        keys, nodes, lengths, seen, size = [], [], [], set(), 0

        def posted() -> pd.DataFrame:
            payloads = np.repeat(np.array(nodes, NODE), lengths)
            return pack(np.concatenate(keys), payloads, buckets)

        for batch in batches:
            for node, n, low in zip(batch["node"], batch["n"], batch["low"], strict=True):
                if node in seen:
                    continue
                seen.add(node)
                keys.append(window(np.frombuffer(low, np.uint32), bits))
                nodes.append((node, n))
                lengths.append(len(keys[-1]))
                size += lengths[-1]
                if size > POSTED:
                    yield posted()
                    keys, nodes, lengths, seen, size = [], [], [], set(), 0
        if keys:
            yield posted()

    def unpack(keys: np.ndarray, payloads: np.ndarray, _: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({
            "cell": keys.astype(np.int64), "node": [node.tobytes() for node in payloads["node"]], "n": payloads["n"].astype(np.int64),
        })

    packed = profile.where("low is not null and n > 0").select("node", "n", "low").mapInPandas(read, PACKED)
    found = shared_postings(packed, np.uint32, NODE, unpack, "cell bigint, node binary, n bigint")
    return stored(found.distinct(), "join-cells")


def held_by(frame: DataFrame, *keys: str) -> DataFrame:
    """count, v and w of each key: equal for keys that the same nodes have, by 128 bits."""
    return frame.groupBy(*keys).agg(
        F.count("*").alias("count"), F.bit_xor(F.xxhash64("node")).alias("v"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("w")
    )


def distinct_cells(found: DataFrame) -> DataFrame:
    """cell, size and weight: one cell of those that the same sets share, and how many there are."""
    alike = held_by(found, "cell").where("count > 1").groupBy("count", "v", "w")
    return alike.agg(F.min("cell").alias("cell"), F.count("*").alias("weight")).select("cell", F.col("count").alias("size"), "weight")


def together(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) with `both`, how many shingles the two have in common; _na and _nb are n of the sets."""

    @F.pandas_udf("bigint")
    def shared(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series([
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(first, second, strict=True)
        ], dtype="int64")

    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a"), F.col("n").alias("_na"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b"), F.col("n").alias("_nb"))
    return pairs.join(a, "a").join(b, "b").withColumn("both", shared("_a", "_b")).drop("_a", "_b")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) with the size of both sets' intersection and union, from the whole sets."""
    return together(pairs, sets).withColumn("either", F.col("_na") + F.col("_nb") - F.col("both")).drop("_na", "_nb")


def candidates(members: DataFrame, tried: DataFrame, rule: Rule) -> DataFrame:
    """a, b: every set with a pivot of another label that it shares most cells with.

    A cell's pivot is its most central set that has not been one before.
    """
    members = members.select("cell", "weight", "node", "n", "f", "central", "label")
    rank = F.struct("central", "node", "label", F.col("n").alias("m"), F.col("f").alias("g"))
    fresh = members.join(tried.select(F.col("b").alias("node")).distinct(), "node", "left_anti")
    pivots = fresh.groupBy("cell").agg(F.max(rank).alias("p")).select(
        "cell", F.col("p.node").alias("pivot"), "p.m", "p.g", F.col("p.label").alias("other")
    )
    met = members.join(pivots, "cell").where(
        (F.col("label") != F.col("other")) & rule.similar_sizes(F.col("n"), F.col("m"))
        & rule.may_link(F.col("n"), F.col("m"), F.least("f", "g"))
    )
    counted = met.groupBy("node", "pivot").agg(F.sum("weight").alias("cells"))
    best = counted.groupBy("node").agg(F.max(F.struct("cells", "pivot")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of linked nodes made equal: each label moves to the least one it links with, and on from there."""
    of = labels.select("node", "label")
    ends = links.select("a", "b").join(of.withColumnsRenamed({"node": "a", "label": "x"}), "a")
    ends = ends.join(of.withColumnsRenamed({"node": "b", "label": "y"}), "b").where("x <> y")
    hooks = ends.select(F.greatest("x", "y").alias("label"), F.least("x", "y").alias("up"))
    hooks = stored(hooks.groupBy("label").agg(F.min("up").alias("up")), "join-hooks")
    for _ in range(3):
        above = hooks.select(F.col("label").alias("up"), F.col("up").alias("top"))
        hooks = hooks.join(above, "up", "left").select("label", F.coalesce("top", "up").alias("up"))
    moved = labels.join(hooks, "label", "left").withColumn("label", F.coalesce("up", "label")).drop("up")
    return moved.select(*labels.columns)


def crowded_cells(members: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """The members with their new labels, without cells where all have one: their sets are connected.

    Sets that can't reach the overlap they need with even the smallest set of the cell leave it.
    """
    named = members.select("cell", "weight", "node").join(labels.select("node", "n", "f", "central", "label"), "node")
    smallest = named.groupBy("cell").agg(F.min("n").alias("m"), F.min("label").alias("low"), F.max("label").alias("high"))
    partner = F.greatest("m", F.ceil(F.col("n") * rule.percent / 100))
    able = named.join(smallest.where("low <> high").select("cell", "m"), "cell").where(rule.may_link(F.col("n"), partner, F.col("f")))
    several = able.groupBy("cell").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return able.join(several.select("cell"), "cell", "left_semi").select("cell", "weight", "node", "n", "f", "central", "label")


def homes(members: DataFrame) -> DataFrame:
    """a, b: every set with the centre of its region, itself if it is one.

    The way goes from a set to the most central set of all its cells, and on from there.
    """
    rank = F.struct("central", "node")
    tops = members.groupBy("cell").agg(F.max(rank).alias("top"))
    up = stored(members.join(tops, "cell").groupBy("node").agg(F.max("top").getField("node").alias("up")), "join-up")
    for _ in range(2):
        above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        up = up.join(above, "up").select("node", F.col("top").alias("up"))
    return up.select(F.col("node").alias("a"), F.col("up").alias("b"))


def nearby(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) without most of those beyond twice the radius, by 16 bits of each shingle.

    These agree wherever shingles do, so no pair within it is lost, and whole sets need not be sent along for the others.
    """

    @F.pandas_udf("binary")
    def brief(shingles: pd.Series) -> pd.Series:
        return pd.Series([np.sort(np.frombuffer(x, np.uint64).astype(np.uint16)).tobytes() for x in shingles], dtype=object)

    @F.pandas_udf("bigint")
    def agreeing(first: pd.Series, second: pd.Series) -> pd.Series:
        found = []
        for x, y in zip(first, second, strict=True):
            x, y = np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            found.append(min(int((y[at] == x).sum()), len(y)))
        return pd.Series(found, dtype="int64")

    short = sets.select("node", "n", brief("shingles").alias("brief"))
    a = short.select(F.col("node").alias("a"), F.col("brief").alias("_a"), F.col("n").alias("_na"))
    b = short.select(F.col("node").alias("b"), F.col("brief").alias("_b"), F.col("n").alias("_nb"))
    most = pairs.join(a, "a").join(b, "b").withColumn("most", agreeing("_a", "_b"))
    near = F.col("most") * 100 >= (F.col("_na") + F.col("_nb") - F.col("most")) * (2 * rule.percent - 100)
    return most.where(near).select("a", "b")


def differences(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) with both, either, and the shingles that only one of the two sets has.

    These are null beyond twice the radius: nothing can link with a and with what links with b.
    """

    @F.pandas_udf("both bigint, only binary")
    def apart(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        found = []
        for x, y in zip(first, second, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            only = np.setxor1d(x, y, assume_unique=True)
            both = (len(x) + len(y) - len(only)) // 2
            near = both * 100 >= (both + len(only)) * (2 * rule.percent - 100)
            found.append((both, only.tobytes() if near else None))
        return pd.DataFrame(found, columns=["both", "only"])

    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("_a"), F.col("n").alias("na"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("_b"), F.col("n").alias("_nb"))
    found = pairs.join(a, "a").join(b, "b").withColumn("_found", apart("_a", "_b"))
    found = found.select("a", "b", "na", "_nb", "_found.both", "_found.only")
    found = found.withColumn("either", F.col("na") + F.col("_nb") - F.col("both"))
    return found.select("a", "b", "na", (F.col("either") - F.col("both")).alias("d"), "both", "either", "only")


def links_within(regions: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """a, b, both, either: linked sets of different labels in one region, but for those that link with its centre."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for home, node, only in zip(batch["home"], batch["node"], batch["only"], strict=True):
                own = np.frombuffer(only, np.int64)
                yield pd.DataFrame({"home": [home] * len(own), "node": [node] * len(own), "shingle": own})

    sets = regions.select(F.col("b").alias("home"), F.col("a").alias("node"), "only")
    postings = stored(sets.mapInPandas(spread, "home binary, node binary, shingle bigint"), "join-differences")
    alike = held_by(postings, "home", "shingle").where("count > 1")
    kept = alike.groupBy("home", "count", "v", "w").agg(F.min("shingle").alias("shingle"), F.count("*").alias("weight"))
    # Sets link if their differences share a weight of (needa + needb) / scale at least.
    scale = 2 * (100 + rule.percent)
    need = F.col("d") * (100 + rule.percent) - F.col("n") * (100 - rule.percent)
    known = regions.select(F.col("b").alias("home"), F.col("a").alias("node"), F.col("na").alias("n"), "d").join(
        labels.select("node", "label"), "node").withColumn("need", need)
    sizes = known.groupBy("home", "label").agg(F.count("*").alias("size"), F.min("need").alias("need"))
    major = sizes.groupBy("home").agg(
        F.max(F.struct("size", "label")).alias("most"), F.count("*").alias("labels"), F.min("need").alias("least")
    ).where("labels > 1").select("home", F.col("most.label").alias("major"), "least")
    others = sizes.join(major, "home").where("label <> major").groupBy("home").agg(F.min("need").alias("least_few"))
    known = known.join(major.join(others, "home"), "home")
    # What a set shares from a shingle on, in one order with rare ones first, is no more than it has from there on.
    rest = Window.partitionBy("home", "node").orderBy(F.desc("count"), F.desc("shingle")).rowsBetween(Window.unboundedPreceding, 0)
    rows = postings.join(kept.select("home", "shingle", "weight", "count"), ["home", "shingle"]).join(known, ["home", "node"])
    rows = stored(rows.withColumn("rest", F.sum("weight").over(rest)).drop("weight", "count"), "join-alike")
    names = ("node", "n", "d", "label", "need", "rest")
    few = rows.where((F.col("label") != F.col("major")) & (F.col("rest") * scale >= F.col("need") + F.col("least")))
    few = few.select("home", "shingle", *(F.col(x).alias(f"{x}a") for x in names))
    every = rows.where(F.col("rest") * scale >= F.col("need") + F.col("least_few"))
    every = every.select("home", "shingle", "major", *(F.col(x).alias(f"{x}b") for x in names))
    once = (F.col("labelb") == F.col("major")) | (F.col("nodea") < F.col("nodeb"))
    # True at the first shingle that linked sets share.
    enough = F.least("resta", "restb") * scale >= F.col("needa") + F.col("needb")
    met = few.join(every, ["home", "shingle"]).where(
        (F.col("labela") != F.col("labelb")) & once & enough & rule.similar_sizes(F.col("na"), F.col("nb"))
    )
    pairs = met.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b"), "na", "nb", "da", "db").distinct()
    shared = together(pairs, regions.select(F.col("a").alias("node"), F.col("na").alias("n"), F.col("only").alias("shingles")))
    total = F.col("na") + F.col("nb")
    both = F.col("both") + ((total - F.col("da") - F.col("db")) / 2).cast("bigint")
    return linked(shared.select("a", "b", both.alias("both"), (total - both).alias("either")), rule)


def boundary_pairs(members: DataFrame, tried: DataFrame, rule: Rule) -> DataFrame:
    """a, b: sets of different labels and homes that share enough cells and pass the triangle inequality."""
    whole = members.groupBy("cell").agg(F.min("home").alias("low"), F.max("home").alias("high"))
    members = members.join(whole.where("low <> high").select("cell"), "cell", "left_semi")
    sizes = members.groupBy("cell", "label").agg(F.count("*").alias("size"))
    most = sizes.groupBy("cell").agg(F.max(F.struct("size", "label")).alias("most"), F.count("*").alias("labels"))
    most = most.where("labels > 1").select("cell", F.col("most.label").alias("major"))
    crowded = members.join(most, "cell")
    names = {"node": "", "n": "n", "f": "f", "label": "l", "reached": "r", "home": "h"}
    few = crowded.where("label <> major").select("cell", *(F.col(x).alias(f"{to}a") for x, to in names.items()))
    every = crowded.select("cell", "weight", "major", *(F.col(x).alias(f"{to}b") for x, to in names.items()))
    once = (F.col("lb") == F.col("major")) | (F.col("a") < F.col("b"))
    radius = 1 - rule.percent / 100 + 1e-9
    apart = F.exists("ra", lambda x: F.exists("rb", lambda y: (x.pivot == y.pivot) & (F.abs(x.distance - y.distance) > radius)))
    met = few.join(every, "cell").where(
        (F.col("la") != F.col("lb")) & (F.col("ha") != F.col("hb")) & once & rule.similar_sizes(F.col("na"), F.col("nb"))
        & rule.may_link(F.col("na"), F.col("nb"), F.least("fa", "fb")) & ~apart
    ).select("weight", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.least("na", "nb").alias("na"), F.greatest("na", "nb").alias("nb"))
    counted = met.groupBy("a", "b").agg(F.sum("weight").alias("cells"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    hopeful = counted.where(rule.may_link(F.col("na"), F.col("nb"), F.col("cells"))).select("a", "b")
    seen = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return hopeful.join(seen, ["a", "b"], "left_anti")


def linked(overlap: DataFrame, rule: Rule) -> DataFrame:
    return overlap.where(F.col("both") * 100 >= F.col("either") * rule.percent)


def join(docs: DataFrame, identifier: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> tuple[Located, DataFrame]:
    """The numbered rows, and rid, doc_id, n_shingles, component_id and first (its least doc_id and rid) of each."""
    ship(docs.sparkSession)
    with settings(docs.sparkSession, SETTINGS):
        return _join(docs, identifier, text, rule)


def _join(docs: DataFrame, identifier: str, text: str, rule: Rule) -> tuple[Located, DataFrame]:
    rows = numbered(docs)
    profile = stored(profiles(rows, identifier, text, rule), "join-profiles")
    documents = stored(profile.where("node is not null").select("rid", "doc_id", "n", "node"), "join-documents")
    common = common_table(profile)
    postings = documents.agg(F.sum("n")).first()[0] or 0
    found = cells(profile, rule, common, buckets_for(docs, postings * (1 - rule.percent / 100), POSTED))

    discard(profile)
    own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "rid")
    nodes = documents.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least_id"), F.min(own).alias("first"))
    # f: cells of a set that others share; two sets share no more cells than either has. central: sets met in them.
    every, found = found, stored(found.join(distinct_cells(found), "cell"), "join-distinct-cells")
    discard(every)
    inside = stored(found.groupBy("node").agg(
        F.first("n").alias("n"), F.sum("weight").alias("f"), F.sum(F.col("weight") * (F.col("size") - 1)).alias("central")
    ), "join-nodes")
    nowhere = F.array().cast("array<struct<pivot:binary,distance:double>>")
    labels = inside.select("node", "n", "f", "central", F.col("node").alias("label"), nowhere.alias("reached"))
    tried = labels.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).cast("bigint").alias("both"), F.lit(1).cast("bigint").alias("either")).limit(0)
    members = stored(crowded_cells(found, labels, rule), "join-members")
    in_order = F.pandas_udf(lambda texts: pd.Series([shingle_set(x, rule.width).tobytes() for x in texts]), "binary")
    # Only sets in crowded cells are ever compared.
    compared = inside.join(members.select("node").distinct(), "node", "left_semi")
    wanted = compared.join(nodes, "node").select("node", "n", F.col("first.rid").alias("rid"))
    whole = rows.frame.select(F.col(rows.row).alias("rid"), plain_text(text).alias("content"))
    sets = stored(whole.join(wanted, "rid").select("node", "n", in_order("content").alias("shingles")), "join-sets")
    for _ in range(ROUNDS):
        done = stored(overlaps(candidates(members, tried, rule), sets), "join-regions")
        if done.isEmpty():
            break
        at = F.struct(F.col("b").alias("pivot"), (1 - F.col("both") / F.col("either")).alias("distance"))
        regions = done.select(F.col("a").alias("node"), F.array(at).alias("at"))
        # A pivot is no way from itself.
        centres = done.select(F.col("b").alias("node")).distinct().select(
            "node", F.array(F.struct(F.col("node").alias("pivot"), F.lit(0.0).alias("distance"))).alias("here")
        )
        labels = relabelled(labels, linked(done, rule)).join(regions, "node", "left").join(centres, "node", "left").select(
            "node", "n", "f", "central", "label",
            F.concat("reached", F.coalesce("at", nowhere), F.coalesce("here", nowhere)).alias("reached"),
        )
        labels = stored(labels, "join-labels")
        tried = tried.unionByName(done)
        members = stored(crowded_cells(members, labels, rule), "join-members")
    near = stored(nearby(homes(members), sets, rule), "join-near")
    regions = stored(differences(near, sets, rule), "join-homes")
    labels = stored(relabelled(labels, linked(regions, rule)), "join-labels")
    # Only sets nearer than twice the radius can link with what links with the centre; the others are on their own.
    regions = regions.where("only is not null")
    within = stored(links_within(regions, labels, rule), "join-within")
    home = regions.select(F.col("a").alias("node"), F.col("b").alias("home"))
    left = members.select("cell", "weight", "node").join(labels.join(home, "node", "left").withColumn("home", F.coalesce("home", "node")), "node")
    rest = boundary_pairs(left, tried, rule)
    met = stored(overlaps(rest, sets), "join-boundary")
    links = linked(tried, rule).select("a", "b").unionByName(linked(regions, rule).select("a", "b"))
    links = links.unionByName(within.select("a", "b")).unionByName(linked(met, rule).select("a", "b"))
    roots = components(links.select("a", "b"))
    discard(sets, found)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    tops = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.min("first").alias("first"))
    named = rooted.select("node", "root").join(tops, "root").select("node", "component_id", "first")
    alone = documents.where("n = 0").select(
        "rid", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), own.alias("first")
    )
    together = documents.where("n > 0").join(named, "node").select(
        "rid", "doc_id", F.col("n").alias("n_shingles"), "component_id", "first"
    )
    return rows, together.unionByName(alone)


def keep_one(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without all but the first of each group of near duplicates."""
    rows, joined = join(docs, identifier, text)
    kept = joined.where("rid = first.rid").select(F.col("rid").alias(rows.row))
    return rows.frame.join(kept, rows.row, "left_semi").select(*rows.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join(spark.read.parquet(f"{sf_dir}/documents.parquet"))[1]
    return joined.select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE texts AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, list_sort(list_distinct(list_transform(
        range(1, CASE WHEN len(words) = 0 THEN 1 ELSE greatest(len(words) - 4, 1) + 1 END),
        lambda k: array_to_string(words[k:k + 4], ' ')))) AS shingles
    FROM texts
), nodes AS MATERIALIZED (
    SELECT row_number() OVER () AS node, shingles, len(shingles) AS n, min(doc_id) AS least
    FROM sets WHERE len(shingles) > 0 GROUP BY shingles
), flat AS MATERIALIZED (
    SELECT node, n, md5_number_lower(unnest(shingles)) AS shingle FROM nodes
), pairs AS (
    SELECT x.node AS a, y.node AS b FROM flat x JOIN flat y USING (shingle)
    WHERE x.node < y.node AND 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)
    GROUP BY x.node, y.node, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), links AS MATERIALIZED (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached(node, other) AS (
    SELECT node, node FROM nodes UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other
), named AS (
    SELECT r.node, min(o.least) AS component_id FROM reached r JOIN nodes o ON o.node = r.other GROUP BY r.node
)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(g.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN nodes o ON o.shingles = s.shingles LEFT JOIN named g ON g.node = o.node
"""
