"""Mixing sources to target sizes by entropy balancing.

The mix takes document i at a rate r_i that is as close to 1 as it can be in
relative entropy while every source's words add up to its target and no rate is
above `most`. The dual has one multiplier per source and the rates are tilted
exponentially: r_i = min(most, exp(lambda * size_i / mean size)). Newton steps on
the logarithm of the source's words find the multipliers, safeguarded by a
bracket, over a table of distinct (source, size) pairs with their counts. Rates
then become whole copies by systematic rounding along the documents of a source
in order of size, so rounding errors cancel between documents of like size; of
PHASES starting points each source takes the one that meets its target best.

* A null source is a source of its own. Documents without words have rate 1.
* Targets: a source's weight decides its share of the wanted size; a source stops
  at `most` times its size and the rest is shared again by weight.
* Ties in size are ordered by a hash of the identifier, then by file and row: the
  same files give the same copies, repeated rows are rows of their own.
* An empty table gives an empty table; other columns are not read.

Tables with a row per source (the catalogue) are handled by one task where they
are ordered; documents never are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import WORD, Located, fresh, located, plain_text, ranked, stored

# Fixed values of the recipe: weights of the sources in order, share of all words, repeats.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
PHASES = 64


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """number, source, source_size, mean and target of each source of the catalogue (source, source_size, mean)."""
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod("number", F.lit(len(weights))) + 1)
    table = sizes.withColumn("number", number).withColumn("weight", weight.cast("double"))
    table = table.withColumns({
        "cap": F.col("source_size") * float(most),
        "fill": F.col("source_size") * float(most) / F.col("weight"),
    })
    order = Window.orderBy("fill", "number")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    wanted = F.sum("source_size").over(everything) * share
    table = table.withColumn(
        "level", (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    )
    free = F.col("fill") > F.col("level")
    level = F.min_by(F.when(free, F.col("level")), F.when(free, F.struct("fill", "number"))).over(everything)
    return table.withColumn("shared", level).select(
        "number", "source", "source_size", "mean",
        F.when(free, F.least(F.col("cap"), F.col("weight") * F.col("shared"))).otherwise(F.col("cap")).alias("target"),
    )


def balance(classes: DataFrame, tolerance: float = 1e-9, steps: int = 80, most: float = MOST) -> DataFrame:
    """number and multiplier of each source, from classes (number, target, size, n, mean).

    A source's sizes are folded step by step within one plan, in ascending order. They are
    few: D distinct sizes need D * D / 2 words, so a source of 10^12 words has 1.5 million.
    """
    ceiling = math.log(most)
    sources = classes.groupBy("number").agg(
        F.first("target").alias("target"), F.first("mean").alias("mean"),
        F.sort_array(F.collect_list(F.struct("size", "n"))).alias("sizes"),
    )
    x = F.col("mean") / F.col("sizes")[0]["size"]
    start = F.struct(
        F.lit(0.0).alias("multiplier"), (-60 * x).alias("low"), (ceiling * x).alias("high"), F.lit(False).alias("done")
    )
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)), start,
        lambda state, _: F.when(state["done"], state).otherwise(newton_step(state, tolerance, ceiling)),
    )
    return sources.select("number", last["multiplier"].alias("multiplier"))


def newton_step(state: Column, tolerance: float, ceiling: float) -> Column:
    """The state (multiplier, low, high, done) after a safeguarded Newton step over a row's target, mean and sizes."""
    multiplier, target = state["multiplier"], F.col("target")

    def add(sums: Column, item: Column) -> Column:
        x = item["size"] / F.col("mean")
        words = item["n"] * item["size"] * F.exp(F.least(multiplier * x, F.lit(ceiling)))
        slope = F.when(multiplier * x < ceiling, words * x).otherwise(0.0)
        return F.struct((sums["words"] + words).alias("words"), (sums["slope"] + slope).alias("slope"))

    def moved(sums: Column) -> Column:
        words, slope = sums["words"], sums["slope"]
        low = F.when(words > target, state["low"]).otherwise(multiplier)
        high = F.when(words > target, multiplier).otherwise(state["high"])
        step = F.when((slope > 0) & (words > 0) & (target > 0), multiplier - F.ln(words / target) * words / slope)
        close = F.abs(words - target) <= tolerance * F.greatest(target, F.lit(1.0))
        narrow = (high - low) <= 1e-13 * F.greatest(F.abs(low), F.abs(high))
        inside = F.when((step > low) & (step < high), step).otherwise((low + high) / 2)
        return F.struct(
            F.when(close, multiplier).otherwise(inside).alias("multiplier"),
            low.alias("low"), high.alias("high"), (close | narrow).alias("done"),
        )

    return F.aggregate("sizes", F.struct(F.lit(0.0).alias("words"), F.lit(0.0).alias("slope")), add, moved)


def mix(
    docs: DataFrame, identifier: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """doc_id, size, source_size, target, copies, and the row's place (file, row)."""
    return mix_located(located(docs), identifier, text, source, weights, share, most)


def mix_located(
    rows: Located, identifier: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """The mix of rows whose places are known."""
    sized = stored(rows.frame.select(
        F.col(identifier).alias("doc_id"),
        F.col(source).alias("source"),
        F.regexp_count(plain_text(text), F.lit(WORD)).cast("long").alias("size"),
        F.col(rows.file).alias("file"),
        F.col(rows.row).alias("row"),
    ), "mixing-sizes")
    counts = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-classes")
    words, holders = F.sum(F.col("n") * F.col("size")), F.sum(F.when(F.col("size") > 0, F.col("n")))
    catalogue = stored(targets(
        counts.groupBy("source").agg(words.alias("source_size"), (words / holders).alias("mean")), weights, share, most
    ), "mixing-targets")
    classes = stored(counts.join(catalogue, counts["source"].eqNullSafe(catalogue["source"])).select(
        "number", counts["source"], "source_size", "target", "size", "n", "mean"
    ), "mixing-classes")
    multipliers = balance(classes.where("size > 0"), most=most)
    full = F.col("target") >= most * F.col("source_size")
    tilted = F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(math.log(most))))
    rate = F.when(F.col("size") == 0, 1.0).when(full, float(most)).otherwise(F.least(F.lit(float(most)), tilted))
    smaller = Window.partitionBy("number").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = classes.join(multipliers, "number", "left").withColumn("rate", rate)
    rated = rated.withColumn("expected", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(smaller), F.lit(0.0)))
    rated = stored(rated, "mixing-rates")
    rated = rated.join(phases(rated), "number").select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), "number", "source_size", "target", "rate",
        (F.col("expected") + F.col("phase")).alias("expected"),
    )
    joined = sized.join(rated, sized["source"].eqNullSafe(rated["_source"]) & (sized["size"] == rated["_size"]))
    joined = joined.drop("_source", "_size", "source").withColumn("draw", F.xxhash64("doc_id"))
    placed = ranked(joined, ["number", "size"], ["draw", "doc_id", "file", "row"], "rank", "mixing-ranks")
    return placed.withColumn("copies", upto(F.col("rank") + 1) - upto(F.col("rank")))


def upto(documents: Column) -> Column:
    """Whole copies of all smaller documents and the first so many of this size."""
    return F.floor(F.col("expected") + documents * F.col("rate"))


def phases(rated: DataFrame) -> DataFrame:
    """number and phase: where a source's rounding starts so that its words come nearest its target."""
    phase = F.explode(F.transform(F.sequence(F.lit(0), F.lit(PHASES - 1)), lambda k: k / float(PHASES)))
    tried = rated.where("size > 0").withColumn("phase", phase).withColumn("expected", F.col("expected") + F.col("phase"))
    words = F.col("size") * (upto(F.col("n")) - upto(F.lit(0)))
    tried = tried.groupBy("number", "phase").agg(F.sum(words).alias("words"), F.first("target").alias("target"))
    missed = F.struct(F.abs(F.col("words") - F.col("target")), "phase")
    best = tried.groupBy("number").agg(F.min_by("phase", missed).alias("phase"))
    empty = rated.groupBy("number").agg(F.lit(0.5).alias("half"))
    return empty.join(best, "number", "left").select("number", F.coalesce("phase", "half").alias("phase"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it."""
    rows = located(docs)
    taken = mix_located(rows, **options).where("copies > 0")
    copies = fresh([*rows.columns, rows.file, rows.row], "_copies")
    taken = taken.select(F.col("file").alias(rows.file), F.col("row").alias(rows.row), F.col("copies").alias(copies))
    repeated = rows.frame.join(taken, [rows.file, rows.row])
    again = fresh(repeated.columns, "_again")
    return repeated.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*rows.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )
