"""A quality classifier as a sparse ensemble of rules.

Statistics of a text count its bytes by class, over the whole text. Shallow trees of a
random forest, fitted on them, give paths; each path is a rule, a conjunction of
comparisons. A logistic model with a lasso penalty weighs the rules and leaves
most at zero. What remains is compiled into one Spark expression over the statistics,
which scores any frame with a text column without a join or a shuffle.

* Null texts count as empty; empty texts get a score like any other.
* Labels, language, source and identifier are never read by the expression.
* Null labels and labels of unknown documents are left out. With no labels, or of
  one class only, the score is the smoothed share of that class.
* Fitting takes at most `fit_rows` labelled rows, those of the least hashes of
  their identifiers; the statistics of all documents and all scores are whole.
* Repeated rows are scored alike. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice
from math import log
from operator import eq

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import fresh, plain_text, ship, stored


# Classes of bytes.
SPACE, LOWER, UPPER, DIGIT, SYMBOL, MARK, BEYOND, CONTROL = range(8)
CLASSES = np.full(256, CONTROL, np.uint8)
CLASSES[128:] = BEYOND
for _kind, _bytes in [
    (SPACE, b" \t\n\v\f\r"), (LOWER, bytes(range(97, 123))), (UPPER, bytes(range(65, 91))), (DIGIT, bytes(range(48, 58))),
    (SYMBOL, b"#$%&*+<=>@\\^_`{|}~"), (MARK, b"!\"'(),-./:;?[]"),
]:
    CLASSES[list(_bytes)] = _kind

NAMES = (
    "words", "word_length", "line_length", "capitals", "capital_words", "digits", "symbols", "bars", "exclamations",
    "sentence_ends", "doubled_marks", "repeated_lines", "controls", "stutter",
)


def measure(text: str) -> tuple[float, ...]:
    """The statistics of a whole text, in the order of their names."""
    content = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    often = np.bincount(content, minlength=256)
    kinds = CLASSES[content]
    by_kind = np.bincount(CLASSES, weights=often, minlength=8)
    upper = kinds == UPPER
    tokens, lines = content.tobytes().split(), text.split("\n")
    words = len(tokens)
    pairs = upper[1:] & upper[:-1]
    shouted = int(np.count_nonzero(pairs[1:] & ~pairs[:-1])) + int(len(pairs) > 0 and pairs[0])
    ends = (content[1:] == ord(".")) | (content[1:] == ord("?"))
    ended = np.count_nonzero(ends & ((kinds[:-1] == LOWER) | (kinds[:-1] == BEYOND)))
    doubled = np.count_nonzero((content[1:] == content[:-1]) & ((kinds[1:] == SYMBOL) | (kinds[1:] == MARK)))
    per_word, per_char = 1 / max(words, 1), 1 / max(len(text), 1)
    return (
        float(np.log1p(words)), len(text) * per_word, float(np.log1p(len(text) / len(lines))),
        by_kind[UPPER] * per_char, shouted * per_word, by_kind[DIGIT] * per_char, by_kind[SYMBOL] * per_word,
        often[ord("|")] * per_word, often[ord("!")] * per_word, ended * per_word, doubled * per_word,
        1 - len(set(lines)) / len(lines), by_kind[CONTROL] * per_char,
        sum(map(eq, tokens, islice(tokens, 1, None))) * per_word,
    )


def statistics(text: str) -> Column:
    """A struct of the statistics of a text column; a task holds one text's arrays at a time."""

    @F.pandas_udf(", ".join(f"{name} double" for name in NAMES))
    def measured_batch(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(content) for content in texts], columns=list(NAMES), dtype="float64")

    return measured_batch(plain_text(text))


#: A comparison: statistic, whether it must be at most the bound, bound.
Test = tuple[str, bool, float]


@dataclass(frozen=True)
class Rules:
    """An intercept and weighted rules; each rule is a tuple of comparisons that must all hold."""

    intercept: float
    weighted: tuple[tuple[tuple[Test, ...], float], ...] = ()

    def score(self, values: dict[str, Column]) -> Column:
        """The probability of label 1 as one expression over the statistics."""
        margin = F.lit(self.intercept)
        for rule, weight in self.weighted:
            margin = margin + F.when(holds(rule, values), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-margin))


def holds(rule: tuple[Test, ...], values: dict[str, Column]) -> Column:
    tests = [values[name] <= bound if most else values[name] > bound for name, most, bound in rule]
    condition = tests[0]
    for test in tests[1:]:
        condition = condition & test
    return condition


def paths(model, names: list[str]) -> list[tuple[Test, ...]]:
    """Every path from a root to another node of the forest, shortened to its tightest bounds."""
    found: set[tuple[Test, ...]] = set()

    def walk(node, tests: dict[tuple[str, bool], float]) -> None:
        if tests:
            found.add(tuple(sorted((name, most, bound) for (name, most), bound in tests.items())))
        if node.numDescendants() == 0:
            return
        split = node.split()
        name, bound = names[split.featureIndex()], float(split.threshold())
        least = tests.get((name, True), bound)
        walk(node.leftChild(), tests | {(name, True): min(bound, least)})
        walk(node.rightChild(), tests | {(name, False): max(bound, tests.get((name, False), bound))})

    for tree in model.trees:
        walk(tree._call_java("rootNode"), {})
    return sorted(found)


def fit(sample: DataFrame, names: list[str], trees: int = 20, depth: int = 3, penalty: float = 0.0005, seed: int = 7) -> Rules:
    """Rules from a bounded sample with the statistics and a label 0 or 1."""
    counts = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    good, bad = counts.get(1.0, 0), counts.get(0.0, 0)
    if not good or not bad:
        return Rules(log((good + 1) / (bad + 1)))
    vectors = sample.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5, subsamplingRate=0.7)
    rules = paths(forest.fit(vectors), names)
    if not rules:
        return Rules(log((good + 1) / (bad + 1)))
    values = {name: F.col(name) for name in names}
    indicators = [holds(rule, values).cast("double") for rule in rules]
    rows = stored(sample.select("label", F.array(*indicators).alias("rules")), "quality-rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60)
    model = lasso.fit(rows.select("label", array_to_vector("rules").alias("features")))
    weights = zip(rules, model.coefficients.toArray().tolist(), strict=True)
    return Rules(float(model.intercept), tuple((rule, weight) for rule, weight in weights if weight))


def held_out(identifier: str) -> Column:
    """Whether labels of these documents are never learned from."""
    digest = F.crc32(F.encode(F.col(identifier).cast("string"), "UTF-8"))
    return F.coalesce(digest % 3 == 1, F.lit(False))


def measured(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the statistics of every document, stored."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(identifier).alias("doc_id"), statistics(text).alias("statistics"))
    return stored(rows.select("doc_id", "statistics.*"), "quality-statistics")


def train(features: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = 20_000) -> Rules:
    """Rules learned from the labels of documents that are not held out."""
    names = list(NAMES)
    known = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("double").alias("label"))
    known = known.where(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows)
    sample = stored(features.join(known, "doc_id").select("label", *names), "quality-sample")
    return fit(sample, names)


def scored(features: DataFrame, rules: Rules) -> DataFrame:
    """doc_id, held_out, score and predicted of measured documents."""
    score = rules.score({name: F.col(name) for name in features.columns if name != "doc_id"})
    rows = features.select("doc_id", held_out("doc_id").alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, rules: Rules, text: str = "text") -> DataFrame:
    """The documents that score at least 0.5."""
    ship(docs.sparkSession)
    found = fresh(docs.columns, "_statistics")
    values = {name: F.col(found).getField(name) for name in NAMES}
    return docs.withColumn(found, statistics(text)).where(rules.score(values) >= 0.5).drop(found)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = measured(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored(features, train(features, spark.read.parquet(f"{sf_dir}/labels.parquet")))
