"""URL filter: given host rules first, then association rules mined by FP-growth.

A given rule is a host and a path, like `example.org/en/`; it fits that host and
its subdomains when the path starts with its path, and the longest fitting rule
decides. Other urls are judged by association rules: every labelled url is a basket
of its tokens (labels of the host, words in them, suffixes, path segments, query
keys) and of its class; FP-growth finds the sets of tokens that enough urls have.
Of the rules that imply `block` those are kept whose confidence is well above the
share of blocked urls, by more than chance explains among as many sets as were
looked at, and above that of any shorter rule inside them. They match by an
inverted index on the rarest token of each.

The support is a number of urls, so a rule needs as many of them in a large corpus
as in a small one. Tokens that the same labelled urls have are mined as one; tokens
that all of them have say nothing. A rule of one such token is spelled out for each of
its equals. A rule of several names one token of each class and tells which tokens
stand for it, so rules stay in proportion to the tokens.

* Null urls and urls without :// have an empty host and path, fit no given rule
  and have no tokens: they are allowed, as is any url that no rule blocks.
* Rules of equal length are ordered by host, then path. Repeated rows are judged
  alike. Without labels there are no mined rules. An empty table gives an empty
  table; other columns are not read.

A frequent set needs `least_rows` urls and a url has few tokens that differ, so the
sets grow with the corpus at most as the labelled urls do. They stay in the
cluster, as the classes of tokens do; only the rules that pass both bounds and the
classes in them reach the driver, and the single tokens that FP-growth itself counts.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import chain, combinations

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import ship, stored
from tierlake.llm.html_extract import host_of

# The given rules by verdict.
GIVEN = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
BLOCK = "=block"

#: Tokens, confidence, support, and by token the one of the rule it stands for.
Mined = tuple[frozenset[str], float, float, dict[str, str]]


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def given_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest of the rules that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule), rule)):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a url."""
    host, path = host_of(url), path_of(url)
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(host, r"\."), lambda part: part != "")
    count = F.size(parts)
    labels = F.transform(parts, lambda part: F.concat(F.lit("host:"), part))
    words = F.transform(F.filter(F.split(host, r"[.-]"), lambda word: word != ""), lambda word: F.concat(F.lit("word:"), word))
    suffix = F.when(count >= 2, F.array(F.concat(F.lit("site:"), F.array_join(F.slice(parts, F.greatest(count - 2, F.lit(1)), 3), ".")))).otherwise(F.array().cast("array<string>"))
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda part: part != ""),
        lambda part: F.concat(F.lit("path:"), F.regexp_replace(part, "[0-9]+", "0")),
    )
    keys = F.transform(
        F.filter(F.split(rest, "&"), lambda part: part != ""), lambda part: F.concat(F.lit("query:"), F.substring_index(part, "=", 1))
    )
    return F.array_distinct(F.concat(labels, words, suffix, segments, keys))


def token_classes(baskets: DataFrame, count: int, least_rows: int) -> DataFrame:
    """token and name: tokens of at least so many baskets (row, tokens), but not of all, named by the least token of the same baskets."""
    tokens = baskets.select(F.xxhash64("row").alias("row"), F.explode("tokens").alias("token"))
    vectors = tokens.groupBy("token").agg(F.bit_xor("row").alias("vector"), F.count("*").alias("n"))
    vectors = vectors.where((F.col("n") >= least_rows) & (F.col("n") < count))
    names = vectors.groupBy("vector", "n").agg(F.min("token").alias("name"))
    return stored(vectors.join(names, ["vector", "n"]).select("token", "name"), "url-classes")


def surprise(confidence: Column, rows: Column, base: float) -> Column:
    """The bound of Chernoff: chance gives this confidence over so many rows at most exp(-surprise) times."""
    missed = F.when(confidence < 1, (1 - confidence) * F.ln((1 - confidence) / (1 - base))).otherwise(0.0)
    return rows * (confidence * F.ln(confidence / base) + missed)


def mine(urls: DataFrame, least_rows: int = 25, least_lift: float = 1.5, chance: float = 0.05) -> list[Mined]:
    """Rules (tokens, confidence, support) that imply a block, from urls (tokens, blocked).

    A rule has its tokens in `least_rows` urls, `least_lift` times the confidence of
    the empty rule (or half of what that one misses, if less), and such rules come up
    by chance in a share `chance` of corpora at most.
    """
    labelled = urls.where("blocked is not null").where(F.size("tokens") > 0).select("tokens", "blocked")
    labelled = stored(labelled.withColumn("row", F.monotonically_increasing_id()), "url-baskets")
    count, blocked = labelled.agg(F.count("*"), F.count_if("blocked")).first()
    if count < least_rows or blocked in (0, count):
        return []
    base = blocked / count
    classes = token_classes(labelled, count, least_rows)
    if classes.isEmpty():
        return []
    named = classes.where("token = name").select("token")
    items = labelled.select("row", F.explode("tokens").alias("token")).join(named, "token")
    items = items.groupBy("row").agg(F.collect_list("token").alias("tokens"))
    baskets = items.join(labelled.select("row", "blocked"), "row").select(
        F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCK))).otherwise(F.col("tokens")).alias("items")
    )
    held = baskets.count()
    confidence = min(least_lift * base, (1 + base) / 2)
    # Half a basket less, so that rounding never asks for one more. A rule of least_rows urls may block fewer.
    support = (max(math.ceil(confidence * least_rows), 1) - 0.5) / held
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    tests = model.freqItemsets.where(~F.array_contains("items", BLOCK) & (F.col("freq") >= least_rows)).count()
    share = F.least(F.col("confidence"), F.lit(1.0))
    rows = F.col("support") * held / F.col("confidence")
    implied = model.associationRules.where(F.col("consequent") == F.array(F.lit(BLOCK)))
    implied = implied.where((rows > least_rows - 0.5) & (surprise(share, rows, base) >= math.log(max(tests, 1) / chance)))
    found = {
        frozenset(row["antecedent"]): (row["confidence"], row["support"] * held / count)
        for row in implied.select("antecedent", "confidence", "support").collect()
    }
    least = [
        (tokens, *figures) for tokens, figures in found.items()
        if not any(found.get(frozenset(part), (0.0,))[0] >= figures[0] for part in parts(tokens))
    ]
    return sorted(spelled_out(least, classes), key=lambda rule: (len(rule[0]), sorted(rule[0])))


def spelled_out(rules: list[tuple[frozenset[str], float, float]], classes: DataFrame) -> list[Mined]:
    """The rules of one class for each of its tokens, and the others with what stands for their tokens."""
    used = sorted({token for tokens, *_ in rules for token in tokens})
    if not used:
        return []
    wanted = classes.sparkSession.createDataFrame([(token,) for token in used], "name string")
    same: dict[str, list[str]] = defaultdict(list)
    for row in classes.join(wanted, "name").select("name", "token").collect():
        same[row.name].append(row.token)
    single = [(frozenset([token]), *figures, {}) for (name, *more), *figures in rules if not more for token in same[name]]
    several = [
        (tokens, *figures, {token: name for name in tokens for token in same[name] if token != name})
        for tokens, *figures in rules if len(tokens) > 1
    ]
    return single + several


def parts(tokens: frozenset[str]):
    """The smaller sets inside, without the empty one."""
    return chain.from_iterable(combinations(tokens, size) for size in range(1, len(tokens)))


def index(rules: list[Mined]) -> dict[str, list[frozenset[str]]]:
    """The rules by the token that the fewest of them have."""
    often: dict[str, int] = defaultdict(int)
    for tokens, *_ in rules:
        for token in tokens:
            often[token] += 1
    entries: dict[str, list[frozenset[str]]] = defaultdict(list)
    for tokens, *_ in rules:
        entries[min(tokens, key=lambda token: (often[token], token))].append(tokens)
    return dict(entries)


def blocked_by(rules: list[Mined]):
    """A function of a token array that says whether a mined rule fits."""
    entries = index(rules)
    # A token is in one class at most.
    stands_for = {token: name for _, _, _, *same in rules for names in same for token, name in names.items()}

    @F.pandas_udf("boolean")
    def fits(tokens: pd.Series) -> pd.Series:
        found = []
        for row in tokens:
            own = set(row)
            own.update([stands_for[token] for token in row if token in stands_for])
            found.append(any(rule <= own for token in own for rule in entries.get(token, ())))
        return pd.Series(found, dtype="bool")

    return fits


def judge(pages: DataFrame, mined: list[Mined], given: dict[str, str] = GIVEN, identifier: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(identifier).alias("page_id"), F.col(url).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("rule", given_rule(F.col("host"), F.col("path"), list(given)))
    own = F.element_at(F.create_map(*[F.lit(x) for pair in given.items() for x in pair]), F.col("rule"))
    fits = blocked_by(mined)(tokens_of(F.col("url"))) if mined else F.lit(False)
    learned = F.when(fits, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce(own, learned).alias("verdict"))


def document_of(url: Column) -> Column:
    """The number of the document a page shows, the last one in the path of its url; null without."""
    return F.regexp_extract(path_of(url), "([0-9]+)[^0-9]*$", 1).try_cast("bigint")


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tokens and blocked of the pages whose documents are labelled: low quality or toxic is to be blocked."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        "doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked")
    )
    return pages.select(document_of(F.col("url")).alias("doc_id"), tokens_of(F.col("url")).alias("tokens")).join(labels, "doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), mine(labelled_urls(spark, sf_dir)))
