"""Quality rules, suites, reports and the gate on the given data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators.membership import orphan_rows
from tierlake.plans.gold import task_metrics, user_profile
from tierlake.plans.medallion import Lake
from tierlake.quality import report, rulesets
from tierlake.quality.gate import outcome
from tierlake.quality.suite import Suite
from tierlake.queries import sql, tables
from tierlake.queries.gold import profile
from tierlake.queries.tables import RUN, table
from tierlake.sources import sinks
from tierlake.sources.scratch import scratch_folder


def _numbers(results: DataFrame) -> DataFrame:
    return results.drop("details")


def _with_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = task_metrics(tables.todos(spark, sf_dir))
    return tables.users(spark, sf_dir).join(metrics, "user_id", "left")


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users without tasks give real nulls; a column that is not there fails."""
    suite = Suite("users", "SILVER").not_null(["user_id", "total_tasks"]).not_null(["no_such"], "WARNING")
    results = suite.evaluate(_with_tasks(spark, sf_dir))
    share = F.regexp_extract("details", r"\((.*)%\)", 1)
    return results.select("check", "status", "failing", F.nullif(share, F.lit("")).try_cast("double").alias("pct"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of one result of every kind."""
    customer = table(spark, sf_dir, "customer")
    suite = (
        Suite("users", "SILVER")
        .row_count(5)
        .not_null(["total_tasks"])
        .unique(["addr_city"])
        .regex("email", rulesets.EMAIL, "email in the {rows} form")
        .in_range("geo_lat", -90, 90)
        .references("total_tasks", customer, "c_custkey")
    )
    return suite.evaluate(_with_tasks(spark, sf_dir)).select("check", "details")


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One minimum that any table here reaches and one that none does."""
    users = table(spark, sf_dir, "customer")
    enough = Suite("customer", "SILVER").row_count(5)
    return _numbers(enough.row_count(10**12, "WARNING").evaluate(users))


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = Suite("documents", "SILVER").unique(["text", "doc_id", "no_such"])
    keys = Suite("customer", "SILVER").unique(["c_custkey"])
    results = texts.evaluate(table(spark, sf_dir, "documents"))
    return _numbers(results.union(keys.evaluate(table(spark, sf_dir, "customer"))))


def regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = Suite("customer", "SILVER").regex("c_name", r"^Customer#\d{9}$", "customer number")
    names = names.regex("c_mktsegment", "BUILD", "starts with BUILD", "ERROR")
    urls = Suite("pages", "SILVER").regex("url", "^https?://", "web address").regex("url", "https", "secure")
    results = names.evaluate(table(spark, sf_dir, "customer"))
    return _numbers(results.union(urls.evaluate(table(spark, sf_dir, "pages"))))


def in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    suite = (
        Suite("customer", "SILVER")
        .in_range("c_acctbal", 0)
        .in_range("c_acctbal", -500, 5000, "ERROR")
        .in_range("c_nationkey", 0, 24)
        .in_range("no_such", 0)
    )
    return _numbers(suite.evaluate(table(spark, sf_dir, "customer")))


def referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions, and a key column with nulls, which are orphans."""
    customer, events = table(spark, sf_dir, "customer"), table(spark, sf_dir, "events")
    optional = events.withColumn("payer", F.when(F.col("event_type") == "purchase", F.col("user_id")))
    up = Suite("events", "SILVER").references("user_id", customer, "c_custkey")
    up = up.references("payer", customer, "c_custkey", "WARNING")
    down = Suite("customer", "SILVER").references("c_custkey", events, "user_id")
    return _numbers(up.evaluate(optional).union(down.evaluate(customer)))


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers without an event, as rows."""
    customer, events = table(spark, sf_dir, "customer"), table(spark, sf_dir, "events")
    return orphan_rows(customer, "c_custkey", events, "user_id").select("c_custkey", "c_name")


SUITES = {
    "users": lambda spark, sf_dir: (rulesets.users_silver(), tables.users(spark, sf_dir)),
    "posts": lambda spark, sf_dir: (
        rulesets.posts_silver(tables.users(spark, sf_dir)), tables.posts(spark, sf_dir)
    ),
    "profile": lambda spark, sf_dir: (rulesets.profile_gold(), profile(spark, sf_dir)),
}


def suite_results(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        suite, df = SUITES[name](spark, sf_dir)
        return _numbers(suite.evaluate(df))

    return query


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of the suites on stored tables, as a run makes them."""
    lake = Lake(spark, scratch_folder(spark, "suites"))
    users, posts, todos = (
        lake.write(make(spark, sf_dir), "silver", name)
        for name, make in [("users", tables.users), ("posts", tables.posts), ("todos", tables.todos)]
    )
    profile = lake.write(user_profile(users, posts, todos, RUN), "gold", "user_profile")
    evaluated = [
        (rulesets.users_silver(), users), (rulesets.posts_silver(users), posts), (rulesets.profile_gold(), profile),
    ]
    return report.union_reports(
        report.report(suite.evaluate(df), suite.entity, suite.layer, RUN) for suite, df in evaluated
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports stored as JSON and read back, a row per check."""
    path = scratch_folder(spark, "reports")
    sinks.write_reports(_reports(spark, sf_dir), path)
    stored = report.read_reports(spark, path)
    checks = F.posexplode("checks").alias("place", "found")
    return stored.select("entity", "layer", "score", "timestamp", checks).select(
        "entity", "layer", "score", "timestamp", "place",
        F.col("found.check").alias("check"), "found.status", "found.failing",
    )


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.summary(_reports(spark, sf_dir))


GATES = {
    "passes": [
        {"tipo": "min_count", "valor": 1},
        {"tipo": "not_null", "coluna": "c_custkey"},
        {"tipo": "unique", "coluna": "c_custkey"},
    ],
    "warns": [
        {"tipo": "not_null", "coluna": "c_custkey"},
        {"tipo": "unique", "coluna": "c_mktsegment", "critico": False},
    ],
    "stops": [
        {"tipo": "not_null", "coluna": "c_custkey"},
        {"tipo": "unique", "coluna": "c_nationkey"},
        {"tipo": "not_null", "coluna": "no_such"},
        {"tipo": "no_such_kind", "coluna": "c_custkey"},
    ],
}


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    outcomes = [
        outcome(rulesets.bronze("customer", checks).evaluate(customer)).withColumn("gate", F.lit(name))
        for name, checks in GATES.items()
    ]
    return reduce(DataFrame.unionByName, outcomes)


QUERIES = {
    "dq_not_null": not_null,
    "dq_messages": messages,
    "dq_row_count": row_count,
    "dq_unique": unique,
    "dq_regex": regex,
    "dq_range": in_range,
    "dq_referential": referential,
    "orphan_rows": orphans,
    "dq_suite_users": suite_results("users"),
    "dq_suite_posts": suite_results("posts"),
    "dq_suite_profile": suite_results("profile"),
    "dq_report": reports,
    "dq_summary": summary,
    "dq_gate": gate,
}

_C, _U, _V, _K = "COMPLETENESS", "UNIQUENESS", "VALIDITY", "CONSISTENCY"


def _unmatched(name: str, column: str, pattern: str) -> str:
    return f"SELECT count(*) FROM {name} WHERE NOT regexp_matches({column}, '{pattern}')"


USERS_SUITE = sql.suite("users", "SILVER", [
    (0, "row_count", _C, "ERROR", sql.shortfall("users", 5)),
    *[(1 + i, f"not_null:{c}", _C, "ERROR", sql.nulls("users", c))
      for i, c in enumerate(["user_id", "name", "email", "username"])],
    (5, "unique:user_id", _U, "ERROR", sql.duplicates("users", "user_id")),
    (6, "unique:email", _U, "ERROR", sql.duplicates("users", "email")),
    (7, "regex:email", _V, "WARNING", _unmatched("users", "email", rulesets.EMAIL)),
    (8, "range:geo_lat", _V, "WARNING", sql.outside("users", "geo_lat", -90, 90)),
    (9, "range:geo_lng", _V, "WARNING", sql.outside("users", "geo_lng", -180, 180)),
])
POSTS_SUITE = sql.suite("posts", "SILVER", [
    (0, "row_count", _C, "ERROR", sql.shortfall("posts", 50)),
    *[(1 + i, f"not_null:{c}", _C, "ERROR", sql.nulls("posts", c))
      for i, c in enumerate(["post_id", "user_id", "title"])],
    (4, "unique:post_id", _U, "ERROR", sql.duplicates("posts", "post_id")),
    (5, "referential:user_id→user_id", _K, "ERROR", sql.orphans("posts", "user_id", "users", "user_id")),
    (6, "range:title_word_count", _V, "WARNING", sql.outside("posts", "title_word_count", 1, 50)),
])
PROFILE_SUITE = sql.suite("user_profile", "GOLD", [
    *[(i, f"not_null:{c}", _C, "ERROR", sql.nulls("profile", c))
      for i, c in enumerate(["user_id", "name", "email", "total_posts", "total_tasks"])],
    (5, "unique:user_id", _U, "ERROR", sql.duplicates("profile", "user_id")),
    (6, "range:completion_rate_pct", _V, "WARNING", sql.outside("profile", "completion_rate_pct", 0, 100)),
    (7, "range:total_posts", _V, "WARNING", sql.outside("profile", "total_posts", 0, None)),
])

_RESULTS = (
    f"{sql.WITH_PROFILE}, results AS"
    f" ({USERS_SUITE} UNION ALL BY NAME {POSTS_SUITE} UNION ALL BY NAME {PROFILE_SUITE})"
)
_SCORE = sql.half_even("CAST(count(*) FILTER (WHERE status = 'PASS') AS DOUBLE) / count(*) * 100", 1)
_SUMMARY = f"""SELECT entity, layer, score,
       CASE WHEN score >= 80 THEN 'GREEN' WHEN score >= 60 THEN 'YELLOW' ELSE 'RED' END AS band,
       passed, failed, warnings
FROM (SELECT entity, layer, {_SCORE} AS score, count(*) FILTER (WHERE status = 'PASS') AS passed,
             count(*) FILTER (WHERE status = 'FAIL') AS failed,
             count(*) FILTER (WHERE status = 'WARN') AS warnings
      FROM results GROUP BY entity, layer)"""

_TASKED = f"""WITH {sql.USERS}, {sql.TODOS}, tasked AS (
  SELECT users.*, total_tasks FROM users LEFT JOIN
    (SELECT user_id, count(*) AS total_tasks FROM todos GROUP BY user_id) t USING (user_id))"""


def _message(check: str, details: str, failing: str) -> str:
    return f"SELECT '{check}' AS \"check\", {details} AS details FROM ({failing}) AS measured(n)"


ORACLES = {
    "dq_messages": _TASKED + " UNION ALL ".join([
        _message("row_count", "n || ' rows (minimum 5)'", "SELECT count(*) FROM tasked"),
        _message(
            "not_null:total_tasks",
            "printf('%d nulls (%.1f%%)', n, round_even(CAST(n AS DOUBLE) / (SELECT count(*) FROM tasked) * 1000, 0) / 10)",
            sql.nulls("tasked", "total_tasks"),
        ),
        _message("unique:addr_city", "n || ' duplicates'", sql.duplicates("tasked", "addr_city")),
        _message("regex:email", "n || ' not valid (email in the {rows} form)'", _unmatched("tasked", "email", rulesets.EMAIL)),
        _message("range:geo_lat", "n || ' outside [-90, 90]'", sql.outside("tasked", "geo_lat", -90, 90)),
        _message(
            "referential:total_tasks→c_custkey", "n || ' orphans'",
            sql.orphans("tasked", "total_tasks", "customer", "c_custkey"),
        ),
    ]),
    "dq_not_null": f"""{_TASKED}
SELECT 'not_null:user_id' AS "check", 'PASS' AS status, CAST(0 AS BIGINT) AS failing, CAST(0 AS DOUBLE) AS pct
UNION ALL
SELECT 'not_null:total_tasks', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n,
       {sql.half_even('CAST(n AS DOUBLE) / total * 100', 1)}
FROM (SELECT count(*) FILTER (WHERE total_tasks IS NULL) AS n, count(*) AS total FROM tasked)
UNION ALL SELECT 'not_null:no_such', 'WARN', NULL, NULL""",
    "dq_row_count": sql.suite("customer", "SILVER", [
        (0, "row_count", _C, "ERROR", sql.shortfall("customer", 5)),
        (1, "row_count", _C, "WARNING", sql.shortfall("customer", 10**12)),
    ]),
    "dq_unique": sql.suite("documents", "SILVER", [
        (0, "unique:text", _U, "ERROR", sql.duplicates("documents", "text")),
        (1, "unique:doc_id", _U, "ERROR", sql.duplicates("documents", "doc_id")),
    ]) + " UNION ALL BY NAME " + sql.suite("customer", "SILVER", [
        (0, "unique:c_custkey", _U, "ERROR", sql.duplicates("customer", "c_custkey")),
    ]),
    "dq_regex": sql.suite("customer", "SILVER", [
        (0, "regex:c_name", _V, "WARNING", _unmatched("customer", "c_name", "^Customer#\\d{9}$")),
        (1, "regex:c_mktsegment", _V, "ERROR", _unmatched("customer", "c_mktsegment", "^BUILD")),
    ]) + " UNION ALL BY NAME " + sql.suite("pages", "SILVER", [
        (0, "regex:url", _V, "WARNING", _unmatched("pages", "url", "^https?://")),
        (1, "regex:url", _V, "WARNING", _unmatched("pages", "url", "^https")),
    ]),
    "dq_range": sql.suite("customer", "SILVER", [
        (0, "range:c_acctbal", _V, "WARNING", sql.outside("customer", "c_acctbal", 0, None)),
        (1, "range:c_acctbal", _V, "ERROR", sql.outside("customer", "c_acctbal", -500, 5000)),
        (2, "range:c_nationkey", _V, "WARNING", sql.outside("customer", "c_nationkey", 0, 24)),
    ]),
    "dq_referential": sql.suite("events", "SILVER", [
        (0, "referential:user_id→c_custkey", _K, "ERROR", sql.orphans("events", "user_id", "customer", "c_custkey")),
        (1, "referential:payer→c_custkey", _K, "WARNING",
         "SELECT count(*) FROM events c WHERE event_type <> 'purchase' OR NOT EXISTS"
         " (SELECT 1 FROM customer WHERE c_custkey = c.user_id)"),
    ]) + " UNION ALL BY NAME " + sql.suite("customer", "SILVER", [
        (0, "referential:c_custkey→user_id", _K, "ERROR", sql.orphans("customer", "c_custkey", "events", "user_id")),
    ]),
    "orphan_rows": """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
    "dq_suite_users": f"WITH {sql.USERS} {USERS_SUITE}",
    "dq_suite_posts": f"WITH {sql.USERS},{sql.POSTS} {POSTS_SUITE}",
    "dq_suite_profile": f"{sql.WITH_PROFILE} {PROFILE_SUITE}",
    "dq_report": f"""{_RESULTS}
SELECT entity, layer, score, '2024-02-03T04:05:06+00:00' AS timestamp, position AS place, "check", status, failing
FROM results JOIN ({_SUMMARY}) USING (entity, layer)""",
    "dq_summary": f"{_RESULTS} {_SUMMARY}",
    "full_run_summary": f"{_RESULTS} {_SUMMARY}",
    "dq_gate": """
WITH dup AS (SELECT count(*) - count(DISTINCT c_custkey) AS k, count(*) - count(DISTINCT c_mktsegment) AS m,
                    count(*) - count(DISTINCT c_nationkey) AS n, count(*) AS total FROM customer),
cases AS (
  SELECT 'passes' AS gate, 3 AS checks, (total >= 1)::INT + 1 + (k = 0)::INT AS passed,
         (total < 1)::INT + (k > 0)::INT AS critical FROM dup
  UNION ALL SELECT 'warns', 2, 1 + (m = 0)::INT, 0 FROM dup
  UNION ALL SELECT 'stops', 4, 1 + (n = 0)::INT, 2 + (n > 0)::INT FROM dup)
SELECT gate, round_even(CAST(passed AS DOUBLE) / checks * 100 * 10, 0) / 10 AS score,
       CAST(passed AS BIGINT) AS passed, CAST(checks - passed AS BIGINT) AS failed,
       CAST(critical AS BIGINT) AS critical, critical > 0 AS blocked
FROM cases""",
}
