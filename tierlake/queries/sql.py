"""Pieces of the SQL the queries are checked against."""

from __future__ import annotations

# Characters Python takes for whitespace, as a pattern class and
# as an expression that yields them in one string.
SPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
SPACES = "(" + " || ".join(f"chr({code})" for code in SPACE_CODES) + ")"


def strip(c: str) -> str:
    return f"trim({c}, {SPACES})"


def title(c: str) -> str:
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    first = "(CASE WHEN x[1] = 'ß' THEN 'Ss' ELSE upper(x[1]) END)"
    return (
        f"array_to_string(list_transform(regexp_extract_all({c}, '[{cased}]+|[^{cased}]+'),"
        f" lambda x: {first} || lower(x[2:])), '')"
    )


def words(c: str) -> str:
    return f"CAST(len(regexp_extract_all({c}, '[^{SPACE_CLASS}]+')) AS INTEGER)"


def half_even(x: str, places: int) -> str:
    scale = float(10**places)
    return f"round_even(CAST({x} AS DOUBLE) * {scale}, 0) / {scale}"


USERS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS name,
         lower(replace(c_name, '#', '.')) || (CASE WHEN c_acctbal < 0 THEN '.' ELSE '@' END)
           || lower(c_mktsegment) || '.com' AS email,
         lower(c_name) AS username, n_name AS addr_city,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS addr_zipcode,
         c_mktsegment AS company_name, c_acctbal / 100 AS geo_lat, c_acctbal / 50 AS geo_lng
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

POSTS = f"""
posts AS (
  SELECT o_custkey AS user_id, o_orderkey AS post_id, o_orderpriority AS title,
         {words('o_orderpriority')} AS title_word_count,
         length(o_orderstatus || ' ' || o_orderpriority) AS body_length
  FROM orders)"""

TODOS = """
todos AS (
  SELECT user_id, event_id AS todo_id, event_type <> 'error' AS completed FROM events)"""

PROFILE = f"""
posts_agg AS (
  SELECT user_id, count(post_id) AS total_posts,
         {half_even('avg(title_word_count)', 2)} AS avg_title_words,
         {half_even('avg(body_length)', 2)} AS avg_body_length
  FROM posts WHERE user_id IS NOT NULL GROUP BY user_id),
todos_agg AS (
  SELECT user_id, count(todo_id) AS total_tasks,
         count(*) FILTER (WHERE completed) AS completed_tasks,
         count(*) FILTER (WHERE NOT completed) AS pending_tasks,
         {half_even('CAST(count(*) FILTER (WHERE completed) AS DOUBLE) / count(todo_id) * 100', 1)}
           AS completion_rate_pct
  FROM todos WHERE user_id IS NOT NULL GROUP BY user_id),
profile AS (
  SELECT users.*, total_posts, avg_title_words, avg_body_length, total_tasks, completed_tasks,
         pending_tasks, completion_rate_pct,
         CASE WHEN completion_rate_pct >= 70 AND total_posts >= 10 THEN 'HIGH'
              WHEN completion_rate_pct >= 40 OR total_posts >= 5 THEN 'MEDIUM'
              ELSE 'LOW' END AS engagement_level
  FROM users LEFT JOIN posts_agg USING (user_id) LEFT JOIN todos_agg USING (user_id))"""

WITH_PROFILE = f"WITH {USERS},{POSTS},{TODOS},{PROFILE}"


def exact_mean(x: str, places: int) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28, {places}))) AS DOUBLE) / count({x})"


# One row of a suite: position, check, dimension, severity, SQL for the failing count.
SuiteRow = tuple[int, str, str, str, str]


def suite(entity: str, layer: str, rows: list[SuiteRow]) -> str:
    """The results a suite must give, without the messages."""
    parts = [
        f"SELECT '{entity}' AS entity, '{layer}' AS layer, {position} AS position, '{check}' AS \"check\","
        f" '{dimension}' AS dimension, '{severity}' AS severity, CAST(({failing}) AS BIGINT) AS failing"
        for position, check, dimension, severity, failing in rows
    ]
    status = (
        "CASE WHEN failing = 0 THEN 'PASS' WHEN severity = 'WARNING' THEN 'WARN' ELSE 'FAIL' END AS status"
    )
    return f"SELECT *, {status} FROM ({' UNION ALL '.join(parts)})"


def nulls(table: str, column: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"


def duplicates(table: str, column: str) -> str:
    return f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {table} GROUP BY {column})"


def shortfall(table: str, minimum: int) -> str:
    return f"SELECT greatest({minimum} - count(*), 0) FROM {table}"


def outside(table: str, column: str, low: float | None, high: float | None) -> str:
    tests = [f"{column} < {low}"] if low is not None else []
    tests += [f"{column} > {high}"] if high is not None else []
    return f"SELECT count(*) FROM {table} WHERE {' OR '.join(tests)}"


def orphans(child: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"SELECT count(*) FROM {child} c WHERE NOT EXISTS"
        f" (SELECT 1 FROM {parent} p WHERE p.{parent_column} IS NOT DISTINCT FROM c.{column})"
    )
