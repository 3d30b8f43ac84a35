"""Silver: typed, cleaned, deduplicated entities.

Rows are deduplicated before they are cleaned: the key is not changed by
cleaning, the shuffle then carries no derived columns, and dropped rows are
never cleaned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.functions import text
from tierlake.functions.numbers import number_or_null, strict_long, true_or_false
from tierlake.operators.columns import expand_nested, present, with_process_stamp
from tierlake.operators.dedup import keep_first
from tierlake.run import RunInfo
from tierlake.sources.entities import POSITION

LINEAGE = ("_ingestion_timestamp", "_source_system", "_record_hash")

# Readable task status.
TASK_STATUS = {True: "COMPLETED", False: "PENDING"}


def first_landed(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First row per key as it stood in the files, where bronze recorded that."""
    position = present(bronze, POSITION)
    return keep_first(bronze, keys, position if len(position) == len(POSITION) else None)


def silver_users(bronze: DataFrame, run: RunInfo) -> DataFrame:
    """Users from nested records, or from records flattened in bronze."""
    users = first_landed(bronze, ["id"])
    users = expand_nested(users, "address", "addr_", separators=".")
    users = expand_nested(users, "company", "company_", separators=" ")
    nested = [c for c in users.columns if c.startswith(("addr_", "company_"))]
    users = users.select(
        "id", "name", "username", "email", "phone", "website",
        *present(users, LINEAGE), *[F.col(f"`{c}`") for c in nested],
    )
    users = users.withColumns(
        {
            "email": F.lower(text.strip(F.col("email"))),
            "username": F.lower(text.strip(F.col("username"))),
            "name": text.title_case(text.strip(F.col("name"))),
            "phone": text.clean_phone(F.col("phone")),
            "id": strict_long(F.col("id")),
            "addr_geo_lat": number_or_null(F.col("addr_geo_lat")),
            "addr_geo_lng": number_or_null(F.col("addr_geo_lng")),
        }
    )
    users = users.withColumnsRenamed(
        {"id": "user_id", "addr_geo_lat": "geo_lat", "addr_geo_lng": "geo_lng"}
    )
    return with_process_stamp(users, "silver", run, version=True)


def silver_posts(bronze: DataFrame, run: RunInfo) -> DataFrame:
    """Posts with cleaned text, word counts and body length."""
    posts = first_landed(bronze, ["id"]).select(
        strict_long(F.col("userId")).alias("user_id"),
        strict_long(F.col("id")).alias("post_id"),
        text.title_case(text.strip(F.col("title"))).alias("title"),
        text.replace_text(text.strip(F.col("body")), "\n", " ").alias("body"),
        *present(bronze, LINEAGE),
    )
    posts = posts.withColumns(
        {
            "title_word_count": text.word_count(F.col("title")),
            "body_word_count": text.word_count(F.col("body")),
            "body_length": text.length(F.col("body")),
        }
    )
    return with_process_stamp(posts, "silver", run)


def silver_todos(bronze: DataFrame, run: RunInfo, dedup_on: Sequence[str] = ()) -> DataFrame:
    """Tasks with a readable status; repeated records stay unless keys are given.

    A task without ``completed`` has no status and counts as not completed.
    """
    todos = first_landed(bronze, dedup_on) if dedup_on else bronze
    todos = todos.select(
        strict_long(F.col("userId")).alias("user_id"),
        strict_long(F.col("id")).alias("todo_id"),
        text.title_case(text.strip(F.col("title"))).alias("title"),
        true_or_false(F.col("completed")).alias("completed"),
        *present(bronze, LINEAGE),
        text.map_values(F.col("completed"), TASK_STATUS).alias("status"),
    )
    return with_process_stamp(todos, "silver", run)
