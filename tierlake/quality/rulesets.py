"""The rules of the shipped layers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierlake.quality.rules import rules_from_dicts
from tierlake.quality.suite import Suite

# The format of an e-mail address, and the rules and limits below.
EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"

BRONZE_CHECKS = {
    "users": [
        {"tipo": "min_count", "valor": 1},
        {"tipo": "not_null", "coluna": "id"},
        {"tipo": "not_null", "coluna": "email"},
    ],
    "posts": [
        {"tipo": "min_count", "valor": 1},
        {"tipo": "not_null", "coluna": "id"},
        {"tipo": "not_null", "coluna": "userId"},
    ],
    "todos": [
        {"tipo": "min_count", "valor": 1},
        {"tipo": "not_null", "coluna": "id"},
        {"tipo": "not_null", "coluna": "userId"},
    ],
}


def bronze(entity: str, checks: list[dict]) -> Suite:
    return Suite(entity, "BRONZE").having(*rules_from_dicts(checks))


def users_silver() -> Suite:
    return (
        Suite("users", "SILVER")
        .row_count(5)
        .not_null(["user_id", "name", "email", "username"])
        .unique(["user_id", "email"])
        .regex("email", EMAIL, "email format")
        .in_range("geo_lat", -90, 90)
        .in_range("geo_lng", -180, 180)
    )


def posts_silver(users: DataFrame) -> Suite:
    return (
        Suite("posts", "SILVER")
        .row_count(50)
        .not_null(["post_id", "user_id", "title"])
        .unique(["post_id"])
        .references("user_id", users, "user_id")
        .in_range("title_word_count", 1, 50)
    )


def profile_gold() -> Suite:
    return (
        Suite("user_profile", "GOLD")
        .not_null(["user_id", "name", "email", "total_posts", "total_tasks"])
        .unique(["user_id"])
        .in_range("completion_rate_pct", 0, 100)
        .in_range("total_posts", 0)
    )
