"""Gold: profiles, city analysis and KPIs.

Every table is reduced to its join key before it is joined, so a key with very
many rows is counted inside the map tasks and the joins see one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions.numbers import exact_mean, percent, round_half_even
from tierlake.operators.columns import with_process_stamp
from tierlake.run import RunInfo

PROFILE_USER_COLUMNS = (
    "user_id", "name", "email", "username", "addr_city", "addr_zipcode",
    "company_name", "geo_lat", "geo_lng",
)

# The engagement classes and their limits.
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"
HIGH_PCT, HIGH_POSTS = 70, 10
MEDIUM_PCT, MEDIUM_POSTS = 40, 5


def post_metrics(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("post_id").alias("total_posts"),
        round_half_even(F.avg("title_word_count"), 2).alias("avg_title_words"),
        round_half_even(F.avg("body_length"), 2).alias("avg_body_length"),
    )


def task_metrics(todos: DataFrame) -> DataFrame:
    counted = todos.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("todo_id").alias("total_tasks"),
        F.count_if("completed").alias("completed_tasks"),
        F.count_if(~F.col("completed")).alias("pending_tasks"),
    )
    rate = percent(F.col("completed_tasks"), F.col("total_tasks"))
    return counted.withColumn("completion_rate_pct", round_half_even(rate, 1))


def engagement_level(completion_pct: Column, posts: Column) -> Column:
    """A user without tasks or posts fails the tests on what is missing."""
    return (
        F.when((completion_pct >= HIGH_PCT) & (posts >= HIGH_POSTS), HIGH)
        .when((completion_pct >= MEDIUM_PCT) | (posts >= MEDIUM_POSTS), MEDIUM)
        .otherwise(LOW)
    )


def user_profile(users: DataFrame, posts: DataFrame, todos: DataFrame, run: RunInfo) -> DataFrame:
    """Every user with post and task metrics, null where there are none."""
    profile = (
        users.select(*PROFILE_USER_COLUMNS)
        .join(post_metrics(posts), "user_id", "left")
        .join(task_metrics(todos), "user_id", "left")
    )
    level = engagement_level(F.col("completion_rate_pct"), F.col("total_posts"))
    return with_process_stamp(profile.withColumn("engagement_level", level), "gold", run)


def city_analysis(profile: DataFrame, run: RunInfo) -> DataFrame:
    """Cities by mean completion, best first; users without a city are left out."""
    cities = profile.where(F.col("addr_city").isNotNull()).groupBy("addr_city").agg(
        F.count("user_id").alias("total_users"),
        F.coalesce(F.sum("total_posts"), F.lit(0).cast("bigint")).alias("total_posts"),
        round_half_even(exact_mean(F.col("completion_rate_pct"), 1), 2).alias("avg_completion_pct"),
        F.count_if(F.col("engagement_level") == HIGH).alias("high_engagement"),
    )
    ranked = cities.orderBy(F.col("avg_completion_pct").desc_nulls_last(), "addr_city")
    return with_process_stamp(ranked, "gold", run)


def global_kpis(profile: DataFrame) -> DataFrame:
    """One row over all users, in one pass."""
    return profile.agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.coalesce(F.sum("total_posts"), F.lit(0).cast("bigint")).alias("total_posts"),
        round_half_even(exact_mean(F.col("completion_rate_pct"), 1), 1).alias("avg_completion_pct"),
        F.count_if(F.col("engagement_level") == HIGH).alias("high_engagement"),
    )
