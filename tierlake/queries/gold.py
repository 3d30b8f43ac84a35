"""Gold tables on the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierlake.operators.columns import drop_metadata
from tierlake.plans import gold
from tierlake.queries import sql, tables


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = gold.user_profile(
        tables.users(spark, sf_dir), tables.posts(spark, sf_dir), tables.todos(spark, sf_dir), tables.RUN
    )
    return drop_metadata(made)


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_metadata(gold.city_analysis(profile(spark, sf_dir), tables.RUN))


def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.global_kpis(profile(spark, sf_dir))


QUERIES = {"gold_user_profile": profile, "gold_city_analysis": cities, "gold_global_kpis": kpis}

PROFILE_SQL = f"{sql.WITH_PROFILE} SELECT * FROM profile"

ORACLES = {
    "gold_user_profile": PROFILE_SQL,
    "gold_city_analysis": f"""{sql.WITH_PROFILE}
SELECT addr_city, count(user_id) AS total_users,
       CAST(coalesce(sum(total_posts), 0) AS BIGINT) AS total_posts,
       {sql.half_even(sql.exact_mean('completion_rate_pct', 1), 2)} AS avg_completion_pct,
       count(*) FILTER (WHERE engagement_level = 'HIGH') AS high_engagement
FROM profile WHERE addr_city IS NOT NULL GROUP BY addr_city
ORDER BY avg_completion_pct DESC NULLS LAST, addr_city""",
    "gold_global_kpis": f"""{sql.WITH_PROFILE}
SELECT count(DISTINCT user_id) AS unique_users,
       CAST(coalesce(sum(total_posts), 0) AS BIGINT) AS total_posts,
       {sql.half_even(sql.exact_mean('completion_rate_pct', 1), 1)} AS avg_completion_pct,
       count(*) FILTER (WHERE engagement_level = 'HIGH') AS high_engagement
FROM profile""",
}
