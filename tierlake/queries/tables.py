"""The given tables, and the entities this library works on derived from them.

users are customers with their nation as city, posts are orders or documents,
todos are events. Everything is derived by Spark and grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions import text
from tierlake.functions.numbers import number_text
from tierlake.plans.parallel import side_by_side
from tierlake.run import RunInfo

RUN = RunInfo(datetime(2024, 2, 3, 4, 5, 6, tzinfo=timezone.utc), job_name="queries")
LATER_RUN = RunInfo(datetime(2024, 2, 4, 4, 5, 6, tzinfo=timezone.utc), job_name="queries")

COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def email() -> Column:
    """An address per customer, without its @ where the balance is negative."""
    user = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    at = F.when(F.col("c_acctbal") < 0, ".").otherwise("@")
    return F.concat(user, at, F.lower("c_mktsegment"), F.lit(".com"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        email().alias("email"),
        F.lower("c_name").alias("username"),
        F.col("n_name").alias("addr_city"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("addr_zipcode"),
        F.col("c_mktsegment").alias("company_name"),
        (F.col("c_acctbal") / 100).alias("geo_lat"),
        (F.col("c_acctbal") / 50).alias("geo_lng"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users as nested records with text coordinates."""
    return customers(spark, sf_dir).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("username"),
        email().alias("email"),
        F.struct(
            F.concat(F.lit("Street "), F.col("c_custkey")).alias("street"),
            F.concat(F.lit("Suite "), F.col("c_nationkey")).alias("suite"),
            F.col("n_name").alias("city"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zipcode"),
            F.struct(
                number_text(F.col("c_acctbal") / 100).alias("lat"),
                number_text(F.col("c_acctbal") / 50).alias("lng"),
            ).alias("geo"),
        ).alias("address"),
        F.concat(F.lit("tel. +"), "c_nationkey", F.lit(" (0) "), "c_custkey", F.lit("-x1")).alias("phone"),
        F.concat(F.lower("c_mktsegment"), F.lit(".example")).alias("website"),
        F.struct(
            F.col("c_mktsegment").alias("name"),
            F.concat(F.lit("We do "), "c_mktsegment").alias("catchPhrase"),
            F.lower("c_mktsegment").alias("bs"),
        ).alias("company"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_posts(spark, sf_dir)
    return raw.select(
        F.col("userId").alias("user_id"),
        F.col("id").alias("post_id"),
        "title",
        text.word_count(F.col("title")).alias("title_word_count"),
        text.length(F.col("body")).alias("body_length"),
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("userId"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("body"),
    )


def todos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_id").alias("todo_id"),
        F.col("event_type").alias("title"),
        (F.col("event_type") != "error").alias("completed"),
    )


def raw_todos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return todos(spark, sf_dir).withColumnsRenamed({"user_id": "userId", "todo_id": "id"})


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("postId"),
        F.col("turn").alias("id"),
        F.col("role").alias("name"),
        F.concat("role", F.lit("@example.com")).alias("email"),
        F.col("text").alias("body"),
    )


RAW = {"users": raw_users, "posts": raw_posts, "todos": raw_todos, "comments": raw_comments}


def land(spark: SparkSession, sf_dir: str, folder: str, repeated: Mapping[str, str] = {}) -> None:
    """Write every raw entity as JSON lines below the folder, side by side; then again those that a condition repeats."""

    def write(name: str, make: Callable[[SparkSession, str], DataFrame]) -> None:
        records = make(spark, sf_dir)
        records.write.mode("overwrite").json(f"{folder}/{name}")
        if name in repeated:
            records.where(repeated[name]).write.mode("append").json(f"{folder}/{name}")

    side_by_side(spark, {name: partial(write, name, make) for name, make in RAW.items()})


#: Records of an array file, about: an array is one value, and one task cuts it.
ARRAY_RECORDS = 250_000


def land_arrays(records: DataFrame, folder: str, files: int = 8) -> None:
    """Write the records as JSON arrays, a record to a line and an array to a file.

    There are so many files at least; more records make more files and not larger ones.
    """
    columns = records.columns
    files = max(files, -(-records.count() // ARRAY_RECORDS))
    whole = records.withColumn("_file", F.pmod(F.xxhash64(*columns), F.lit(files)))
    arrays = whole.groupBy("_file").agg(F.array_join(F.collect_list(F.to_json(F.struct(*columns))), ",\n").alias("content"))
    values = arrays.select(F.concat(F.lit("[\n"), "content", F.lit("\n]")).alias("value"))
    values.write.option("maxRecordsPerFile", 1).text(folder)
