"""Silver entities and their building blocks on the given data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions import text
from tierlake.functions.numbers import number_or_null
from tierlake.operators.columns import drop_metadata, expand_nested, flatten, normalised_name
from tierlake.operators.dedup import duplicate_count, keep_first
from tierlake.plans import silver
from tierlake.queries import sql
from tierlake.queries.tables import RUN, raw_users, table

LINE_KEY = ["l_orderkey", "l_linenumber"]


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy records; those of negative latitude were landed twice."""
    raw = raw_users(spark, sf_dir)
    copies = F.when(F.col("address.geo.lat").startswith("-"), 2).otherwise(1)
    landed = raw.withColumn("_source_row", F.explode(F.sequence(F.lit(1), copies)))
    again = F.col("_source_row") > 1
    untidy = landed.withColumns(
        {
            "name": F.when(again, "changed").otherwise(F.concat(F.lit("\t "), F.upper("name"), F.lit(" \n"))),
            "username": F.concat(F.lit(" "), F.upper("username"), F.lit("\xa0")),
            "email": F.concat(F.lit(" "), F.upper("email"), F.lit("\r\n")),
            "address": F.col("address").withField(
                "geo.lat", F.when(F.col("address.geo.lat").startswith("9"), "n/a").otherwise(
                    F.concat(F.lit(" "), "address.geo.lat", F.lit(" "))
                ),
            ),
            "_source_file": F.lit("users"),
            "_source_block": F.lit(0),
        }
    )
    return drop_metadata(silver.silver_users(untidy, RUN))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    raw = documents.select(
        F.col("n_chars").alias("userId"), F.col("doc_id").alias("id"),
        F.col("text").alias("title"), F.concat(F.lit("\n\t"), "text", F.lit(" \n")).alias("body"),
    )
    return drop_metadata(silver.silver_posts(raw, RUN))


def todos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sign-up neither has nor has not been completed."""
    known = F.col("event_type") != "signup"
    raw = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"), F.col("event_id").alias("id"),
        F.concat(F.lit(" "), "event_type").alias("title"),
        F.when(known, F.col("event_type") != "error").alias("completed"),
    )
    return drop_metadata(silver.silver_todos(raw, RUN))


def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(table(spark, sf_dir, "lineitem"), LINE_KEY)


def removed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_count(table(spark, sf_dir, "lineitem"), LINE_KEY)


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k BIGINT").alias("props"),
        F.struct(
            F.struct(F.col("user_id").alias("Id"), F.col("event_type").alias("Kind Of")).alias("actor"),
            "value",
        ).alias("detail"),
    )
    flat = flatten(expand_nested(events, "detail", "det_", separators=". "))
    return flat.toDF(*[normalised_name(name, "", ".") for name in flat.columns])


def lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        number_or_null(F.regexp_extract("p_brand", r"\d+", 0)).alias("brand_number"),
        number_or_null(F.col("p_name")).alias("name_number"),
        number_or_null(F.concat(F.lit(" -"), "p_size", F.lit(".5e1 "))).alias("size_number"),
        number_or_null(F.concat("p_size", F.lit("d"))).alias("suffixed_number"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.title_case(F.col("text")).alias("title"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.word_count(F.col("text")).alias("words"),
        text.length(text.strip(F.col("text"))).cast("bigint").alias("chars"),
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.clean_phone(F.col("text")).alias("phone"),
        text.replace_text(F.lower(text.strip(F.col("text"))), "\n", " ").alias("line"),
    )


QUERIES = {
    "silver_users": users,
    "silver_posts_text": posts,
    "silver_todos_status": todos,
    "dedup_keep_first": first_lines,
    "dedup_removed_count": removed_lines,
    "flatten_nested": nested_events,
    "lenient_numeric": lenient,
    "title_case": titles,
    "word_count": words,
    "regex_clean": cleaned,
}

_BODY = f"replace({sql.strip('text')}, chr(10), ' ')"

ORACLES = {
    "silver_users": f"""WITH {sql.USERS}
SELECT user_id, {sql.title('name')} AS name, username, email,
       ' +' || CAST(c_nationkey AS VARCHAR) || ' (0) ' || CAST(user_id AS VARCHAR) || '-x1' AS phone,
       lower(company_name) || '.example' AS website,
       'Street ' || CAST(user_id AS VARCHAR) AS addr_street,
       'Suite ' || CAST(c_nationkey AS VARCHAR) AS addr_suite,
       addr_city, addr_zipcode,
       CASE WHEN starts_with(CAST(geo_lat AS VARCHAR), '9') THEN NULL ELSE geo_lat END AS geo_lat, geo_lng,
       company_name, 'We do ' || company_name AS company_catchphrase, lower(company_name) AS company_bs
FROM users JOIN customer ON user_id = c_custkey""",
    "silver_posts_text": f"""
SELECT n_chars AS user_id, doc_id AS post_id, {sql.title(sql.strip('text'))} AS title, {_BODY} AS body,
       {sql.words('text')} AS title_word_count, {sql.words('text')} AS body_word_count,
       CAST(length({_BODY}) AS INTEGER) AS body_length
FROM documents""",
    "silver_todos_status": f"""
SELECT user_id, event_id AS todo_id, {sql.title('event_type')} AS title,
       event_type NOT IN ('signup', 'error') AS completed,
       CASE event_type WHEN 'signup' THEN NULL WHEN 'error' THEN 'PENDING' ELSE 'COMPLETED' END AS status
FROM events""",
    "dedup_keep_first": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                 l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem)
WHERE rn = 1""",
    "dedup_removed_count": """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS removed
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "flatten_nested": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k,
       user_id AS det_actor_id, event_type AS det_actor_kind_of, value AS det_value
FROM events""",
    "lenient_numeric": """
SELECT p_partkey, try_cast(regexp_extract(p_brand, '\\d+') AS DOUBLE) AS brand_number,
       try_cast(p_name AS DOUBLE) AS name_number,
       try_cast('-' || p_size || '.5e1' AS DOUBLE) AS size_number,
       try_cast(p_size || 'd' AS DOUBLE) AS suffixed_number
FROM part""",
    "title_case": f"SELECT doc_id, {sql.title('text')} AS title FROM documents",
    "word_count": f"""
SELECT doc_id, {sql.words('text')} AS words, length({sql.strip('text')}) AS chars FROM documents""",
    "regex_clean": f"""
SELECT doc_id, regexp_replace(text, '[^\\p{{Nd}}+\\-() x]', '', 'g') AS phone,
       replace(lower({sql.strip('text')}), chr(10), ' ') AS line
FROM documents""",
}
