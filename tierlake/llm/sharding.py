"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number for every key and the key goes to the highest. A
draw depends on the key and that shard alone, so a new shard only takes the keys
it wins and a removed one only gives its own away. Draws are -weight / ln(u) with
u uniform, so a shard wins in proportion to its weight.

* Null keys count as one key of their own; repeated keys share a shard.
* Ties between draws go to the larger shard number.
* Weights must be above 0 and at least one shard is needed.
* An empty table gives an empty table; columns of the input are never read by name
  except those given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import located, plain_text, ranked


def shard_of(key: Column, weights: dict[int, float]) -> Column:
    """The number of the shard that the key belongs to."""
    if not weights or any(weight <= 0 for weight in weights.values()):
        raise ValueError("shards need weights above 0")
    shards = F.array(*[
        F.struct(F.lit(number).alias("number"), F.lit(float(weight)).alias("weight"))
        for number, weight in sorted(weights.items())
    ])

    def draw(shard: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, shard.getField("number")), 11)
        uniform = (bits + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct((-shard.getField("weight") / F.ln(uniform)).alias("draw"), shard.getField("number").alias("number"))

    return F.array_max(F.transform(shards, draw)).getField("number")


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's shard and slot, and its shard if there were one more.

    The slot is the rank of the key in its shard; rows of one key follow in file
    order. Size is the text's bytes in UTF-8 plus 16; null texts have none.
    """
    rows = located(docs)
    content = F.encode(plain_text(text), "UTF-8")
    weights = {number: 1.0 for number in range(shards)}
    placed = rows.frame.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), weights).alias("shard"),
        shard_of(F.col(key), weights | {shards: 1.0}).alias("grown_shard"),
        F.col(rows.file).alias("_file"),
        F.col(rows.row).alias("_row"),
    )
    slots = ranked(placed, ["shard"], ["doc_id", "_file", "_row"], "slot", "sharding")
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40)
