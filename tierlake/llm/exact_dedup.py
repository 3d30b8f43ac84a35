"""Exact deduplication as a stream with keyed state on disk.

Every document becomes a small landed row: digest of its text, stable identifier
and content locator (file and row). The landed rows are streamed into an
aggregation keyed by digest whose state lives in RocksDB and never expires: it
retains the identifier and the locator of the row that stays and the number of
rows seen. Later runs on the same folder go on with that state. A row that hits
another row's digest is compared with the retained row's whole text, whichever run
landed that; texts of earlier runs are fetched by their locators. Texts that share
a digest by accident are told apart.

* Files of earlier runs have to stay where they are, with the same text column; one
  that is gone stops the run if another text has a digest of its own.
* Null texts count as empty; equal means equal bytes, whatever the collation.
* The row with the largest identifier stays, null being the smallest; among rows
  of one identifier the last by file and row stays, so exactly one row stays.
* An empty table gives an empty table. Other columns are carried, never read.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import Located, located, plain_text, settings, stored
from tierlake.sources.scratch import scratch_folder

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def here() -> Column:
    """What the state retains of a row."""
    return F.struct("id", "file", "row")


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


class DedupState:
    """Disk-backed state of all documents landed so far, below one shared folder."""

    def __init__(self, spark: SparkSession, folder: str, digest: Callable[[Column], Column] = sha256):
        self.spark, self.folder, self.digest = spark, folder, digest

    def rows(self, docs: Located, identifier: str, text: str) -> DataFrame:
        content = F.encode(plain_text(text), "UTF-8")
        return docs.frame.select(
            self.digest(content).alias("digest"),
            F.col(identifier).alias("id"),
            F.col(docs.file).alias("file"),
            F.col(docs.row).alias("row"),
            content.alias("content"),
        )

    def ingest(self, docs: Located, identifier: str, text: str, bytes_per_batch: int = 64 << 30) -> None:
        """Land the documents and stream what is new into the state."""
        landing = self.rows(docs, identifier, text).drop("content")
        landing.write.mode("append").parquet(f"{self.folder}/landed")
        stream = (
            self.spark.readStream.schema(landing.schema)
            .option("maxBytesPerTrigger", bytes_per_batch)
            .parquet(f"{self.folder}/landed")
        )
        retained = stream.groupBy("digest").agg(F.max(here()).alias("keep"), F.count("*").alias("size"))
        with settings(self.spark, ROCKSDB):
            run = (
                retained.writeStream.format("noop").outputMode("update")
                .option("checkpointLocation", f"{self.folder}/state")
                .trigger(availableNow=True).start()
            )
            run.awaitTermination()

    def landed(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/landed")

    def retained(self) -> DataFrame:
        """digest, keep (id, file, row) and size, as the state store holds them."""
        state = self.spark.read.format("statestore").load(f"{self.folder}/state")
        kept, count = state.schema["value"].dataType.names
        return state.select(
            F.col("key.digest").alias("digest"),
            F.col(f"value.`{kept}`").alias("keep"),
            F.col(f"value.`{count}`").alias("size"),
        )


def fetched(places: DataFrame, text: str) -> DataFrame:
    """The rows with the whole text at their locator (file, row) as content."""
    spark = places.sparkSession
    # A row per file, as in any listing of the folder. The paths come as URIs.
    files = [unquote(row.file) for row in places.select("file").distinct().collect()]
    texts = spark.read.parquet(*files)
    meta = texts.metadataColumn("_metadata")
    texts = texts.select(
        meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row"),
        F.encode(plain_text(text), "UTF-8").alias("content"),
    )
    return places.join(texts, ["file", "row"])


def hits(state: DedupState, retained: DataFrame, docs: Located, identifier: str, text: str) -> DataFrame:
    """digest, id, file, row, content, keep and size of every landed row whose digest another row has."""
    shared = retained.where("size > 1")
    own = stored(state.rows(docs, identifier, text).join(shared, "digest"), "dedup-hits")
    if state.landed().count() <= docs.frame.count():
        return own
    earlier = state.landed().join(shared, "digest").join(own.select("file", "row"), ["file", "row"], "left_anti")
    earlier = stored(earlier.select("digest", "id", "file", "row", "keep", "size"), "dedup-earlier")
    if earlier.isEmpty():
        return own
    return own.unionByName(stored(fetched(earlier, text), "dedup-fetched"))


def decide(state: DedupState, docs: Located, identifier: str, text: str) -> DataFrame:
    """id, file, row, digest, keep (id, file, row), size and kept of every document landed in any run, `docs` among them."""
    retained = stored(state.retained(), "dedup-state")
    repeated = hits(state, retained, docs, identifier, text)
    others = repeated.where(~here().eqNullSafe(F.col("keep")))
    holders = repeated.where(here().eqNullSafe(F.col("keep"))).select("digest", F.col("content").alias("held"))
    # Not made distinct here: Spark splits a hot digest only if nothing above the join needs its rows together.
    accidents = stored(others.join(holders, "digest").where("content <> held").select("digest"), "dedup-accidents")

    rows = state.landed().join(retained, "digest")
    if not accidents.isEmpty():
        apart = repeated.drop("keep", "size").join(accidents, "digest", "left_semi")
        holders = apart.groupBy("digest", "content").agg(F.max(here()).alias("keep"), F.count("*").alias("size"))
        apart = apart.join(holders, ["digest", "content"]).drop("content")
        rows = rows.join(accidents, "digest", "left_anti").unionByName(apart)
    return rows.withColumn("kept", here().eqNullSafe(F.col("keep")))


def deduplicate(
    docs: DataFrame, identifier: str = "doc_id", text: str = "text",
    digest: Callable[[Column], Column] = sha256, bytes_per_batch: int = 64 << 30,
) -> tuple[Located, DataFrame]:
    """The located documents and the decision on each of them."""
    spark = docs.sparkSession
    state = DedupState(spark, scratch_folder(spark, "dedup"), digest)
    rows = located(docs)
    state.ingest(rows, identifier, text, bytes_per_batch)
    return rows, decide(state, rows, identifier, text)


def keep_one(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without all but one row of each text."""
    rows, decided = deduplicate(docs, identifier, text)
    kept = decided.where("kept").select(F.col("file").alias(rows.file), F.col("row").alias(rows.row))
    return rows.frame.join(kept, [rows.file, rows.row], "left_semi").select(*rows.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"))[1]
    return decided.select(
        F.col("id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
