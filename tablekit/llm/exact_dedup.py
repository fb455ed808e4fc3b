"""Exact dedup by a stateful stream: keyed state on disk, kept for good, says of each digest which row stays.

The stream groups by digest without a watermark, so state never expires; its store is RocksDB, checkpointed to the
shared folder. State holds the digest, the largest id and the place (file, row) of that content, and how many rows
there were. Copies are combined in the task that reads them, so a group that holds a third of all rows is a few rows of
the shuffle. A later call with the same state reads only files that are new and goes on.

Rows whose digest was met more than once are then compared by their full bytes with the content that the state names.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import filters
from tablekit.llm.hot_join import join_groups
from tablekit.operators.ordered import salted_join
from tablekit.session import materialize, scratch_path

#: State on the executors' disks, with snapshots in the checkpoint. Stores may be many and small, so files are not
#: allocated ahead (some 4 MB a store).
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: What one micro-batch reads at most; what a lost driver has to read again.
BATCH_BYTES = 1 << 38


def text_digest(text: Column) -> Column:
    """SHA-256 of a text, null as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _facts(docs: DataFrame, id_col: str, text_col: str, digest, *more: Column) -> DataFrame:
    """(digest, keep): the row's digest, and its id and place in the order in which rows are preferred."""
    place = docs.metadataColumn("_metadata")
    return docs.select(digest(docs[text_col]).alias("digest"), F.struct(
        docs[id_col].alias("id"), place["file_path"].alias("file"), place["row_index"].alias("row")).alias("keep"), *more)


def _stream_path(path: str) -> str:
    """A pattern that matches the path only: file streams take single files by pattern alone."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def ingest(spark: SparkSession, path: str, state_dir: str, id_col: str = "doc_id", text_col: str = "text",
           digest=text_digest) -> DataFrame:
    """Bring the state under ``state_dir`` up to the Parquet files at ``path``; (digest, keep, size) of every digest.

    ``keep`` is the (id, file, row) of the row that stays: the largest id, nulls below all others, of equal ids the
    last place. Files that the state has seen are not read again.
    """
    schema = spark.read.parquet(path).schema
    with _settings(spark, STORE):
        docs = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(_stream_path(path))
        state = _facts(docs, id_col, text_col, digest).groupBy("digest").agg(
            F.max("keep").alias("keep"), F.count(F.lit(1)).alias("size"))
        running = (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
                   .option("checkpointLocation", state_dir).start())
        running.awaitTermination()
        stored = spark.read.format("statestore").load(state_dir)
        keep, size = stored.schema["value"].dataType.names
        return materialize(stored.select(F.col("key")["digest"].alias("digest"), F.col("value")[keep].alias("keep"),
                                         F.col("value")[size].alias("size")), "dedup-groups")


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _hits(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` of the digests with more than one row, and a few others; the filter has a fixed size."""
    held_hash = F.xxhash64("digest")
    table = rows.sparkSession.sparkContext.broadcast(
        filters.filter_of(groups.where("size > 1").select(held_hash.alias("h"))))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filters.read_filter(table.value)
        for batch in batches:
            hashes = batch.column("h").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(filters.held(hashes, bits)))

    rows = rows.withColumn("h", held_hash)
    return rows.mapInArrow(passing, rows.schema).drop("h")


def _by_bytes(hits: DataFrame) -> DataFrame:
    """(digest, text, keep, size) of every text; copies are compared and combined in the tasks that read them."""
    return hits.groupBy("digest", "text").agg(F.max("keep").alias("keep"), F.count(F.lit(1)).alias("size"))


def dedup_exact(spark: SparkSession, path: str, state_dir: str | None = None, id_col: str = "doc_id",
                text_col: str = "text", digest=text_digest) -> DataFrame:
    """(id, digest, keep_id, group_size, kept) of every row of the Parquet files at ``path``.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest id stays (nulls below
    all ids, of equal ids the one in the last place), so each group keeps one row, repeated rows included. Different
    texts with the same digest, if a digest is weak, are told apart by their bytes. Extra columns are ignored, an empty
    table gives an empty result. ``state_dir`` keeps the state for later calls, in which ``path`` has all files so far.
    """
    groups = ingest(spark, path, state_dir or scratch_path(spark, "dedup-state"), id_col, text_col, digest)
    docs = spark.read.parquet(path)
    facts = _facts(docs, id_col, text_col, digest)
    texts = _facts(docs, id_col, text_col, digest, F.coalesce(docs[text_col], F.lit("")).alias("text"))
    bytewise = materialize(_by_bytes(_hits(texts, groups)).select("digest", F.col("keep").alias("found")), "dedup-bytes")
    named = bytewise.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("found").alias("found"))
    missed = groups.where("size > 1").join(named, "digest", "left")
    mixed = materialize(missed.where("texts is null or texts > 1 or found <> keep").select("digest"), "dedup-mixed")
    rows = materialize(facts, "dedup-rows")
    judged = join_groups(rows, groups.withColumnRenamed("keep", "stays"), ["digest"], "size")
    if not mixed.isEmpty():  # a weak digest: the texts themselves are the keys
        apart = texts.join(mixed, "digest", "left_semi")
        kinds = _by_bytes(apart).withColumnRenamed("keep", "stays")
        judged = (judged.join(mixed, "digest", "left_anti")
                  .unionByName(salted_join(apart, kinds, ["digest", "text"]).drop("text")))
    return judged.select(F.col("keep.id").alias("id"), "digest", F.col("stays.id").alias("keep_id"),
                         F.col("size").alias("group_size"), (F.col("keep") == F.col("stays")).alias("kept"))
