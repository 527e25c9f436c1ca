"""Exact deduplication with keyed streaming state.

Fingerprints of the documents are read as a stream. The state, kept on disk by
RocksDB without expiry, holds per digest the identifier of the document that
stays, the place of its content and the number of documents seen. New files of
fingerprints can be added to a later run with the same checkpoint. A hit is a
duplicate only if its full bytes equal those of the document that stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.functions.columns import quoted
from shelfwise.functions.staging import Scratch, new_path, stage
from shelfwise.llm.tables import FILE, POSITION, filed, located, normal_space

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each store would reserve some MB of disk for its logs, also if it holds little.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    """Lower-case hex digest of the UTF-8 bytes."""
    return F.sha2(text, 256)


def update_state(spark: SparkSession, fingerprints: str, schema: StructType, checkpoint: str) -> DataFrame:
    """Feed the fingerprint files not yet seen to the state and return the state.

    Columns ``digest``, ``keep`` (the first of ``no_id, doc_id`` and place) and ``n``.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    for name, value in STATE_STORE.items():
        session.conf.set(name, value)
    groups = (
        session.readStream.schema(schema)
        .parquet(fingerprints)
        .groupBy("digest")
        .agg(F.min(F.struct("no_id", "doc_id", FILE, POSITION)).alias("keep"), F.count(F.lit(1)).alias("n"))
    )
    query = (
        groups.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state = session.read.format("statestore").load(checkpoint)
    least, count = state.schema["value"].dataType.names
    held = new_path(spark, "state")
    state.select(
        F.col("key.digest").alias("digest"),
        F.col("value")[least].alias("keep"),
        F.col("value")[count].alias("n"),
    ).write.parquet(held)
    return spark.read.parquet(held)


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per document: its place, ``doc_id, keep_id, group_size, kept, digest``.

    Texts are equal when identical with each run of white space as one space;
    null counts as empty. Of equal texts the row with the smallest id stays, null
    ids last, and of repeated ids the one that lies first; so exactly one row of
    a group stays. An empty table gives none.
    """
    with Scratch(docs.sparkSession) as scratch:
        return scratch.result(_exact_duplicates(docs, doc_id, text, digest), "exact")


def _exact_duplicates(docs: DataFrame, doc_id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    spark = docs.sparkSession
    placed, file, position = located(filed(docs))
    texts = placed.select(
        quoted(doc_id).alias("doc_id"),
        quoted(doc_id).isNull().alias("no_id"),
        F.col(file).alias(FILE),
        F.col(position).alias(POSITION),
        normal_space(quoted(text)).alias("normal"),
    ).withColumn("digest", digest(F.col("normal")))
    prints = texts.drop("normal")
    folder = new_path(spark, "fingerprints")
    prints.write.parquet(folder)
    state = update_state(spark, folder, prints.schema, new_path(spark, "dedup-state"))
    seen = spark.read.schema(prints.schema).parquet(folder)
    rows = seen.join(state, "digest").select(*prints.columns, "keep", F.col("n").alias("group_size"))

    other = stage(different_bytes(texts, state.where("n > 1")), "different")
    if not other.isEmpty():
        rows = split_collisions(rows, other)
    same = (F.col("keep")[FILE] == F.col(FILE)) & (F.col("keep")[POSITION] == F.col(POSITION))
    return rows.select(
        FILE, POSITION, "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", same.alias("kept"), "digest"
    )


def different_bytes(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows whose digest is in the state but whose bytes differ from the row that stays."""
    hits = stage(
        texts.join(repeated.select("digest", "keep"), "digest").select(
            "digest", "no_id", "doc_id", FILE, POSITION, "normal",
            ((F.col("keep")[FILE] == F.col(FILE)) & (F.col("keep")[POSITION] == F.col(POSITION))).alias("stays"),
        ),
        "hits",
    )
    kept = hits.where("stays").select("digest", F.col("normal").alias("kept_text"))
    return (
        hits.where("NOT stays")
        .join(kept, "digest")
        .where("normal <> kept_text")
        .drop("stays", "kept_text")
    )


def split_collisions(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Group the rows of ``other`` by their full text and take them from their group."""
    lost = other.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    groups = other.groupBy("digest", "normal").agg(
        F.min(F.struct("no_id", "doc_id", FILE, POSITION)).alias("own_keep"),
        F.count(F.lit(1)).alias("own_size"),
    )
    moved = other.join(groups, ["digest", "normal"]).select(FILE, POSITION, "own_keep", "own_size")
    return (
        rows.join(lost, "digest", "left")
        .join(moved, [FILE, POSITION], "left")
        .withColumn(
            "group_size",
            F.coalesce("own_size", F.col("group_size") - F.coalesce("lost", F.lit(0))),
        )
        .withColumn("keep", F.coalesce("own_keep", "keep"))
    )
