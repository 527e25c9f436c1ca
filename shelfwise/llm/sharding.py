"""Two-pass external shuffle into shards.

Pass one scatters the records by a seeded hash into buckets that fit in memory.
Pass two permutes each bucket (Spark's ``shuffle`` of an array is a Fisher-Yates
shuffle) and lays the buckets end to end: the global order is then dealt to the
shards in turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.functions.ordering import running_totals
from shelfwise.functions.staging import stage
from shelfwise.llm.tables import filed, fresh, located

#: Tasks of the second pass; beyond it a task permutes several buckets in turn.
MAX_TASKS = 100_000


def external_shuffle(
    records: DataFrame,
    shards: int = 24,
    size: str = "size",
    bucket_bytes: int = 2 << 20,
    record_bytes: int = 64,
    seed: int = 7,
) -> DataFrame:
    """All columns of ``records`` with ``shard`` and ``slot`` in random order.

    Shards differ by one record at most, and slots count from 0 without a gap.
    Buckets are made so that the expected sum of ``size`` plus ``record_bytes`` per
    record is ``bucket_bytes``; null sizes count as 0. The scatter hashes the file
    name and position of a record (of its staged copy, unless ``records`` are read
    from files), not its values: repeated rows and a key that holds any share of
    them spread evenly. A single record beyond ``bucket_bytes`` is a
    bucket of its own size. An empty table gives none. Columns of the input
    called ``shard`` or ``slot``, in any case, are kept under a name with underscores
    that no other column has.
    """
    names: dict[str, str] = {}
    for c in records.columns:
        others = [x for x in records.columns if x != c]
        clashes = c.lower() in ("shard", "slot")
        names[c] = fresh(["shard", "slot", *others, *names.values()], c) if clashes else c
    placed, file, position = located(filed(records))
    packed = placed.select(
        F.struct(F.col(file).alias("file"), F.col(position).alias("position")).alias("row"),
        F.coalesce(F.col(f"`{size}`").cast("bigint"), F.lit(0)).alias("bytes"),
        F.struct(*[F.col(f"`{c}`").alias(names[c]) for c in records.columns]).alias("record"),
    )
    whole = packed.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    total = (whole.bytes or 0) + record_bytes * whole.n
    buckets = max(1, -(-total // bucket_bytes))

    bucket = F.pmod(
        F.xxhash64(F.lit(seed), F.substring_index("row.file", "/", -1), "row.position"), F.lit(buckets)
    )
    scattered = packed.withColumn("bucket", bucket)
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = stage(
        running_totals(counts, [], ["bucket"], ["n"]).select(
            "bucket", (F.col("cum_n") - F.col("n")).alias("offset")
        ),
        "offsets",
    )
    # A fixed number of partitions: the permutation of a bucket depends on the
    # partition it lies in. Sorting first makes it independent of fetch order.
    permuted = (
        scattered.repartition(min(buckets, MAX_TASKS), "bucket")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list(F.struct("row", "record"))).alias("rows"))
        .join(offsets, "bucket")
        .select("offset", F.posexplode(F.shuffle("rows", seed)).alias("place", "item"))
        .withColumn("at", F.col("offset") + F.col("place"))
    )
    return permuted.select(
        "item.record.*",
        F.pmod("at", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("at") / shards).cast("bigint").alias("slot"),
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write each shard to its own folder in slot order."""
    (
        shuffled.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_shards(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows that ``write_shards`` has written; ``schema`` is that of its input."""
    return spark.read.schema(schema).parquet(path)
