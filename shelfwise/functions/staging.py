"""Stage tables: intermediate results written once and read back.

A stage lives under the cluster's shared checkpoint folder, so it survives the
loss of executors, and it is parquet, so a reader still prunes columns. The
reader has no lineage behind it, and two branches that read one stage see the
same rows.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_root(spark: SparkSession) -> str:
    """Folder for the stages of this application: under ``spark.checkpoint.dir``,
    else under the warehouse, which every executor reaches as well."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/stages-{sc.applicationId}"


_open = threading.local()
_tables: list[str] = []


class Scratch:
    """Stages made inside are deleted at the end, but for what ``result`` stores.

        with Scratch(spark) as scratch:
            ...
            return scratch.result(table)

    Scopes nest: a result of an inner scope goes with the outer one.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.kept = spark, [], set()

    def __enter__(self) -> Scratch:
        _open.scopes = [*getattr(_open, "scopes", []), self]
        return self

    def result(self, df: DataFrame, label: str = "result") -> DataFrame:
        path = new_path(self.spark, label)
        self.kept.add(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *error) -> None:
        _open.scopes = _open.scopes[:-1]
        if _open.scopes:
            _open.scopes[-1].paths += self.kept
        for path in self.paths:
            if path not in self.kept:
                _delete(self.spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def new_path(spark: SparkSession, label: str = "stage") -> str:
    """Place of a new stage that nothing else writes to."""
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    if scopes := getattr(_open, "scopes", []):
        scopes[-1].paths.append(path)
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of a part where a task's work or memory goes by rows, not by stored bytes.
PART_ROWS = 250_000


def parts_of(spark: SparkSession, rows: int) -> int:
    """Parts of at most about ``PART_ROWS`` rows, and no fewer than the cluster has cores."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def sizes_by_key(df: DataFrame, key: str) -> tuple[int, int]:
    """Rows of ``df``, and the most that one ``key`` holds."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.sum("n").alias("rows"), F.max("n").alias("largest")).first()
    return found.rows or 0, found.largest or 0


def rows_by_key(df: DataFrame, key: str) -> tuple[int, bool]:
    """Rows of ``df``, and whether they may lie by ``key`` alone: no key then holds more of
    them than a part should."""
    rows, largest = sizes_by_key(df, key)
    return rows, largest <= PART_ROWS


def bucket_multiple(spark: SparkSession, parts: int) -> int:
    """``parts`` up to a multiple of the buckets that ``stage_bucketed`` makes, so that each
    task writes to one."""
    return parts + -parts % int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt_by_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` dealt by ``keys`` into parts of about ``PART_ROWS`` rows.

    A reader of a stage packs tasks by stored bytes, and rows that compress well come to
    millions per task. A fit keeps its rows in memory in a larger form, so its parts go
    by the number of rows.
    """
    return df.repartition(parts_of(df.sparkSession, df.count()), *keys)


def stage_bucketed(
    df: DataFrame, keys: list[str], label: str = "bucketed", buckets: int | None = None
) -> DataFrame:
    """Stage ``df`` in buckets of ``keys``: tables staged by the same keys, as many columns
    as they may have, join without an exchange.

    There are as many buckets as shuffle partitions unless given, so rows that come out of an exchange
    on the keys go to one bucket per task. The table is external and its name goes from
    the catalogue with ``drop_stages``.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = f"stage_{path.rsplit('-', 1)[1]}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    _tables.append(name)
    return spark.table(name)


def stage_all(tables: dict[str, DataFrame], buckets: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Stage independent tables side by side, so one job's last tasks do not
    leave the cluster idle; those named in ``buckets`` by the keys given there."""
    spark = next(iter(tables.values())).sparkSession
    stage_root(spark)

    @inheritable_thread_target(spark)
    def write(label: str) -> DataFrame:
        if label in (buckets or {}):
            return stage_bucketed(tables[label], buckets[label], label)
        return stage(tables[label], label)

    with ThreadPool(len(tables)) as pool:
        return dict(zip(tables, pool.map(write, tables), strict=True))


def drop_stages(spark: SparkSession) -> None:
    """Delete the stages of this application once its results are stored."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    _delete(spark, stage_root(spark))
