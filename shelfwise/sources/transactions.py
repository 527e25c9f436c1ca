"""Transaction, calendar and stage sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import quoted
from shelfwise.schema import CALENDAR_SCHEMA, TRANSACTION_SCHEMA

CORRUPT = "_corrupt_record"
CALENDAR_FILE = "time.csv"
# Files whose first line is read at the same time.
HEADER_READERS = 16


def weekly_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Every file under ``path`` but those named exactly as the calendar."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load([path] if isinstance(path, str) else list(path))
        .select("path")
    )
    return sorted(r.path for r in listed.collect() if r.path.rsplit("/", 1)[-1] != CALENDAR_FILE)


def files_by_header(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by their header; empty files are left out. Only the first
    line of each file is read."""

    @inheritable_thread_target(spark)
    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).csv(file).columns)

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPool(HEADER_READERS) as pool:
        for file, names in zip(files, pool.map(header, files), strict=True):
            if names:
                groups.setdefault(names, []).append(file)
    return groups


def scan_transactions(
    spark: SparkSession,
    path: str | Sequence[str],
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read every file under ``path`` except the calendar as CSV with a header.

    Names and endings of the files do not matter, and they may be compressed.
    Files are appended by column name: columns that a file lacks are null, and
    columns outside the declared schema are left out. The declared types are
    enforced at the read, so they cannot drift between files. With
    ``keep_corrupt`` a line that does not fit is kept whole in
    ``_corrupt_record``; otherwise its bad values are null.
    """
    declared = {f.name: f for f in TRANSACTION_SCHEMA}
    extra = [T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []
    parts = []
    for header, files in files_by_header(spark, weekly_files(spark, path)).items():
        fields = [declared.get(c, T.StructField(c, T.StringType())) for c in header]
        df = (
            spark.read.schema(T.StructType(fields + extra))
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(files)
        )
        whole = df.withColumns({c: F.lit(None).cast(f.dataType) for c, f in declared.items() if c not in header})
        parts.append(whole.select(*declared, *[f.name for f in extra]))
    if not parts:
        return spark.createDataFrame([], T.StructType([*TRANSACTION_SCHEMA.fields, *extra]))
    return reduce(DataFrame.unionByName, parts)


def scan_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Read the calendar lookup that lies beside the weekly files."""
    return (
        spark.read.schema(CALENDAR_SCHEMA)
        .option("header", True)
        .csv(f"{folder.rstrip('/')}/{CALENDAR_FILE}")
    )


def conform(df: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Cast to the declared schema; columns that are missing become null and
    values that do not fit become null."""
    return df.select(
        *[
            (quoted(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def write_snapshot(df: DataFrame, path: str, partition: str = "SHOP_WEEK") -> None:
    """Store transactions partitioned by week, so a week filter prunes folders.

    The rebalance brings a week together for few files, and lets adaptive
    execution split a week that is much larger than the advisory size.
    """
    df.hint("rebalance", F.col(partition)).write.mode("overwrite").partitionBy(partition).parquet(path)


def append_weeks(df: DataFrame, path: str, partition: str = "SHOP_WEEK") -> None:
    """Put the weeks of ``df`` into a snapshot: each replaces what the snapshot held of it.

    Only the folders of those weeks are written, so a load neither touches nor doubles the
    others, and a load that is repeated after a failure leaves the same rows.
    """
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def read_snapshot(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a stored snapshot with its columns in declared order."""
    df = spark.read.option("basePath", path).parquet(path)
    return df.select(*(columns or [f.name for f in TRANSACTION_SCHEMA if f.name in df.columns]))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", header: bool = True) -> None:
    """Store a pairs, factor, prediction or feature table as parquet or CSV."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", header) if fmt == "csv" else writer).save(path)


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Read a stored table; CSV needs its schema, so no pass infers types."""
    if fmt == "csv" and schema is None:
        raise ValueError("give the schema of a CSV table")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)
