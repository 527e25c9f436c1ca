"""Reading the tables and naming their rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.functions.staging import stage

FILE, POSITION = "row_file", "row_position"

#: Class of the white space that separates words, and a word.
SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores in front while a column already has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def filed(df: DataFrame) -> DataFrame:
    """``df`` if its rows lie in files, else its staged copy."""
    try:
        _with_place(df, FILE, POSITION)
        return df
    except AnalysisException:
        return stage(df, "filed")


def located(df: DataFrame) -> tuple[DataFrame, str, str]:
    """Add the place of each row, a file and a position in it, and name both columns.

    The place identifies a row whatever its values are: ids may be null or
    repeated. ``df`` must be read from files (see ``filed``), so that its rows have
    the same places whenever they are read.
    """
    file, position = fresh(df.columns, FILE), fresh(df.columns, POSITION)
    return _with_place(df, file, position), file, position


def _with_place(df: DataFrame, file: str, position: str) -> DataFrame:
    place = df.metadataColumn("_metadata")
    return df.select(
        *[quoted(c) for c in df.columns],
        place["file_path"].alias(file),
        place["row_index"].alias(position),
    )


def numbered(df: DataFrame, label: str, row: str = "row") -> DataFrame:
    """Stage ``df`` with a unique number per row, which is fixed once written."""
    return stage(df.withColumn(row, F.monotonically_increasing_id()), label)


def normal_space(text: Column) -> Column:
    """Text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def keep_rows(docs: DataFrame, rows: DataFrame, file: str = FILE, position: str = POSITION) -> DataFrame:
    """Rows of ``docs`` whose place is in ``rows``, once per row of ``rows``.

    ``rows`` holds the places as ``file`` and ``position``.
    """
    placed, own_file, own_position = located(docs)
    wanted = rows.select(F.col(file).alias("wanted_file"), F.col(position).alias("wanted_position"))
    return placed.join(
        wanted,
        (F.col(own_file) == F.col("wanted_file")) & (F.col(own_position) == F.col("wanted_position")),
    ).select(*[placed[quoted_name(c)] for c in docs.columns])


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
