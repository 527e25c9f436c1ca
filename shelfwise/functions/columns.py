"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def day_part(hour: str | Column = "SHOP_HOUR") -> Column:
    """Part of the day of a shopping hour; hours before 8 have none."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return (
        F.when(h.between(8, 11), "MORNING")
        .when(h.between(12, 16), "AFTERNOON")
        .when(h >= 17, "EVENING")
    )


def weekday_weekend(weekday: str | Column = "SHOP_WEEKDAY") -> Column:
    """WEEKEND for days 1 and 7, WEEKDAY for every other value."""
    d = F.col(weekday) if isinstance(weekday, str) else weekday
    return F.when(d.isin(1, 7), "WEEKEND").otherwise("WEEKDAY")


def shop_date(date: str | Column = "SHOP_DATE") -> Column:
    """Date value of a ``yyyymmdd`` integer."""
    d = F.col(date) if isinstance(date, str) else date
    return F.make_date(
        (d / 10000).cast("int"), (d / 100).cast("int") % 100, d % 100
    )


def ratio_sql(numerator: str, denominator: str) -> str:
    """Double quotient; 0 where it has no finite value or an operand is null.

    Wide tables are generated as SQL expressions: one string per column is
    analysed much faster than a tree of Column calls.
    """
    return (
        f"coalesce(try_divide(CAST({numerator} AS double), CAST({denominator} AS double)), 0D)"
    )


def key_hash(*keys: str | Column, seed: int = 0) -> Column:
    """Hex digest of a row key and a seed. It depends on neither the partitioning
    nor the row order, so a sample drawn from it can be drawn again."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *cols, F.lit(str(seed))))


def hash_number(digest: Column, digits: int = 8) -> Column:
    """Leading hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def hash_bucket(*keys: str | Column, buckets: int = 100, seed: int = 0) -> Column:
    """Bucket number in ``0 .. buckets-1`` of a row key."""
    return hash_number(key_hash(*keys, seed=seed)) % F.lit(buckets)


def double_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def columns_like(df: DataFrame, fragment: str) -> list[str]:
    """Columns whose name holds a fragment, such as CHNG, RATIO or PROP."""
    return [c for c in df.columns if fragment in c]


def quoted(name: str) -> Column:
    """Column by exact name; generated names may hold spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def literal(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def replace_inf(df: DataFrame) -> DataFrame:
    """Write 0 for every infinite value of the floating-point columns."""
    infinite = float("inf")
    return df.withColumns(
        {
            c: F.when(F.abs(quoted(c)) == infinite, F.lit(0.0)).otherwise(quoted(c))
            for c in double_columns(df)
        }
    )
