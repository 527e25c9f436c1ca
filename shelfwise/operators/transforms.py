"""Statistical transforms. Each is fitted on training rows and applied to any.

A fit returns a small driver-side table (bounds per column, categories per
column), as the Spark ML estimators do; per-group bounds stay a DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import (
    literal,
    numeric_columns,
    quoted,
    string_columns,
)
from shelfwise.functions.ordering import order_statistics
from shelfwise.schema import CUSTOMER_VOCABULARY


def winsor_bounds(
    train: DataFrame, columns: Sequence[str], lower: float, upper: float
) -> dict[str, tuple[float, float]]:
    """Order statistics between which a column is clamped.

    Of n non-null values in order, the bounds are number ``int(lower * n)`` and
    number ``n - int(upper * n) - 1``, counted from 0, without interpolation.
    """
    low = F.floor(F.lit(float(lower)) * F.col("size"))
    high = F.col("size") - F.floor(F.lit(float(upper)) * F.col("size")) - 1
    found = order_statistics(train, columns, {"low": low, "high": high})
    return {r["column"]: (r["low"], r["high"]) for r in found.collect()}


def clamp(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Move values outside the bounds to the nearer bound; nulls stay null."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {
            c: F.when(quoted(c) < low, F.lit(low)).when(quoted(c) > high, F.lit(high))
            .otherwise(quoted(c))
            .cast(types[c])
            for c, (low, high) in bounds.items()
        }
    )


def winsorize(
    train: DataFrame, others: Sequence[DataFrame], columns: Sequence[str], lower: float, upper: float
) -> list[DataFrame]:
    """Clamp train and the other frames to the bounds of train."""
    bounds = winsor_bounds(train, columns, lower, upper)
    return [clamp(df, bounds) for df in (train, *others)]


def group_bounds(train: DataFrame, group: str, column: str) -> DataFrame:
    """Smallest and largest value of a column per group."""
    return (
        train.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))
    )


def normalize_min_max(df: DataFrame, bounds: DataFrame, group: str, column: str) -> DataFrame:
    """Scale a column to 0 .. 1 within its group and add 0.01.

    A group with one value gives 0.01. A row outside such a group's value has no
    finite score and gets 0. Rows of groups without bounds are left out.
    """
    width = F.col("high") - F.col("low")
    value = quoted(column).cast("double")
    score = (
        F.when(width != 0, (value - F.col("low")) / width + 0.01)
        .when(value == F.col("low"), F.lit(0.01))
        .when(value.isNull(), F.lit(0.01))
        .otherwise(F.lit(0.0))
    )
    return df.join(bounds, group).select(
        *[score.alias(column) if c == column else quoted(c) for c in df.columns]
    )


def moments(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column (1 for a constant)."""
    numbers = [quoted(c).cast("double") for c in columns]
    row = train.agg(
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(numbers)],
        *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(numbers)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, fitted: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Subtract the fitted mean and divide by the fitted deviation."""
    return df.withColumns(
        {
            c: (quoted(c).cast("double") - F.lit(mean)) / F.lit(deviation)
            for c, (mean, deviation) in fitted.items()
            if mean is not None
        }
    )


def categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Distinct non-null values of each column in alphabetical order.

    Each value is to become a column, so the values come to the driver; leave
    columns of free text out of ``columns``.
    """
    pairs = ", ".join(f"{literal(c)}, `{c}`" for c in columns)
    distinct = (
        train.select(F.expr(f"stack({len(columns)}, {pairs}) as (name, value)"))
        .where(F.col("value").isNotNull())
        .distinct()
    )
    rows = distinct.collect()
    return {c: sorted(r["value"] for r in rows if r["name"] == c) for c in columns}


def one_hot(df: DataFrame, fitted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each fitted column by a 0/1 column per category.

    A value that was not met in the fit is 0 in all of them.
    """
    kept = [quoted(c) for c in df.columns if c not in fitted]
    return df.select(
        *kept,
        *[
            F.coalesce(quoted(c) == v, F.lit(False)).cast("int").alias(f"{c}_{v}")
            for c, values in fitted.items()
            for v in values
        ],
    )


def vocab_indicator(
    df: DataFrame, vocabulary: Mapping[str, Sequence[str]] = CUSTOMER_VOCABULARY
) -> DataFrame:
    """Replace columns by a 0/1 column per vocabulary entry and one for values
    outside the vocabulary. A null is 0 in all of them."""
    kept = [quoted(c) for c in df.columns if c not in vocabulary]
    return df.select(
        *kept,
        *[
            F.coalesce(test, F.lit(False)).cast("int").alias(name)
            for c, values in vocabulary.items()
            for name, test in [
                *[(f"{c}_{v}", quoted(c) == v) for v in values],
                (f"{c}_OOV", ~quoted(c).isin(list(values))),
            ]
        ],
    )


def dummies(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame | None:
    """One-hot every string column and put the numeric columns behind; None when
    there is no string column. ``keys`` are passed through."""
    strings = string_columns(df, tuple(keys))
    if not strings:
        return None
    numbers = numeric_columns(df, tuple(keys))
    encoded = one_hot(df.select(*keys, *strings, *[quoted(c) for c in numbers]), categories(df, strings))
    coded = [c for c in encoded.columns if c not in numbers and c not in keys]
    return encoded.select(*keys, *[quoted(c) for c in [*coded, *numbers]])
