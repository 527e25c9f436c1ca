"""Summaries and feature profiles."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import literal, numeric_columns, quoted
from shelfwise.functions.ordering import quantiles, unpivot_doubles, value_frequencies
from shelfwise.schema import CUST, PROD

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def distinct_counts(df: DataFrame, columns: Sequence[str] = (CUST, PROD)) -> DataFrame:
    """Distinct non-null values per column, one row each.

    Values are made distinct per column first, so the count never holds a column
    in one task.
    """
    pairs = ", ".join(f"{literal(c)}, CAST(`{c}` AS string)" for c in columns)
    return (
        df.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, value)"))
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max per column."""
    basic = (
        unpivot_doubles(df, [], columns, "column", "value")
        .groupBy("column")
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    cuts = quantiles(df, columns, QUARTILES).drop("size")
    return basic.join(cuts, "column", "left").select(
        "column", "n", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls and rows per column, from one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)],
    )
    pairs = ", ".join(f"{literal(c)}, n_rows - c{i}" for i, c in enumerate(columns))
    return counts.select(
        F.expr(f"stack({len(columns)}, {pairs}) as (column, n_null)"), "n_rows"
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per non-null value of several columns, from one pass."""
    pairs = ", ".join(f"{literal(c)}, CAST(`{c}` AS string)" for c in columns)
    return (
        df.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, value)"))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def segment_census(df: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Value counts over the distinct (customer, segments) rows."""
    return value_counts(df.select(CUST, *segments).distinct(), segments)


def class_balance(df: DataFrame, label: str = "TARGET") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def matrix_sparsity(
    ratings: DataFrame, user: str = CUST, item: str = PROD, value: str = "QUANTITY"
) -> DataFrame:
    """100 x (1 - non-zero cells / (users x items))."""
    cells = ratings.groupBy(user, item).agg(F.sum(value).alias("v"))
    parts = cells.select(
        F.expr(f"stack(3, 'user', CAST({user} AS string), 'item', CAST({item} AS string), "
               "'cell', IF(v <> 0, '', NULL)) as (part, id)")
    )
    # Users and items are counted as distinct rows, cells as rows.
    counted = parts.where(F.col("id").isNotNull()).groupBy("part", "id").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.count(F.when(F.col("part") == "user", 1)).alias("n_users"),
        F.count(F.when(F.col("part") == "item", 1)).alias("n_items"),
        F.coalesce(F.sum(F.when(F.col("part") == "cell", F.col("n"))), F.lit(0)).alias("n_cells"),
    ).select(
        "n_users",
        "n_items",
        "n_cells",
        (
            100.0
            * (1 - F.col("n_cells").cast("double") / (F.col("n_users").cast("double") * F.col("n_items").cast("double")))
        ).alias("sparsity"),
    )


def squared_corr(df: DataFrame, target: str, k: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The k numeric features with the largest squared correlation with the target.

    A constant feature has no correlation and is not ranked.
    """
    columns = list(columns or numeric_columns(df, (target,)))
    long = unpivot_doubles(df.withColumn("target", quoted(target)), ["target"], columns, "features", "x")
    y = F.col("target").cast("double")
    both = F.col("x").isNotNull() & y.isNotNull()
    sums = (
        long.where(both)
        .groupBy("features")
        .agg(
            F.covar_pop("x", y).alias("cov"),
            F.var_pop("x").alias("var_x"),
            F.var_pop(y).alias("var_y"),
        )
    )
    squared = F.try_divide(F.col("cov") * F.col("cov"), F.col("var_x") * F.col("var_y"))
    return (
        sums.select("features", squared.alias("squared_correlation"))
        .where(F.col("squared_correlation").isNotNull())
        .orderBy(F.desc("squared_correlation"), "features")
        .limit(k)
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]):
    """Pearson matrix as a numpy array of features x features, each pair over the
    rows where both are set (null and NaN are not).

    Each batch gives sums of products, squares, values and counts per pair; they
    are added by Spark, so only one row per pair reaches the driver. Values are
    taken from the column means, which keeps the sums exact enough.
    """
    columns = list(columns)
    size = len(columns)
    inputs = [F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)]
    rows = df.select(*inputs)
    means = np.array([m or 0.0 for m in rows.agg(*[F.avg(c) for c in rows.columns]).first()], float)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((5, size, size))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - means
            on = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            total += np.stack([on.T @ on, x.T @ on, on.T @ x, (x * x).T @ on, x.T @ x])
        i, j = (a.ravel() for a in np.indices((size, size)))
        yield pd.DataFrame({"i": i, "j": j, **{f"s{k}": total[k].ravel() for k in range(5)}})

    added = (
        rows.mapInPandas(sums, "i int, j int, s0 double, s1 double, s2 double, s3 double, s4 double")
        .groupBy("i", "j")
        .agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(5)])
    )
    n, left, right, square, product = np.zeros((5, size, size))
    for r in added.collect():
        at = r.i, r.j
        n[at], left[at], right[at], square[at], product[at] = r.s0, r.s1, r.s2, r.s3, r.s4
    with np.errstate(all="ignore"):
        spread = np.maximum(square - left * left / n, 0)
        matrix = (product - left * right / n) / np.sqrt(spread * spread.T)
    constant = spread <= 1e-14 * square
    return np.where(constant | constant.T, np.nan, matrix)


def paired_corr(df: DataFrame, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The n pairs of numeric features with the largest absolute correlation.

    Pairs are taken above the diagonal, in column order.
    """
    columns = list(columns or numeric_columns(df))
    matrix = correlation_matrix(df, columns)
    pairs = [
        (a, columns[j], abs(float(matrix[i, j])))
        for i, a in enumerate(columns)
        for j in range(i + 1, len(columns))
        if not math.isnan(matrix[i, j])
    ]
    found = df.sparkSession.createDataFrame(
        pairs, "feature_1 string, feature_2 string, abs_correlation double"
    )
    return found.orderBy(F.desc("abs_correlation"), "feature_1", "feature_2").limit(n)


def _extent(df: DataFrame, column: str):
    """Count, mean, deviation, min and max of a column as one row."""
    x = quoted(column).cast("double")
    return df.agg(
        F.count(x).alias("n"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
    ).first()


def profile_numeric(df: DataFrame, column: str, target: str, bins: int = 10) -> DataFrame:
    """Profile of a numeric feature as rows ``section, item, value``.

    Sections: ``missing`` (nulls and rows), ``summary``, ``histogram`` (count per
    equal-width bin, the last one closed) and ``box <target>`` (quartiles and
    the ends of the whiskers at 1.5 interquartile ranges).
    """
    x = quoted(column).cast("double")
    extent = _extent(df, column)
    missing = null_counts(df, [column]).select(
        F.lit("missing").alias("section"),
        F.expr("stack(2, 'nulls', CAST(n_null AS double), 'rows', CAST(n_rows AS double)) as (item, value)"),
    )
    stats = ["n", "mean", "std", "min", "p25", "p50", "p75", "max"]
    pairs = ", ".join(f"'{s}', CAST({s} AS double)" for s in stats)
    summary = describe(df, [column]).select(
        F.lit("summary").alias("section"), F.expr(f"stack({len(stats)}, {pairs}) as (item, value)")
    )
    out = missing.unionByName(summary)
    if extent["low"] is None:
        return out
    width = (extent["high"] - extent["low"]) / bins or 1.0
    bin_number = F.least(
        F.floor((x - F.lit(extent["low"])) / F.lit(width)), F.lit(bins - 1)
    )
    histogram = (
        df.where(x.isNotNull())
        .groupBy(bin_number.alias("bin"))
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(F.lit("histogram").alias("section"), F.col("bin").cast("string").alias("item"), "value")
    )
    labelled = df.select(quoted(target).cast("string").alias("label"), x.alias("x"))
    cuts = quantiles(labelled, ["x"], QUARTILES, ["label"])
    reach = 1.5 * (F.col("p75") - F.col("p25"))
    inside = F.col("x").between(F.col("p25") - reach, F.col("p75") + reach)
    whiskers = (
        value_frequencies(labelled, ["x"], ["label"])
        .select(F.col("label").alias("l"), F.col("value").alias("x"))
        .join(cuts, F.col("l").eqNullSafe(F.col("label")))
        .groupBy("label", "p25", "p50", "p75")
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("low"),
            F.max(F.when(inside, F.col("x"))).alias("high"),
        )
    )
    boxes = whiskers.select(
        F.concat(F.lit("box "), F.coalesce("label", F.lit("null"))).alias("section"),
        F.expr("stack(5, 'low', low, 'p25', p25, 'p50', p50, 'p75', p75, 'high', high) as (item, value)"),
    )
    return out.unionByName(histogram).unionByName(boxes)


def profile_categorical(df: DataFrame, column: str, target: str) -> DataFrame:
    """Rows, target mean and target deviation per value; nulls have a row too."""
    y = quoted(target).cast("double")
    return (
        df.groupBy(quoted(column).alias("value"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(y).alias("target_mean"),
            F.stddev_samp(y).alias("target_sd"),
        )
        .withColumn("is_null", F.col("value").isNull().cast("int"))
    )


def density(df: DataFrame, column: str, points: int = 100, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of a column on an even grid.

    The bandwidth is Scott's: deviation x n^(-1/5); the grid reaches ``cut``
    bandwidths beyond the data. Each distinct value adds to every grid point
    once, weighted by its count, and the grid sums are combined map-side.
    """
    extent = _extent(df, column)
    if not extent["n"] or not extent["std"]:
        raise ValueError("a density needs two distinct values")
    width = extent["std"] * extent["n"] ** (-1.0 / 5.0)
    first = extent["low"] - cut * width
    step = (extent["high"] + cut * width - first) / (points - 1)
    scale = 1.0 / (extent["n"] * width * math.sqrt(2.0 * math.pi))
    x = F.lit(first) + F.col("point") * F.lit(step)
    z = (x - F.col("value")) / F.lit(width)
    return (
        value_frequencies(df, [column])
        .select("value", "n", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .groupBy("point")
        .agg((F.sum(F.col("n") * F.exp(-0.5 * z * z)) * F.lit(scale)).alias("density"))
        .select("point", x.alias("x"), "density")
    )
