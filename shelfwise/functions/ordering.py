"""Exact ranks, running totals and quantiles without a single-task window.

A window over a whole table, or over one group that holds a large share of it,
runs in one task. The functions here cut the order into ranges (or, where the
order is a hash, into equal hash buckets), work inside each piece, and add the
total of the pieces before it. The tables of piece totals hold a row per piece
and group, whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import hash_number, key_hash, quoted
from shelfwise.functions.staging import stage

# 4 hex digits: 65,536 buckets, so a bucket of 10^10 rows holds about 150,000.
BUCKET_DIGITS = 4


def dense_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """Distinct non-null values of ``column`` numbered from 0 in sorted order."""
    position_bits = 33  # layout of monotonically_increasing_id
    placed = stage(
        df.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .repartitionByRange(column)
        .sortWithinPartitions(column)
        .select(column, F.monotonically_increasing_id().alias("place")),
        "index",
    ).select(
        column,
        F.shiftright("place", position_bits).alias("piece"),
        F.col("place").bitwiseAND((1 << position_bits) - 1).alias("position"),
    )
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).select(
        "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    return placed.join(starts, "piece").select(
        column, (F.col("start") + F.col("position")).alias(index)
    )


def running_totals(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Add ``cum_<value>``: the total of ``value`` up to and including the row.

    Rows must be unique on ``groups + order``. The table is cut by ranges of
    ``groups + order``, so a group of any size is spread over many tasks.
    """
    groups, order = list(groups), list(order)
    pieces = stage(
        df.repartitionByRange(*groups, *order).withColumn("piece", F.spark_partition_id()),
        "running",
    )
    totals = pieces.groupBy("piece", *groups).agg(
        *[F.sum(v).alias(f"total_{v}") for v in values]
    )
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        F.col("piece").alias("o_piece"),
        *[F.col(g).alias(f"o_{g}") for g in groups],
        *[
            F.coalesce(F.sum(f"total_{v}").over(earlier), F.lit(0)).alias(f"before_{v}")
            for v in values
        ],
    )
    inside = (
        Window.partitionBy("piece", *groups)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same_piece = F.col("piece") == F.col("o_piece")
    for g in groups:
        same_piece = same_piece & F.col(g).eqNullSafe(F.col(f"o_{g}"))
    return (
        pieces.select(
            "*", *[F.sum(v).over(inside).alias(f"inside_{v}") for v in values]
        )
        .join(offsets, same_piece)
        .select(
            *df.columns,
            *[
                (F.col(f"inside_{v}") + F.col(f"before_{v}")).alias(f"cum_{v}")
                for v in values
            ],
        )
    )


def hash_rank(
    df: DataFrame,
    groups: Sequence[str],
    keys: Sequence[str],
    rank: str = "hash_rank",
    seed: int = 0,
) -> DataFrame:
    """Add the 0-based position of each row in the hash order of its group.

    Hash buckets hold equal shares of a group, so the row numbers are taken per
    (group, bucket) and a group of any size is spread evenly.
    """
    groups = list(groups)
    hashed = df.withColumn("digest", key_hash(*keys, seed=seed)).withColumn(
        "slot", hash_number(F.col("digest"), BUCKET_DIGITS)
    )
    before = (
        Window.partitionBy(*groups)
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = hashed.groupBy(*groups, "slot").agg(F.count(F.lit(1)).alias("n")).select(
        *groups, "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy(*groups, "slot").orderBy("digest", *keys)
    return (
        hashed.withColumn("inside", F.row_number().over(inside) - 1)
        # Rows lie by group and slot already. A table that is small as stored may hold too
        # many rows to be sent to every task, so the planner is not left to go by its bytes.
        .join(starts.hint("merge"), [*groups, "slot"])
        .select(*df.columns, (F.col("start") + F.col("inside")).alias(rank))
    )


def value_frequencies(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Long table ``groups, column, value, n`` of the non-null values of numeric columns."""
    pairs = ", ".join(
        f"'{c}', cast(`{c}` as double)" for c in columns
    )
    return (
        df.select(*groups, F.expr(f"stack({len(columns)}, {pairs}) as (column, value)"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*groups, "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _picked(cumulative: DataFrame, groups: list[str], ranks: dict[str, F.Column]) -> DataFrame:
    """Value at each wanted 0-based rank of each group of a running frequency table."""
    sizes = cumulative.groupBy(*groups).agg(F.max("cum_n").alias("size"))
    first = F.col("cum_n") - F.col("n")
    return (
        cumulative.join(sizes, groups)
        .groupBy(*groups)
        .agg(
            F.max("size").alias("size"),
            *[
                F.max(F.when((first <= r) & (r < F.col("cum_n")), F.col("value"))).alias(name)
                for name, r in ranks.items()
            ],
        )
    )


def order_statistics(
    df: DataFrame, columns: Sequence[str], ranks: dict[str, F.Column], groups: Sequence[str] = ()
) -> DataFrame:
    """Values at given ranks of each column; ``ranks`` are expressions over ``size``."""
    keys = [*groups, "column"]
    cumulative = running_totals(
        value_frequencies(df, columns, groups), keys, ["value"], ["n"]
    )
    return _picked(cumulative, keys, ranks)


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: dict[str, float], groups: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated quantiles, one row per group and column."""
    place = {name: (F.col("size") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    ranks = {}
    for name, h in place.items():
        ranks[f"{name}_lo"] = F.floor(h)
        ranks[f"{name}_hi"] = F.ceil(h)
    found = order_statistics(df, columns, ranks, groups)
    return found.select(
        *groups,
        "column",
        "size",
        *[
            (
                F.col(f"{name}_lo")
                + (h - F.floor(h)) * (F.col(f"{name}_hi") - F.col(f"{name}_lo"))
            ).alias(name)
            for name, h in place.items()
        ],
    )


def unpivot_doubles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Long form of numeric columns, cast to double."""
    return df.select(
        *keys, *[quoted(c).cast("double").alias(c) for c in columns]
    ).unpivot(
        [quoted(k) for k in keys], [quoted(c) for c in columns], name, value
    )
