"""Target and activity labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.staging import parts_of, stage
from shelfwise.schema import CUST, PAIR, PROD

TARGET = "TARGET"

# Products per block in the pair table. It bounds the array a task holds.
BLOCK = 1024


def filter_window(df: DataFrame, start: int, end: int) -> DataFrame:
    """Rows of the weeks ``start`` to ``end``, both included."""
    return df.where(F.col("SHOP_WEEK").between(start, end))


def drop_null_customers(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[CUST])


def targets(df: DataFrame, week: int) -> DataFrame:
    """Distinct (customer, product) pairs bought in the target week."""
    return (
        df.where(F.col("SHOP_WEEK") == week)
        .select(*PAIR)
        .dropna()
        .dropDuplicates()
        .withColumn(TARGET, F.lit(1))
    )


def active_customers(df: DataFrame, start: int, end: int) -> DataFrame:
    """Distinct customers with a purchase in the weeks ``start`` to ``end``."""
    return filter_window(df, start, end).select(CUST).dropna().distinct()


def hierarchy_map(df: DataFrame, levels: list[str]) -> DataFrame:
    """Distinct combinations of product code and parent levels."""
    return df.select(*levels).distinct()


def add_non_target(active: DataFrame, target_pairs: DataFrame) -> DataFrame:
    """Label every pair of an active customer and a target product.

    The result has a row per pair by definition. Only the last step writes them:
    before it, a customer meets blocks of up to ``BLOCK`` product codes, and the
    purchases are joined as one array per customer and block. The customers and blocks
    are laid into as many parts as the pairs need, as few bytes become many rows here.
    The codes, one entry per product, are sent to every task: by block number, all
    customers would lie with a few blocks. No shuffle carries the pair table. To draw
    a training sample, ``sampling.draw_pairs`` needs no pair table at all.
    """
    codes = stage(target_pairs.select(PROD).dropna().distinct(), "codes")
    n_codes = codes.count()
    n_blocks = max(1, -(-n_codes // BLOCK))
    people = stage(active.select(CUST), "people")
    parts = parts_of(active.sparkSession, people.count() * n_codes)
    block = F.pmod(F.xxhash64(PROD), F.lit(n_blocks)).alias("block")
    blocks = codes.select(PROD, block).groupBy("block").agg(F.collect_list(PROD).alias("codes"))
    bought = (
        target_pairs.select(*PAIR, block)
        .groupBy(CUST, "block")
        .agg(F.collect_set(PROD).alias("bought"))
    )
    return (
        people.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        .withColumn("block", F.col("block").cast("bigint"))
        .join(bought, [CUST, "block"], "left")
        .repartition(parts, CUST, "block")
        .join(F.broadcast(blocks), "block")
        .select(CUST, "bought", F.explode("codes").alias(PROD))
        .select(
            CUST,
            PROD,
            F.coalesce(F.array_contains("bought", F.col(PROD)), F.lit(False))
            .cast("int")
            .alias(TARGET),
        )
    )
