"""Deterministic samples and splits.

Every rule orders or buckets rows by a hash of their keys and a seed, so a
sample does not depend on the partitioning and can be drawn again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import hash_number, key_hash
from shelfwise.functions.ordering import hash_rank
from shelfwise.functions.staging import stage
from shelfwise.operators.labels import TARGET
from shelfwise.schema import CUST, PAIR, PROD

# Candidates per generated range in draw_pairs.
RANGE = 4096

# Values of the hash that shares are taken from.
HASH_VALUES = float(1 << 32)

# 3 hex digits: 4,096 hash buckets per product.
SLOT_DIGITS = 3


def in_share(*keys: str, share: float, seed: int = 0) -> Column:
    """True for about ``share`` of the keys, by the 32-bit hash of the key."""
    return hash_number(key_hash(*keys, seed=seed)) < F.lit(share * HASH_VALUES)


def customer_split(customers: DataFrame, test_share: float = 0.3, seed: int = 42) -> DataFrame:
    """Add IN_TEST to distinct customers."""
    return customers.withColumn(
        "IN_TEST", in_share(CUST, share=test_share, seed=seed).cast("int")
    )


def three_way_split(df: DataFrame, seed: int = 42) -> DataFrame:
    """Add SPLIT: train 67 %, test 16.5 % and valid 16.5 % of the customers.

    The split is a function of the customer, so all rows of one stay together
    without a join back.
    """
    number = hash_number(key_hash(CUST, seed=seed))
    return df.where(F.col(CUST).isNotNull()).withColumn(
        "SPLIT",
        F.when(number < F.lit(0.67 * HASH_VALUES), "train")
        .when(number < F.lit(0.835 * HASH_VALUES), "test")
        .otherwise("valid"),
    )


def row_split(df: DataFrame, keys: list[str], test_share: float = 0.2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split rows into (train, test)."""
    test = in_share(*keys, share=test_share, seed=seed)
    return df.where(~test), df.where(test)


def als_holdout(df: DataFrame, share: float, seed: int = 1234) -> tuple[DataFrame, DataFrame]:
    """Hold out a share of the (customer, product) rows: (test, train)."""
    test = in_share(*PAIR, share=share, seed=seed)
    return df.where(test), df.where(~test)


def stratified_folds(df: DataFrame, keys: list[str], label: str = TARGET, folds: int = 5, seed: int = 0) -> DataFrame:
    """Add ``fold``: each label is dealt to the folds in hash order."""
    ranked = hash_rank(df, [label], keys, "fold", seed)
    return ranked.withColumn("fold", (F.col("fold") % folds).cast("int"))


def sample_non_target(pairs: DataFrame, seed: int = 0) -> DataFrame:
    """Balance a labelled pair table: per product all positives, and as many
    negatives (or all of them, where there are fewer).

    The wanted negatives are the first of the product in hash order. Counts per
    (product, hash bucket) show which buckets are wanted whole and which one is
    cut, so rows are only ranked inside a bucket and a product that holds much
    of the table is spread over all tasks.
    """
    known = pairs.where(F.col(PROD).isNotNull())
    positives = known.where(F.col(TARGET) == 1)
    negatives = (
        known.where(F.col(TARGET) == 0)
        .withColumn("digest", key_hash(*PAIR, seed=seed))
        .withColumn("slot", hash_number(F.col("digest"), SLOT_DIGITS))
    )
    quotas = positives.groupBy(PROD).agg(F.count(F.lit(1)).alias("quota"))
    before = (
        Window.partitionBy(PROD)
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    wanted = (
        negatives.groupBy(PROD, "slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(quotas, PROD)
        .where(F.col("before") < F.col("quota"))
        .select(PROD, "slot", (F.col("quota") - F.col("before")).alias("room"))
    )
    inside = Window.partitionBy(PROD, "slot").orderBy("digest", CUST)
    drawn = (
        # All pairs of a product may be few bytes as stored, so the planner is not left to
        # send them to every task; the ranks need them by product and slot anyway.
        negatives.join(wanted.hint("merge"), [PROD, "slot"])
        .withColumn("place", F.row_number().over(inside))
        .where(F.col("place") <= F.col("room"))
    )
    return positives.unionByName(drawn.select(*pairs.columns))


def draw_pairs(
    active: DataFrame, target_pairs: DataFrame, seed: int = 0, strata: Sequence[str] = ()
) -> DataFrame:
    """Balanced labelled pairs of active customers and target products.

    It gives what balancing the table of all pairs would give - all positives,
    and per product as many non-buyers drawn without replacement - but never
    makes that table. The customers stand in a circle in hash order. A product
    starts at a place given by its own hash and takes the first non-buyers from
    there on. A product with n buyers meets n non-buyers within the next 2n
    places, so only 2n places per product are looked up. A stretch of a random
    order is a random subset, so each product's sample is uniform.

    ``strata`` are columns of ``active``, such as train or test; each stratum is
    a circle of its own and is sampled by itself.
    """
    strata = list(strata)
    people = active.select(CUST, *strata).dropDuplicates([CUST])
    circle = stage(hash_rank(people, strata, [CUST], "place", seed), "circle")
    positives = stage(
        target_pairs.select(*PAIR).distinct().join(circle.select(CUST, *strata), CUST),
        "positives",
    )
    product = [*strata, PROD]
    sizes = circle.groupBy(*strata).agg(F.count(F.lit(1)).alias("size"))
    counts = positives.groupBy(*product).agg(F.count(F.lit(1)).alias("quota"))
    step_size = F.lit(RANGE).cast("bigint")
    ranges = (
        (counts.join(sizes, strata) if strata else counts.withColumn("size", F.lit(circle.count())))
        .withColumn("span", F.least(2 * F.col("quota"), F.col("size")))
        .withColumn("start", hash_number(key_hash(PROD, seed=seed), 12) % F.col("size"))
        .withColumn(
            "first",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("span") - 1, step_size)),
        )
        # A product with many buyers is one row here; spread its ranges.
        .repartition(*product, "first")
    )
    candidates = stage(
        ranges.withColumn(
            "step",
            F.explode(F.sequence("first", F.least(F.col("first") + RANGE, F.col("span")) - 1)),
        )
        .withColumn("place", (F.col("start") + F.col("step")) % F.col("size"))
        .join(circle, [*strata, "place"])
        .join(positives.select(*PAIR), PAIR, "left_anti")
        .select(*PAIR, *strata, "quota", "first", "step"),
        "candidates",
    )
    before = (
        Window.partitionBy(*product)
        .orderBy("first")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    room = (
        candidates.groupBy(*product, "first")
        .agg(F.count(F.lit(1)).alias("n"), F.max("quota").alias("quota"))
        .select(
            *product,
            "first",
            (F.col("quota") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("room"),
        )
    )
    inside = Window.partitionBy(*product, "first").orderBy("step")
    negatives = (
        candidates.withColumn("order", F.row_number().over(inside))
        .join(room, [*product, "first"])
        .where(F.col("order") <= F.col("room"))
        .select(*PAIR, *strata, F.lit(0).alias(TARGET))
    )
    return positives.select(*PAIR, *strata, F.lit(1).alias(TARGET)).unionByName(negatives)
