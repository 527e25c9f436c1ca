"""Implicit-feedback matrix factorisation and recommendations."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from random import Random

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from shelfwise.functions.ordering import dense_index
from shelfwise.functions.staging import Scratch, dealt_by_rows, stage, stage_root
from shelfwise.operators import few_items
from shelfwise.operators.labels import drop_null_customers, filter_window
from shelfwise.operators.sampling import als_holdout
from shelfwise.operators.topk import top_products
from shelfwise.operators.transforms import group_bounds, normalize_min_max, winsorize
from shelfwise.schema import CUST, PAIR, PROD

USER_INDEX = "index_CUST_CODE"
ITEM_INDEX = "index_PROD_CODE"
RATING = "QUANTITY"
SCORE = "PRED_QUANTITY"

# Blocks of the factor tables where both sides are large. The seeded start depends on
# them, so they do not follow the session. There are far fewer products than customers, and
# every customer block sends to every product block.
USER_BLOCKS, ITEM_BLOCKS = 16, 8


def cust_quant_summ(df: DataFrame, start: int, end: int) -> DataFrame:
    """Units bought per (customer, product) in a week range."""
    return (
        filter_window(drop_null_customers(df), start, end)
        .where(F.col(PROD).isNotNull())
        .groupBy(*PAIR)
        .agg(F.coalesce(F.sum(RATING), F.lit(0)).alias(RATING))
    )


def merge_mapping(df: DataFrame, customer_map: DataFrame, item_map: DataFrame) -> DataFrame:
    """Add the integer ids; rows with an unknown customer or product drop out."""
    return df.join(customer_map, CUST).join(item_map, PROD)


@dataclass
class AlsInput:
    """Train and test rows with ids, and the id tables."""

    train: DataFrame
    test: DataFrame
    customers: DataFrame
    items: DataFrame


def als_input(
    transactions: DataFrame,
    start: int,
    end: int,
    limits: tuple[float, float] = (0.05, 0.05),
    test_share: float = 0.1,
) -> AlsInput:
    """Sum, clamp, normalise per product, hold out rows and number the ids."""
    summed = stage(cust_quant_summ(transactions, start, end), "quantities")
    clamped = winsorize(summed, [], [RATING], *limits)[0]
    scaled = normalize_min_max(clamped, group_bounds(clamped, PROD, RATING), PROD, RATING)
    scaled = stage(scaled, "scaled")
    test, train = als_holdout(scaled, test_share)
    customers = stage(dense_index(train, CUST, USER_INDEX), "customer-ids")
    items = stage(dense_index(train, PROD, ITEM_INDEX), "item-ids")
    return AlsInput(
        train=stage(merge_mapping(train, customers, items), "train"),
        test=stage(merge_mapping(test, customers, items), "test"),
        customers=customers,
        items=items,
    )


def rating_columns(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        F.col(USER_INDEX).cast("int").alias("user"),
        F.col(ITEM_INDEX).cast("int").alias("item"),
        F.col(RATING).cast("float").alias("rating"),
    )


def few_item_blocks(ratings: DataFrame, rank: int) -> few_items.Blocks | None:
    """The ratings in blocks by customer, for fits of up to ``rank`` factors; None where the
    products are too many for it."""
    rows = rating_columns(ratings)
    items = rows.select("item").distinct()
    n = items.count()
    if not n or few_items.sums_bytes(n, rank) > few_items.TASK_BYTES:
        return None
    return few_items.pack(rows, np.array(sorted(r.item for r in items.collect())), rank)


def fit_als(
    ratings: DataFrame,
    alpha: float = 20.0,
    rank: int = 5,
    reg: float = 0.1,
    iterations: int = 50,
    seed: int = 0,
    user_blocks: int = USER_BLOCKS,
    item_blocks: int = ITEM_BLOCKS,
    blocks: few_items.Blocks | None = None,
) -> ALSModel | few_items.Factorisation:
    """Fit implicit ALS on (customer id, product id, quantity).

    The penalty is scaled by the number of ratings of a row and the confidence is
    1 + alpha x rating, as in Spark, so ``reg`` is much smaller than for libraries with a
    plain penalty. Where the products are few (``few_items``), what a step needs of all
    customers are small sums per product, and no customer's factors are exchanged;
    ``blocks`` are the ratings laid for it, where several fits share them. For more
    products it is Spark's ALS, which sends the factors of all customers of a product to
    one task in every step. Its factors are checkpointed every few iterations, which cuts
    the lineage of a long fit. Its numbers of blocks are settings of the fit: raise them
    with the cluster.
    """
    spark = ratings.sparkSession
    stage_root(spark)  # makes sure a checkpoint folder is set
    if laid := blocks or few_item_blocks(ratings, rank):
        model = few_items.fit(laid, rank, iterations, reg, float(alpha), seed)
        if laid is not blocks:
            laid.table.unpersist()
        return model
    als = ALS(
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        alpha=float(alpha),
        implicitPrefs=True,
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        checkpointInterval=5,
        coldStartStrategy="drop",
        seed=seed,
        intermediateStorageLevel="MEMORY_AND_DISK",
        finalStorageLevel="MEMORY_AND_DISK",
        userCol="user",
        itemCol="item",
        ratingCol="rating",
    )
    return als.fit(rating_columns(ratings))


def score_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add the dot product of the factors to the given pairs.

    Only these pairs are scored, by joins to both factor tables. Pairs with an
    unknown id are left out.
    """
    users = model.userFactors.select(F.col("id").cast("bigint").alias(USER_INDEX), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").cast("bigint").alias(ITEM_INDEX), F.col("features").alias("i"))
    dot = F.aggregate(
        F.zip_with("u", "i", lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return (
        pairs.join(users, USER_INDEX)
        .join(items, ITEM_INDEX)
        .select(*pairs.columns, dot.alias(SCORE))
    )


def mse(scored: DataFrame, actual: str = RATING, predicted: str = SCORE) -> DataFrame:
    """Mean squared difference of two columns, with the row count."""
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.pow(F.col(actual).cast("double") - F.col(predicted), 2)).alias("mse"),
    )


def als_mse(model: ALSModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """Error on the train and test rows whose ids are known."""
    return mse(score_pairs(model, train)).select(F.lit("train").alias("split"), "n", "mse").unionByName(
        mse(score_pairs(model, test)).select(F.lit("test").alias("split"), "n", "mse")
    )


def factor_table(factors: DataFrame, rank: int, mapping: DataFrame, key: str, index: str) -> DataFrame:
    """Factors as columns ``factor_0 ..`` keyed by the real code."""
    flat = factors.select(
        F.col("id").cast("bigint").alias(index),
        *[F.col("features")[i].cast("double").alias(f"factor_{i}") for i in range(rank)],
    )
    return flat.join(mapping, index).select(key, *[f"factor_{i}" for i in range(rank)])


def user_item_factors(model: ALSModel, customers: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        factor_table(model.userFactors, model.rank, customers, CUST, USER_INDEX),
        factor_table(model.itemFactors, model.rank, items, PROD, ITEM_INDEX),
    )


def predict_top_x(model: ALSModel, customers: DataFrame, items: DataFrame, top_x: int) -> DataFrame:
    """Products of dense rank up to ``top_x`` per customer, ties kept.

    Scores are those of ``score_pairs``. A customer whose factors are all zero scores
    every product alike and gets none (``topk.top_products``).
    """
    found = top_products(model.userFactors, model.itemFactors, top_x)
    return (
        found.select(
            F.col("user").alias(USER_INDEX), F.col("item").alias(ITEM_INDEX), F.col("score").alias(SCORE), "pred_rank"
        )
        .join(customers, USER_INDEX)
        .join(items, ITEM_INDEX)
        .select(CUST, PROD, SCORE, "pred_rank")
    )


# The searched ALS settings. The penalty has its own range, because
# Spark scales it by the number of ratings.
ALS_SPACE: dict[str, Sequence[float]] = {
    "alpha": list(range(5, 51, 5)),
    "rank": list(range(5, 31, 5)),
    "reg": [0.01, 0.03, 0.1, 0.3, 1.0],
    "iterations": list(range(50, 501)),
}


@dataclass
class AlsSearch:
    """Trials of a search (best first) and the best settings."""

    trials: DataFrame
    best: dict[str, float] = field(default_factory=dict)


def tune_als(
    train: DataFrame,
    test: DataFrame,
    trials: int = 25,
    space: Mapping[str, Sequence[float]] = ALS_SPACE,
    seed: int = 0,
    parallelism: int = 3,
) -> AlsSearch:
    """Seeded random search; the loss of a trial is its test error.

    The loop only picks settings: every trial is a distributed fit over rows
    that are kept in memory and on disk for the length of the search, by customer, so that
    the errors of a trial only move its factors, which go when it ends. A fit is a chain of
    short stages with one task per block, which leave cores idle, so trials run side by
    side; a trial's result does not depend on the others, its time does.
    """
    random = Random(seed)
    settings = [{name: random.choice(list(values)) for name, values in space.items()} for _ in range(trials)]
    stage_root(train.sparkSession)
    train = dealt_by_rows(train, [USER_INDEX]).persist(StorageLevel.MEMORY_AND_DISK)
    test = dealt_by_rows(test, [USER_INDEX]).persist(StorageLevel.MEMORY_AND_DISK)
    # Both are read by every trial: fill them once, before the trials start together.
    train.count(), test.count()
    blocks = few_item_blocks(train, max(int(s["rank"]) for s in settings))

    @inheritable_thread_target(train.sparkSession)
    def run(number: int) -> tuple:
        params, started = settings[number - 1], time.monotonic()
        with Scratch(train.sparkSession):
            model = fit_als(
                train,
                params["alpha"],
                int(params["rank"]),
                params["reg"],
                int(params["iterations"]),
                seed,
                USER_BLOCKS,
                ITEM_BLOCKS,
                blocks,
            )
            errors = {r["split"]: r["mse"] for r in als_mse(model, train, test).collect()}
        return (
            errors["test"],
            errors["train"],
            number,
            time.monotonic() - started,
            "ok",
            float(params["alpha"]),
            int(params["rank"]),
            float(params["reg"]),
            int(params["iterations"]),
        )

    with ThreadPool(max(1, min(parallelism, trials))) as pool:
        rows = pool.map(run, range(1, trials + 1), chunksize=1)
    train.unpersist()
    test.unpersist()
    if blocks:
        blocks.table.unpersist()
    table = train.sparkSession.createDataFrame(
        rows,
        "loss double, train_mse double, iteration int, train_time double, status string,"
        " alpha double, rank int, reg double, iterations int",
    )
    ordered = table.select(
        "loss",
        "train_mse",
        "iteration",
        "train_time",
        "status",
        F.struct("alpha", "rank", "reg", "iterations").alias("params"),
    ).orderBy("loss", "iteration")
    best = min(rows, key=lambda r: (r[0], r[2]))
    return AlsSearch(
        ordered, {"alpha": best[5], "rank": best[6], "reg": best[7], "iterations": best[8]}
    )


def trial_columns(trials: DataFrame) -> DataFrame:
    """Trial table with a column per parameter, best first."""
    return trials.select("loss", "iteration", "params.*").orderBy("loss", "iteration")
