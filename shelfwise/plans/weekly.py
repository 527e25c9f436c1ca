"""The weekly chain: labels, features, recommendations and probabilities."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import columns_like, replace_inf
from shelfwise.functions.staging import dealt_by_rows, stage, stage_all
from shelfwise.operators import (
    assemble,
    classify,
    explain,
    hierarchy,
    labels,
    recency,
    recommend,
    sampling,
    segments,
)
from shelfwise.schema import CUST, MODEL_FEATURES, PAIR, PROD, SEGMENT_VALUES, SEGMENTS, Windows
from shelfwise.sources.model_tables import model_input, safe_name


def training_sample(transactions: DataFrame, windows: Windows, test_share: float = 0.3, seed: int = 42) -> DataFrame:
    """Balanced labelled pairs of the active customers, with IN_TEST.

    Customers are split first, and each side is sampled by itself.
    """
    bought = labels.targets(transactions, windows.target_week)
    active = labels.active_customers(transactions, windows.active_start, windows.active_end)
    split = sampling.customer_split(active, test_share, seed)
    return sampling.draw_pairs(split, bought, seed, ["IN_TEST"])


@dataclass
class FeatureTables:
    """Feature tables of one observation window; ``summary`` holds the changes of its
    periods and ``gaps`` the gap ratios."""

    transactions: DataFrame
    summary: DataFrame
    gaps: DataFrame
    customer_segments: DataFrame
    item_segments: DataFrame


def feature_tables(
    transactions: DataFrame,
    windows: Windows,
    values=SEGMENT_VALUES,
    wanted: DataFrame | None = None,
    staged: bool = False,
) -> FeatureTables:
    """Compute every feature table of the given (already restricted) rows.

    The rows, unless ``staged`` says that they are, and the tables that feed later joins are
    staged, so each is computed once. The four tables only depend on the rows and are
    computed side by side; the two of pairs lie in buckets of the pair and hold only
    ``wanted`` pairs where given, that of customers lies in buckets of the customer.
    """
    levels = list(windows.levels)
    rows = segments.with_shopping_segments(transactions)
    if not staged:
        rows = stage(rows, "restricted")
    products = labels.hierarchy_map(rows, levels)
    staged = stage_all(
        {
            "summary": hierarchy.sp_vi_qu(
                rows, products, windows.periods, windows.labels, levels, wanted, by_pair=True
            ),
            "gaps": recency.time_last_purchased(rows, products, levels, wanted),
            "customers": segments.seg_summary(rows, CUST, SEGMENTS, values),
            "items": segments.seg_summary(rows, PROD, SEGMENTS, values),
        },
        {"summary": PAIR, "gaps": PAIR, "customers": [CUST]},
    )
    return FeatureTables(
        transactions=rows,
        summary=hierarchy.with_changes(staged["summary"], windows.labels[::-1], levels),
        gaps=recency.with_ratios(staged["gaps"], levels),
        customer_segments=staged["customers"],
        item_segments=staged["items"],
    )


def prefixed_factors(factors: DataFrame, key: str, prefix: str) -> DataFrame:
    """Rename factor columns to ``USER_...`` or ``ITEM_...``."""
    return factors.select(
        key, *[F.col(c).alias(f"{prefix}_{c}") for c in columns_like(factors, "factor_")]
    )


def merge_all(
    pairs: DataFrame, tables: FeatureTables, user_factors: DataFrame, item_factors: DataFrame, fills=None, side=None
) -> DataFrame:
    """Join every feature table and the customer segments to labelled pairs."""
    merged = assemble.merge_features(
        pairs,
        tables.summary,
        None,
        tables.gaps,
        None,
        tables.customer_segments,
        tables.item_segments,
        prefixed_factors(user_factors, CUST, "USER"),
        prefixed_factors(item_factors, PROD, "ITEM"),
        fills,
        side,
    )
    return assemble.append_cust_segments(tables.transactions, merged)


def feature_table(
    transactions: DataFrame,
    pairs: DataFrame,
    windows: Windows,
    user_factors: DataFrame,
    item_factors: DataFrame,
) -> DataFrame:
    """Features of the train and test pairs (column IN_TEST tells them apart).

    Transactions are restricted to the modelled pairs and the observation
    window. Train and test are merged in one pass, and each fills its missing gaps with
    its own largest value.
    """
    sides = [pairs.where(F.col("IN_TEST") == side) for side in (0, 1)]
    restricted = assemble.filter_cust_trans(
        transactions, sides[0], sides[1], windows.obs_start, windows.obs_end
    )
    tables = feature_tables(restricted, windows)
    # Few bytes as stored become wide rows: the pairs are dealt by their number.
    pairs = dealt_by_rows(pairs, PAIR)
    return replace_inf(merge_all(pairs, tables, user_factors, item_factors, side="IN_TEST"))


@dataclass
class Recommendations:
    """Ranked products per customer and the factors behind them."""

    predictions: DataFrame
    user_factors: DataFrame
    item_factors: DataFrame
    errors: DataFrame


def recommend_products(
    transactions: DataFrame,
    windows: Windows,
    top_x: int = 1000,
    alpha: float = 20.0,
    rank: int = 5,
    reg: float = 0.1,
    iterations: int = 50,
    seed: int = 0,
) -> Recommendations:
    """Summarise, clamp, normalise, hold out, fit and rank."""
    data = recommend.als_input(transactions, windows.obs_start, windows.obs_end)
    model = recommend.fit_als(data.train, alpha, rank, reg, iterations, seed)
    users, items = recommend.user_item_factors(model, data.customers, data.items)
    return Recommendations(
        recommend.predict_top_x(model, data.customers, data.items, top_x),
        stage(users, "user-factors"),
        stage(items, "item-factors"),
        recommend.als_mse(model, data.train, data.test),
    )


@dataclass
class Purchases:
    """Scored validation pairs, the fitted model and its report."""

    scores: DataFrame
    report: DataFrame
    model: Model
    splits: classify.Splits


def purchase_probability(
    transactions: DataFrame,
    windows: Windows,
    kind: str = "forest",
    settings: Mapping[str, object] | None = None,
    als: Mapping[str, float] | None = None,
    seed: int = 42,
) -> Purchases:
    """From transactions to each test customer's ranked items for the week."""
    pairs = stage(training_sample(transactions, windows, seed=seed), "pairs")
    factors = recommend_products(transactions, windows, **(als or {}))
    wide = feature_table(transactions, pairs, windows, factors.user_factors, factors.item_factors)
    table = stage(model_input(wide, MODEL_FEATURES, [*PAIR, "IN_TEST"]), "model-input")
    splits = classify.prepare(
        table.where(F.col("IN_TEST") == 0),
        table.where(F.col("IN_TEST") == 1),
        PAIR,
        [safe_name(f) for f in MODEL_FEATURES],
    )
    model, report = classify.train_evaluate(kind, splits, settings or {})
    order = Window.partitionBy(CUST).orderBy(F.desc(classify.PROBABILITY))
    scores = classify.score(model, splits.valid).withColumn(
        "item_rank", F.dense_rank().over(order)
    )
    return Purchases(scores, report, model, splits)


@dataclass
class Explanation:
    """Attributions of pairs, what they leave unexplained, and their summary."""

    values: DataFrame
    residuals: DataFrame
    summary: DataFrame


def explain_purchases(purchases: Purchases, rows: DataFrame | None = None) -> Explanation:
    """Attributions of a forest's probabilities; of the validation pairs unless other
    encoded ``rows`` are given."""
    rows = purchases.splits.valid if rows is None else rows
    names = purchases.splits.encoder.names
    values = stage(explain.shap_values(rows, purchases.model, names, PAIR), "attributions")
    return Explanation(
        values,
        explain.residuals(values, rows, purchases.model, names, PAIR),
        explain.shap_summary(values, names),
    )
