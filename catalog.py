"""Queries over the star-schema tables: one per operator, wiring only."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.columns import day_part, hash_bucket, quoted, replace_inf, weekday_weekend
from shelfwise.functions.ordering import dense_index
from shelfwise.functions.staging import dealt_by_rows, stage, stage_root
from shelfwise.operators import (
    assemble,
    classify,
    evaluate,
    explain,
    hierarchy,
    labels,
    profile,
    recency,
    recommend,
    sampling,
    segments,
    selection,
    transforms,
)
from shelfwise.plans import weekly
from shelfwise.schema import (
    CUST,
    CUSTOMER_VOCABULARY,
    LEVELS,
    PAIR,
    PROD,
    SEGMENT_VALUES,
    TRANSACTION_SCHEMA,
    Windows,
)
from shelfwise.sources import model_tables, transactions
from shelfwise.sources.basket_view import basket_view

Query = Callable[[SparkSession, str], DataFrame]

WINDOWS = Windows()
EVERY_WEEK = (0, 999999)
CORR_COLUMNS = ["SHOP_WEEKDAY", "SHOP_HOUR", "QUANTITY", "SPEND", "SHOP_WEEK"]
BASKET_SEGMENTS = ["BASKET_SIZE", "BASKET_PRICE_SENSITIVITY", "BASKET_TYPE", "BASKET_DOMINANT_MISSION"]
CUSTOMER_SEGMENTS = ["CUST_PRICE_SENSITIVITY", "CUST_LIFESTAGE"]
COUNTED = [
    "SHOP_WEEK",
    "SHOP_DATE",
    "SHOP_WEEKDAY",
    "SHOP_HOUR",
    *CUSTOMER_SEGMENTS,
    *BASKET_SEGMENTS,
    "STORE_FORMAT",
    "STORE_REGION",
    "PROD_CODE_10",
    "PROD_CODE_20",
    "PROD_CODE_30",
    "PROD_CODE_40",
]


def scratch(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Cut the floating-point noise that depends on the order of a sum."""
    return df.select(
        *[
            F.round(quoted(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else quoted(f.name)
            for f in df.schema
        ]
    )


def baskets(spark: SparkSession, path: str) -> DataFrame:
    """The view, staged: for chains that read it several times, which would each repeat the
    join behind it."""
    return stage(basket_view(spark, path), "baskets")


def observed(spark: SparkSession, path: str) -> DataFrame:
    weeks = (WINDOWS.obs_start, WINDOWS.obs_end)
    return labels.filter_window(basket_view(spark, path, weeks), *weeks)


def segmented(spark: SparkSession, path: str) -> DataFrame:
    return segments.with_shopping_segments(basket_view(spark, path))


def target_pairs(spark: SparkSession, path: str) -> DataFrame:
    week = WINDOWS.target_week
    return labels.targets(basket_view(spark, path, (week, week)), week)


def active(spark: SparkSession, path: str) -> DataFrame:
    weeks = (WINDOWS.active_start, WINDOWS.active_end)
    return labels.active_customers(basket_view(spark, path, weeks), *weeks)


def pair_table(spark: SparkSession, path: str) -> DataFrame:
    return labels.add_non_target(active(spark, path), stage(target_pairs(spark, path), "targets"))


def quantities(spark: SparkSession, path: str) -> DataFrame:
    return recommend.cust_quant_summ(basket_view(spark, path), *EVERY_WEEK)


def with_target(df: DataFrame) -> DataFrame:
    """Basket lines labelled by whether the shop was a top-up."""
    return df.withColumn("TARGET", (F.col("BASKET_TYPE") == "Top Up").cast("int"))


def scored(spark: SparkSession, path: str) -> DataFrame:
    return with_target(basket_view(spark, path)).select(
        "TARGET", ((F.col("QUANTITY") * 7 % 50) / 50.0).cast("double").alias("probability")
    )


def report_of_scores(spark: SparkSession, path: str) -> DataFrame:
    return rounded(evaluate.classification_report(evaluate.threshold_predictions(scored(spark, path))))


def split_flag(parts: tuple[DataFrame, DataFrame], flags: tuple[int, int]) -> DataFrame:
    return parts[0].withColumn("IN_TEST", F.lit(flags[0])).unionByName(
        parts[1].withColumn("IN_TEST", F.lit(flags[1]))
    )


def scan_transactions(spark, path):
    folder = scratch(spark, "csv")
    basket_view(spark, path).write.csv(folder, header=True)
    return transactions.scan_transactions(spark, folder)


def schema_conform(spark, path):
    drifted = basket_view(spark, path).select(
        *[
            (
                F.when(F.col("QUANTITY") % 10 == 0, "n/a").otherwise(F.col(c).cast("string"))
                if c == "SPEND"
                else F.col(c).cast("string")
            ).alias(c)
            for c in TRANSACTION_SCHEMA.names
        ]
    )
    return transactions.conform(drifted)


def snapshot_roundtrip(spark, path):
    folder = scratch(spark, "snapshot")
    transactions.write_snapshot(basket_view(spark, path), folder)
    stored = transactions.read_snapshot(spark, folder)
    return labels.filter_window(stored, WINDOWS.obs_start, WINDOWS.obs_end)


def model_input(spark, path):
    profiles = segments.seg_summary(segmented(spark, path), CUST, values=SEGMENT_VALUES)
    buyers = target_pairs(spark, path).select(CUST).distinct().withColumn("TARGET", F.lit(1))
    labelled = profiles.join(buyers, CUST, "left").fillna(0, ["TARGET"])
    features = [
        "BASKET_TYPE_PROP_VISITS_CUST_CODE_Small Shop",
        "BASKET_TYPE_SPEND_CUST_CODE_Top Up",
        "STORE_FORMAT_PROP_VISITS_CUST_CODE_MS",
        "DAY_PART_PROP_SPEND_CUST_CODE_AFTERNOON",
    ]
    return model_tables.model_input(labelled, features, keys=[CUST])


def replace_infinite(spark, path):
    rest = F.col("QUANTITY") % 25
    price = F.when(rest == 0, F.lit(float("inf"))).otherwise(
        F.try_divide(F.col("SPEND").cast("double"), rest)
    )
    return replace_inf(basket_view(spark, path).select("BASKET_ID", PROD, price.alias("price")))


def filter_cust_trans(spark, path):
    rows = basket_view(spark, path)
    train = labels.filter_window(rows, 200808, 200811)
    test = labels.filter_window(rows, 200812, 200815)
    return assemble.filter_cust_trans(rows, train, test, WINDOWS.obs_start, WINDOWS.obs_end)


def fixed_factors(rows: DataFrame, key: str) -> DataFrame:
    """Factor table with known values, so the assembly can be checked exactly."""
    ids = rows.select(key).where(F.col(key).isNotNull()).distinct()
    return ids.select(
        key, *[(hash_bucket(key, buckets=1000, seed=i) / 1000.0).alias(f"factor_{i}") for i in range(2)]
    )


def merge_features(spark, path):
    rows = baskets(spark, path)
    pairs = stage(weekly.training_sample(rows, WINDOWS), "pairs")
    window = labels.filter_window(rows, WINDOWS.obs_start, WINDOWS.obs_end)
    tables = weekly.feature_tables(window, WINDOWS, wanted=pairs, staged=True)
    user = weekly.prefixed_factors(fixed_factors(tables.transactions, CUST), CUST, "USER")
    item = weekly.prefixed_factors(fixed_factors(tables.transactions, PROD), PROD, "ITEM")
    return assemble.merge_features(
        pairs,
        tables.summary,
        None,
        tables.gaps,
        None,
        tables.customer_segments,
        tables.item_segments,
        user,
        item,
        side="IN_TEST",
    )


class FixedModel(NamedTuple):
    """Stands for a fitted factorisation, with known factors."""

    userFactors: DataFrame
    itemFactors: DataFrame
    rank: int


def fixed_model(spark, path):
    """Known factors over the real ids, the id tables and the rated pairs."""
    rows = stage(quantities(spark, path), "quantities")
    maps = {key: stage(dense_index(rows, key, f"index_{key}"), "ids") for key in PAIR}
    sides = [
        fixed_factors(rows, key).join(ids, key).select(
            F.col(f"index_{key}").alias("id"), F.array("factor_0", "factor_1").alias("features")
        )
        for key, ids in maps.items()
    ]
    pairs = recommend.merge_mapping(rows, maps[CUST], maps[PROD])
    return FixedModel(*sides, 2), maps, pairs


def score_pairs_fixed(spark, path):
    model, _, pairs = fixed_model(spark, path)
    return recommend.score_pairs(model, pairs).select(*PAIR, "QUANTITY", F.round("PRED_QUANTITY", 9).alias("score"))


def predict_top_x_fixed(spark, path):
    """Best products by factors that are multiples of a quarter, so that many scores tie."""
    model, maps, _ = fixed_model(spark, path)
    quarters = F.transform("features", lambda x: F.floor(x * 16) / 4.0)
    coarse = FixedModel(*[f.select("id", quarters.alias("features")) for f in model[:2]], 2)
    return recommend.predict_top_x(coarse, maps[CUST], maps[PROD], 5).withColumnRenamed("PRED_QUANTITY", "score")


def mse_fixed(spark, path):
    model, _, pairs = fixed_model(spark, path)
    return recommend.als_mse(model, pairs.where("QUANTITY > 50"), pairs.where("QUANTITY <= 50")).select(
        "split", "n", F.round("mse", 6).alias("mse")
    )


def factor_tables_fixed(spark, path):
    model, maps, _ = fixed_model(spark, path)
    users, items = recommend.user_item_factors(model, maps[CUST], maps[PROD])
    return users.withColumnRenamed(CUST, "code").unionByName(items.withColumnRenamed(PROD, "code"))


def merge_mapping(spark, path):
    rows = stage(quantities(spark, path), "quantities")
    return recommend.merge_mapping(
        rows, dense_index(rows, CUST, "index_CUST_CODE"), dense_index(rows, PROD, "index_PROD_CODE")
    )


def summary(spark, path):
    # Read several times; the join behind it is made once.
    columns = [CUST, "BASKET_ID", "SHOP_WEEK", "SPEND", "QUANTITY", *LEVELS]
    rows = stage(observed(spark, path).select(*columns), "lines")
    return hierarchy.sp_vi_qu(
        rows, labels.hierarchy_map(rows, LEVELS), WINDOWS.periods, WINDOWS.labels
    )


def gaps(spark, path):
    # Read several times; the join behind it is made once.
    rows = stage(observed(spark, path).select(CUST, "SHOP_DATE", *LEVELS), "lines")
    return recency.time_last_purchased(rows, labels.hierarchy_map(rows, LEVELS))


def segment_census(spark, path):
    rows = basket_view(spark, path)
    return profile.segment_census(rows, BASKET_SEGMENTS).unionByName(
        profile.segment_census(rows, CUSTOMER_SEGMENTS)
    )


def normalize(spark, path):
    clamped = stage(winsorize(spark, path), "clamped")
    bounds = transforms.group_bounds(clamped, PROD, "QUANTITY")
    return transforms.normalize_min_max(clamped, bounds, PROD, "QUANTITY")


def winsorize(spark, path):
    rows = stage(quantities(spark, path), "quantities")
    return transforms.winsorize(rows, [], ["QUANTITY"], 0.05, 0.05)[0]


def standardize(spark, path):
    fitted = transforms.moments(basket_view(spark, path), ["QUANTITY", "SPEND"])
    rows = basket_view(spark, path).select("BASKET_ID", PROD, "QUANTITY", "SPEND")
    return rounded(transforms.standardize(rows, fitted), 6)


def one_hot(spark, path):
    rows = basket_view(spark, path).select("BASKET_ID", PROD, *CUSTOMER_SEGMENTS)
    return transforms.one_hot(rows, transforms.categories(rows, CUSTOMER_SEGMENTS))


def vocab_indicator(spark, path):
    rows = basket_view(spark, path).select("BASKET_ID", PROD, *CUSTOMER_SEGMENTS, "BASKET_SIZE")
    return transforms.vocab_indicator(rows, {**CUSTOMER_VOCABULARY, "BASKET_SIZE": ["L", "M"]})


def dummies(spark, path):
    rows = basket_view(spark, path).select(
        "BASKET_ID", *CUSTOMER_SEGMENTS, "BASKET_SIZE", "SHOP_HOUR", "QUANTITY"
    )
    return transforms.dummies(rows, ["BASKET_ID"])


def class_weights(spark, path):
    return rounded(classify.class_weights(stage(pair_table(spark, path), "pairs")))


def threshold_predictions(spark, path):
    logit = (F.col("QUANTITY") - 25.5).cast("double") / 10.0
    rows = basket_view(spark, path).select(
        "BASKET_ID", PROD, evaluate.probability_from_logit(logit).alias("probability")
    )
    return rounded(evaluate.threshold_predictions(rows))


def sql_queries() -> dict[str, Query]:
    """Queries with an exact SQL counterpart."""
    view = basket_view
    top_up = lambda s, p: with_target(view(s, p))
    return {
        "scan_transactions": scan_transactions,
        "schema_conform": schema_conform,
        "snapshot_roundtrip": snapshot_roundtrip,
        "model_input": model_input,
        "filter_window": observed,
        "drop_null_customers": lambda s, p: labels.drop_null_customers(view(s, p)),
        "targets": target_pairs,
        "active_customers": active,
        "hierarchy_map": lambda s, p: labels.hierarchy_map(view(s, p), LEVELS),
        "day_part": lambda s, p: view(s, p).select(
            "BASKET_ID", PROD, "SHOP_HOUR", day_part().alias("DAY_PART")
        ),
        "weekday_weekend": lambda s, p: view(s, p).select(
            "BASKET_ID", PROD, "SHOP_WEEKDAY", weekday_weekend().alias("WKDAY_WKEND")
        ),
        "replace_inf": replace_infinite,
        "filter_cust_trans": filter_cust_trans,
        "add_non_target": pair_table,
        "merge_features": merge_features,
        "append_cust_segments": lambda s, p: assemble.append_cust_segments(
            view(s, p), target_pairs(s, p)
        ),
        "als_holdout": lambda s, p: split_flag(
            sampling.als_holdout(quantities(s, p), 0.1), (1, 0)
        ),
        "create_mapping": lambda s, p: dense_index(quantities(s, p), CUST, "index_CUST_CODE"),
        "merge_mapping": merge_mapping,
        "score_pairs_fixed": score_pairs_fixed,
        "predict_top_x_fixed": predict_top_x_fixed,
        "mse_fixed": mse_fixed,
        "factor_tables_fixed": factor_tables_fixed,
        "model_store": model_store,
        "pairs_csv_roundtrip": pairs_csv_roundtrip,
        "label_first_csv": label_first_csv,
        "snapshot_append": snapshot_append,
        "calendar_scan": calendar_scan,
        "stored_factors": stored_factors,
        "stored_report": stored_report,
        "sp_vi_qu": summary,
        "chng_features": lambda s, p: hierarchy.chng_features(summary(s, p), WINDOWS.labels[::-1]),
        "time_last_purchased": gaps,
        "time_since_ratios": lambda s, p: recency.time_since_ratios(gaps(s, p)),
        "cust_quant_summ": lambda s, p: recommend.cust_quant_summ(
            observed(s, p), WINDOWS.obs_start, WINDOWS.obs_end
        ),
        "seg_summary_cust": lambda s, p: segments.seg_summary(
            segmented(s, p), CUST, values=SEGMENT_VALUES
        ),
        "seg_summary_item": lambda s, p: segments.seg_summary(
            segmented(s, p), PROD, values=SEGMENT_VALUES
        ),
        "class_balance": lambda s, p: profile.class_balance(pair_table(s, p)),
        "distinct_counts": lambda s, p: profile.distinct_counts(view(s, p)),
        "describe": lambda s, p: rounded(
            profile.describe(view(s, p), ["SHOP_WEEKDAY", "SHOP_HOUR", "QUANTITY", "SPEND"]), 6
        ),
        "null_counts": lambda s, p: profile.null_counts(view(s, p)),
        "value_counts": lambda s, p: profile.value_counts(view(s, p), COUNTED),
        "segment_census": segment_census,
        "matrix_sparsity": lambda s, p: rounded(profile.matrix_sparsity(quantities(s, p))),
        "customer_split": lambda s, p: sampling.customer_split(active(s, p)),
        "three_way_split": lambda s, p: sampling.three_way_split(quantities(s, p)),
        "sample_non_target": lambda s, p: sampling.sample_non_target(
            stage(pair_table(s, p), "pairs")
        ),
        "row_split": lambda s, p: split_flag(sampling.row_split(pair_table(s, p), PAIR), (0, 1)),
        "stratified_folds": lambda s, p: sampling.stratified_folds(
            stage(pair_table(s, p), "pairs"), PAIR
        ),
        "winsorize": winsorize,
        "normalize_min_max": normalize,
        "standardize": standardize,
        "one_hot": one_hot,
        "vocab_indicator": vocab_indicator,
        "dummies": dummies,
        "squared_corr": lambda s, p: rounded(
            profile.squared_corr(top_up(s, p), "TARGET", 3, CORR_COLUMNS)
        ),
        "paired_corr": lambda s, p: rounded(profile.paired_corr(view(s, p), 5, CORR_COLUMNS)),
        "profile_numeric": lambda s, p: rounded(
            profile.profile_numeric(top_up(s, p), "SPEND", "TARGET"), 6
        ),
        "profile_categorical": lambda s, p: rounded(
            profile.profile_categorical(top_up(s, p), "CUST_LIFESTAGE", "TARGET")
        ),
        "density": lambda s, p: profile.density(view(s, p), "QUANTITY", 50).select(
            "point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density")
        ),
        "class_weights": class_weights,
        "threshold_predictions": threshold_predictions,
        "classification_report": report_of_scores,
        "roc_auc": lambda s, p: rounded(evaluate.roc_auc(scored(s, p))),
        "training_sample": lambda s, p: weekly.training_sample(view(s, p), WINDOWS),
    }


# Settings of the model queries: small fits over whole tables.
ALS_SETTINGS = {"alpha": 20.0, "rank": 5, "reg": 0.1, "iterations": 50}
FOREST = {"n_estimators": 10, "max_depth": 5}
FULL_FOREST = {"n_estimators": 236, "max_features": "log2", "max_depth": 12}
LINE_FEATURES = ["QUANTITY", "SHOP_HOUR", "SHOP_WEEKDAY", "BASKET_SIZE"]
LINE_KEYS = ["BASKET_ID", PROD]


def fitted_als(spark, path):
    data = recommend.als_input(basket_view(spark, path), *EVERY_WEEK)
    return data, recommend.fit_als(data.train, **ALS_SETTINGS)


def als_fit(spark, path):
    """Both factor tables of a fit, as id and vector."""
    _, model = fitted_als(spark, path)
    return model.userFactors.withColumn("side", F.lit("user")).unionByName(
        model.itemFactors.withColumn("side", F.lit("item"))
    )


def als_score_pairs(spark, path):
    data, model = fitted_als(spark, path)
    return recommend.score_pairs(model, data.test)


def als_mse(spark, path):
    data, model = fitted_als(spark, path)
    return recommend.als_mse(model, data.train, data.test)


def user_item_factors(spark, path):
    data, model = fitted_als(spark, path)
    users, items = recommend.user_item_factors(model, data.customers, data.items)
    return users.withColumnRenamed(CUST, "code").unionByName(items.withColumnRenamed(PROD, "code"))


def predict_top_x(spark, path):
    data, model = fitted_als(spark, path)
    return recommend.predict_top_x(model, data.customers, data.items, 10)


def als_tune(spark, path):
    data = recommend.als_input(basket_view(spark, path), *EVERY_WEEK)
    return recommend.trial_columns(recommend.tune_als(data.train, data.test).trials)


def lines(spark, path):
    """Basket lines labelled by whether their spend is high; read several times,
    so they are staged."""
    labelled = basket_view(spark, path).select(
        *LINE_KEYS, *LINE_FEATURES, (F.col("SPEND") > 25000).cast("int").alias("TARGET")
    )
    return stage(labelled, "lines")


def line_splits(spark, path) -> classify.Splits:
    train, valid = sampling.row_split(lines(spark, path), ["BASKET_ID"], 0.3, 7)
    return classify.prepare(train, valid, LINE_KEYS, LINE_FEATURES)


def encoded_lines(spark, path):
    rows = lines(spark, path)
    encoder = classify.fit_encoder(rows, LINE_KEYS, LINE_FEATURES)
    encoded = stage(classify.class_weights(encoder.vectors(rows)), "encoded")
    return dealt_by_rows(encoded, LINE_KEYS), encoder.names


def train_model(kind, settings, spark, path):
    """Scores of the validation rows."""
    splits = line_splits(spark, path)
    return classify.score(classify.train(kind, splits, settings), splits.valid)


def train_evaluate(spark, path):
    return classify.train_evaluate("forest", line_splits(spark, path), FOREST)[1]


def model_store(spark, path):
    """Validation rows, and those that a stored and loaded model scores otherwise."""
    splits = line_splits(spark, path)
    model = classify.train("logistic", splits, {})
    folder = scratch(spark, "model")
    model_tables.save_model(model, folder)
    before = classify.score(model, splits.valid)
    after = classify.score(model_tables.load_model(spark, folder), splits.valid)
    return before.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(before.exceptAll(after).count()).alias("n_different"))


def pairs_csv_roundtrip(spark, path):
    """Target pairs stored as CSV and read with their schema."""
    pairs = target_pairs(spark, path)
    folder = scratch(spark, "pairs")
    transactions.write_table(pairs, folder, "csv")
    return transactions.read_table(spark, folder, "csv", pairs.schema)


def snapshot_append(spark, path):
    """A snapshot, loads of later weeks, and one of them once more."""
    folder, rows = scratch(spark, "snapshot"), basket_view(spark, path)
    transactions.write_snapshot(rows.where("SHOP_WEEK <= 200810"), folder)
    for weeks in ("SHOP_WEEK > 200810", "SHOP_WEEK BETWEEN 200809 AND 200812"):
        transactions.append_weeks(rows.where(weeks), folder)
    return transactions.read_snapshot(spark, folder)


def calendar_scan(spark, path):
    """Weeks of the baskets as a calendar file, read back."""
    folder = scratch(spark, "calendar")
    weeks = basket_view(spark, path).groupBy("SHOP_WEEK").agg(
        F.min("SHOP_DATE").alias("DATE_FROM"), F.max("SHOP_DATE").alias("DATE_TO")
    )
    weeks.write.csv(f"{folder}/{transactions.CALENDAR_FILE}", header=True)
    return transactions.scan_calendar(spark, folder)


def stored_factors(spark, path):
    """Factor tables stored as CSV and parquet, one per side."""
    model, maps, _ = fixed_model(spark, path)
    sides = recommend.user_item_factors(model, maps[CUST], maps[PROD])
    found = []
    for table, key, fmt in zip(sides, PAIR, ("csv", "parquet"), strict=True):
        folder = scratch(spark, "factors")
        transactions.write_table(table, folder, fmt)
        found.append(transactions.read_table(spark, folder, fmt, table.schema).withColumnRenamed(key, "code"))
    return found[0].unionByName(found[1])


def stored_report(spark, path):
    """Evaluation report stored as JSON lines and read back."""
    report, folder = report_of_scores(spark, path), scratch(spark, "report")
    model_tables.write_report(report, folder)
    return spark.read.schema(report.schema).json(folder)


def label_first_csv(spark, path):
    """Lines stored label first without a header."""
    rows = with_target(basket_view(spark, path))
    folder = scratch(spark, "label-first")
    model_tables.write_label_first(rows, folder, ["QUANTITY", "SHOP_HOUR"])
    return spark.read.schema("TARGET int, QUANTITY int, SHOP_HOUR int").csv(folder)


def tune_classifier(spark, path):
    splits = line_splits(spark, path)
    search = classify.tune_classifier("logistic", splits.train, splits.test)
    return search.trials.withColumn("params", F.to_json("params"))


def rf_importance(spark, path):
    rows, names = encoded_lines(spark, path)
    return selection.rf_importance(rows, names, partial(classify.forest, **FOREST), 5)


def abs_coeffs(spark, path):
    rows, names = encoded_lines(spark, path)
    return selection.abs_coeffs(rows, names, partial(classify.logistic, iterations=20), 5)


def rfe_cv(spark, path):
    rows, names = encoded_lines(spark, path)
    return selection.rfe_cv(rows, names, LINE_KEYS, classify.logistic)


def best_subset(spark, path):
    rows, names = encoded_lines(spark, path)
    return selection.best_subset(rows, names, LINE_KEYS, classify.logistic, k=1)


def feature_clusters(spark, path):
    profiles = stage(segments.seg_summary(segmented(spark, path), CUST, values=SEGMENT_VALUES), "profiles")
    return selection.feature_clusters(profiles, [c for c in profiles.columns if c != CUST], 8)


def attributions(spark, path):
    rows, names = encoded_lines(spark, path)
    model = classify.forest(rows, n_estimators=5, max_depth=4).fit(rows)
    return explain.shap_values(rows, model, names, LINE_KEYS), names


def shap_values(spark, path):
    return attributions(spark, path)[0]


def shap_summary(spark, path):
    return explain.shap_summary(*attributions(spark, path))


def shap_dependence(spark, path):
    values, names = attributions(spark, path)
    return explain.shap_dependence(values, names, LINE_KEYS, "QUANTITY", "SHOP_HOUR")


def feature_table(spark, path):
    rows = baskets(spark, path)
    pairs = stage(weekly.training_sample(rows, WINDOWS), "pairs")
    found = weekly.recommend_products(rows, WINDOWS, top_x=10, **ALS_SETTINGS)
    return weekly.feature_table(rows, pairs, WINDOWS, found.user_factors, found.item_factors)


def recommend_products(spark, path):
    return weekly.recommend_products(
        basket_view(spark, path), WINDOWS, top_x=20, **ALS_SETTINGS
    ).predictions


def purchase_probability(spark, path):
    return weekly.purchase_probability(
        baskets(spark, path), WINDOWS, "forest", FOREST, {**ALS_SETTINGS, "top_x": 10}
    ).scores


def purchase_attributions(spark, path):
    """What the attributions of every labelled pair, at the full forest and all features,
    leave unexplained of its probability."""
    found = weekly.purchase_probability(
        baskets(spark, path), WINDOWS, "forest", FULL_FOREST, {**ALS_SETTINGS, "top_x": 10}
    )
    parts = [df.select(*PAIR, "TARGET", classify.FEATURES) for df in (found.splits.train, found.splits.test, found.splits.valid)]
    rows = stage(reduce(DataFrame.unionByName, parts), "labelled")
    # A residual of rounding errors is 0 here; adding 0 takes the sign from -0.
    return weekly.explain_purchases(found, rows).residuals.select(*PAIR, (F.round("residual", 6) + 0.0).alias("residual"))


def model_queries() -> dict[str, Query]:
    """Queries whose result rests on a fitted model."""
    return {
        "als_fit": als_fit,
        "als_score_pairs": als_score_pairs,
        "als_mse": als_mse,
        "user_item_factors": user_item_factors,
        "predict_top_x": predict_top_x,
        "als_tune": als_tune,
        "train_logistic": partial(train_model, "logistic", {}),
        "train_rf": partial(train_model, "forest", FOREST),
        "train_gbt": partial(train_model, "boosting", {"rounds": 5, "max_depth": 3}),
        "train_mlp": partial(train_model, "network", {"hidden": (8,), "epochs": 20}),
        "tune_classifier": tune_classifier,
        "train_evaluate": train_evaluate,
        "rf_importance": rf_importance,
        "abs_coeffs": abs_coeffs,
        "rfe_cv": rfe_cv,
        "best_subset": best_subset,
        "feature_clusters": feature_clusters,
        "shap_values": shap_values,
        "shap_summary": shap_summary,
        "shap_dependence": shap_dependence,
        "feature_table": feature_table,
        "recommend": recommend_products,
        "purchase_probability": purchase_probability,
        "purchase_attributions": purchase_attributions,
    }


def queries() -> dict[str, Query]:
    return {**sql_queries(), **model_queries()}
