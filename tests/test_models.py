import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import classify, explain, recommend, selection, topk


@pytest.fixture(scope="module")
def ratings(spark):
    r = random.Random(9)
    rows = [
        (f"U{u}", f"P{p}", 1.01 if u % 2 == p % 2 else 0.01)
        for u in range(30) for p in range(12) if r.random() < (0.8 if u % 2 == p % 2 else 0.1)
    ]
    df = spark.createDataFrame(rows, "CUST_CODE string, PROD_CODE string, QUANTITY double")
    users = recommend.dense_index(df, "CUST_CODE", recommend.USER_INDEX).cache()
    items = recommend.dense_index(df, "PROD_CODE", recommend.ITEM_INDEX).cache()
    return recommend.merge_mapping(df, users, items).cache(), users, items


@pytest.fixture(scope="module")
def als(ratings):
    return recommend.fit_als(ratings[0], alpha=20, rank=4, reg=0.05, iterations=6)


def test_factors_keep_the_codes(ratings, als):
    df, users, items = ratings
    u, i = recommend.user_item_factors(als, users, items)
    assert {r.CUST_CODE for r in u.collect()} == {r.CUST_CODE for r in df.collect()}
    assert u.columns == ["CUST_CODE", "factor_0", "factor_1", "factor_2", "factor_3"]
    assert all(math.isfinite(v) for r in i.collect() for v in r[1:])


def test_scores_are_dot_products(ratings, als):
    df, users, items = ratings
    u = {r.id: np.array(r.features) for r in als.userFactors.collect()}
    v = {r.id: np.array(r.features) for r in als.itemFactors.collect()}
    unknown = df.limit(1).withColumn(recommend.ITEM_INDEX, F.lit(999).cast("bigint"))
    scored = recommend.score_pairs(als, df.unionByName(unknown)).collect()
    assert len(scored) == df.count()
    for r in scored:
        assert r.PRED_QUANTITY == pytest.approx(float(u[r.index_CUST_CODE] @ v[r.index_PROD_CODE]), abs=1e-5)
    errors = {r.split: r.mse for r in recommend.als_mse(als, df, df).collect()}
    assert errors["train"] == pytest.approx(np.mean([(r.QUANTITY - r.PRED_QUANTITY) ** 2 for r in scored]))


@pytest.mark.parametrize("top_x", [1, 3, 50])
def test_top_products_match_all_scores(spark, ratings, als, top_x):
    _, users, items = ratings
    pairs = [(*u, *i) for u in users.collect() for i in items.collect()]
    names = [*users.columns, *items.columns]
    everything = recommend.score_pairs(als, spark.createDataFrame(pairs, names)).collect()
    expected = set()
    for _, group in itertools.groupby(sorted(everything, key=lambda r: r.CUST_CODE), lambda r: r.CUST_CODE):
        group = sorted(group, key=lambda r: -r.PRED_QUANTITY)[:top_x]
        expected |= {(r.CUST_CODE, r.PROD_CODE) for r in group}
    found = recommend.predict_top_x(als, users, items, top_x).collect()
    assert {(r.CUST_CODE, r.PROD_CODE) for r in found} == expected
    # Even and odd customers are recommended their own kind first.
    best = [r for r in found if r.pred_rank == 1]
    assert sum(int(r.CUST_CODE[1:]) % 2 == int(r.PROD_CODE[1:]) % 2 for r in best) >= 0.9 * len(best)


class TiedModel:
    """Stands for a fitted model: every product scores the same for user 0."""

    def __init__(self, spark, n):
        self.userFactors = spark.createDataFrame(
            [(0, [0.5, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 0.0])], "id int, features array<float>"
        )
        self.itemFactors = spark.createDataFrame([(i, [1.0, float(n - i)]) for i in range(n)], "id int, features array<float>")


def test_ties_are_all_kept(spark):
    n = 9
    users = spark.createDataFrame([("U0", 0), ("U1", 1), ("U2", 2)], "CUST_CODE string, index_CUST_CODE bigint")
    items = spark.createDataFrame([(f"P{i}", i) for i in range(n)], "PROD_CODE string, index_PROD_CODE bigint")
    found = recommend.predict_top_x(TiedModel(spark, n), users, items, 2).collect()
    assert sorted(r.PROD_CODE for r in found if r.CUST_CODE == "U0") == [f"P{i}" for i in range(n)]
    assert sorted((r.PROD_CODE, r.pred_rank) for r in found if r.CUST_CODE == "U1") == [("P0", 1), ("P1", 2)]
    assert not any(r.CUST_CODE == "U2" for r in found)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 600])
def test_best_products_by_chunks(spark, chunk_bytes, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 4)
    draw = np.random.default_rng(3)
    # Quarters tie often; lengths differ by far, so that scans end early.
    users = np.round(draw.normal(size=(40, 3)) * 4) / 4
    items = np.round(draw.normal(size=(90, 3)) * draw.exponential(2, (90, 1)) * 4) / 4
    table = lambda m: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "id long, features array<double>")
    got = topk.top_products(table(users), table(items), 4, chunk_bytes).collect()
    expected = set()
    for u, row in enumerate(users):
        scores = (row * items).sum(1)
        ranks = {s: i for i, s in enumerate(sorted(set(scores.tolist()), reverse=True), 1)}
        if row.any():
            expected |= {(u, i, s, ranks[s]) for i, s in enumerate(scores.tolist()) if ranks[s] <= 4}
    assert sorted(map(tuple, got)) == sorted(expected)


def test_best_products_of_nothing(spark):
    some = spark.createDataFrame([(1, [1.0])], "id long, features array<double>")
    assert topk.top_products(some, some.limit(0), 3).collect() == []
    assert topk.top_products(some.limit(0), some, 3).collect() == []


def test_scans_end_at_the_bound(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 10)
    seen = []
    dots = topk.dots
    monkeypatch.setattr(topk, "dots", lambda u, v: seen.append(len(u)) or dots(u, v))
    items = np.linspace(100, 1, 100)[:, None]
    none = [(np.empty(0), np.empty(0, np.int64))] * 2
    found, more = topk.scan(np.array([[1.0], [-1.0]]), none, items, np.arange(100), items[:, 0], 0.5, 3)
    assert found[0][1].tolist() == [0, 1, 2] and not more[0]
    # The second customer likes the shortest best and must see all.
    assert sorted(found[1][1].tolist()) == [97, 98, 99] and more[1] and seen == [2] + [1] * 9


def test_als_search_finds_its_lowest_loss(ratings):
    df = ratings[0]
    space = {"alpha": [5, 40], "rank": [2, 4], "reg": [0.01, 1.0], "iterations": [2]}
    search = recommend.tune_als(df, df, 3, space)
    rows = recommend.trial_columns(search.trials).collect()
    assert len(rows) == 3 and rows[0].loss == min(r.loss for r in rows)
    assert rows[0].alpha == search.best["alpha"]


def test_als_input_normalises_and_numbers(make_lines, random_lines):
    df = make_lines(random_lines(400, 11))
    data = recommend.als_input(df, 200801, 200808)
    n = recommend.cust_quant_summ(df, 200801, 200808).count()
    assert data.train.count() + data.test.count() <= n
    assert all(0 <= r.QUANTITY <= 1.01 for r in data.train.collect())


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(10)
    rows = []
    for i in range(400):
        a, b, c = r.gauss(0, 1), r.gauss(0, 1), r.gauss(0, 1)
        rows.append((f"K{i}", a, 2 * a + r.gauss(0, 0.1), b, c, r.choice(["x", "y"]), int(a + 0.5 * b + r.gauss(0, 0.3) > 0.4)))
    return spark.createDataFrame(rows, "id string, a double, a2 double, b double, c double, s string, TARGET int")


@pytest.fixture(scope="module")
def encoded(table):
    encoder = classify.fit_encoder(table, ["id"], ["a", "b", "c", "s"])
    return classify.class_weights(encoder.vectors(table)).cache(), encoder.names


def small_forest(rows):
    return classify.forest(rows, n_estimators=4, max_depth=4, seed=3)


def test_weights_balance_the_classes(encoded):
    sums = encoded[0].groupBy("TARGET").agg(F.sum("weight").alias("w")).collect()
    assert sums[0].w == pytest.approx(200) and sums[1].w == pytest.approx(200)


@pytest.mark.parametrize(
    ("kind", "settings"),
    [
        ("logistic", {"reg_param": 1.0}),
        ("forest", {"n_estimators": 10, "max_depth": 5}),
        ("boosting", {"rounds": 10, "max_depth": 3}),
        ("network", {"hidden": (4,), "epochs": 60}),
    ],
)
def test_models_learn(table, kind, settings, tmp_path):
    splits = classify.prepare(table.where("id < 'K7'"), table.where("id >= 'K7'"), ["id"])
    model, report = classify.train_evaluate(kind, splits, settings)
    rows = {r["class"]: r.precision for r in report.collect()}
    assert rows["roc_auc scores"] > 0.85
    model.write().overwrite().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    a = {r.id: r.probability_1 for r in classify.score(model, splits.valid).collect()}
    b = {r.id: r.probability_1 for r in classify.score(again, splits.valid).collect()}
    assert a == pytest.approx(b)


def test_classifier_search(table):
    splits = classify.prepare(table.where("id < 'K7'"), table.where("id >= 'K7'"), ["id"])
    search = classify.tune_classifier("logistic", splits.train, splits.test, trials=4, parallelism=2)
    rows = search.trials.collect()
    assert len(rows) == 4 and rows[0].objective == max(r.objective for r in rows)
    assert float(rows[0].params["reg_param"]) == search.best["reg_param"]


def test_rankings(encoded):
    df, names = encoded
    top = selection.rf_importance(df, names, small_forest, 10).collect()
    assert sum(r.rf_importance for r in top) == pytest.approx(1.0)
    assert top[0].features == "a" and [r.rf_rank for r in top] == list(range(1, len(names) + 1))
    coefficients = selection.abs_coeffs(df, names, classify.logistic, 2).collect()
    assert [r.features for r in coefficients] == ["a", "b"]
    assert coefficients[0].coeff_abs == abs(coefficients[0].coeff)


def test_elimination_keeps_the_signal(encoded):
    df, names = encoded
    rows = {r.features: r for r in selection.rfe_cv(df, names, ["id"], lambda d: classify.logistic(d, iterations=10), folds=2).collect()}
    assert rows["a"].selected and rows["b"].selected
    steps = selection.best_subset(df, names, ["id"], lambda d: classify.logistic(d, iterations=10), 2).collect()
    assert [r.n_features for r in steps] == [5, 4, 3, 2]
    best, = [r for r in steps if r.is_best]
    assert best.auc == max(r.auc for r in steps) and "a" in best.features


def brute_ward(columns, n):
    clusters = [[i] for i in range(len(columns))]

    def spread(c):
        points = columns[c]
        return ((points - points.mean(axis=0)) ** 2).sum()

    while len(clusters) > n:
        i, j = min(
            itertools.combinations(range(len(clusters)), 2),
            key=lambda p: spread(clusters[p[0]] + clusters[p[1]]) - spread(clusters[p[0]]) - spread(clusters[p[1]]),
        )
        clusters[i] += clusters.pop(j)
    return {frozenset(c) for c in clusters}


@pytest.mark.parametrize("standardized", [True, False])
def test_feature_clusters(spark, standardized):
    r = np.random.default_rng(12)
    base = r.normal(size=(60, 3))
    data = np.hstack([base + r.normal(scale=s, size=base.shape) for s in (0.1, 0.5)] + [np.ones((60, 1))])
    names = [f"f{i}" for i in range(7)]
    df = spark.createDataFrame([tuple(map(float, row)) for row in data], names)
    found = selection.feature_clusters(df, names, 3, standardized).collect()
    groups = {frozenset(names.index(r.features) for r in found if r.cluster_number == k) for k in range(3)}
    columns = data.copy()
    if standardized:
        spread = columns.std(axis=0)
        columns = (columns - columns.mean(axis=0)) / np.where(spread == 0, 1, spread)
    assert groups == brute_ward(columns.T, 3)


def test_parts_of_a_forest_add_up(spark, encoded, monkeypatch):
    df, names = encoded
    model = small_forest(df).fit(df)
    whole = {r.id: [*r[1:-1]] for r in explain.shap_values(df, model, names, ["id"]).collect()}
    for setting, value in {"PART_TESTS": 12, "STACK_PATHS": 3, "BATCH_ROWS": 20, "CELLS": 50}.items():
        monkeypatch.setattr(explain, setting, value)
    found = explain.shap_values(df, model, names, ["id"]).collect()
    assert len(found) == len(whole)
    for r in found:
        assert [*r[1:-1]] == pytest.approx(whole[r.id])


def test_attributions_of_no_rows_repeated_rows_and_a_forest_of_leaves(spark, encoded):
    df, names = encoded
    model = small_forest(df).fit(df)
    assert explain.shap_values(df.limit(0), model, names, ["id"]).count() == 0
    first = df.orderBy("id").limit(1)
    twice = explain.shap_values(first.union(first), model, names, ["id"]).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    leaves = classify.forest(df, n_estimators=3, max_depth=0).fit(df)
    for r in explain.shap_values(first, leaves, names, ["id"]).collect():
        assert all(r[n] == 0 for n in names)
        assert r.base_value == pytest.approx(classify.score(leaves, first).first().probability_1)


def test_attributions_at_full_size_leave_no_residual(spark, encoded):
    df, names = encoded
    model = classify.forest(df, 236, "log2", 12).fit(df)
    found = explain.residuals(explain.shap_values(df, model, names, ["id"]), df, model, names, ["id"]).collect()
    assert len(found) == df.count() and max(abs(r.residual) for r in found) < 1e-9


def test_als_does_not_depend_on_the_partitions(spark, ratings):
    def factors(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            model = recommend.fit_als(ratings[0].repartition(partitions), rank=3, iterations=20)
            rows = [*model.userFactors.collect(), *[r for r in model.itemFactors.collect()]]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        return np.array([f for r in sorted(rows) for f in r.features])

    assert np.allclose(factors(4), factors(8), atol=1e-4)


def test_attributions_are_shapley_values(spark, encoded):
    df, names = encoded
    model = small_forest(df).fit(df)
    values = explain.shap_values(df, model, names, ["id"]).collect()
    probability = {r.id: r.probability_1 for r in classify.score(model, df).collect()}
    for r in values:
        assert sum(r[n] for n in names) + r.base_value == pytest.approx(probability[r.id])
    # Brute force: expectation with only a set of features known, over all sets.
    stacks = explain.path_stacks(explain.stored_nodes(spark, model)).collect()
    paths = [
        (value, *(np.reshape(a, (len(s.value), s.depth))[i] for a in (s.feature, s.share, s.low, s.high)))
        for s in stacks
        for i, value in enumerate(s.value)
    ]
    base = sum(s.base for s in stacks)
    row = values[5]
    x = np.array(row.x)

    def expected(known):
        total = 0.0
        for value, features, share, low, high in paths:
            for f, s, lo, hi in zip(features, share, low, high, strict=True):
                value *= float(lo < x[f] <= hi) if f in known else s
            total += value
        return total

    p = len(names)
    assert expected(set()) == pytest.approx(base)
    for i in range(p):
        phi = 0.0
        for k in range(p):
            for known in itertools.combinations([j for j in range(p) if j != i], k):
                weight = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
                phi += weight * (expected({*known, i}) - expected(set(known)))
        assert row[names[i]] == pytest.approx(phi)


def test_attribution_tables(encoded):
    df, names = encoded
    model = small_forest(df).fit(df)
    values = explain.shap_values(df, model, names, ["id"]).cache()
    top = explain.shap_summary(values, names).first()
    assert top.features == "a"
    assert top.mean_abs_shap == pytest.approx(np.mean([abs(r.a) for r in values.collect()]))
    dependence = {r.id: r for r in explain.shap_dependence(values, names, ["id"], "a", "b").collect()}
    some = df.first()
    assert dependence[some.id].feature_value == some.features[names.index("a")]
    importance = selection.rf_importance(df, names, small_forest, 3)
    assert explain.top_features(importance, 1) == ["a"]


def test_paths_are_explained_by_pattern_and_values_no_bound_compares_with_go_right(monkeypatch):
    r = np.random.default_rng(5)
    x = r.normal(size=(3000, 3))
    x[7, 1] = np.nan
    tests = [(0, 0.4, -np.inf, 0.2), (1, 0.5, -0.1, np.inf), (2, 0.7, -0.5, 0.5)]
    stacks = [(3, [2.0], *map(list, zip(*tests, strict=True)))]
    sizes, table = [], explain.pattern_table
    monkeypatch.setattr(explain, "pattern_table", lambda *a: sizes.append(a[2].shape[1]) or table(*a))
    found = explain.attribute(x, stacks)
    assert sizes == [8]

    def expected(row, known):
        value = 2.0
        for f, share, low, high in tests:
            follows = high == np.inf if np.isnan(row[f]) else low < row[f] <= high
            value *= follows if f in known else share
        return value

    for i in (0, 1, 2, 7):
        for f, others in ((0, (1, 2)), (1, (0, 2)), (2, (0, 1))):
            sets = [(set(), 2), ({others[0]}, 1), ({others[1]}, 1), ({*others}, 2)]
            phi = sum(w * (expected(x[i], {*known, f}) - expected(x[i], known)) for known, w in sets) / 6
            assert found[i, f] == pytest.approx(phi)


def test_paths_that_share_tests_share_a_table(monkeypatch):
    r = np.random.default_rng(6)
    x = r.normal(size=(4000, 4))
    x[3, 2], x[4, 2] = np.nan, np.inf
    inf = np.inf
    # Two leaves of one node, one that tests a feature twice, and an unrelated path.
    paths = [
        (0.3, [(0, 0.4, -inf, 0.2), (1, 0.5, -inf, 0.1), (2, 0.7, -inf, 0.5)]),
        (0.1, [(0, 0.4, -inf, 0.2), (1, 0.5, -inf, 0.1), (2, 0.3, 0.5, inf)]),
        (0.2, [(0, 0.4, -inf, 0.2), (1, 0.2, 0.1, 0.9), (2, 0.6, -inf, 0.5)]),
        (0.7, [(1, 0.1, 1.1, inf), (2, 0.9, -1.0, inf), (3, 0.5, 0.0, inf)]),
    ]
    def stacked(paths):
        columns = zip(*[t for _, tests in paths for t in tests], strict=True)
        return (3, [v for v, _ in paths], *map(list, columns))

    alone = sum(explain.attribute(x, [stacked([p])]) for p in paths)
    taken, take = [], np.take
    monkeypatch.setattr(explain.np, "take", lambda *a, **k: taken.append(1) or take(*a, **k))
    together = explain.attribute(x, [stacked(paths)])
    assert together == pytest.approx(alone)
    assert len(taken) < 12  # a look-up per feature and group, not per feature and path
