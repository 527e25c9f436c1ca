import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import evaluate, profile, transforms


def test_winsor_moves_one_value_at_each_end(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(20)], "x int, g int").repartition(5)
    assert transforms.winsor_bounds(df, ["x"], 0.05, 0.05) == {"x": (1.0, 18.0)}
    other = spark.createDataFrame([(-5, 0), (99, 0), (None, 0)], "x int, g int")
    train, test = transforms.winsorize(df, [other], ["x"], 0.05, 0.05)
    assert sorted(r.x for r in train.collect()) == [1, *range(1, 19), 18]
    assert [r.x for r in test.collect()] == [1, 18, None]
    assert train.schema == df.schema


def test_min_max_within_groups(spark):
    train = spark.createDataFrame([("a", 1), ("a", 5), ("a", 3), ("c", 2), ("c", 2)], "g string, q int")
    bounds = transforms.group_bounds(train, "g", "q")
    scaled = sorted((r.g, r.q) for r in transforms.normalize_min_max(train, bounds, "g", "q").collect())
    assert scaled == [("a", 0.01), ("a", 0.51), ("a", 1.01), ("c", 0.01), ("c", 0.01)]
    other = spark.createDataFrame([("a", 9), ("c", 2), ("c", 7), ("z", 1)], "g string, q int")
    found = {(r.g, round(r.q, 6)) for r in transforms.normalize_min_max(other, bounds, "g", "q").collect()}
    assert found == {("a", 2.01), ("c", 0.01), ("c", 0.0)}


def test_standardize_and_encodings(spark):
    train = spark.createDataFrame([(1.0, 7, "b"), (3.0, 7, "a"), (5.0, 7, None)], "x double, k int, s string")
    scaled = transforms.standardize(train, transforms.moments(train, ["x", "k"])).collect()
    assert [r.x for r in scaled] == pytest.approx([-math.sqrt(1.5), 0.0, math.sqrt(1.5)])
    assert [r.k for r in scaled] == [0.0, 0.0, 0.0]
    levels = transforms.categories(train, ["s"])
    assert levels == {"s": ["a", "b"]}
    new = spark.createDataFrame([("b",), ("zz",), (None,)], "s string")
    assert [tuple(r) for r in transforms.one_hot(new, levels).collect()] == [(0, 1), (0, 0), (0, 0)]
    vocab = transforms.vocab_indicator(new, {"s": ["b", "a"]})
    assert vocab.columns == ["s_b", "s_a", "s_OOV"]
    assert [tuple(r) for r in vocab.collect()] == [(1, 0, 0), (0, 0, 1), (0, 0, 0)]
    assert transforms.dummies(train).columns == ["s_a", "s_b", "x", "k"]
    assert transforms.dummies(train.drop("s")) is None


def test_profiles(spark):
    r = random.Random(6)
    data = [(r.gauss(0, 1), float(r.randrange(5)), r.choice(["u", "v", None]), r.randrange(2)) for _ in range(200)]
    df = spark.createDataFrame([*data, (None, 1.0, "u", 1)], "x double, y double, s string, TARGET int")
    xs = np.array([d[0] for d in data])
    stats = {r["column"]: r for r in profile.describe(df, ["x", "y"]).collect()}["x"]
    assert (stats.n, stats["mean"], stats["std"]) == (200, pytest.approx(xs.mean()), pytest.approx(xs.std(ddof=1)))
    assert [stats[c] for c in ("min", "p25", "p50", "p75", "max")] == pytest.approx(np.quantile(xs, [0, 0.25, 0.5, 0.75, 1]))
    rows = {(r.section, r["item"]): r.value for r in profile.profile_numeric(df, "x", "TARGET", 8).collect()}
    counts, _ = np.histogram(xs, 8)
    assert [rows.get(("histogram", str(i)), 0) for i in range(8)] == list(counts)
    assert rows["missing", "nulls"] == 1
    ones = np.array([d[0] for d in data if d[3] == 1])
    q1, q3 = np.quantile(ones, [0.25, 0.75])
    assert rows["box 1", "p25"] == pytest.approx(q1)
    assert rows["box 1", "high"] == pytest.approx(ones[ones <= q3 + 1.5 * (q3 - q1)].max())
    cats = {r.value: r for r in profile.profile_categorical(df, "s", "TARGET").collect()}
    assert cats["v"].n == sum(d[2] == "v" for d in data) and cats[None].is_null == 1
    nulls = {r["column"]: r.n_null for r in profile.null_counts(df).collect()}
    assert nulls == {"x": 1, "y": 0, "s": sum(d[2] is None for d in data), "TARGET": 0}
    curve = profile.density(df, "x", 50).orderBy("point").collect()
    width = xs.std(ddof=1) * 200 ** (-0.2)
    at = curve[20].x
    expected = np.exp(-0.5 * ((at - xs) / width) ** 2).sum() / (200 * width * math.sqrt(2 * math.pi))
    assert curve[20].density == pytest.approx(expected)
    step = curve[1].x - curve[0].x
    assert sum(c.density for c in curve) * step == pytest.approx(1.0, abs=0.01)


def test_correlations(spark):
    r = random.Random(7)
    data = [(a, a + r.random(), r.random(), 4.0, int(a > 0.5)) for a in (r.random() for _ in range(100))]
    df = spark.createDataFrame(data, "a double, b double, c double, k double, TARGET int")
    m = np.corrcoef(np.array(data).T[[0, 1, 2, 4]])
    top = profile.squared_corr(df, "TARGET", 2).collect()
    assert [t.features for t in top] == ["a", "b"]
    assert top[0].squared_correlation == pytest.approx(m[0, 3] ** 2)
    pair = profile.paired_corr(df, 2, ["a", "b", "c", "k"]).first()
    assert (pair.feature_1, pair.feature_2) == ("a", "b")
    assert pair.abs_correlation == pytest.approx(m[0, 1])


@pytest.mark.parametrize("values", [3, 1000])
def test_auc_counts_ties_half(spark, values):
    r = random.Random(8)
    data = [(r.randrange(2), r.randrange(values) / values) for _ in range(150)]
    pos = [s for t, s in data if t]
    neg = [s for t, s in data if not t]
    area = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(data, "TARGET int, probability double").repartition(6)
    assert evaluate.roc_auc(df).first().roc_auc == pytest.approx(area)
    assert evaluate.roc_auc(df.where("TARGET = 1")).first().roc_auc is None


def test_report(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 4
    df = spark.createDataFrame(pairs, "TARGET int, prediction int")
    rows = {r["class"]: r for r in evaluate.evaluation_report(df).collect()}
    assert rows["1"].precision == pytest.approx(3 / 4) and rows["1"].recall == pytest.approx(3 / 5)
    assert rows["0"].f1 == pytest.approx(2 * (4 / 6) * (4 / 5) / (4 / 6 + 4 / 5))
    assert rows["accuracy"].precision == pytest.approx(0.7) and rows["accuracy"].support == 10
    assert rows["macro avg"].recall == pytest.approx((3 / 5 + 4 / 5) / 2)
    assert rows["roc_auc labels"].precision == pytest.approx(0.7)
    # A class that is never predicted scores 0.
    none = {r["class"]: r for r in evaluate.classification_report(df.where("TARGET = 1").withColumn("prediction", F.lit(0))).collect()}
    assert (none["1"].recall, none["0"].precision) == (0.0, 0.0)


def test_logits(spark):
    df = spark.createDataFrame([(-800.0,), (0.0,), (2.0,), (800.0,)], "z double")
    found = [r[0] for r in df.select(evaluate.probability_from_logit("z")).collect()]
    assert found == pytest.approx([0.0, 0.5, math.exp(2) / (1 + math.exp(2)), 1.0])
    scored = evaluate.threshold_predictions(spark.createDataFrame([(0.5,), (0.6,), (None,)], "probability double"))
    assert [r.prediction for r in scored.collect()] == [0, 1, 0]


def test_counts(spark):
    df = spark.createDataFrame(
        [("U1", "P1", 1, "a"), ("U1", "P2", 0, "a"), ("U2", "P1", 2, None), ("U2", "P1", 2, "b"), (None, "P1", 1, "b")],
        "CUST_CODE string, PROD_CODE string, QUANTITY int, s string",
    )
    assert {tuple(r) for r in profile.distinct_counts(df).collect()} == {("CUST_CODE", 2), ("PROD_CODE", 2)}
    assert {tuple(r) for r in profile.value_counts(df, ["s"]).collect()} == {("s", "a", 2), ("s", "b", 2)}
    assert {tuple(r) for r in profile.segment_census(df, ["s"]).collect()} == {("s", "a", 1), ("s", "b", 2)}
    known = df.where("CUST_CODE IS NOT NULL")
    assert profile.matrix_sparsity(known).first().sparsity == pytest.approx(50.0)


def test_correlation_is_pairwise_complete(spark):
    import numpy as np

    from shelfwise.operators.profile import correlation_matrix, paired_corr

    draw = np.random.default_rng(3)
    x = draw.standard_normal((200, 3)) * [1, 50, 1e-3] + [0, 1e6, 5]
    x[:, 1] += 30 * x[:, 0]
    x[draw.random((200, 3)) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) + (7.0,) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double").repartition(3)
    found = correlation_matrix(df, df.columns)
    for i in range(3):
        for j in range(3):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            assert abs(found[i, j] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
    assert np.isnan(found[3]).all()
    assert paired_corr(df, 1).first()[:2] == ("a", "b")
