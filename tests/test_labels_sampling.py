import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import labels, sampling


def digest(*keys, seed=0):
    return hashlib.md5("|".join([*keys, str(seed)]).encode()).hexdigest()


@pytest.fixture(scope="module")
def people():
    r = random.Random(3)
    active = [f"U{i}" for i in range(40)]
    bought = {(f"U{r.randrange(50)}", f"P{min(r.randrange(12), r.randrange(12))}") for _ in range(150)}
    # Nearly everybody bought P0: it has fewer negatives than positives.
    bought |= {(u, "P0") for u in active[:35]}
    return active, bought


def frames(spark, active, bought):
    return (
        spark.createDataFrame([(u,) for u in active], "CUST_CODE string"),
        spark.createDataFrame([(u, p, 1) for u, p in bought], "CUST_CODE string, PROD_CODE string, TARGET int"),
    )


def test_labels(make_lines):
    df = make_lines(
        [
            {"SHOP_WEEK": 200816, "CUST_CODE": "U1"},
            {"SHOP_WEEK": 200816, "CUST_CODE": "U1"},
            {"SHOP_WEEK": 200816, "CUST_CODE": None},
            {"SHOP_WEEK": 200815, "CUST_CODE": "U2"},
            {"SHOP_WEEK": 200807, "CUST_CODE": "U3"},
        ]
    )
    assert [tuple(r) for r in labels.targets(df, 200816).collect()] == [("U1", "P1", 1)]
    assert [r[0] for r in labels.active_customers(df, 200808, 200815).collect()] == ["U2"]
    assert labels.drop_null_customers(df).count() == 4


@pytest.mark.parametrize("block", [1, 4, 1024])
def test_pair_table_is_whole(spark, people, block, monkeypatch):
    monkeypatch.setattr(labels, "BLOCK", block)
    active, bought = people
    pairs = labels.add_non_target(*frames(spark, active, bought)).collect()
    products = {p for _, p in bought}
    expected = {(u, p): int((u, p) in bought) for u in active for p in products}
    assert {(r.CUST_CODE, r.PROD_CODE): r.TARGET for r in pairs} == expected
    assert len(pairs) == len(expected)


@pytest.mark.parametrize("parts", [1, 6])
def test_balanced_sample_of_a_pair_table(spark, people, parts):
    active, bought = people
    products = {p for _, p in bought}
    table = [(u, p, int((u, p) in bought)) for u in active for p in products]
    df = spark.createDataFrame(table, "CUST_CODE string, PROD_CODE string, TARGET int").repartition(parts)
    found = {tuple(r) for r in sampling.sample_non_target(df).collect()}
    expected = set()
    for p in products:
        positive = [(u, q, t) for u, q, t in table if q == p and t]
        negative = sorted((digest(u, q), u, q) for u, q, t in table if q == p and not t)
        expected |= set(positive) | {(u, q, 0) for _, u, q in negative[: len(positive)]}
    assert found == expected


@pytest.mark.parametrize(("parts", "size"), [(1, 4096), (6, 4096), (3, 4)])
def test_draw_pairs_matches_its_rule(spark, people, parts, size, monkeypatch):
    monkeypatch.setattr(sampling, "RANGE", size)
    active, bought = people
    a, b = frames(spark, active, bought)
    found = [tuple(r) for r in sampling.draw_pairs(a.repartition(parts), b.repartition(parts)).collect()]
    circle = sorted(active, key=lambda u: (digest(u), u))
    expected = []
    for p in {p for _, p in bought}:
        buyers = {u for u, q in bought if q == p and u in active}
        start = int(digest(p)[:12], 16) % len(circle)
        around = circle[start:] + circle[:start]
        others = [u for u in around if u not in buyers][: len(buyers)]
        expected += [(u, p, 1) for u in buyers] + [(u, p, 0) for u in others]
    assert sorted(found) == sorted(expected)
    sizes = Counter((p, t) for _, p, t in found)
    assert sizes["P0", 1] >= 35 and sizes["P0", 0] == 40 - sizes["P0", 1]


def test_splits_are_disjoint_and_whole(spark):
    df = spark.createDataFrame([(f"U{i % 400}", f"P{i % 7}", i % 3) for i in range(2000)], "CUST_CODE string, PROD_CODE string, TARGET int").distinct()
    train, test = sampling.row_split(df, ["CUST_CODE", "PROD_CODE"], 0.2)
    assert train.count() + test.count() == df.count()
    assert train.intersect(test).count() == 0
    assert 0.1 < test.count() / df.count() < 0.3
    held, rest = sampling.als_holdout(df, 0.1)
    assert held.count() + rest.count() == df.count()
    split = sampling.three_way_split(df).groupBy("CUST_CODE").agg(F.countDistinct("SPLIT").alias("n"))
    assert split.where("n > 1").isEmpty()
    customers = df.select("CUST_CODE").distinct()
    assert 0.2 < customers.transform(sampling.customer_split).agg(F.avg("IN_TEST")).first()[0] < 0.4


def test_folds_keep_the_label_shares(spark):
    df = spark.createDataFrame([(f"U{i}", "P", int(i % 10 == 0)) for i in range(503)], "CUST_CODE string, PROD_CODE string, TARGET int")
    sizes = sampling.stratified_folds(df, ["CUST_CODE", "PROD_CODE"]).groupBy("TARGET", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r.TARGET == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
