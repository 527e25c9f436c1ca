"""The factorisation for few items against dense normal equations and Spark's ALS."""

import random

import numpy as np
import pytest

from shelfwise.operators import few_items, recommend
from shelfwise.plans import weekly
from shelfwise.schema import Windows

NAMES = "index_CUST_CODE long, index_PROD_CODE long, QUANTITY double"


@pytest.fixture(scope="module")
def rated(spark):
    """Ratings of 60 users, one with a zero only, over items that are not numbered densely."""
    r = random.Random(4)
    rows = [(u, 3 * i, r.choice([0.0, 0.3, 1.01])) for u in range(60) for i in range(9) if r.random() < 0.5]
    rows.append((99, 6, 0.0))
    return spark.createDataFrame(rows, NAMES).repartition(5).cache(), rows


def step(rows, fixed, ids, side, alpha, reg):
    """Dense normal equations of one side."""
    gram = sum(np.outer(f, f) for f in fixed.values())
    out = {}
    for i in ids:
        mine = [r for r in rows if r[side] == i]
        a = gram + reg * sum(r[2] > 0 for r in mine) * np.eye(len(gram))
        b = np.zeros(len(gram))
        for r in mine:
            y = fixed[r[1 - side]]
            a = a + alpha * abs(r[2]) * np.outer(y, y)
            b = b + (1 + alpha * abs(r[2])) * (r[2] > 0) * y
        out[i] = np.linalg.solve(a, b) if b.any() else b
    return out


@pytest.mark.parametrize("size", [250_000, 7])
def test_steps_are_the_normal_equations(spark, rated, size, monkeypatch):
    df, rows = rated
    monkeypatch.setattr(few_items, "BLOCK_RATINGS", size)
    monkeypatch.setattr(few_items, "CELLS", size)
    monkeypatch.setattr(recommend, "ALS", None)  # not Spark's
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3 if size == 7 else before)
    try:
        model = recommend.fit_als(df, alpha=7, rank=3, reg=0.2, iterations=4, seed=5)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    users = sorted({r[0] for r in rows})
    u = dict(zip(users, few_items.start(np.array(users), 3, 5), strict=True))
    # The ratings are kept as float, as Spark's ALS keeps them.
    single = [(a, b, float(np.float32(q))) for a, b, q in rows]
    for _ in range(4):
        v = step(single, u, sorted({r[1] for r in rows}), 1, 7, 0.2)
        u = step(single, v, users, 0, 7, 0.2)
    for table, want in ((model.userFactors, u), (model.itemFactors, v)):
        got = {r.id: list(r.features) for r in table.collect()}
        assert got.keys() == want.keys()
        for i in want:
            assert got[i] == pytest.approx(want[i], abs=1e-5)


def test_the_error_is_that_of_sparks_als(spark, rated, monkeypatch):
    df, _ = rated
    settings = {"alpha": 10, "rank": 2, "reg": 0.05, "iterations": 60}
    mine = {r.split: r.mse for r in recommend.als_mse(recommend.fit_als(df, **settings), df, df).collect()}
    monkeypatch.setattr(few_items, "TASK_BYTES", 0)
    theirs = {r.split: r.mse for r in recommend.als_mse(recommend.fit_als(df, **settings), df, df).collect()}
    assert mine["train"] == pytest.approx(theirs["train"], rel=0.05)


def test_start_goes_by_id_and_seed():
    ids = np.arange(2000)
    drawn = few_items.start(ids, 4, 0)
    assert np.allclose(np.linalg.norm(drawn, axis=1), 1) and np.abs(drawn.mean(axis=0)).max() < 0.05
    assert (few_items.start(ids[7:9], 4, 0) == drawn[7:9]).all()
    assert not np.allclose(few_items.start(ids, 4, 1), drawn)


def test_the_chain_of_features_fits_without_sparks_als(make_lines, random_lines, monkeypatch):
    monkeypatch.setattr(recommend, "ALS", None)
    rows = make_lines(random_lines(300, 2))
    found = weekly.recommend_products(rows, Windows(), top_x=2, rank=2, iterations=2)
    assert found.user_factors.columns == ["CUST_CODE", "factor_0", "factor_1"]
    assert found.item_factors.count() == 12 and {r.split for r in found.errors.collect()} == {"train", "test"}
