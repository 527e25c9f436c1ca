import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import columns as C
from shelfwise.functions.ordering import dense_index, hash_rank, quantiles, running_totals


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_index_numbers_sorted_values(spark, parts):
    values = [f"c{random.Random(i).randrange(200):04d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(parts)
    found = {r.c: r.i for r in dense_index(df, "c", "i").collect()}
    expected = sorted({v for v in values if v is not None})
    assert found == {v: i for i, v in enumerate(expected)}


@pytest.mark.parametrize("parts", [1, 5])
def test_running_totals_with_a_hot_group(spark, parts):
    r = random.Random(1)
    rows = {(("hot" if r.random() < 0.7 else f"g{r.randrange(4)}"), r.randrange(1000)): r.randrange(9) for _ in range(900)}
    rows |= {(None, 3): 5, (None, 1): 2}
    df = spark.createDataFrame([(g, o, v) for (g, o), v in rows.items()], "g string, o int, v int").repartition(parts)
    found = {(x.g, x.o): x.cum_v for x in running_totals(df, ["g"], ["o"], ["v"]).collect()}
    for (g, o), total in found.items():
        assert total == sum(v for (g2, o2), v in rows.items() if g2 == g and o2 <= o)
    assert len(found) == len(rows)


def test_hash_rank_is_the_order_of_the_digest(spark):
    df = spark.createDataFrame([(f"k{i}", i % 2) for i in range(300)], "k string, g int")
    rows = hash_rank(df, ["g"], ["k"], "r").withColumn("d", C.key_hash("k")).collect()
    for g in (0, 1):
        mine = sorted((x for x in rows if x.g == g), key=lambda x: x.d)
        assert [x.r for x in mine] == list(range(len(mine)))
    again = {x.k: x.r for x in hash_rank(df.repartition(7), ["g"], ["k"], "r").collect()}
    assert again == {x.k: x.r for x in rows}


def test_quantiles_match_linear_interpolation(spark):
    r = random.Random(2)
    data = [(r.choice("ab"), float(r.randrange(40)), r.uniform(-5, 5)) for _ in range(401)]
    df = spark.createDataFrame([*data, ("a", None, 1.0)], "g string, x double, y double")
    found = quantiles(df, ["x", "y"], {"p10": 0.1, "p50": 0.5}, ["g"]).collect()
    for row in found:
        at = 1 if row.column == "x" else 2
        mine = [d[at] for d in [*data, ("a", None, 1.0)] if d[0] == row.g and d[at] is not None]
        assert row.p10 == pytest.approx(np.quantile(mine, 0.1))
        assert row.p50 == pytest.approx(np.quantile(mine, 0.5))


def test_column_functions(spark):
    df = spark.createDataFrame([(7,), (8,), (11,), (12,), (16,), (17,), (23,), (None,)], "SHOP_HOUR int")
    parts = [r[0] for r in df.select(C.day_part()).collect()]
    assert parts == [None, "MORNING", "MORNING", "AFTERNOON", "AFTERNOON", "EVENING", "EVENING", None]
    days = spark.createDataFrame([(d,) for d in range(1, 8)], "SHOP_WEEKDAY int")
    assert [r[0] for r in days.select(C.weekday_weekend()).collect()].count("WEEKEND") == 2
    date = spark.createDataFrame([(20080229,), (19991231,)], "SHOP_DATE int").select(C.shop_date().cast("string"))
    assert [r[0] for r in date.collect()] == ["2008-02-29", "1999-12-31"]
    inf = spark.createDataFrame([(float("inf"), 1), (float("-inf"), 2), (3.0, 3)], "`a b` double, i int")
    assert [tuple(r) for r in C.replace_inf(inf).collect()] == [(0.0, 1), (0.0, 2), (3.0, 3)]
    zero = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in zero.select(F.expr(C.ratio_sql("a", "b"))).collect()] == [0.0, 0.0, 0.25, 0.0]
    # Two key columns cannot run together.
    collide = spark.createDataFrame([("1", "23"), ("12", "3")], "a string, b string")
    assert collide.select(C.key_hash("a", "b")).distinct().count() == 2


def test_scratch_deletes_all_but_the_result(spark):
    from shelfwise.functions.staging import Scratch, stage

    def place(df):
        return df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]

    with Scratch(spark) as outer:
        with Scratch(spark) as inner:
            lost = stage(spark.range(3))
            middle = inner.result(lost.selectExpr("id + 1 AS id"))
            gone = place(lost)
        assert not os.path.exists(gone) and middle.count() == 3
        between = place(middle)
        last = outer.result(middle.selectExpr("id * 2 AS id"))
    assert not os.path.exists(between)
    assert sorted(r.id for r in last.collect()) == [2, 4, 6]
