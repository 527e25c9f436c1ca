"""Plans and parts that must not go by the stored bytes of a table or by few keys."""

import threading
from collections import Counter
from unittest.mock import Mock

import pytest

from shelfwise.functions import staging
from shelfwise.functions.ordering import hash_rank
from shelfwise.operators import classify, explain, hierarchy, labels, recommend, sampling, segments


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def pairs(spark):
    rows = [(f"C{c}", f"P{p}", int((c + p) % 4 == 0)) for c in range(40) for p in range(5)]
    return staging.stage(spark.createDataFrame(rows, "CUST_CODE string, PROD_CODE string, TARGET int"), "pairs")


def test_class_weights_do_not_deal_rows_by_label(spark, pairs):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    try:
        weighted = classify.class_weights(pairs)
        assert "SortMergeJoin" not in plan(weighted)
        assert {(r.TARGET, r.weight) for r in weighted.collect()} == {(1, 2.0), (0, 200 / 300)}
    finally:
        spark.conf.set(threshold, before)


def test_sampling_does_not_send_small_stored_pairs_to_every_task(pairs):
    drawn = sampling.sample_non_target(pairs)
    assert "SortMergeJoin" in plan(drawn)
    assert Counter((r.PROD_CODE, r.TARGET) for r in drawn.collect()) == {
        (f"P{p}", label): 10 for p in range(5) for label in (0, 1)
    }


def test_hash_rank_does_not_send_small_stored_rows_to_every_task(pairs):
    ranked = hash_rank(pairs, ["TARGET"], ["CUST_CODE", "PROD_CODE"])
    assert "SortMergeJoin" in plan(ranked)
    assert sorted(r.hash_rank for r in ranked.where("TARGET = 0").collect()) == list(range(150))


def test_pair_table_and_training_rows_come_in_parts_by_rows(spark, pairs, monkeypatch):
    monkeypatch.setattr(staging, "PART_ROWS", 20)
    active = pairs.select("CUST_CODE").distinct()
    table = labels.add_non_target(active, pairs.where("TARGET = 1"))
    assert table.rdd.getNumPartitions() == 10
    assert table.exceptAll(pairs).count() == 0 and table.count() == 200
    dealt = staging.dealt_by_rows(pairs, ["CUST_CODE", "PROD_CODE"])
    assert dealt.rdd.getNumPartitions() == 10 and dealt.exceptAll(pairs).count() == 0


def test_trials_of_a_search_run_side_by_side(spark, monkeypatch):
    barrier = threading.Barrier(3)

    def fit(train, *settings):
        barrier.wait(timeout=60)
        return settings

    errors = spark.createDataFrame([("train", 1, 0.5), ("test", 1, 0.25)], "split string, n long, mse double")
    monkeypatch.setattr(recommend, "fit_als", fit)
    monkeypatch.setattr(recommend, "als_mse", lambda *_: errors)
    rows = spark.createDataFrame([(0, 0, 1.0)], "index_CUST_CODE long, index_PROD_CODE long, QUANTITY double")
    found = recommend.tune_als(rows, rows, 3)
    assert [r.iteration for r in found.trials.collect()] == [1, 2, 3]


def test_segment_profile_comes_in_parts_by_rows_with_mixed_and_null_baskets(make_lines, monkeypatch):
    monkeypatch.setattr(staging, "PART_ROWS", 1)
    rows = [
        {"BASKET_ID": 1, "STORE_FORMAT": "LS", "SPEND": "1.00"},
        {"BASKET_ID": 1, "STORE_FORMAT": "MS", "SPEND": "2.00"},
        {"BASKET_ID": 1, "STORE_FORMAT": "MS", "SPEND": "4.00", "BASKET_TYPE": "XX"},
        {"BASKET_ID": 2, "STORE_FORMAT": "LS", "SPEND": "8.00"},
        {"BASKET_ID": None, "STORE_FORMAT": "LS", "SPEND": "16.00"},
        {"BASKET_ID": 3, "STORE_FORMAT": None, "SPEND": "32.00"},
    ]
    found = segments.seg_summary(make_lines(rows), "CUST_CODE", ["STORE_FORMAT", "BASKET_TYPE"])
    assert found.rdd.getNumPartitions() == 6
    (row,) = found.collect()
    got = {m: [row[f"STORE_FORMAT_{m}_CUST_CODE_{v}"] for v in ("LS", "MS")] for m in ("SPEND", "VISITS", "PROP_VISITS")}
    assert got == {"SPEND": [25.0, 6.0], "VISITS": [2.0, 1.0], "PROP_VISITS": [2 / 3, 1 / 3]}
    assert row["BASKET_TYPE_VISITS_CUST_CODE_Top Up"] == 3.0 and row["BASKET_TYPE_VISITS_CUST_CODE_XX"] == 1.0


def test_summary_comes_in_parts_by_stacked_rows(make_lines, monkeypatch):
    monkeypatch.setattr(staging, "PART_ROWS", 1)
    rows = make_lines([{"BASKET_ID": b, "SPEND": "2.00"} for b in (1, 1, 2)])
    levels = ["PROD_CODE", "PROD_CODE_10"]
    found = hierarchy.sp_vi_qu(rows, labels.hierarchy_map(rows, levels), [200701], ["1y"], levels)
    assert found.rdd.getNumPartitions() == 8  # 3 lines at 2 levels, up to a multiple of the 4 buckets
    (row,) = found.collect()
    assert (row.SPEND_PROD_CODE_1y, row.VISITS_PROD_CODE_10_1y) == (6.0, 2)


def test_a_small_forest_is_carried_to_the_rows(spark):
    rows = [(i, float(i % 7), float(i % 5), int(i % 7 > 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, b double, TARGET int")
    df = classify.class_weights(classify.fit_encoder(df, ["id"], ["a", "b"]).vectors(df))
    df = staging.stage(df, "encoded")
    model = classify.forest(df, n_estimators=2, max_depth=2).fit(df)
    values = explain.shap_values(df, model, ["a", "b"], ["id"])
    assert "Exchange" not in plan(values) and values.count() == 60
    summary = explain.shap_summary(values, ["a", "b"])
    means = {n: sum(abs(r[n]) for r in values.collect()) / 60 for n in ("a", "b")}
    assert {r.features: r.mean_abs_shap for r in summary.collect()} == pytest.approx(means)
    assert explain.shap_summary(values.limit(0), ["a", "b"]).count() == 0


def test_gaps_are_stacked_behind_one_exchange_by_customer(make_lines, monkeypatch):
    from shelfwise.operators import recency

    rows = make_lines(
        [{"CUST_CODE": u, "SHOP_DATE": d} for u in ("U1", "U2") for d in (20080301, 20080301, 20080304, 20080305)]
    )
    levels = ["PROD_CODE", "PROD_CODE_10"]
    want = {(u, c, (3, 1)) for u in ("U1", "U2") for c in ("P1", "C1")}
    for part_rows in (250_000, 1):  # a customer with more lines than a part: made distinct before
        monkeypatch.setattr(staging, "PART_ROWS", part_rows)
        gaps, parts = recency.purchase_gaps(rows, levels)
        assert {(r.CUST_CODE, r.code, tuple(r.gaps)) for r in gaps.collect()} == want
        counted = plan(gaps.groupBy("CUST_CODE", "lvl", "code").count())
        assert "Exchange" not in counted and parts == (16 if part_rows == 1 else 4)
    found = recency.time_last_purchased(rows, labels.hierarchy_map(rows, levels), levels)
    assert {tuple(r)[2:] for r in found.collect()} == {(2.0, 2.0, 1) * 2}


def test_segment_profile_of_ordinary_keys_is_exchanged_once(make_lines):
    rows = [{"CUST_CODE": f"U{i % 3}", "BASKET_ID": i, "STORE_FORMAT": "LS"} for i in range(12)]
    found = segments.seg_summary(make_lines(rows), "CUST_CODE", ["STORE_FORMAT"])
    assert plan(found).count("Exchange") == 1
    assert {(r.CUST_CODE, r.STORE_FORMAT_VISITS_CUST_CODE_LS) for r in found.collect()} == {(f"U{i}", 4.0) for i in range(3)}


def test_summary_and_gaps_of_wanted_pairs_take_in_needed_codes_only(make_lines, random_lines, monkeypatch):
    from shelfwise.operators import recency

    rows = make_lines(random_lines())
    levels = ["PROD_CODE", "PROD_CODE_10", "PROD_CODE_20"]
    products = labels.hierarchy_map(rows, levels)
    wanted = rows.select("CUST_CODE", "PROD_CODE").where("PROD_CODE IN ('P0', 'P5')").distinct()
    for make in (
        lambda w: hierarchy.sp_vi_qu(rows, products, [200801, 200805], ["l", "s"], levels, w),
        lambda w: recency.time_last_purchased(rows, products, levels, w),
    ):
        want = make(None).where("PROD_CODE IN ('P0', 'P5')").collect()
        for part_rows in (250_000, 1):
            monkeypatch.setattr(staging, "PART_ROWS", part_rows)
            found = make(wanted)
            assert "array_contains" in plan(found)
            assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want)) and want
        monkeypatch.undo()


def test_chains_read_staged_baskets(spark, monkeypatch):
    import catalog

    seen = []

    def chain(rows, *_):
        seen.append(rows)
        return Mock(scores=rows)

    monkeypatch.setattr(catalog.weekly, "purchase_probability", chain)
    catalog.purchase_probability(spark, "/root/testdata/sf0.001")
    assert "Join" not in plan(seen[0]) and seen[0].count() == 6000


def test_summary_is_looked_up_without_an_exchange_of_sums(make_lines, random_lines, monkeypatch):
    # Moved products, null baskets, codes and spends: as by the join of sums and pairs.
    rows = random_lines(400, 3)
    rows += [{"CUST_CODE": "U1", "PROD_CODE_20": None, "BASKET_ID": None}, {"CUST_CODE": "U2", "PROD_CODE": None}]
    rows = staging.stage(make_lines(rows), "rows")
    products = labels.hierarchy_map(rows, levels := ["PROD_CODE", "PROD_CODE_10", "PROD_CODE_20"])
    args = (rows, products, [200801, 200805], ["l", "s"], levels)
    found = hierarchy.sp_vi_qu(*args)
    assert plan(found).count("hashpartitioning") == 2  # the lines and the narrow pairs, by customer
    assert "hashpartitioning(CUST_CODE#" in plan(found)
    by_pair = hierarchy.sp_vi_qu(*args, by_pair=True)
    assert plan(by_pair).count("hashpartitioning") == 3 and "hashpartitioning(CUST_CODE#" in plan(by_pair)
    monkeypatch.setattr(hierarchy, "MAP_LINES", 1)
    joined = hierarchy.sp_vi_qu(*args)
    assert "pivot" in plan(joined) and "pivot" not in plan(found)
    want = sorted(map(repr, joined.collect()))
    assert sorted(map(repr, found.collect())) == want == sorted(map(repr, by_pair.collect()))


def test_changes_exchange_only_lines_and_narrow_pairs(spark):
    import catalog

    changes = catalog.queries()["chng_features"](spark, "/root/testdata/sf0.001")
    assert plan(changes).count("hashpartitioning") == 2 and "pivot" not in plan(changes)
