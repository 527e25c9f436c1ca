import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfwise.schema import TRANSACTION_SCHEMA
from shelfwise.sources import model_tables, transactions


def write_csv(path, header, rows):
    path.write_text("\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n")


def line(**changes):
    from conftest import LINE

    return [str({**LINE, **changes}[c]) for c in TRANSACTION_SCHEMA.names]


def test_weekly_files_are_appended_and_the_calendar_is_left_out(spark, tmp_path):
    names = TRANSACTION_SCHEMA.names
    write_csv(tmp_path / "transactions_200801.csv", names, [line()])
    write_csv(tmp_path / "trans_b.csv", names, [line(SHOP_WEEK=200802), line(QUANTITY="x")])
    write_csv(tmp_path / "time.csv", ["SHOP_WEEK", "DATE_FROM", "DATE_TO"], [["200801", "20080225", "20080302"]])
    df = transactions.scan_transactions(spark, str(tmp_path))
    assert df.schema == TRANSACTION_SCHEMA
    assert sorted(r.SHOP_WEEK for r in df.collect()) == [200801, 200801, 200802]
    assert df.where("QUANTITY IS NULL").count() == 1
    kept = transactions.scan_transactions(spark, str(tmp_path), keep_corrupt=True).cache()
    assert kept.where(F.col("_corrupt_record").isNotNull()).count() == 1
    calendar = transactions.scan_calendar(spark, str(tmp_path))
    assert [tuple(r) for r in calendar.collect()] == [(200801, 20080225, 20080302)]


def test_files_of_any_name_are_appended_by_column_name(spark, tmp_path):
    import gzip

    names = TRANSACTION_SCHEMA.names
    write_csv(tmp_path / "a.csv", names, [line(BASKET_ID=1)])
    write_csv(tmp_path / "C.CSV", names[::-1][1:] + ["UNKNOWN"], [[*line(BASKET_ID=2)[::-1][1:], "?"]])
    write_csv(tmp_path / "time.2008.csv", names, [line(BASKET_ID=3)])
    (tmp_path / "empty").write_text("")
    (tmp_path / "deeper").mkdir()
    with gzip.open(tmp_path / "deeper" / "b.csv.gz", "wt") as out:
        out.write(",".join(names) + "\n" + ",".join(line(BASKET_ID=4)) + "\n")
    write_csv(tmp_path / "time.csv", ["SHOP_WEEK", "DATE_FROM", "DATE_TO"], [["200801", "20080225", "20080302"]])
    df = transactions.scan_transactions(spark, str(tmp_path))
    assert df.schema == TRANSACTION_SCHEMA
    rows = {r.BASKET_ID: r for r in df.collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[2].PROD_CODE == rows[1].PROD_CODE and rows[2].SPEND == rows[1].SPEND
    # The reversed header lacks the last column.
    assert rows[2][names[-1]] is None and rows[1][names[-1]] is not None


def test_a_folder_with_the_calendar_alone_has_no_rows(spark, tmp_path):
    write_csv(tmp_path / "time.csv", ["SHOP_WEEK", "DATE_FROM", "DATE_TO"], [["200801", "20080225", "20080302"]])
    df = transactions.scan_transactions(spark, str(tmp_path))
    assert df.schema == TRANSACTION_SCHEMA and df.collect() == []


def test_snapshot_prunes_weeks(spark, make_lines, tmp_path):
    rows = [{"SHOP_WEEK": 200801 + i % 3, "BASKET_ID": i} for i in range(30)]
    df = make_lines(rows)
    transactions.write_snapshot(df, str(tmp_path / "s"))
    back = transactions.read_snapshot(spark, str(tmp_path / "s"))
    assert back.columns == TRANSACTION_SCHEMA.names
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    plan = back.where("SHOP_WEEK = 200802")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SHOP_WEEK" in plan


def test_conform_casts_and_adds_missing_columns(spark):
    df = spark.createDataFrame([("5", "oops", "7")], ["QUANTITY", "SPEND", "BASKET_ID"])
    row = transactions.conform(df).first()
    assert (row.QUANTITY, row.SPEND, row.BASKET_ID, row.CUST_CODE) == (5, None, 7, None)


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("U1", "P 1", 1)], "CUST_CODE string, PROD_CODE string, TARGET int")
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        transactions.write_table(df, path, fmt)
        back = transactions.read_table(spark, path, fmt, df.schema)
        assert back.collect() == df.collect()
    with pytest.raises(ValueError):
        transactions.read_table(spark, str(tmp_path / "csv"), "csv")


def test_bare_models_load(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression

    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.2, 0.0), (0.9, 1.0)], "x double, label double")
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = LogisticRegression(maxIter=5).fit(vectors)
    model_tables.save_model(model, str(tmp_path / "bare"))
    again = model_tables.load_model(spark, str(tmp_path / "bare"))
    assert type(again) is type(model) and again.coefficients == model.coefficients


def test_model_tables(spark, tmp_path):
    df = spark.createDataFrame([("U1", 1, 0.5)], "CUST_CODE string, TARGET int, `A B` double")
    ready = model_tables.model_input(df, ["A B"], ["CUST_CODE"])
    assert ready.columns == ["CUST_CODE", "TARGET", "A_B"]
    model_tables.write_label_first(ready, str(tmp_path / "l"), ["A_B"])
    assert spark.read.text(str(tmp_path / "l")).first()[0] == "1,0.5"
    model = Pipeline(stages=[VectorAssembler(inputCols=["A_B"], outputCol="features")]).fit(ready)
    model_tables.save_model(model, str(tmp_path / "m"))
    again = model_tables.load_model(spark, str(tmp_path / "m"))
    assert isinstance(again, PipelineModel)
    vectors = again.transform(ready)
    model_tables.write_model_ready(vectors, str(tmp_path / "r"), ["CUST_CODE"])
    assert spark.read.parquet(str(tmp_path / "r")).columns == ["CUST_CODE", "features", "TARGET"]
    model_tables.write_report(ready, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    trials = df.select(F.lit(0.5).alias("loss"), F.struct(F.lit(1).alias("k")).alias("params"))
    model_tables.append_trials(trials, str(tmp_path / "t"), restart=True)
    model_tables.append_trials(trials, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), header=True).count() == 2


def test_weeks_are_appended_once(spark, make_lines, tmp_path):
    folder = str(tmp_path / "snapshot")
    week = lambda w, n, spend="1.00": make_lines([{"SHOP_WEEK": w, "BASKET_ID": i, "SPEND": spend} for i in range(n)])
    transactions.write_snapshot(week(200801, 3).unionByName(week(200802, 2)), folder)
    kept = sorted((tmp_path / "snapshot" / "SHOP_WEEK=200801").iterdir())
    load = week(200803, 4).unionByName(week(200802, 5, "2.00"))
    for _ in range(2):
        transactions.append_weeks(load, folder)
    rows = transactions.read_snapshot(spark, folder).collect()
    assert sorted((r.SHOP_WEEK, str(r.SPEND)) for r in rows) == (
        [(200801, "1.00")] * 3 + [(200802, "2.00")] * 5 + [(200803, "1.00")] * 4
    )
    # The files of other weeks are not touched.
    assert sorted((tmp_path / "snapshot" / "SHOP_WEEK=200801").iterdir()) == kept
