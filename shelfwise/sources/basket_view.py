"""Basket-line transactions over an orders / lineitem star schema."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

# The order dates of the star schema spread few baskets over many years. They are drawn
# together, in order, into the 60 weeks from 200712 to 200819, so that the windows of 52,
# 26, 8 and 1 weeks before a target week, and that week, all hold baskets.
FIRST_ORDER, FIRST_DAY = date(1995, 1, 1), date.fromisocalendar(2007, 12, 1)
ORDER_DAYS, CALENDAR_DAYS = 2405, 60 * 7
_DAY = f"CAST(floor({{DAYS}} * {CALENDAR_DAYS} / {ORDER_DAYS}) AS INT)"
SPARK_DAY = f"date_add(DATE'{FIRST_DAY}', {_DAY.format(DAYS=f"datediff(o_orderdate, DATE'{FIRST_ORDER}')")})"
SQL_DAY = f"(DATE '{FIRST_DAY}' + {_DAY.format(DAYS=f"datediff('day', DATE '{FIRST_ORDER}', CAST(o_orderdate AS DATE))")})"

# One expression per transaction column, in the common subset of Spark SQL and
# ANSI SQL. DAY is the day of the basket; ISOYEAR and DOW stand for the two date parts
# that dialects spell differently.
VIEW_COLUMNS = {
    "SHOP_WEEK": "CAST(extract({ISOYEAR} FROM {DAY}) * 100 + extract(week FROM {DAY}) AS INT)",
    "SHOP_DATE": "CAST(year({DAY}) * 10000 + month({DAY}) * 100 + day({DAY}) AS INT)",
    "SHOP_WEEKDAY": "CAST({DOW} AS INT)",
    "SHOP_HOUR": "CAST(o_orderkey % 24 AS INT)",
    "QUANTITY": "CAST(l_quantity AS INT)",
    "SPEND": "CAST(l_extendedprice AS DECIMAL(18,2))",
    "PROD_CODE": "concat('PRD', lpad(CAST(l_partkey % 120 AS STRING), 7, '0'))",
    "PROD_CODE_10": "concat('CL', lpad(CAST(l_partkey % 60 AS STRING), 5, '0'))",
    "PROD_CODE_20": "concat('DEP', lpad(CAST(l_partkey % 20 AS STRING), 5, '0'))",
    "PROD_CODE_30": "concat('G', lpad(CAST(l_partkey % 10 AS STRING), 5, '0'))",
    "PROD_CODE_40": "concat('D', lpad(CAST(l_partkey % 2 AS STRING), 5, '0'))",
    "CUST_CODE": "CASE WHEN o_custkey % 37 = 0 THEN NULL "
    "ELSE concat('CUST', lpad(CAST(o_custkey AS STRING), 10, '0')) END",
    "CUST_PRICE_SENSITIVITY": "CASE WHEN o_custkey % 37 = 0 OR o_custkey % 10 = 3 THEN NULL "
    "WHEN o_custkey % 4 = 0 THEN 'LA' WHEN o_custkey % 4 = 1 THEN 'MM' "
    "WHEN o_custkey % 4 = 2 THEN 'UM' ELSE 'XX' END",
    "CUST_LIFESTAGE": "CASE WHEN o_custkey % 37 = 0 OR o_custkey % 10 = 3 THEN NULL "
    "WHEN o_custkey % 7 = 0 THEN 'OT' WHEN o_custkey % 7 = 1 THEN 'YF' "
    "WHEN o_custkey % 7 = 2 THEN 'YA' WHEN o_custkey % 7 = 3 THEN 'OA' "
    "WHEN o_custkey % 7 = 4 THEN 'PE' WHEN o_custkey % 7 = 5 THEN 'OF' ELSE 'XX' END",
    "BASKET_ID": "o_orderkey",
    "BASKET_SIZE": "CASE WHEN o_orderkey % 3 = 0 THEN 'L' WHEN o_orderkey % 3 = 1 THEN 'M' ELSE 'S' END",
    "BASKET_PRICE_SENSITIVITY": "CASE WHEN o_orderstatus = 'F' THEN 'LA' "
    "WHEN o_orderstatus = 'O' THEN 'MM' ELSE 'UM' END",
    "BASKET_TYPE": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Small Shop' "
    "WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Top Up' ELSE 'XX' END",
    "BASKET_DOMINANT_MISSION": "CASE WHEN o_orderkey % 5 = 0 THEN 'Fresh' "
    "WHEN o_orderkey % 5 = 1 THEN 'Grocery' WHEN o_orderkey % 5 = 2 THEN 'Mixed' "
    "WHEN o_orderkey % 5 = 3 THEN 'Nonfood' ELSE 'XX' END",
    "STORE_CODE": "concat('STORE', lpad(CAST(o_orderkey % 25 AS STRING), 5, '0'))",
    "STORE_FORMAT": "CASE WHEN o_orderkey % 25 % 4 = 0 THEN 'LS' WHEN o_orderkey % 25 % 4 = 1 THEN 'MS' "
    "WHEN o_orderkey % 25 % 4 = 2 THEN 'SS' ELSE 'XLS' END",
    "STORE_REGION": "concat('E', lpad(CAST(o_orderkey % 25 % 5 AS STRING), 2, '0'))",
}


def _columns(day: str, isoyear: str, dow: str) -> list[str]:
    dow = dow.format(DAY=day)
    return [f"{sql.format(DAY=day, ISOYEAR=isoyear, DOW=dow)} AS {name}" for name, sql in VIEW_COLUMNS.items()]


def basket_view_sql() -> str:
    """The view as one ANSI SELECT, for engines other than Spark."""
    columns = ", ".join(_columns(SQL_DAY, "isoyear", "(dayofweek({DAY}) + 1)"))
    return f"SELECT {columns} FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def order_date(day: date) -> date:
    """First order date that falls on ``day`` or later."""
    passed = (day - FIRST_DAY).days
    return FIRST_ORDER + timedelta(days=-(-passed * ORDER_DAYS // CALENDAR_DAYS))


def basket_view(
    spark: SparkSession, path: str, weeks: tuple[int, int] | None = None
) -> DataFrame:
    """Transactions read from ``orders`` and ``lineitem`` parquet under ``path``.

    ``weeks`` keeps an inclusive week range. It is written as a range of order dates, which
    the parquet scan of ``orders`` can use to skip row groups; a filter on the
    computed week code could not. Both tables grow with the data, so the join
    carries no hint and Spark compares their sizes.
    """
    lines = spark.read.parquet(f"{path}/lineitem.parquet")
    orders = spark.read.parquet(f"{path}/orders.parquet")
    if weeks:
        first, last = (divmod(week, 100) for week in weeks)
        start = order_date(date.fromisocalendar(*first, 1))
        end = order_date(date.fromisocalendar(*last, 7) + timedelta(days=1))
        kind = dict(orders.dtypes)["o_orderdate"]
        orders = orders.where(
            f"o_orderdate >= CAST('{start}' AS {kind}) AND o_orderdate < CAST('{end}' AS {kind})"
        )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        *_columns(SPARK_DAY, "yearofweek", "dayofweek({DAY})")
    )
