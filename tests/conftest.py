import pytest
from pyspark.sql import SparkSession

from shelfwise.schema import TRANSACTION_SCHEMA


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


# A line with every column filled; tests change what matters to them.
LINE = {
    "SHOP_WEEK": 200801,
    "SHOP_DATE": 20080301,
    "SHOP_WEEKDAY": 2,
    "SHOP_HOUR": 10,
    "QUANTITY": 1,
    "SPEND": "1.00",
    "PROD_CODE": "P1",
    "PROD_CODE_10": "C1",
    "PROD_CODE_20": "D1",
    "PROD_CODE_30": "G1",
    "PROD_CODE_40": "A1",
    "CUST_CODE": "U1",
    "CUST_PRICE_SENSITIVITY": "LA",
    "CUST_LIFESTAGE": "YF",
    "BASKET_ID": 1,
    "BASKET_SIZE": "L",
    "BASKET_PRICE_SENSITIVITY": "LA",
    "BASKET_TYPE": "Top Up",
    "BASKET_DOMINANT_MISSION": "Fresh",
    "STORE_CODE": "S1",
    "STORE_FORMAT": "LS",
    "STORE_REGION": "E1",
}


@pytest.fixture(scope="session")
def make_lines(spark):
    """Transactions from partial rows; ``parts`` sets the partitioning."""
    from decimal import Decimal

    def make(rows, parts=None):
        full = []
        for row in rows:
            line = {**LINE, **row}
            if line["SPEND"] is not None:
                line["SPEND"] = Decimal(str(line["SPEND"]))
            full.append(tuple(line[c] for c in TRANSACTION_SCHEMA.names))
        df = spark.createDataFrame(full, TRANSACTION_SCHEMA)
        return df.repartition(parts) if parts else df

    return make


@pytest.fixture(scope="session")
def random_lines():
    """Random rows with null keys, a moved product and baskets over two weeks."""
    import random

    def draw(n=300, seed=0):
        r = random.Random(seed)
        rows = []
        for _ in range(n):
            product = r.randrange(12)
            basket = r.randrange(60)
            day = r.randrange(1, 29)
            week = 200801 + r.randrange(8)
            # P0 has moved between two parents at the lowest level.
            lowest = f"C{product // 2}" if product or r.random() < 0.5 else "C5"
            rows.append(
                {
                    "SHOP_WEEK": week,
                    "SHOP_DATE": 20080100 + 100 * (week % 7) + day,
                    "SHOP_WEEKDAY": r.randrange(1, 8),
                    "SHOP_HOUR": r.randrange(6, 23),
                    "QUANTITY": r.randrange(0, 6),
                    "SPEND": None if r.random() < 0.05 else round(r.uniform(-2, 20), 2),
                    "PROD_CODE": f"P{product}",
                    "PROD_CODE_10": lowest,
                    "PROD_CODE_20": f"D{product // 3}",
                    "PROD_CODE_30": f"G{product // 6}",
                    "PROD_CODE_40": "A1",
                    "CUST_CODE": None if r.random() < 0.1 else f"U{r.randrange(10)}",
                    "BASKET_ID": basket,
                    "BASKET_SIZE": r.choice(["L", "M", "S", None]),
                    "BASKET_TYPE": r.choice(["Small Shop", "Top Up", "XX"]),
                }
            )
        return rows

    return draw
