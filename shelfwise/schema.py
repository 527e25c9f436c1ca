"""Schemas, fixed value lists and window settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

CUST = "CUST_CODE"
PROD = "PROD_CODE"
PAIR = [CUST, PROD]

# The basket-line table, 22 columns.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("SHOP_WEEK", T.IntegerType()),
        T.StructField("SHOP_DATE", T.IntegerType()),
        T.StructField("SHOP_WEEKDAY", T.IntegerType()),
        T.StructField("SHOP_HOUR", T.IntegerType()),
        T.StructField("QUANTITY", T.IntegerType()),
        T.StructField("SPEND", T.DecimalType(18, 2)),
        T.StructField("PROD_CODE", T.StringType()),
        T.StructField("PROD_CODE_10", T.StringType()),
        T.StructField("PROD_CODE_20", T.StringType()),
        T.StructField("PROD_CODE_30", T.StringType()),
        T.StructField("PROD_CODE_40", T.StringType()),
        T.StructField("CUST_CODE", T.StringType()),
        T.StructField("CUST_PRICE_SENSITIVITY", T.StringType()),
        T.StructField("CUST_LIFESTAGE", T.StringType()),
        T.StructField("BASKET_ID", T.LongType()),
        T.StructField("BASKET_SIZE", T.StringType()),
        T.StructField("BASKET_PRICE_SENSITIVITY", T.StringType()),
        T.StructField("BASKET_TYPE", T.StringType()),
        T.StructField("BASKET_DOMINANT_MISSION", T.StringType()),
        T.StructField("STORE_CODE", T.StringType()),
        T.StructField("STORE_FORMAT", T.StringType()),
        T.StructField("STORE_REGION", T.StringType()),
    ]
)

CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("SHOP_WEEK", T.IntegerType()),
        T.StructField("DATE_FROM", T.IntegerType()),
        T.StructField("DATE_TO", T.IntegerType()),
    ]
)

LEVELS = ["PROD_CODE", "PROD_CODE_10", "PROD_CODE_20", "PROD_CODE_30", "PROD_CODE_40"]

# Segment columns and the values each can take.
SEGMENT_VALUES = {
    "BASKET_PRICE_SENSITIVITY": ["LA", "MM", "UM"],
    "BASKET_SIZE": ["L", "M", "S"],
    "DAY_PART": ["AFTERNOON", "EVENING", "MORNING"],
    "WKDAY_WKEND": ["WEEKDAY", "WEEKEND"],
    "BASKET_TYPE": ["Small Shop", "Top Up", "XX"],
    "BASKET_DOMINANT_MISSION": ["Fresh", "Grocery", "Mixed", "Nonfood", "XX"],
    "STORE_FORMAT": ["LS", "MS", "SS", "XLS"],
}
SEGMENTS = list(SEGMENT_VALUES)

# Customer segment vocabularies for the indicator encoding.
CUSTOMER_VOCABULARY = {
    "CUST_PRICE_SENSITIVITY": ["MM", "LA", "UM", "XX"],
    "CUST_LIFESTAGE": ["OT", "XX", "YF", "YA", "OA", "PE", "OF"],
}

# The curated model features.
MODEL_FEATURES = [
    "CUST_PRICE_SENSITIVITY",
    "CUST_LIFESTAGE",
    "BASKET_SIZE_PROP_SPEND_PROD_CODE_M",
    "BASKET_PRICE_SENSITIVITY_SPEND_CUST_CODE_LA",
    "DAY_PART_PROP_SPEND_CUST_CODE_AFTERNOON",
    "BASKET_SIZE_PROP_VISITS_CUST_CODE_L",
    "BASKET_DOMINANT_MISSION_PROP_SPEND_PROD_CODE_Fresh",
    "BASKET_TYPE_PROP_VISITS_CUST_CODE_Small Shop",
    "BASKET_SIZE_PROP_QUANTITY_PROD_CODE_L",
    "STORE_FORMAT_PROP_VISITS_CUST_CODE_MS",
    "CHNG_VISITS_PROD_CODE_30_1_52",
    "STORE_FORMAT_PROP_SPEND_PROD_CODE_LS",
    "STORE_FORMAT_PROP_QUANTITY_CUST_CODE_SS",
    "BASKET_SIZE_QUANTITY_CUST_CODE_S",
    "BASKET_DOMINANT_MISSION_PROP_QUANTITY_PROD_CODE_Nonfood",
    "CHNG_SPEND_PROD_CODE_40_8_52",
    "BASKET_DOMINANT_MISSION_PROP_VISITS_CUST_CODE_XX",
    "BASKET_TYPE_VISITS_CUST_CODE_XX",
    "WKDAY_WKEND_PROP_QUANTITY_CUST_CODE_WEEKEND",
    "BASKET_TYPE_QUANTITY_CUST_CODE_Small Shop",
    "SPEND_PROD_CODE_30_52",
    "BASKET_TYPE_SPEND_CUST_CODE_Top Up",
    "BASKET_DOMINANT_MISSION_PROP_SPEND_CUST_CODE_Grocery",
    "CHNG_QUANTITY_PROD_CODE_40_26_52",
    "SPEND_PROD_CODE_20_52",
    "BASKET_TYPE_PROP_QUANTITY_CUST_CODE_Top Up",
    "VISITS_PROD_CODE_20_52",
    "WKDAY_WKEND_PROP_VISITS_PROD_CODE_WEEKEND",
    "VISITS_PROD_CODE_40_1",
    "CHNG_VISITS_PROD_CODE_40_1_26",
    "BASKET_TYPE_PROP_SPEND_PROD_CODE_XX",
    "STORE_FORMAT_PROP_VISITS_CUST_CODE_XLS",
    "DAY_PART_PROP_VISITS_CUST_CODE_EVENING",
    "TIME_BTWN_MEDIAN_OVERALL_PROD_CODE_40",
    "STORE_FORMAT_PROP_VISITS_PROD_CODE_XLS",
    "DAY_PART_PROP_SPEND_PROD_CODE_MORNING",
    "STORE_FORMAT_PROP_SPEND_PROD_CODE_SS",
    "STORE_FORMAT_PROP_VISITS_PROD_CODE_MS",
    "DAY_PART_PROP_SPEND_CUST_CODE_MORNING",
    "BASKET_PRICE_SENSITIVITY_PROP_SPEND_PROD_CODE_LA",
    "DAY_PART_PROP_QUANTITY_PROD_CODE_EVENING",
    "BASKET_PRICE_SENSITIVITY_SPEND_CUST_CODE_UM",
    "BASKET_DOMINANT_MISSION_PROP_SPEND_PROD_CODE_Grocery",
    "BASKET_PRICE_SENSITIVITY_PROP_QUANTITY_PROD_CODE_MM",
    "STORE_FORMAT_PROP_SPEND_CUST_CODE_LS",
    "QUANTITY_PROD_CODE_52",
    "BASKET_TYPE_PROP_VISITS_PROD_CODE_Top Up",
    "DAY_PART_PROP_SPEND_PROD_CODE_AFTERNOON",
    "CHNG_VISITS_PROD_CODE_20_1_8",
    "BASKET_PRICE_SENSITIVITY_PROP_QUANTITY_CUST_CODE_MM",
    "BASKET_DOMINANT_MISSION_SPEND_CUST_CODE_XX",
    "USER_factor_0",
    "USER_factor_1",
    "USER_factor_2",
    "USER_factor_3",
    "USER_factor_4",
    "ITEM_factor_0",
    "ITEM_factor_1",
    "ITEM_factor_2",
    "ITEM_factor_3",
    "ITEM_factor_4",
]


@dataclass(frozen=True)
class Windows:
    """Observation, activity and target weeks (``yyyyww``).

    ``periods`` are the start weeks of the feature periods, longest first, and
    ``labels`` name them in column names. A period runs from its start week to
    the end of the observation window.
    """

    obs_start: int = 200716
    obs_end: int = 200815
    active_start: int = 200808
    active_end: int = 200815
    target_week: int = 200816
    periods: tuple[int, ...] = (200716, 200742, 200808, 200815)
    labels: tuple[str, ...] = ("52", "26", "8", "1")
    levels: tuple[str, ...] = field(default_factory=lambda: tuple(LEVELS))
