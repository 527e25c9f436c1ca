"""ANSI SQL that states the expected result of each query, run by another engine
over the same tables."""

from __future__ import annotations

from shelfwise.schema import LEVELS, SEGMENT_VALUES, SEGMENTS, TRANSACTION_SCHEMA
from shelfwise.sources.basket_view import basket_view_sql

COLUMNS = TRANSACTION_SCHEMA.names
OBS = "SHOP_WEEK BETWEEN 200716 AND 200815"
ACTIVE = "SHOP_WEEK BETWEEN 200808 AND 200815"
PERIODS = [200716, 200742, 200808, 200815]
LABELS = ["52", "26", "8", "1"]


def with_txn(body: str, **ctes: str) -> str:
    """A query over ``txn`` (all rows), ``obs`` (the observation window) and more."""
    parts = [f"txn AS ({basket_view_sql()})", f"obs AS (SELECT * FROM txn WHERE {OBS})"]
    parts += [f"{name} AS ({sql})" for name, sql in ctes.items()]
    return "WITH " + ", ".join(parts) + " " + body


def bucket(expr: str, n: int, digits: int = 8) -> str:
    return f"(('0x' || substr(md5({expr}), 1, {digits}))::BIGINT % {n})"


def below(expr: str, share: float) -> str:
    """Whether the 32-bit hash of a key lies in the first part of its range."""
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT < {share}::DOUBLE * 4294967296"


DAY_PART = (
    "CASE WHEN SHOP_HOUR BETWEEN 8 AND 11 THEN 'MORNING' WHEN SHOP_HOUR BETWEEN 12 AND 16"
    " THEN 'AFTERNOON' WHEN SHOP_HOUR >= 17 THEN 'EVENING' END"
)
WKDAY = "CASE WHEN SHOP_WEEKDAY IN (1, 7) THEN 'WEEKEND' ELSE 'WEEKDAY' END"
TARGETS = (
    "SELECT DISTINCT CUST_CODE, PROD_CODE, 1 AS TARGET FROM txn WHERE SHOP_WEEK = 200816"
    " AND CUST_CODE IS NOT NULL AND PROD_CODE IS NOT NULL"
)
ACTIVE_CUSTOMERS = f"SELECT DISTINCT CUST_CODE FROM txn WHERE {ACTIVE} AND CUST_CODE IS NOT NULL"
PAIR_TABLE = (
    "SELECT a.CUST_CODE, p.PROD_CODE, CASE WHEN t.TARGET = 1 THEN 1 ELSE 0 END AS TARGET"
    " FROM active a CROSS JOIN (SELECT DISTINCT PROD_CODE FROM targets) p"
    " LEFT JOIN targets t ON t.CUST_CODE = a.CUST_CODE AND t.PROD_CODE = p.PROD_CODE"
)
QUANT = (
    "SELECT CUST_CODE, PROD_CODE, CAST(sum(QUANTITY) AS BIGINT) AS QUANTITY FROM txn"
    " WHERE CUST_CODE IS NOT NULL GROUP BY CUST_CODE, PROD_CODE"
)
LABEL_CTES = {"targets": TARGETS, "active": ACTIVE_CUSTOMERS, "pairs": PAIR_TABLE}


def product_summary(src: str = "obs") -> dict[str, str]:
    """CTEs ending in ``summary``: per level and period, by plain grouping."""
    ctes = {"hmap": f"SELECT DISTINCT {', '.join(LEVELS)} FROM {src}"}
    for level in LEVELS:
        cells = ", ".join(
            f"CAST(coalesce(sum(SPEND) FILTER (WHERE SHOP_WEEK >= {p}), 0) AS DOUBLE) AS SPEND_{level}_{w},"
            f" CAST(coalesce(sum(QUANTITY) FILTER (WHERE SHOP_WEEK >= {p}), 0) AS BIGINT) AS QUANTITY_{level}_{w},"
            f" count(DISTINCT BASKET_ID) FILTER (WHERE SHOP_WEEK >= {p}) AS VISITS_{level}_{w}"
            for p, w in zip(PERIODS, LABELS, strict=True)
        )
        ctes[f"agg_{level}"] = (
            f"SELECT CUST_CODE, {level}, {cells} FROM {src} WHERE SHOP_WEEK >= {PERIODS[0]}"
            f" AND CUST_CODE IS NOT NULL AND {level} IS NOT NULL GROUP BY CUST_CODE, {level}"
        )
    ctes["summary"] = spread("agg_", lambda level: [
        f"{m}_{level}_{w}" for w in LABELS for m in ("SPEND", "QUANTITY", "VISITS")
    ])
    return ctes


def spread(prefix: str, names) -> str:
    columns = ["b.CUST_CODE", "b.PROD_CODE"]
    joins = ""
    for i, level in enumerate(LEVELS):
        alias = "b" if i == 0 else f"l{i}"
        columns += [f"{alias}.{n}" for n in names(level)]
        if i:
            joins += (
                f" JOIN (SELECT a.*, h.PROD_CODE AS P FROM {prefix}{level} a JOIN hmap h"
                f" ON a.{level} = h.{level}) l{i} ON l{i}.CUST_CODE = b.CUST_CODE AND l{i}.P = b.PROD_CODE"
            )
    return f"SELECT {', '.join(columns)} FROM {prefix}PROD_CODE b{joins}"


def changes() -> str:
    short_first = LABELS[::-1]
    columns = [
        f"coalesce(CAST({m}_{lv}_{a} AS DOUBLE) / nullif(CAST({m}_{lv}_{b} AS DOUBLE), 0), 0)"
        f" AS CHNG_{m}_{lv}_{a}_{b}"
        for lv in LEVELS
        for i, a in enumerate(short_first)
        for b in short_first[i + 1 :]
        for m in ("SPEND", "QUANTITY", "VISITS")
    ]
    return f"SELECT CUST_CODE, PROD_CODE, {', '.join(columns)} FROM summary"


def gap_ctes(src: str = "obs") -> dict[str, str]:
    ctes = {"hmap": f"SELECT DISTINCT {', '.join(LEVELS)} FROM {src}"}
    for level in LEVELS:
        ctes[f"days_{level}"] = (
            f"SELECT DISTINCT CUST_CODE, {level}, strptime(CAST(SHOP_DATE AS VARCHAR), '%Y%m%d')::DATE AS d"
            f" FROM {src} WHERE CUST_CODE IS NOT NULL AND {level} IS NOT NULL"
        )
        ctes[f"gaps_{level}"] = (
            f"SELECT * FROM (SELECT *, d - lag(d) OVER (PARTITION BY CUST_CODE, {level} ORDER BY d) AS gap"
            f" FROM days_{level}) WHERE gap IS NOT NULL"
        )
        ctes[f"gap_{level}"] = (
            f"SELECT c.CUST_CODE, c.{level}, c.m AS TIME_BTWN_MEDIAN_CUST_{level},"
            f" o.m AS TIME_BTWN_MEDIAN_OVERALL_{level}, c.last AS TIME_BTWN_LAST_{level} FROM"
            f" (SELECT CUST_CODE, {level}, CAST(median(gap) AS DOUBLE) AS m, CAST(max_by(gap, d) AS INT) AS last"
            f" FROM gaps_{level} GROUP BY CUST_CODE, {level}) c JOIN"
            f" (SELECT {level}, CAST(median(gap) AS DOUBLE) AS m FROM gaps_{level} GROUP BY {level}) o"
            f" ON o.{level} = c.{level}"
        )
    ctes["gaps"] = spread("gap_", lambda level: [
        f"TIME_BTWN_{m}_{level}" for m in ("MEDIAN_CUST", "MEDIAN_OVERALL", "LAST")
    ])
    return ctes


def gap_ratios() -> str:
    columns = [
        f"CAST(TIME_BTWN_LAST_{lv} AS DOUBLE) / nullif(TIME_BTWN_MEDIAN_{w}_{lv}, 0) AS TIME_BTWN_RATIO_{w}_{lv}"
        for lv in LEVELS
        for w in ("CUST", "OVERALL")
    ]
    return f"SELECT CUST_CODE, PROD_CODE, {', '.join(columns)} FROM gaps"


SEGMENTED = f"SELECT *, {DAY_PART} AS DAY_PART, {WKDAY} AS WKDAY_WKEND FROM obs"


def segment_profile(key: str, src: str = "segmented") -> str:
    """Segment profile by filtered aggregates over one grouping."""
    columns = []
    total = {"SPEND": "sum(SPEND)", "QUANTITY": "sum(QUANTITY)", "VISITS": "count(DISTINCT BASKET_ID)"}
    having = []
    for s in SEGMENTS:
        having.append(f"count({s}) > 0")
        for share in (False, True):
            if key == "PROD_CODE" and not share:
                continue
            for m, sql in total.items():
                for v in SEGMENT_VALUES[s]:
                    own = f"CAST(coalesce({sql} FILTER (WHERE {s} = '{v}'), 0) AS DOUBLE)"
                    out = f"coalesce({own} / nullif(CAST({sql} AS DOUBLE), 0), 0)" if share else own
                    columns.append(f'{out} AS "{s}_{"PROP_" if share else ""}{m}_{key}_{v}"')
    return (
        f"SELECT {key}, {', '.join(columns)} FROM {src} WHERE {key} IS NOT NULL"
        f" GROUP BY {key} HAVING {' AND '.join(having)}"
    )


def stacked(columns: list[str], src: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS \"column\", {c} AS value FROM {src}" for c in columns
    )


def describe(columns: list[str], src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,"
        f" round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,"
        f" round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,"
        f" round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,"
        f" round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM {src}"
        for c in columns
    )


def drawn(side: int) -> dict[str, str]:
    """CTEs for the balanced draw of one side of the customer split."""
    s = f"_{side}"
    return {
        f"cust{s}": f"SELECT CUST_CODE FROM split WHERE IN_TEST = {side}",
        f"circle{s}": f"SELECT CUST_CODE, row_number() OVER (ORDER BY md5(CUST_CODE || '|42'), CUST_CODE) - 1 AS place,"
        f" count(*) OVER () AS size FROM cust{s}",
        f"pos{s}": f"SELECT t.CUST_CODE, t.PROD_CODE FROM targets t JOIN cust{s} c ON c.CUST_CODE = t.CUST_CODE",
        f"quota{s}": f"SELECT PROD_CODE, count(*) AS quota FROM pos{s} GROUP BY PROD_CODE",
        f"ranked{s}": "SELECT c.CUST_CODE, q.PROD_CODE, q.quota, row_number() OVER (PARTITION BY q.PROD_CODE ORDER BY"
        f" (c.place - ('0x' || substr(md5(q.PROD_CODE || '|42'), 1, 12))::BIGINT % c.size + c.size) % c.size) AS r"
        f" FROM quota{s} q CROSS JOIN circle{s} c WHERE NOT EXISTS (SELECT 1 FROM pos{s} p"
        " WHERE p.CUST_CODE = c.CUST_CODE AND p.PROD_CODE = q.PROD_CODE)",
        f"drawn{s}": f"SELECT CUST_CODE, PROD_CODE, 1 AS TARGET, {side} AS IN_TEST FROM pos{s} UNION ALL"
        f" SELECT CUST_CODE, PROD_CODE, 0, {side} FROM ranked{s} WHERE r <= quota",
    }


CUST_KEY = "CUST_CODE || '|42'"
SPLIT = f"SELECT CUST_CODE, CAST({below(chr(67) + 'UST_CODE || ' + chr(39) + '|42' + chr(39), 0.3)} AS INT) AS IN_TEST FROM active"
SAMPLE_CTES = {
    "targets": TARGETS,
    "active": ACTIVE_CUSTOMERS,
    "split": SPLIT,
    **drawn(0),
    **drawn(1),
    "sample": "SELECT * FROM drawn_0 UNION ALL SELECT * FROM drawn_1",
}

USER_FACTORS = "SELECT CUST_CODE, " + ", ".join(
    f"{bucket(f'CUST_CODE || {chr(39)}|{i}{chr(39)}', 1000)} / 1000.0::DOUBLE AS USER_factor_{i}" for i in range(2)
) + " FROM (SELECT DISTINCT CUST_CODE FROM obs WHERE CUST_CODE IS NOT NULL)"
ITEM_FACTORS = "SELECT PROD_CODE, " + ", ".join(
    f"{bucket(f'PROD_CODE || {chr(39)}|{i}{chr(39)}', 1000)} / 1000.0::DOUBLE AS ITEM_factor_{i}" for i in range(2)
) + " FROM (SELECT DISTINCT PROD_CODE FROM obs)"


def merged() -> str:
    """Feature assembly over the sample with the tables built above."""
    summary = [f"{m}_{lv}_{w}" for lv in LEVELS for w in LABELS for m in ("SPEND", "QUANTITY", "VISITS")]
    short_first = LABELS[::-1]
    chng = [
        f"CHNG_{m}_{lv}_{a}_{b}" for lv in LEVELS for i, a in enumerate(short_first)
        for b in short_first[i + 1 :] for m in ("SPEND", "QUANTITY", "VISITS")
    ]
    gaps = [f"TIME_BTWN_{m}_{lv}" for lv in LEVELS for m in ("MEDIAN_CUST", "MEDIAN_OVERALL", "LAST")]
    ratios = [f"TIME_BTWN_RATIO_{w}_{lv}" for lv in LEVELS for w in ("CUST", "OVERALL")]
    segs = {
        key: [
            f"{s}_{'PROP_' if share else ''}{m}_{key}_{v}" for s in SEGMENTS for share in (False, True)
            if share or key == "CUST_CODE" for m in ("SPEND", "QUANTITY", "VISITS") for v in SEGMENT_VALUES[s]
        ]
        for key in ("CUST_CODE", "PROD_CODE")
    }
    columns = ["p.CUST_CODE", "p.PROD_CODE", "p.TARGET", "p.IN_TEST"]
    columns += [f"coalesce(s.{c}, 0) AS {c}" for c in summary]
    columns += [f"coalesce(c.{c}, 0) AS {c}" for c in chng]
    columns += [f"CAST(coalesce(g.{c}, max(g.TIME_BTWN_MEDIAN_OVERALL_PROD_CODE) OVER (PARTITION BY p.IN_TEST)) AS DOUBLE) AS {c}" for c in gaps]
    columns += [f"coalesce(r.{c}, max(r.TIME_BTWN_RATIO_OVERALL_PROD_CODE) OVER (PARTITION BY p.IN_TEST)) AS {c}" for c in ratios]
    columns += [f'coalesce(sc."{c}", 0) AS "{c}"' for c in segs["CUST_CODE"]]
    columns += [f'coalesce(si."{c}", 0) AS "{c}"' for c in segs["PROD_CODE"]]
    columns += [f"uf.USER_factor_{i}" for i in range(2)] + [f"itf.ITEM_factor_{i}" for i in range(2)]
    columns += ["uf.CUST_CODE AS u", "itf.PROD_CODE AS i"]
    both = "{0}.CUST_CODE = p.CUST_CODE AND {0}.PROD_CODE = p.PROD_CODE"
    return (
        f"SELECT * EXCLUDE (u, i) FROM (SELECT {', '.join(columns)} FROM sample p"
        f" LEFT JOIN summary s ON {both.format('s')} LEFT JOIN chng c ON {both.format('c')}"
        f" LEFT JOIN gaps g ON {both.format('g')} LEFT JOIN ratios r ON {both.format('r')}"
        " LEFT JOIN seg_cust sc ON sc.CUST_CODE = p.CUST_CODE LEFT JOIN seg_item si ON si.PROD_CODE = p.PROD_CODE"
        " LEFT JOIN user_factors uf ON uf.CUST_CODE = p.CUST_CODE"
        " LEFT JOIN item_factors itf ON itf.PROD_CODE = p.PROD_CODE)"
        " WHERE u IS NOT NULL AND i IS NOT NULL"
    )


SCORED = (
    "SELECT CAST(BASKET_TYPE = 'Top Up' AS INT) AS TARGET, (QUANTITY * 7 % 50) / 50.0::DOUBLE AS probability FROM txn"
)
PREDICTED = "SELECT *, CAST(probability > 0.5 AS INT) AS prediction FROM scored"


def report_sql() -> str:
    classes = " UNION ALL ".join(
        f"SELECT '{k}' AS class, count(*) FILTER (WHERE TARGET = {k} AND prediction = {k}) AS hit,"
        f" count(*) FILTER (WHERE prediction = {k}) AS called, count(*) FILTER (WHERE TARGET = {k}) AS support FROM predicted"
        for k in (0, 1)
    )
    scored = (
        f"SELECT class, hit, support, hit::DOUBLE / called AS precision, hit::DOUBLE / support AS recall FROM ({classes})"
    )
    f1 = f"SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM ({scored})"
    ctes = {"scored": SCORED, "predicted": PREDICTED, "per_class": f1}
    rounded = "round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1"
    body = (
        f"SELECT class, {rounded}, CAST(support AS BIGINT) AS support FROM ("
        "SELECT class, precision, recall, f1, support FROM per_class UNION ALL"
        " SELECT 'accuracy', sum(hit)::DOUBLE / sum(support), NULL, NULL, sum(support) FROM per_class UNION ALL"
        " SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per_class UNION ALL"
        " SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),"
        " sum(f1 * support) / sum(support), sum(support) FROM per_class)"
    )
    return with_txn(body, **ctes)


WINSOR = {
    "quant": QUANT,
    "placed": "SELECT QUANTITY, row_number() OVER (ORDER BY QUANTITY) - 1 AS i, count(*) OVER () AS n FROM quant",
    "bounds": "SELECT max(CASE WHEN i = CAST(floor(0.05 * n) AS BIGINT) THEN QUANTITY END) AS lo,"
    " max(CASE WHEN i = n - CAST(floor(0.05 * n) AS BIGINT) - 1 THEN QUANTITY END) AS hi FROM placed",
    "clamped": "SELECT CUST_CODE, PROD_CODE, least(greatest(QUANTITY, lo), hi) AS QUANTITY FROM quant, bounds",
}
NORMAL = (
    "SELECT q.CUST_CODE, q.PROD_CODE, CASE WHEN hi = lo THEN 0.01 ELSE"
    " (QUANTITY - lo)::DOUBLE / (hi - lo)::DOUBLE + 0.01 END AS QUANTITY FROM clamped q JOIN"
    " (SELECT PROD_CODE, min(QUANTITY) AS lo, max(QUANTITY) AS hi FROM clamped GROUP BY PROD_CODE) b"
    " ON b.PROD_CODE = q.PROD_CODE"
)
CUST_MAP = "SELECT CUST_CODE, row_number() OVER (ORDER BY CUST_CODE) - 1 AS index_CUST_CODE FROM (SELECT DISTINCT CUST_CODE FROM quant)"
ITEM_MAP = "SELECT PROD_CODE, row_number() OVER (ORDER BY PROD_CODE) - 1 AS index_PROD_CODE FROM (SELECT DISTINCT PROD_CODE FROM quant)"
CORR_COLUMNS = ["SHOP_WEEKDAY", "SHOP_HOUR", "QUANTITY", "SPEND", "SHOP_WEEK"]
EVERY_SEGMENTED, EVERY_USER, EVERY_ITEM = (
    sql.replace("FROM obs", "FROM txn") for sql in (SEGMENTED, USER_FACTORS, ITEM_FACTORS)
)
DOT = "USER_factor_0 * ITEM_factor_0 + USER_factor_1 * ITEM_factor_1"
PAIR_KEY = "CUST_CODE || '|' || PROD_CODE || '|{seed}'"
BASKET_SEGMENTS = ["BASKET_SIZE", "BASKET_PRICE_SENSITIVITY", "BASKET_TYPE", "BASKET_DOMINANT_MISSION"]
CUSTOMER_SEGMENTS = ["CUST_PRICE_SENSITIVITY", "CUST_LIFESTAGE"]
COUNTED = [
    "SHOP_WEEK", "SHOP_DATE", "SHOP_WEEKDAY", "SHOP_HOUR", *CUSTOMER_SEGMENTS, *BASKET_SEGMENTS,
    "STORE_FORMAT", "STORE_REGION", "PROD_CODE_10", "PROD_CODE_20", "PROD_CODE_30", "PROD_CODE_40",
]
CODED = {
    "CUST_PRICE_SENSITIVITY": ["LA", "MM", "UM", "XX"],
    "CUST_LIFESTAGE": ["OA", "OF", "OT", "PE", "XX", "YA", "YF"],
}
VOCABULARY = {
    "CUST_PRICE_SENSITIVITY": ["MM", "LA", "UM", "XX"],
    "CUST_LIFESTAGE": ["OT", "XX", "YF", "YA", "OA", "PE", "OF"],
}


def coded(columns: dict[str, list[str]], oov: bool = False) -> str:
    out = []
    for c, values in columns.items():
        out += [f"CAST(coalesce({c} = '{v}', false) AS INT) AS {c}_{v}" for v in values]
        if oov:
            listed = ", ".join(f"'{v}'" for v in values)
            out.append(f"CAST(coalesce({c} NOT IN ({listed}), false) AS INT) AS {c}_OOV")
    return ", ".join(out)


def value_count_sql(columns: list[str], src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {src}"
        f" WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in columns
    )


def numeric_profile() -> str:
    parts = [
        "SELECT 'missing' AS section, 'nulls' AS item, CAST(count(*) - count(x) AS DOUBLE) AS value FROM p",
        "SELECT 'missing', 'rows', CAST(count(*) AS DOUBLE) FROM p",
        "SELECT 'summary', 'n', CAST(count(x) AS DOUBLE) FROM p",
        "SELECT 'summary', 'mean', avg(x) FROM p",
        "SELECT 'summary', 'std', stddev_samp(x) FROM p",
        "SELECT 'summary', 'min', min(x) FROM p",
        "SELECT 'summary', 'max', max(x) FROM p",
    ]
    parts += [
        f"SELECT 'summary', '{n}', quantile_cont(x, {q}) FROM p"
        for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    ]
    parts.append(
        "SELECT 'histogram', CAST(least(CAST(floor((x - lo) / ((hi - lo) / 10)) AS BIGINT), 9) AS VARCHAR),"
        " CAST(count(*) AS DOUBLE) FROM p, (SELECT min(x) AS lo, max(x) AS hi FROM p) GROUP BY 2"
    )
    parts += [
        f"SELECT 'box ' || t, '{n}', {n} FROM box" for n in ("p25", "p50", "p75")
    ]
    inside = "x BETWEEN p25 - 1.5 * (p75 - p25) AND p75 + 1.5 * (p75 - p25)"
    parts += [
        f"SELECT 'box ' || p.t, '{n}', {f}(CASE WHEN {inside} THEN x END) FROM p JOIN box ON box.t = p.t GROUP BY p.t"
        for n, f in (("low", "min"), ("high", "max"))
    ]
    return with_txn(
        "SELECT section, item, round(value, 6) AS value FROM (" + " UNION ALL ".join(parts) + ")",
        p="SELECT CAST(SPEND AS DOUBLE) AS x, CAST(CAST(BASKET_TYPE = 'Top Up' AS INT) AS VARCHAR) AS t FROM txn",
        box="SELECT t, quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75 FROM p GROUP BY t",
    )


def oracle_sql() -> dict[str, str]:
    every = ", ".join(COLUMNS)
    stages = {
        **SAMPLE_CTES,
        "segmented": SEGMENTED,
        **product_summary(),
        "chng": changes(),
        **gap_ctes(),
        "ratios": gap_ratios(),
        "seg_cust": segment_profile("CUST_CODE"),
        "seg_item": segment_profile("PROD_CODE"),
        "user_factors": USER_FACTORS,
        "item_factors": ITEM_FACTORS,
    }
    weight = "SELECT TARGET, count(*) AS n FROM pairs GROUP BY TARGET"
    return {
        "scan_transactions": with_txn(f"SELECT {every} FROM txn"),
        "schema_conform": with_txn(
            f"SELECT {', '.join('CASE WHEN QUANTITY % 10 = 0 THEN NULL ELSE SPEND END AS SPEND' if c == 'SPEND' else c for c in COLUMNS)} FROM txn"
        ),
        "snapshot_roundtrip": with_txn(f"SELECT {every} FROM obs"),
        "snapshot_append": with_txn(f"SELECT {every} FROM txn"),
        "calendar_scan": with_txn(
            "SELECT SHOP_WEEK, min(SHOP_DATE) AS DATE_FROM, max(SHOP_DATE) AS DATE_TO FROM txn GROUP BY SHOP_WEEK"
        ),
        "model_input": with_txn(
            'SELECT s.CUST_CODE, CAST(t.CUST_CODE IS NOT NULL AS INT) AS TARGET,'
            ' "BASKET_TYPE_PROP_VISITS_CUST_CODE_Small Shop" AS "BASKET_TYPE_PROP_VISITS_CUST_CODE_Small_Shop",'
            ' "BASKET_TYPE_SPEND_CUST_CODE_Top Up" AS "BASKET_TYPE_SPEND_CUST_CODE_Top_Up",'
            ' "STORE_FORMAT_PROP_VISITS_CUST_CODE_MS", "DAY_PART_PROP_SPEND_CUST_CODE_AFTERNOON"'
            " FROM seg_cust s LEFT JOIN (SELECT DISTINCT CUST_CODE FROM targets) t ON t.CUST_CODE = s.CUST_CODE",
            targets=TARGETS, segmented=EVERY_SEGMENTED, seg_cust=segment_profile("CUST_CODE"),
        ),
        "filter_window": with_txn(f"SELECT {every} FROM obs"),
        "drop_null_customers": with_txn(f"SELECT {every} FROM txn WHERE CUST_CODE IS NOT NULL"),
        "targets": with_txn("SELECT * FROM targets", targets=TARGETS),
        "active_customers": with_txn("SELECT * FROM active", active=ACTIVE_CUSTOMERS),
        "hierarchy_map": with_txn(f"SELECT DISTINCT {', '.join(LEVELS)} FROM txn"),
        "day_part": with_txn(f"SELECT BASKET_ID, PROD_CODE, SHOP_HOUR, {DAY_PART} AS DAY_PART FROM txn"),
        "weekday_weekend": with_txn(f"SELECT BASKET_ID, PROD_CODE, SHOP_WEEKDAY, {WKDAY} AS WKDAY_WKEND FROM txn"),
        "replace_inf": with_txn(
            "SELECT BASKET_ID, PROD_CODE, CASE WHEN QUANTITY % 25 = 0 THEN 0 ELSE CAST(SPEND AS DOUBLE) / (QUANTITY % 25) END AS price FROM txn"
        ),
        "filter_cust_trans": with_txn(
            f"SELECT {every} FROM obs WHERE EXISTS (SELECT 1 FROM txn t WHERE t.CUST_CODE = obs.CUST_CODE"
            " AND t.PROD_CODE = obs.PROD_CODE AND t.SHOP_WEEK BETWEEN 200808 AND 200815)"
        ),
        "add_non_target": with_txn("SELECT * FROM pairs", **LABEL_CTES),
        "merge_features": with_txn(merged(), **stages),
        "append_cust_segments": with_txn(
            "SELECT t.*, coalesce(s.CUST_PRICE_SENSITIVITY, 'XX') AS CUST_PRICE_SENSITIVITY,"
            " coalesce(s.CUST_LIFESTAGE, 'XX') AS CUST_LIFESTAGE FROM targets t LEFT JOIN"
            " (SELECT DISTINCT CUST_CODE, CUST_PRICE_SENSITIVITY, CUST_LIFESTAGE FROM txn) s ON s.CUST_CODE = t.CUST_CODE",
            targets=TARGETS,
        ),
        "als_holdout": with_txn(
            f"SELECT *, CAST({below(PAIR_KEY.format(seed=1234), 0.1)} AS INT) AS IN_TEST FROM quant", quant=QUANT
        ),
        "score_pairs_fixed": with_txn(
            f"SELECT CUST_CODE, PROD_CODE, QUANTITY, round({DOT}, 9) AS score FROM quant JOIN u USING (CUST_CODE) JOIN i USING (PROD_CODE)",
            quant=QUANT, u=EVERY_USER, i=EVERY_ITEM,
        ),
        "predict_top_x_fixed": with_txn(
            "SELECT CUST_CODE, PROD_CODE, score, pred_rank FROM ("
            "SELECT *, CAST(dense_rank() OVER (PARTITION BY CUST_CODE ORDER BY score DESC) AS INT) AS pred_rank FROM ("
            "SELECT CUST_CODE, PROD_CODE, a * c + b * d AS score FROM"
            " (SELECT CUST_CODE, floor(USER_factor_0 * 16) / 4 AS a, floor(USER_factor_1 * 16) / 4 AS b FROM u) u,"
            " (SELECT PROD_CODE, floor(ITEM_factor_0 * 16) / 4 AS c, floor(ITEM_factor_1 * 16) / 4 AS d FROM i) i"
            " WHERE a <> 0 OR b <> 0) x) y WHERE pred_rank <= 5",
            u=EVERY_USER, i=EVERY_ITEM,
        ),
        "mse_fixed": with_txn(
            "SELECT CASE WHEN QUANTITY > 50 THEN 'train' ELSE 'test' END AS split, count(*) AS n,"
            f" round(avg(pow(QUANTITY - ({DOT}), 2)), 6) AS mse FROM quant JOIN u USING (CUST_CODE) JOIN i USING (PROD_CODE) GROUP BY 1",
            quant=QUANT, u=EVERY_USER, i=EVERY_ITEM,
        ),
        "stored_report": report_sql(),
        "stored_factors": with_txn(
            "SELECT CUST_CODE AS code, USER_factor_0 AS factor_0, USER_factor_1 AS factor_1 FROM u"
            " UNION ALL SELECT PROD_CODE, ITEM_factor_0, ITEM_factor_1 FROM i",
            u=EVERY_USER, i=EVERY_ITEM,
        ),
        "factor_tables_fixed": with_txn(
            "SELECT CUST_CODE AS code, USER_factor_0 AS factor_0, USER_factor_1 AS factor_1 FROM u"
            " UNION ALL SELECT PROD_CODE, ITEM_factor_0, ITEM_factor_1 FROM i",
            u=EVERY_USER, i=EVERY_ITEM,
        ),
        "model_store": with_txn(
            f"SELECT count(*) AS n, 0::BIGINT AS n_different FROM txn WHERE {below('BASKET_ID || ' + chr(39) + '|7' + chr(39), 0.3)}"
        ),
        "pairs_csv_roundtrip": with_txn("SELECT * FROM targets", targets=TARGETS),
        "label_first_csv": with_txn("SELECT CAST(BASKET_TYPE = 'Top Up' AS INT) AS TARGET, QUANTITY, SHOP_HOUR FROM txn"),
        "create_mapping": with_txn("SELECT * FROM m", quant=QUANT, m=CUST_MAP),
        "merge_mapping": with_txn(
            "SELECT q.*, c.index_CUST_CODE, i.index_PROD_CODE FROM quant q JOIN cmap c ON c.CUST_CODE = q.CUST_CODE"
            " JOIN imap i ON i.PROD_CODE = q.PROD_CODE",
            quant=QUANT, cmap=CUST_MAP, imap=ITEM_MAP,
        ),
        "sp_vi_qu": with_txn("SELECT * FROM summary", **product_summary()),
        "chng_features": with_txn(changes(), **product_summary()),
        "time_last_purchased": with_txn("SELECT * FROM gaps", **gap_ctes()),
        "time_since_ratios": with_txn(gap_ratios(), **gap_ctes()),
        "cust_quant_summ": with_txn("SELECT * FROM quant", quant=QUANT.replace("FROM txn", "FROM obs")),
        "seg_summary_cust": with_txn(segment_profile("CUST_CODE"), segmented=EVERY_SEGMENTED),
        "seg_summary_item": with_txn(segment_profile("PROD_CODE"), segmented=EVERY_SEGMENTED),
        "class_balance": with_txn("SELECT TARGET, count(*) AS n FROM pairs GROUP BY TARGET", **LABEL_CTES),
        "distinct_counts": with_txn(
            "SELECT 'CUST_CODE' AS \"column\", count(DISTINCT CUST_CODE) AS n_distinct FROM txn UNION ALL"
            " SELECT 'PROD_CODE', count(DISTINCT PROD_CODE) FROM txn"
        ),
        "describe": with_txn(describe(["SHOP_WEEKDAY", "SHOP_HOUR", "QUANTITY", "SPEND"], "txn")),
        "null_counts": with_txn(" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, count(*) AS n_rows FROM txn" for c in COLUMNS
        )),
        "value_counts": with_txn(value_count_sql(COUNTED, "txn")),
        "segment_census": with_txn(
            value_count_sql(BASKET_SEGMENTS, "b") + " UNION ALL " + value_count_sql(CUSTOMER_SEGMENTS, "c"),
            b=f"SELECT DISTINCT CUST_CODE, {', '.join(BASKET_SEGMENTS)} FROM txn",
            c=f"SELECT DISTINCT CUST_CODE, {', '.join(CUSTOMER_SEGMENTS)} FROM txn",
        ),
        "matrix_sparsity": with_txn(
            "SELECT count(DISTINCT CUST_CODE) AS n_users, count(DISTINCT PROD_CODE) AS n_items, count(*) AS n_cells,"
            " round(100.0 * (1 - count(*)::DOUBLE / (count(DISTINCT CUST_CODE)::DOUBLE * count(DISTINCT PROD_CODE))), 9) AS sparsity"
            " FROM quant",
            quant=QUANT,
        ),
        "customer_split": with_txn("SELECT * FROM split", active=ACTIVE_CUSTOMERS, split=SPLIT),
        "three_way_split": with_txn(
            f"SELECT CUST_CODE, PROD_CODE, QUANTITY, CASE WHEN {below(CUST_KEY, 0.67)} THEN 'train' WHEN {below(CUST_KEY, 0.835)} THEN 'test' ELSE 'valid' END AS SPLIT"
            " FROM quant",
            quant=QUANT,
        ),
        "sample_non_target": with_txn(
            "SELECT CUST_CODE, PROD_CODE, TARGET FROM (SELECT *, sum(TARGET) OVER (PARTITION BY PROD_CODE) AS q,"
            f" row_number() OVER (PARTITION BY PROD_CODE, TARGET ORDER BY md5({PAIR_KEY.format(seed=0)}), CUST_CODE) AS r FROM pairs)"
            " WHERE TARGET = 1 OR r <= q",
            **LABEL_CTES,
        ),
        "row_split": with_txn(
            f"SELECT *, CAST({below(PAIR_KEY.format(seed=0), 0.2)} AS INT) AS IN_TEST FROM pairs", **LABEL_CTES
        ),
        "stratified_folds": with_txn(
            "SELECT CUST_CODE, PROD_CODE, TARGET, CAST((row_number() OVER (PARTITION BY TARGET ORDER BY"
            f" md5({PAIR_KEY.format(seed=0)}), CUST_CODE, PROD_CODE) - 1) % 5 AS INT) AS fold FROM pairs",
            **LABEL_CTES,
        ),
        "winsorize": with_txn("SELECT * FROM clamped", **WINSOR),
        "normalize_min_max": with_txn(NORMAL, **WINSOR),
        "standardize": with_txn(
            "SELECT BASKET_ID, PROD_CODE, round((QUANTITY - mq) / sq, 6) AS QUANTITY, round((CAST(SPEND AS DOUBLE) - ms) / ss, 6) AS SPEND"
            " FROM txn, (SELECT avg(QUANTITY) AS mq, stddev_pop(QUANTITY) AS sq, avg(CAST(SPEND AS DOUBLE)) AS ms,"
            " stddev_pop(CAST(SPEND AS DOUBLE)) AS ss FROM txn)"
        ),
        "one_hot": with_txn(f"SELECT BASKET_ID, PROD_CODE, {coded(CODED)} FROM txn"),
        "vocab_indicator": with_txn(f"SELECT BASKET_ID, PROD_CODE, {coded({**VOCABULARY, 'BASKET_SIZE': ['L', 'M']}, True)} FROM txn"),
        "dummies": with_txn(
            f"SELECT BASKET_ID, {coded({**CODED, 'BASKET_SIZE': ['L', 'M', 'S']})}, SHOP_HOUR, QUANTITY FROM txn"
        ),
        "squared_corr": with_txn(
            "SELECT features, round(c * c, 9) AS squared_correlation FROM (" + " UNION ALL ".join(
                f"SELECT '{c}' AS features, corr(CAST({c} AS DOUBLE), CAST(BASKET_TYPE = 'Top Up' AS INT)) AS c FROM txn"
                for c in CORR_COLUMNS
            ) + ") ORDER BY c * c DESC LIMIT 3"
        ),
        "paired_corr": with_txn(
            "SELECT feature_1, feature_2, round(c, 9) AS abs_correlation FROM (" + " UNION ALL ".join(
                f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, abs(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) AS c FROM txn"
                for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1 :]
            ) + ") ORDER BY c DESC LIMIT 5"
        ),
        "profile_numeric": numeric_profile(),
        "profile_categorical": with_txn(
            "SELECT CUST_LIFESTAGE AS value, count(*) AS n, round(avg(t), 9) AS target_mean, round(stddev_samp(t), 9) AS target_sd,"
            " CAST(CUST_LIFESTAGE IS NULL AS INT) AS is_null FROM (SELECT *, CAST(BASKET_TYPE = 'Top Up' AS INT) AS t FROM txn) GROUP BY CUST_LIFESTAGE"
        ),
        "density": with_txn(
            "SELECT point, round(x, 6) AS x, round(d, 9) AS density FROM (SELECT g.point, lo + g.point * step AS x,"
            " sum(v.n * exp(-0.5 * pow((lo + g.point * step - v.q) / w, 2))) / (max(e.n) * max(w) * sqrt(2 * pi())) AS d"
            " FROM e CROSS JOIN (SELECT CAST(range AS INT) AS point FROM range(50)) g CROSS JOIN"
            " (SELECT CAST(QUANTITY AS DOUBLE) AS q, count(*) AS n FROM txn GROUP BY 1) v GROUP BY g.point, lo, step)",
            b="SELECT count(QUANTITY) AS n, stddev_samp(CAST(QUANTITY AS DOUBLE)) * pow(count(QUANTITY), -0.2) AS w, min(QUANTITY) AS a, max(QUANTITY) AS z FROM txn",
            e="SELECT n, w, a - 3 * w AS lo, (z + 3 * w - (a - 3 * w)) / 49 AS step FROM b",
        ),
        "class_weights": with_txn(
            "SELECT p.*, round((SELECT sum(n) FROM w)::DOUBLE / ((SELECT count(*) FROM w) * w.n), 9) AS weight FROM pairs p JOIN w ON w.TARGET = p.TARGET",
            **LABEL_CTES, w=weight,
        ),
        "threshold_predictions": with_txn(
            "SELECT BASKET_ID, PROD_CODE, round(exp(z) / (1 + exp(z)), 9) AS probability, CAST(exp(z) / (1 + exp(z)) > 0.5 AS INT) AS prediction"
            " FROM (SELECT *, (QUANTITY - 25.5) / 10.0::DOUBLE AS z FROM txn)"
        ),
        "classification_report": report_sql(),
        "roc_auc": with_txn(
            "SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg, round(sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos) * sum(neg))::DOUBLE, 9) AS roc_auc"
            " FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below"
            " FROM (SELECT probability, sum(TARGET) AS pos, sum(1 - TARGET) AS neg FROM scored GROUP BY probability))",
            scored=SCORED,
        ),
        "training_sample": with_txn("SELECT * FROM sample", **SAMPLE_CTES),
        "purchase_attributions": with_txn(
            "SELECT CUST_CODE, PROD_CODE, 0.0::DOUBLE AS residual FROM sample", **SAMPLE_CTES
        ),
    }
