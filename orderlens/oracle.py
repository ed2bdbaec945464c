"""Independent SQL for the registered queries, written for another engine.

The shared part restates the six relations and the view over the driver's tables.
"""

from __future__ import annotations

from orderlens import schemas
from orderlens.operators.profile import DESCRIBED
from orderlens.operators.scoring import CATEGORIES

VIEW = ["order_id", "review_id", "review_answer_timestamp", *schemas.FEATURE_COLUMNS]
CLEAN = ["order_id", *schemas.FEATURE_COLUMNS]


def _after(key: str, hours: str = "0") -> str:
    return f"TIMESTAMP '1992-01-01' + to_hours(CAST({key} % 2406 * 24 + {key} * 7 % 24 + {hours} AS BIGINT))"


DELIVERED = "CASE WHEN o_orderkey % 97 <> 0 THEN 72 + o_orderkey * 17 % 700 END"
ESTIMATED = "(o_orderkey % 14 + 20) * 24"

BASE = f"""
r_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
         lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         n_name AS customer_city, substr(r_name, 1, 2) AS customer_state
  FROM customer LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey),
r_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 37 <> 0 THEN lower(p_type) END AS product_category_name,
         CAST(CASE WHEN p_partkey % 29 <> 0 THEN length(p_name) END AS INTEGER) AS product_name_lenght,
         CAST(CASE WHEN p_partkey % 29 <> 0 THEN p_size * 20 END AS INTEGER) AS product_description_lenght,
         CAST(CASE WHEN p_partkey % 29 <> 0 THEN p_size % 6 + 1 END AS INTEGER) AS product_photos_qty,
         CAST(CASE WHEN p_partkey % 31 <> 0 THEN p_size * 100 END AS INTEGER) AS product_weight_g,
         CAST(p_partkey % 40 + 16 AS INTEGER) AS product_length_cm,
         CAST(p_partkey % 23 + 2 AS INTEGER) AS product_height_cm,
         CAST(CASE WHEN p_partkey % 31 <> 0 THEN p_partkey % 17 + 11 END AS INTEGER) AS product_width_cm
  FROM part),
c_products AS (SELECT * REPLACE (coalesce(product_category_name, 'unknown') AS product_category_name) FROM r_products),
r_names AS (
  SELECT DISTINCT lower(p_type) AS product_category_name, lower(p_type) || '_en' AS product_category_name_english
  FROM part WHERE lower(p_type) <> 'economy'),
r_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'delivered' END AS order_status,
         {_after('o_orderkey')} AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 101 <> 0 THEN {_after('o_orderkey', 'o_orderkey * 7 % 60')} END AS order_approved_at,
         {_after('o_orderkey', '24 + o_orderkey * 13 % 200')} AS order_delivered_carrier_date,
         CASE WHEN o_orderkey % 97 <> 0 THEN {_after('o_orderkey', '72 + o_orderkey * 17 % 700')} END
           AS order_delivered_customer_date,
         {_after('o_orderkey', ESTIMATED)} AS order_estimated_delivery_date
  FROM orders),
r_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         {_after('l_orderkey', '(l_partkey % 6 + 4) * 24')} AS shipping_limit_date,
         CAST(CASE WHEN l_orderkey % 499 = 0 THEN 0.0
                   WHEN (l_partkey + l_linenumber) % 211 <> 0 THEN l_extendedprice END AS DECIMAL(10,2)) AS price,
         CAST(l_quantity AS DECIMAL(10,2)) AS freight_value
  FROM lineitem),
r_review_rows AS (
  SELECT o_orderkey, 1 AS seq,
         CASE WHEN coalesce({DELIVERED} > {ESTIMATED}, false) THEN o_orderkey % 4 + 1
              WHEN o_orderkey % 11 = 0 THEN 2 ELSE 5 - o_orderkey % 2 END AS score
  FROM orders
  UNION ALL
  SELECT o_orderkey, 2, CASE WHEN o_orderkey % 250 <> 0 THEN 4 END FROM orders WHERE o_orderkey % 50 = 0),
r_reviews AS (
  SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(seq AS VARCHAR) AS review_id, o_orderkey AS order_id,
         CAST(score AS INTEGER) AS review_score,
         chr(10) || ' ' || source || chr(13) || lang || chr(9) AS review_comment_title,
         ' ' || chr(13) || chr(10) || text || chr(160) || chr(10) AS review_comment_message,
         {_after('o_orderkey', '800')} AS review_creation_date,
         {_after('o_orderkey', 'CASE WHEN o_orderkey % 100 = 0 THEN 901 ELSE 900 + seq END')} AS review_answer_timestamp
  FROM r_review_rows LEFT JOIN documents ON o_orderkey = doc_id),
items_agg AS (
  SELECT order_id, max(order_item_id) AS num_items, sum(price) AS total_price, sum(freight_value) AS total_freight,
         max(shipping_limit_date) AS limit_date,
         first(product_id ORDER BY price DESC NULLS LAST, order_item_id, product_id) AS most_imp_product_id
  FROM r_items GROUP BY order_id),
delivered AS (
  SELECT * FROM r_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL),
fview AS (
  SELECT o.order_id, r.review_id, r.review_answer_timestamp, r.review_score,
         CASE WHEN r.review_score <= 3 THEN 1 ELSE 0 END AS bad_score,
         i.num_items, CAST(i.total_price AS DOUBLE) AS total_price, CAST(i.total_freight AS DOUBLE) AS total_freight,
         CASE WHEN i.total_price <> 0 THEN
           ((20000 * CAST(i.total_freight * 100 AS BIGINT) + CAST(i.total_price * 100 AS BIGINT))
            // (2 * CAST(i.total_price * 100 AS BIGINT))) / 10000.0 END::DOUBLE AS freight_ratio,
         coalesce(p.product_name_lenght, 0) AS name_len, coalesce(p.product_description_lenght, 0) AS desc_len,
         coalesce(c.product_category_name_english, p.product_category_name) AS category,
         coalesce(p.product_photos_qty, 0) AS prod_photos, coalesce(p.product_weight_g, 0) AS weight_g,
         CAST(coalesce(((CAST(p.product_length_cm AS BIGINT) * p.product_height_cm * p.product_width_cm + 5) // 10)
              / 100.0, 0) AS DOUBLE) AS volume_l,
         CASE WHEN p.product_name_lenght IS NULL OR p.product_description_lenght IS NULL
                OR p.product_photos_qty IS NULL OR p.product_weight_g IS NULL THEN 1 ELSE 0 END AS has_missing_details,
         CAST(extract(DAY FROM o.order_delivered_customer_date - o.order_purchase_timestamp) AS INTEGER) AS delivery_days,
         CAST(extract(DAY FROM o.order_delivered_customer_date - o.order_estimated_delivery_date) AS INTEGER)
           AS estimated_delivery_diff,
         CAST(extract(DAY FROM o.order_delivered_carrier_date - i.limit_date) AS INTEGER) AS seller_disp_diff,
         CAST(extract(DAY FROM o.order_delivered_carrier_date - o.order_approved_at) AS INTEGER) AS processing_days,
         CASE WHEN o.order_delivered_carrier_date > i.limit_date THEN 1 ELSE 0 END AS is_seller_late,
         CASE WHEN CAST(o.order_delivered_customer_date AS DATE) > CAST(o.order_estimated_delivery_date AS DATE)
              THEN 1 ELSE 0 END AS is_delivery_late
  FROM delivered o JOIN items_agg i USING (order_id)
  JOIN c_products p ON i.most_imp_product_id = p.product_id
  JOIN r_reviews r ON o.order_id = r.order_id
  LEFT JOIN r_names c ON p.product_category_name = c.product_category_name),
complete AS (SELECT * FROM fview WHERE {' AND '.join(f'{c} IS NOT NULL' for c in CLEAN)}),
reviewed AS (
  SELECT {', '.join(CLEAN)} FROM complete
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_answer_timestamp DESC, review_id DESC,
                             review_score DESC) = 1),
cleaned AS (SELECT * REPLACE (greatest(processing_days, 0) AS processing_days) FROM reviewed),
logged AS (SELECT *, ln(1 + total_price) AS log_total_price, ln(1 + total_freight) AS log_total_freight FROM cleaned),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY bad_score ORDER BY md5('123|' || order_id), order_id) AS label_rank,
         count(*) OVER (PARTITION BY bad_score) AS label_rows
  FROM logged),
split AS (SELECT *, CASE WHEN label_rank <= floor(label_rows * 0.8) THEN 'train' ELSE 'test' END AS split FROM ranked),
train AS (SELECT * FROM split WHERE split = 'train'),
scored AS (
  SELECT *, least(100, 15 + 30 * is_delivery_late + CASE WHEN num_items >= 5 THEN 20 ELSE 0 END + delivery_days) AS points
  FROM cleaned),
rule AS (SELECT *, points / 100.0::DOUBLE AS probability, CASE WHEN points >= 50 THEN 1 ELSE 0 END AS prediction FROM scored)
"""

BOUNDS = [
    ("lower_seller", "seller_disp_diff", 0.01, "<"),
    ("lower_estimated", "estimated_delivery_diff", 0.01, "<"),
    ("upper_delivery", "delivery_days", 0.99, ">="),
    ("upper_estimated", "estimated_delivery_diff", 0.99, ">="),
    ("upper_processing", "processing_days", 0.99, ">="),
    ("upper_seller", "seller_disp_diff", 0.99, "<"),
]


def _bounds(table: str) -> str:
    return ", ".join(f"quantile_cont({c}, {q}) AS {n}" for n, c, q, _ in BOUNDS) + f" FROM {table}"


def _clipped(table: str, bounds: str, keep: str) -> str:
    return f"""SELECT {keep},
      CAST(least(delivery_days, upper_delivery) AS DOUBLE) AS delivery_days,
      CAST(greatest(lower_estimated, least(estimated_delivery_diff, upper_estimated)) AS DOUBLE) AS estimated_delivery_diff,
      CAST(greatest(lower_seller, least(seller_disp_diff, upper_seller)) AS DOUBLE) AS seller_disp_diff,
      CAST(least(processing_days, upper_processing) AS DOUBLE) AS processing_days
    FROM {table}, {bounds}"""


def sql(body: str, *more: str) -> str:
    """The shared relations, further named parts, and the query itself."""
    return "WITH " + ",\n".join([BASE.strip(), *more]) + "\n" + body


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def parsed(column: str) -> str:
    """A time column as the raw text it would be, parsed: malformed for each 89th order."""
    return f"CASE WHEN order_id % 89 <> 0 THEN {column} END AS {column}"


def raw_text(column: str) -> str:
    text = f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    return (
        f"CASE WHEN {column} IS NULL AND (order_id % 89 <> 0 OR order_id % 2 = 0) THEN NULL "
        f"WHEN order_id % 89 <> 0 THEN {text} "
        f"WHEN order_id % 2 = 0 THEN substr({text}, 1, 10) ELSE 'not a time' END AS {column}"
    )


SPACES = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def tidy(column: str) -> str:
    return (
        f"regexp_replace(regexp_replace(coalesce({column}, ''), '[\\n\\r]', ' ', 'g'), "
        f"'^{SPACES}+|{SPACES}+$', '', 'g') AS {column}"
    )


TABLE_CTE = {
    "customers": "r_customers",
    "products": "c_products",
    "orders": "r_orders",
    "reviews": "r_reviews",
    "order_items": "r_items",
    "category_names": "r_names",
}
FILES = {
    "customers": "*customers_dataset.csv",
    "products": "*products_dataset.csv",
    "orders": "*orders_dataset.csv",
    "reviews": "*order_reviews_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "category_names": "*category_name_translation.csv",
}
MONEY = "CAST({0} AS DOUBLE) AS {0}"
F1 = "coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)"
CELLS = """cells AS (SELECT count(*) FILTER (bad_score = 0 AND prediction = 0) AS tn,
  count(*) FILTER (bad_score = 0 AND prediction = 1) AS fp, count(*) FILTER (bad_score = 1 AND prediction = 0) AS fn,
  count(*) FILTER (bad_score = 1 AND prediction = 1) AS tp FROM rule)"""
LEADING = "order_id, review_id"
TYPES = {
    "order_id": "bigint", "review_id": "string", "review_answer_timestamp": "timestamp_ntz",
    "total_price": "decimal(20,2)", "total_freight": "decimal(20,2)", "freight_ratio": "decimal(25,4)",
    "category": "string", "volume_l": "decimal(22,2)",
}
INPUTS = """inputs AS (SELECT order_id, bad_score, num_items, desc_len, category, weight_g / 1000.0::DOUBLE AS weight_kg,
  delivery_days, estimated_delivery_diff, total_freight AS freight_value FROM cleaned)"""
ENCODING = """stats AS (SELECT category, count(*) AS n, avg(bad_score) AS mean FROM train GROUP BY category),
overall AS (SELECT avg(bad_score) AS prior FROM train),
encoding AS (SELECT category, n, prior * (1 - 1 / (1 + exp(-(n - 20) / 10.0)))
  + mean * (1 / (1 + exp(-(n - 20) / 10.0))) AS encoded, prior FROM stats, overall)"""


def _transformed(where: str, extra: str) -> str:
    kept = [c for c in CLEAN if c not in ("total_price", "total_freight", "category", *schemas.DAY_COLUMNS)]
    columns = ", ".join(kept)
    return sql(
        f"""SELECT {columns}{extra}, round(log_total_price, 6) AS log_total_price,
          round(log_total_freight, 6) AS log_total_freight, round(coalesce(encoded, prior_all), 6) AS category,
          round(delivery_days, 6) AS delivery_days, round(estimated_delivery_diff, 6) AS estimated_delivery_diff,
          round(seller_disp_diff, 6) AS seller_disp_diff, round(processing_days, 6) AS processing_days
        FROM clipped LEFT JOIN encoding USING (category), (SELECT prior AS prior_all FROM overall) {where}""",
        ENCODING,
        f"bounds AS (SELECT {_bounds('train')})",
        "clipped AS ("
        + _clipped("split", "bounds", f"{columns}, category, split, log_total_price, log_total_freight")
        + ")",
    )


def _audit() -> str:
    parts = []

    def add(table: str, rule: str, column: str, count: str) -> None:
        parts.append(f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, ({count}) AS n_bad")

    for name, spec in schemas.TABLES.items():
        t = TABLE_CTE[name]
        for c in spec.primary_key:
            add(name, "primary_key_not_null", c, f"SELECT count(*) FROM {t} WHERE {c} IS NULL")
        for c, n in spec.max_length.items():
            add(name, f"length_at_most_{n}", c, f"SELECT count(*) FROM {t} WHERE length(CAST({c} AS VARCHAR)) > {n}")
        for c in spec.money_columns:
            add(name, "below_10_digits", c, f"SELECT count(*) FROM {t} WHERE abs({c}) >= 100000000")
        if spec.primary_key:
            keys = ", ".join(spec.primary_key)
            add(
                name,
                "primary_key_unique",
                ",".join(spec.primary_key),
                f"SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM {t} GROUP BY {keys})",
            )
        for c, (target, key) in spec.foreign_keys.items():
            add(
                name,
                "foreign_key_exists",
                c,
                f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {key} FROM {TABLE_CTE[target]})",
            )
    return sql(union(parts))


def _correlations() -> str:
    names = [c for c in CLEAN if c not in ("order_id", "review_score", "category")] + ["log_total_price", "log_total_freight"]
    others = ", ".join(c for c in names if c not in schemas.DAY_COLUMNS)
    # The population form with centred sums: a constant column has no correlation.
    parts = [
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN round(corr({a}, {b}), 6) END AS correlation FROM clipped"
        for a in names
        for b in names
    ]
    return sql(
        union(parts),
        f"bounds AS (SELECT {_bounds('cleaned')})",
        "clipped AS MATERIALIZED (" + _clipped("logged", "bounds", others) + ")",
    )


def _histogram() -> str:
    plan = {"total_price": 100, "log_total_price": 50, "total_freight": 100, "log_total_freight": 50}
    ranges = union(
        [f"SELECT '{c}' AS column_name, {n} AS bins, min({c}) AS low, max({c}) AS high FROM logs" for c, n in plan.items()]
    )
    values = union([f"SELECT '{c}' AS column_name, {c} AS value FROM logs" for c in plan])
    return sql(
        """SELECT column_name, CAST(b AS INTEGER) AS bin, round(low + (b - 1) * width, 6) AS lower_edge,
             round(low + b * width, 6) AS upper_edge, coalesce(n, 0) AS n
           FROM (SELECT *, unnest(generate_series(1, bins)) AS b FROM ranges)
           LEFT JOIN counts USING (column_name, b)""",
        "logs AS (SELECT *, ln(1 + total_price) AS log_total_price, ln(1 + total_freight) AS log_total_freight FROM reviewed)",
        f"spans AS ({ranges})",
        "ranges AS (SELECT *, (high - low) / bins AS width FROM spans)",
        f"vals AS ({values})",
        """counts AS (SELECT column_name, CAST(least(floor((value - low) / width) + 1, bins) AS BIGINT) AS b, count(*) AS n
           FROM vals JOIN ranges USING (column_name) GROUP BY ALL)""",
    )


def _boxes() -> str:
    values = union(
        [
            f"SELECT '{c}' AS column_name, review_score, CAST({c} AS DOUBLE) AS value FROM reviewed"
            for c in ("delivery_days", "estimated_delivery_diff", "processing_days")
        ]
    )
    return sql(
        """SELECT column_name, review_score, count(*) AS n, min(q1) AS q1, min(median) AS median, min(q3) AS q3,
             least(min(value) FILTER (inside), min(q1)) AS whisker_low,
             greatest(max(value) FILTER (inside), max(q3)) AS whisker_high,
             count(*) FILTER (NOT inside) AS n_outliers
           FROM (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
                 FROM vals JOIN quartiles USING (column_name, review_score))
           GROUP BY column_name, review_score""",
        f"vals AS ({values})",
        """quartiles AS (SELECT column_name, review_score, quantile_cont(value, 0.25) AS q1,
             quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM vals GROUP BY ALL)""",
    )


def _report() -> str:
    def ratio(part: str, whole: str) -> str:
        return f"coalesce(({part})::DOUBLE / nullif({whole}, 0), 0)"

    classes = {
        "0": (ratio("tn", "tn + fn"), ratio("tn", "tn + fp"), ratio("2 * tn", "2 * tn + fn + fp"), "tn + fp"),
        "1": (ratio("tp", "tp + fp"), ratio("tp", "tp + fn"), ratio("2 * tp", "2 * tp + fp + fn"), "tp + fn"),
    }
    rows = [
        f"SELECT '{k}' AS class, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1, {s} AS support FROM cells"
        for k, (p, r, f, s) in classes.items()
    ]
    n = "(tn + fp + fn + tp)"
    rows.append(f"SELECT 'accuracy', NULL, NULL, round({ratio('tn + tp', n)}, 6), {n} FROM cells")
    macro = [f"round(({a} + {b}) / 2, 6)" for a, b in zip(classes["0"][:3], classes["1"][:3])]
    rows.append(f"SELECT 'macro avg', {', '.join(macro)}, {n} FROM cells")
    weighted = [f"round(({a} * (tn + fp) + {b} * (fn + tp)) / {n}, 6)" for a, b in zip(classes["0"][:3], classes["1"][:3])]
    rows.append(f"SELECT 'weighted avg', {', '.join(weighted)}, {n} FROM cells")
    return sql(union(rows), CELLS)


def _sweep() -> str:
    return sql(
        f"""SELECT CAST(t AS INTEGER) AS threshold, tp, fp, fn, tn, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
              round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall, round({F1}, 6) AS f1 FROM swept""",
        """swept AS (SELECT t, count(*) FILTER (bad_score = 1 AND points >= t) AS tp,
             count(*) FILTER (bad_score = 0 AND points >= t) AS fp, count(*) FILTER (bad_score = 1 AND points < t) AS fn,
             count(*) FILTER (bad_score = 0 AND points < t) AS tn
           FROM scored, (SELECT unnest(generate_series(10, 90)) AS t) GROUP BY t)""",
    )


def _describe() -> str:
    return sql(
        union(
            [
                f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
                  CAST(min({c}) AS DOUBLE) AS minimum, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
                  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75,
                  CAST(max({c}) AS DOUBLE) AS maximum FROM fview"""
                for c in DESCRIBED
            ]
        )
    )


def _tails() -> str:
    counts = union(
        [
            f"SELECT '{n}' AS bound_name, review_score, count(*) AS n FROM cleaned, bounds WHERE {c} {op} {n} GROUP BY review_score"
            for n, c, _, op in BOUNDS
        ]
    )
    return sql(
        """SELECT bound_name, review_score, n, round(n / sum(n) OVER (PARTITION BY bound_name), 6) AS ratio FROM counts""",
        f"bounds AS (SELECT {_bounds('cleaned')})",
        f"counts AS ({counts})",
    )


def _rules() -> str:
    known = ", ".join(f"'{c}'" for c in CATEGORIES)
    rules = {
        "num_items >= 1": "num_items >= 1",
        "desc_len >= 0": "desc_len >= 0",
        "weight_kg >= 0.05": "weight_kg >= 0.05",
        "delivery_days in 1 .. 50": "delivery_days BETWEEN 1 AND 50",
        "estimated_delivery_diff in -30 .. 30": "estimated_delivery_diff BETWEEN -30 AND 30",
        "freight_value >= 0.0": "freight_value >= 0",
        "category known": f"category IN ({known})",
    }
    return sql(
        union([f"SELECT '{n}' AS rule, count(*) FILTER (NOT coalesce({ok}, false)) AS n_bad FROM inputs" for n, ok in rules.items()]),
        INPUTS,
    )


def oracle_sql() -> dict[str, str]:
    """SQL per query; queries whose output is a model have none."""
    times = {n: [c for c, t in s.columns.items() if t == schemas.TIME] for n, s in schemas.TABLES.items()}
    out: dict[str, str] = {}

    out["csv_scan"] = sql(
        "SELECT review_id, CAST(order_id AS VARCHAR) AS order_id, review_score, review_comment_title, review_comment_message, "
        + ", ".join(raw_text(c) for c in times["reviews"])
        + " FROM r_reviews"
    )
    out["dataset_registry"] = sql(
        union(
            [
                f"SELECT {i} AS position, '{t}' AS table_name, '{FILES[t]}' AS file_name, count(*) AS n_rows FROM {c}"
                for i, (t, c) in enumerate(TABLE_CTE.items(), start=1)
            ]
        )
    )
    out["table_schemas"] = sql(
        union(
            [
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k.simpleString()}' AS data_type, count({c}) AS n_values FROM {TABLE_CTE[t]}"
                for t, s in schemas.TABLES.items()
                for c, k in s.columns.items()
            ]
        )
    )
    out["append_load"] = sql(
        "SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id, CAST(product_id AS VARCHAR) AS product_id, "
        f"CAST(seller_id AS VARCHAR) AS seller_id, shipping_limit_date, {MONEY.format('price')}, {MONEY.format('freight_value')} FROM r_items"
    )
    out["etl_status"] = sql(
        union(
            [
                f"SELECT {i} AS position, '{t}' AS table_name, CASE WHEN fits THEN n END AS n_rows, fits AS ok "
                f"FROM (SELECT count(*) AS n, {'count(*) = count(DISTINCT (order_id, product_id, order_item_id))' if t == 'order_items' else 'true'} AS fits FROM {c})"
                + (" WHERE (SELECT count(*) = count(DISTINCT (order_id, product_id, order_item_id)) FROM r_items)" if t == "category_names" else "")
                for i, (t, c) in enumerate(TABLE_CTE.items(), start=1)
            ]
        )
    )
    # After CSV, ids are text (also in the tie-break) and the times of each 89th order are gone, so those orders leave the view.
    text_ids = "CAST(order_id AS VARCHAR) AS order_id"
    out["etl_load"] = sql(
        f"SELECT {text_ids}, {', '.join(VIEW[1:])} FROM fview WHERE order_id % 89 <> 0"
    ).replace("order_item_id, product_id) AS most_imp", "order_item_id, CAST(product_id AS VARCHAR)) AS most_imp")
    out["view_scan"] = sql("SELECT count(*) AS n_rows FROM fview")
    out["limit_rows"] = sql("SELECT least(1000, count(*)) AS n_rows FROM fview")
    out["create_feature_view"] = out["feature_view"] = sql(f"SELECT {', '.join(VIEW)} FROM fview")
    out["save_load_artifacts"] = _transformed("WHERE split = 'test'", ", TRUE AS same_score")
    out["order_transformer"] = _transformed("", ", split")
    out["constraint_audit"] = _audit()

    out["clean_customers"] = sql("SELECT * REPLACE (lower(customer_city) AS customer_city) FROM r_customers")
    out["clean_products"] = sql("SELECT * FROM c_products")
    out["clean_category_names"] = sql("SELECT * FROM r_names")
    out["clean_orders"] = sql(
        "SELECT order_id, customer_id, order_status, " + ", ".join(parsed(c) for c in times["orders"]) + " FROM r_orders"
    )
    out["clean_order_items"] = sql(
        f"SELECT order_id, order_item_id, product_id, seller_id, {parsed('shipping_limit_date')}, "
        f"{MONEY.format('price')}, {MONEY.format('freight_value')} FROM r_items"
    )
    out["clean_reviews"] = sql(
        f"SELECT review_id, order_id, review_score, {tidy('review_comment_title')}, {tidy('review_comment_message')}, "
        + ", ".join(parsed(c) for c in times["reviews"])
        + " FROM r_reviews"
    )

    out["filter_delivered"] = sql("SELECT * FROM delivered")
    out["project_scores"] = sql(f"SELECT {LEADING}, review_score FROM fview")
    out["project_totals"] = sql(f"SELECT {LEADING}, num_items, total_price, total_freight FROM fview")
    for c in ["bad_score", *schemas.FEATURE_COLUMNS[5:]]:
        out[c] = sql(f"SELECT {LEADING}, {c} FROM fview")
    out["join_items"] = sql(
        f"SELECT order_id, customer_id, num_items, {MONEY.format('total_price')}, limit_date FROM delivered JOIN items_agg USING (order_id)"
    )
    out["join_products"] = sql(
        "SELECT order_id, product_id, product_category_name, product_weight_g "
        "FROM items_agg JOIN c_products ON most_imp_product_id = product_id"
    )
    out["join_reviews"] = sql(
        "SELECT order_id, customer_id, review_id, review_score FROM delivered JOIN r_reviews USING (order_id)"
    )
    out["join_category"] = sql(
        "SELECT product_id, product_category_name, product_category_name_english FROM c_products LEFT JOIN r_names USING (product_category_name)"
    )
    out["order_items_agg"] = sql(
        f"SELECT order_id, num_items, {MONEY.format('total_price')}, {MONEY.format('total_freight')}, limit_date FROM items_agg"
    )
    out["most_important_product"] = sql("SELECT order_id, most_imp_product_id FROM items_agg")

    out["split_shipment_rate"] = sql("SELECT num_items, round(avg(bad_score), 6) AS bad_rate FROM cleaned GROUP BY num_items")
    out["feature_view_grain"] = sql(
        "SELECT rows_per_order, count(*) AS n_orders FROM (SELECT count(*) AS rows_per_order FROM fview GROUP BY order_id) GROUP BY 1"
    )
    ratios = """ratios AS (SELECT review_score, round_even(n / sum(n) OVER (), 3) AS ratio
      FROM (SELECT review_score, count(*) AS n FROM reviewed GROUP BY review_score))"""
    out["review_score_ratios"] = sql("SELECT * FROM ratios ORDER BY review_score DESC", ratios)
    out["bad_score_share"] = sql(
        "SELECT round(coalesce(sum(ratio) FILTER (review_score <= 3), 0) * 100, 1) AS bad_percent FROM ratios", ratios
    )
    out["top_categories"] = sql(
        "SELECT category, count(*) AS n_orders FROM reviewed GROUP BY category ORDER BY n_orders DESC, category LIMIT 10"
    )
    out["null_counts"] = sql(
        union([f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM fview" for c in CLEAN])
    )
    out["duplicate_count"] = sql("SELECT count(*) - count(DISTINCT order_id) AS n_duplicates FROM fview")
    out["shape_and_types"] = sql(
        union(
            [
                f"SELECT {i} AS position, '{c}' AS column_name, '{TYPES.get(c, 'int')}' AS data_type, count(*) AS n_rows, {len(VIEW)} AS n_columns FROM fview"
                for i, c in enumerate(VIEW)
            ]
        )
    )
    out["describe_numeric"] = _describe()
    out["clip_quantiles"] = sql(
        union([f"SELECT '{n}' AS bound_name, round(quantile_cont({c}, {q}), 6) AS value FROM train" for n, c, q, _ in BOUNDS])
    )
    out["tail_score_mix"] = _tails()
    out["correlation_matrix"] = _correlations()
    out["histogram"] = _histogram()
    out["box_stats"] = _boxes()

    weights = "counts AS (SELECT count(*) FILTER (bad_score = 0) AS n_negative, count(*) FILTER (bad_score = 1) AS n_positive FROM train)"
    out["class_weight"] = sql("SELECT *, round(n_negative / nullif(n_positive, 0), 6) AS pos_weight FROM counts", weights)
    out["balanced_weights"] = sql(
        """SELECT bad_score, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
           FROM (SELECT bad_score, count(*) AS n FROM train GROUP BY bad_score)"""
    )
    out["confusion_matrix"] = sql(
        "SELECT 0 AS actual, tn AS predicted_0, fp AS predicted_1 FROM cells UNION ALL SELECT 1, fn, tp FROM cells", CELLS
    )
    out["classification_report"] = _report()
    out["f1"] = sql(f"SELECT round({F1}, 6) AS f1 FROM cells", CELLS)
    out["threshold_sweep"] = _sweep()

    out["dedup_keep_last"] = sql(
        f"""SELECT {', '.join(VIEW)} FROM fview QUALIFY row_number() OVER (PARTITION BY order_id
            ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC NULLS LAST, review_score DESC NULLS LAST) = 1"""
    )
    out["stratified_split"] = sql("SELECT order_id, bad_score, split FROM split")
    out["stratified_folds"] = sql("SELECT order_id, bad_score, CAST(label_rank % 5 AS INTEGER) AS fold FROM ranked")
    columns = ", ".join(CLEAN)
    out["head"] = sql(f"SELECT {columns} FROM cleaned ORDER BY order_id LIMIT 5")
    out["drop_nulls"] = sql(f"SELECT {', '.join(VIEW)} FROM complete")
    out["cast_day_columns"] = sql(f"SELECT {LEADING}, {', '.join(schemas.DAY_COLUMNS)} FROM complete")
    out["clamp_processing_days"] = sql(
        f"SELECT {LEADING}, CASE WHEN processing_days < 0 THEN 0 ELSE processing_days END AS processing_days FROM fview"
    )
    out["clean_data"] = out["cleaned_orders"] = sql(f"SELECT {columns} FROM cleaned")
    out["log_transform"] = sql(
        "SELECT order_id, round(log_total_price, 6) AS log_total_price, round(log_total_freight, 6) AS log_total_freight FROM logged"
    )
    out["clip_outliers"] = sql(
        "SELECT order_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in schemas.DAY_COLUMNS) + " FROM clipped",
        f"bounds AS (SELECT {_bounds('cleaned')})",
        "clipped AS (" + _clipped("cleaned", "bounds", "order_id") + ")",
    )
    out["target_encode"] = sql(
        "SELECT category, n, round(encoded, 6) AS encoded, round(prior, 6) AS prior FROM encoding", ENCODING
    )
    out["validation_sample"] = sql(
        """SELECT order_id, bad_score FROM (SELECT order_id, bad_score, count(*) OVER () AS n,
             row_number() OVER (ORDER BY md5('123|' || order_id), order_id) AS r FROM split WHERE split = 'test')
           WHERE r <= round(n * 0.2)"""
    )
    features = [c for c in schemas.FEATURE_COLUMNS if c not in ("review_score", "bad_score", "total_price", "total_freight")]
    out["feature_label_split"] = sql(
        union(
            [
                f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null, '{role}' AS role FROM train"
                for c, role in [*((f, "feature") for f in [*features, "log_total_price", "log_total_freight"]), ("bad_score", "label")]
            ]
        )
    )
    out["apply_selection"] = sql(
        "SELECT order_id, review_score, bad_score, num_items, desc_len, category, weight_g, delivery_days, estimated_delivery_diff FROM cleaned"
    )
    out["scoring_features"] = sql(
        """SELECT order_id, bad_score, num_items, desc_len, category, round(weight_kg * 1000, 6) AS weight_g, delivery_days,
             estimated_delivery_diff, round(ln(1 + freight_value), 6) AS log_total_freight FROM inputs""",
        INPUTS,
    )
    out["risk_decision"] = sql(
        """SELECT order_id, probability, points || '.0%' AS risk_percent,
             CASE WHEN points >= 45 THEN 'High Risk' ELSE 'Safe' END AS risk_level,
             CASE WHEN points >= 45 THEN 'contact the customer' ELSE 'no intervention' END AS advice FROM rule"""
    )
    out["risk_factors"] = sql(
        """SELECT order_id, concat_ws('; ', CASE WHEN num_items >= 2 THEN 'multiple items' END,
             CASE WHEN estimated_delivery_diff > 0 THEN 'delayed by ' || estimated_delivery_diff || ' day(s)' END) AS risk_factors
           FROM cleaned"""
    )
    out["input_rules"] = _rules()
    return out
