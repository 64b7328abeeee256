"""The driver queries as SQL for an engine without this library.

Written from the definitions, with other formulations than the DataFrame
code where there is a choice: ranks by window over all rows, history by self
join, retraining by recursion.
"""

from __future__ import annotations

ORDERS = """
delivered AS (
  SELECT o.o_orderkey AS order_id, min(l.l_shipdate) AS delivered_at
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_shipdate > o.o_orderdate
  GROUP BY o.o_orderkey),
ord AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
    o.o_orderpriority AS order_priority, o.o_orderdate AS purchase_ts,
    CAST(o.o_orderdate AS DATE) AS day,
    CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, d.delivered_at,
    CASE WHEN d.delivered_at IS NULL THEN NULL
         WHEN d.delivered_at > o.o_orderdate + INTERVAL 1000 DAY THEN 1 ELSE 0 END AS label
  FROM orders o LEFT JOIN delivered d ON d.order_id = o.o_orderkey)"""

FEATURES = ORDERS + """,
item AS (
  SELECT l_orderkey AS order_id, l_suppkey AS seller_id, l_partkey AS product_id,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
    CAST(round(l_quantity * 100) AS BIGINT) AS quantity,
    CAST(round(l_discount * 100) AS BIGINT) AS discount,
    CAST(round(l_tax * 100) AS BIGINT) AS tax,
    p.p_brand AS brand, p.p_size AS size,
    CAST(round(p.p_retailprice * 100) AS BIGINT) AS retail,
    s.s_nationkey AS seller_nation
  FROM lineitem LEFT JOIN part p ON p.p_partkey = l_partkey
  LEFT JOIN supplier s ON s.s_suppkey = l_suppkey),
tot AS (
  SELECT order_id, count(*) AS n_items, count(DISTINCT product_id) AS n_products,
    count(DISTINCT seller_id) AS n_sellers, count(DISTINCT brand) AS n_brands,
    CAST(sum(price) AS BIGINT) AS sum_price, max(price) AS max_price,
    CAST(sum(quantity) AS BIGINT) AS sum_qty, CAST(sum(discount) AS BIGINT) AS sum_discount,
    CAST(sum(tax) AS BIGINT) AS sum_tax, CAST(sum(retail) AS BIGINT) AS sum_retail,
    count(retail) AS n_retail, max(size) AS max_size
  FROM item GROUP BY order_id),
nat AS (
  SELECT i.order_id, sum(CASE WHEN i.seller_nation = c.c_nationkey THEN 1 ELSE 0 END)
    / CAST(count(*) AS DOUBLE) AS same_nation_share
  FROM item i JOIN ord o USING (order_id) LEFT JOIN customer c ON c.c_custkey = o.customer_id
  GROUP BY i.order_id),
pair AS (SELECT DISTINCT order_id, seller_id FROM item),
outcome AS (
  SELECT p.seller_id, o.delivered_at, count(*) AS n, sum(o.label) AS late
  FROM pair p JOIN ord o USING (order_id) WHERE o.delivered_at IS NOT NULL
  GROUP BY p.seller_id, o.delivered_at),
hist AS (
  SELECT p.order_id, CAST(sum(u.late) AS DOUBLE) / sum(u.n) AS rate
  FROM pair p JOIN ord o USING (order_id)
  JOIN outcome u ON u.seller_id = p.seller_id AND u.delivered_at < o.purchase_ts
  GROUP BY p.order_id),
feat AS (
  SELECT o.order_id, o.day AS purchase_date, o.month,
    month(o.day) AS purchase_month, quarter(o.day) AS purchase_quarter,
    isodow(o.day) - 1 AS purchase_dow, day(o.day) AS purchase_day,
    year(o.day) * 12 + month(o.day) AS month_index, o.order_priority,
    coalesce(t.n_items, 0) AS n_items, coalesce(t.n_products, 0) AS n_products,
    coalesce(t.n_sellers, 0) AS n_sellers, coalesce(t.sum_price, 0) / 100.0::DOUBLE AS sum_price,
    t.sum_price / CAST(t.n_items AS DOUBLE) / 100.0::DOUBLE AS avg_price,
    t.max_price / 100.0::DOUBLE AS max_price, coalesce(t.sum_qty, 0) / 100.0::DOUBLE AS sum_qty,
    t.sum_discount / CAST(t.n_items AS DOUBLE) / 100.0::DOUBLE AS avg_discount,
    coalesce(t.sum_tax, 0) / 100.0::DOUBLE AS sum_tax,
    t.sum_retail / CAST(t.n_retail AS DOUBLE) / 100.0::DOUBLE AS avg_retail_price, t.max_size,
    coalesce(t.n_brands, 0) AS n_brands, c.c_mktsegment AS customer_segment,
    CAST(round(c.c_acctbal * 100) AS BIGINT) / 100.0::DOUBLE AS customer_acctbal,
    n.same_nation_share, h.rate AS seller_late_rate_before, o.label AS is_late_delivery
  FROM ord o LEFT JOIN customer c ON c.c_custkey = o.customer_id
  LEFT JOIN tot t USING (order_id) LEFT JOIN nat n USING (order_id)
  LEFT JOIN hist h USING (order_id))"""

_FEATURE_COLUMNS = """order_id, strftime(purchase_date, '%Y-%m-%d') AS purchase_date,
  strftime(month, '%Y-%m-%d') AS month, CAST(purchase_month AS BIGINT) AS purchase_month,
  CAST(purchase_quarter AS BIGINT) AS purchase_quarter,
  CAST(purchase_dow AS BIGINT) AS purchase_dow, CAST(purchase_day AS BIGINT) AS purchase_day,
  CAST(month_index AS BIGINT) AS month_index, order_priority,
  CAST(n_items AS BIGINT) AS n_items, CAST(n_products AS BIGINT) AS n_products,
  CAST(n_sellers AS BIGINT) AS n_sellers, round(sum_price, 6) AS sum_price,
  round(avg_price, 6) AS avg_price, round(max_price, 6) AS max_price,
  round(sum_qty, 6) AS sum_qty, round(avg_discount, 6) AS avg_discount,
  round(sum_tax, 6) AS sum_tax, round(avg_retail_price, 6) AS avg_retail_price,
  CAST(max_size AS BIGINT) AS max_size, CAST(n_brands AS BIGINT) AS n_brands,
  customer_segment, round(customer_acctbal, 6) AS customer_acctbal,
  round(same_nation_share, 6) AS same_nation_share,
  round(seller_late_rate_before, 6) AS seller_late_rate_before"""

FACTS = ORDERS + """,
facts AS (
  SELECT order_id, month, CASE WHEN delivered_at <= day + 1000 THEN 0 ELSE 1 END AS label,
    least(coalesce(delivered_at, day + 1000), CAST(day + 1000 AS TIMESTAMP)) AS known_at FROM ord),
late_scores AS (
  SELECT o.order_id, o.month, CASE WHEN year(day) < 1997 THEN 1 ELSE 2 END AS model_version,
    24100 - (year(day) * 12 + month(day)) - 10 * coalesce(n_items, 0) AS score
  FROM ord o LEFT JOIN (SELECT l_orderkey AS order_id, count(*) AS n_items FROM lineitem GROUP BY l_orderkey) USING (order_id))"""

SCORED = FEATURES + """,
scored AS (
  SELECT order_id, purchase_date, month, order_priority, is_late_delivery AS label,
    CAST(24100 - month_index - 10 * n_items AS DOUBLE) AS score,
    CAST(24100 - month_index AS DOUBLE) AS champion_score
  FROM feat WHERE is_late_delivery IS NOT NULL)"""

EVENTS = """
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
    CASE WHEN c.c_custkey IS NULL THEN NULL
         WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS label
  FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id)"""


def unit(key: str, purpose: str, seed: int) -> str:
    digest = f"md5(CAST({key} AS VARCHAR) || '|{purpose}|{seed}')"
    return f"(CAST('0x' || substr({digest}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def evaluation(source: str, by: str = "", name: str = "m") -> str:
    """CTEs that end in `name`: metrics of rows (by, score, label) by ranks over all rows."""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f"""
{name}_r AS (
  SELECT {keys}label, score,
    rank() OVER ({part} ORDER BY score)
      + (count(*) OVER (PARTITION BY {keys}score) - 1) / 2.0::DOUBLE AS avg_rank
  FROM {source} WHERE label IS NOT NULL AND score IS NOT NULL),
{name}_auc AS (
  SELECT {keys}count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive,
    CASE WHEN sum(label) > 0 AND sum(label) < count(*) THEN
      (sum(CASE WHEN label = 1 THEN avg_rank END)
        - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
      / (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label))) END AS roc_auc
  FROM {name}_r {group}),
{name}_s AS (
  SELECT {keys}score, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n
  FROM {name}_r GROUP BY {keys}score),
{name}_c AS (
  SELECT {keys}pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen
  FROM {name}_s WINDOW w AS ({part} ORDER BY score DESC)),
{name}_ap AS (
  SELECT {keys}sum(pos * tp / seen) / nullif(sum(pos), 0) AS ap FROM {name}_c {group}),
{name} AS (
  SELECT a.*, CASE WHEN a.roc_auc IS NOT NULL THEN p.ap END AS pr_auc
  FROM {name}_auc a JOIN {name}_ap p ON {_same(by)})"""


def _same(by: str) -> str:
    columns = [c.strip() for c in by.split(",") if c.strip()]
    return " AND ".join(f"a.{c} IS NOT DISTINCT FROM p.{c}" for c in columns) or "1 = 1"


def fingerprint(source: str, entry: str, params: str, by: str = "", name: str = "f") -> str:
    """CTEs that end in `name`: hash tree over 6, 3 and 0 hex digits."""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
{name}_0 AS (
  SELECT {keys}md5({entry}) AS h, count(*) AS n FROM {source} GROUP BY {keys}md5({entry})),
{name}_6 AS (
  SELECT {keys}substr(h, 1, 6) AS node, md5(string_agg(h || ':' || n, ',' ORDER BY h)) AS hash,
    sum(n) AS n_rows, count(*) AS n_keys FROM {name}_0 GROUP BY {keys}substr(h, 1, 6)),
{name}_3 AS (
  SELECT {keys}substr(node, 1, 3) AS top, md5(string_agg(hash, ',' ORDER BY node)) AS hash,
    sum(n_rows) AS n_rows, sum(n_keys) AS n_keys FROM {name}_6
  GROUP BY {keys}substr(node, 1, 3)),
{name} AS (
  SELECT {keys}CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(n_keys) AS BIGINT) AS n_keys,
    md5(md5(string_agg(hash, ',' ORDER BY top)) || '|{params}') AS fingerprint
  FROM {name}_3 {group})"""


def scored_days(condition: str) -> str:
    """Expected rows per day after scoring each order of some days once with version 1."""
    return f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(1 AS BIGINT) AS model_version,
  count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_orders, count(*) AS n_valid
FROM orders WHERE {condition} GROUP BY strftime(o_orderdate, '%Y-%m-%d')"""


METRICS = "n_rows, n_positive, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc"

NUMERIC = (
    "purchase_month", "purchase_quarter", "purchase_dow", "purchase_day", "month_index",
    "n_items", "n_products", "n_sellers", "sum_price", "avg_price", "max_price", "sum_qty",
    "avg_discount", "sum_tax", "avg_retail_price", "max_size", "n_brands", "customer_acctbal",
    "same_nation_share", "seller_late_rate_before",
)
CATEGORICAL = ("order_priority", "customer_segment")

LONG = FEATURES + """,
long AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, "
    "purchase_date >= DATE '1998-01-01' AS is_cur FROM feat"
    for c in NUMERIC
) + ")"

DECILES = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"

PSI = LONG + f""",
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_disc(v, {DECILES}))) AS e
  FROM long WHERE NOT is_cur GROUP BY feature),
binned AS (
  SELECT feature, is_cur, CASE WHEN v IS NULL THEN -1
    ELSE len(list_filter(e, lambda x: x <= v)) END AS bin
  FROM long JOIN edges USING (feature)),
totals AS (
  SELECT feature, count(*) FILTER (NOT is_cur) AS n_base, count(*) FILTER (is_cur) AS n_cur
  FROM binned GROUP BY feature),
shares AS (
  SELECT b.feature, t.n_base, t.n_cur,
    greatest(count(*) FILTER (NOT is_cur) / CAST(t.n_base AS DOUBLE), 0.0001::DOUBLE) AS e,
    greatest(count(*) FILTER (is_cur) / CAST(t.n_cur AS DOUBLE), 0.0001::DOUBLE) AS c
  FROM binned b JOIN totals t USING (feature) GROUP BY b.feature, b.bin, t.n_base, t.n_cur),
psi AS (
  SELECT feature, n_base, n_cur, sum((c - e) * ln(c / e)) AS psi
  FROM shares GROUP BY feature, n_base, n_cur)"""

RAW = """
raw AS (
  SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS BIGINT) AS line,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE round(l_quantity, 6) END AS quantity,
    CASE WHEN l_linestatus = 'F' THEN strftime(l_shipdate, '%Y-%m-%d') END AS shipped_on,
    CASE WHEN l_returnflag = 'R' THEN true WHEN l_returnflag = 'A' THEN NULL ELSE false END
      AS returned,
    l_linestatus AS status, l_returnflag, l_linestatus
  FROM lineitem)"""

CAST_FAILURES = """
fails AS (
  SELECT 'order_id' AS column_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_failed FROM lineitem
  UNION ALL SELECT 'line', count(*), 0 FROM lineitem
  UNION ALL SELECT 'quantity', count(*), count(*) FILTER (l_returnflag = 'R') FROM lineitem
  UNION ALL SELECT 'shipped_on', count(*), count(*) FILTER (l_linestatus <> 'F') FROM lineitem
  UNION ALL SELECT 'returned', count(*), 0 FROM lineitem
  UNION ALL SELECT 'status', count(*), 0 FROM lineitem)"""

CHECKS = ORDERS + """,
q AS (
  SELECT 'not_null' AS "check", 'orders.order_id' AS subject, 'ERROR' AS severity,
    count(*) FILTER (order_id IS NULL) AS n FROM ord
  UNION ALL SELECT 'not_null', 'orders.delivered_at', 'WARN',
    count(*) FILTER (delivered_at IS NULL) FROM ord
  UNION ALL SELECT 'not_null', 'customers.customer_segment', 'ERROR',
    count(*) FILTER (c_mktsegment IS NULL) FROM customer
  UNION ALL SELECT 'accepted_values', 'orders.order_priority', 'WARN',
    count(*) FILTER (order_priority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) FROM ord
  UNION ALL SELECT 'unique', 'orders.order_id', 'ERROR', count(*) FROM
    (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'unique', 'items.order_id+product_id', 'WARN', count(*) FROM
    (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL SELECT 'relationships', 'items.order_id', 'ERROR', count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'relationships', 'orders.order_id', 'WARN', count(*) FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'relationships', 'orders.customer_id', 'ERROR', count(*) FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)),
checks AS (
  SELECT "check", subject, 'quality' AS stage, severity, n = 0 AS passed,
    CAST(n AS DOUBLE) AS observed, 0.0::DOUBLE AS threshold FROM q)"""

ALL_CHECKS = CHECKS + "," + CAST_FAILURES + """,
all_checks AS (
  SELECT * FROM checks
  UNION ALL SELECT 'cast', 'items.' || column_name, 'transform', 'ERROR', n_failed = 0,
    CAST(n_failed AS DOUBLE), 0.0::DOUBLE FROM fails)"""

CHECK_COLUMNS = (
    '"check", subject, stage, severity, passed, round(observed, 6) AS observed, '
    "round(threshold, 6) AS threshold"
)

FRESH = " UNION ALL ".join(
    f"SELECT '{name}' AS subject, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max({ts}))) "
    f"/ 3600000000.0::DOUBLE AS age FROM {name}"
    for name, ts in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
)

SAMPLE = f"""
s_orders AS (
  SELECT o_orderkey AS k, o_custkey FROM orders WHERE {unit("o_orderkey", "sample", 42)} < 0.05),
s_items AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT k FROM s_orders)),
s_customers AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM s_orders)),
s_products AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM s_items)),
s_sellers AS (SELECT * FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM s_items)),
s_nations AS (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM s_customers)
  OR n_nationkey IN (SELECT s_nationkey FROM s_sellers))"""

SAMPLE_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, "
    f"CAST(coalesce(sum({key}), 0) AS BIGINT) AS key_sum FROM s_{name}"
    for name, key in (
        ("orders", "k"), ("items", "l_orderkey"), ("customers", "c_custkey"),
        ("products", "p_partkey"), ("sellers", "s_suppkey"), ("nations", "n_nationkey"),
    )
)


def curve(by: str, points: int) -> str:
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f"""
pts AS (
  SELECT {keys}value AS threshold, sum(sum(label)) OVER w AS tp, sum(count(*)) OVER w AS seen
  FROM ev WHERE label IS NOT NULL GROUP BY {keys}value
  WINDOW w AS ({part} ORDER BY value DESC)),
full_pts AS (
  SELECT *, max(tp) OVER ({part}) AS p, max(seen) OVER ({part}) AS total FROM pts),
slots AS (
  SELECT *, ceil(seen * {points}.0::DOUBLE / total) AS slot FROM full_pts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {keys}slot ORDER BY seen DESC) AS rn FROM slots)
SELECT {keys}round(threshold, 6) AS threshold,
  round(CAST(seen - tp AS DOUBLE) / (total - p), 6) AS fpr,
  round(CAST(tp AS DOUBLE) / p, 6) AS tpr
FROM ranked WHERE rn = 1"""


LEAK_COLUMNS = (*NUMERIC, "delivery_days")

CANDIDATES = ORDERS + """,
cand AS (
  SELECT 'late_delivery' AS name, month,
    md5(strftime(month, '%Y-%m-%d') || '|' || count(*)) AS fingerprint
  FROM ord GROUP BY month)"""

ALIASES = EVENTS + """,
hist_all AS (
  SELECT event_type AS name, week(ts) AS wk,
    date_trunc('day', min(ts)) + INTERVAL 12 HOUR AS valid_from FROM ev GROUP BY 1, 2),
hist AS (
  SELECT name, 'champion' AS alias, CASE WHEN wk = 4 THEN 2 ELSE wk END AS version, valid_from
  FROM hist_all)"""

LATE = FEATURES + """,
pred AS (
  SELECT order_id, purchase_date AS day,
    CASE WHEN year(purchase_date) < 1997 THEN 1 ELSE 2 END AS model_version,
    CAST(24100 - month_index - 10 * n_items AS DOUBLE) AS score FROM feat),
matured AS (
  SELECT p.*, date_trunc('month', p.day) AS month, CASE
      WHEN o.delivered_at < DATE '1999-07-01'
        AND o.delivered_at <= CAST(o.day AS TIMESTAMP) + INTERVAL 1000 DAY THEN 0
      WHEN CAST(o.day AS TIMESTAMP) + INTERVAL 1000 DAY < DATE '1999-07-01' THEN 1 END AS label
  FROM pred p JOIN ord o USING (order_id)
  WHERE p.day + 1000 <= DATE '1999-06-30')"""

def oracles() -> dict[str, str]:
    """Comparison SQL by query name."""
    unit_split = unit("order_id", "split", 42)
    sql = {
        "mart_order_features": f"""WITH {FEATURES}
SELECT {_FEATURE_COLUMNS}, CAST(is_late_delivery AS BIGINT) AS is_late_delivery
FROM feat WHERE is_late_delivery IS NOT NULL""",
        "inference_mart": f"WITH {FEATURES} SELECT {_FEATURE_COLUMNS} FROM feat",
        "mart_refresh": f"""WITH {FEATURES}
SELECT {_FEATURE_COLUMNS}, CAST(is_late_delivery AS BIGINT) AS is_late_delivery FROM feat""",
        "mart_refresh_reasons": f"""WITH {ORDERS},
pair AS (SELECT DISTINCT l_orderkey AS order_id, l_suppkey AS seller_id FROM lineitem),
fresh AS (SELECT * FROM ord WHERE day = (SELECT max(day) FROM ord)),
told AS (SELECT * FROM ord WHERE CAST(delivered_at AS DATE) = (
  SELECT max(CAST(delivered_at AS DATE)) FROM ord
  WHERE CAST(delivered_at AS DATE) <= (SELECT max(day) FROM ord) - 60)),
news AS (SELECT * FROM fresh UNION SELECT * FROM told),
outcome AS (SELECT seller_id, delivered_at FROM news JOIN pair USING (order_id) WHERE delivered_at IS NOT NULL),
why AS (
  SELECT order_id, 'order' AS reason FROM news
  UNION SELECT order_id, 'item' FROM fresh JOIN pair USING (order_id)
  UNION SELECT o.order_id, 'history' FROM ord o JOIN pair p USING (order_id)
    JOIN outcome u ON u.seller_id = p.seller_id AND u.delivered_at < o.purchase_ts)
SELECT strftime(month, '%Y-%m-%d') AS month, reason, count(*) AS n_orders
FROM why JOIN ord USING (order_id) GROUP BY month, reason""",
        "late_rate_by_month": f"""WITH {ORDERS}
SELECT strftime(month, '%Y-%m-%d') AS month, count(*) AS n_rows,
  CAST(sum(label) AS BIGINT) AS n_positive, round(avg(label), 6) AS positive_rate
FROM ord WHERE label IS NOT NULL GROUP BY month""",
        "late_rate_by_day": f"""WITH {ORDERS}
SELECT order_priority, strftime(day, '%Y-%m-%d') AS day, count(*) AS n_rows,
  CAST(sum(label) AS BIGINT) AS n_positive, round(avg(label), 6) AS positive_rate
FROM ord WHERE label IS NOT NULL GROUP BY order_priority, day""",
        "visible_as_of": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS purchase_ts
FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1999-06-30'""",
        "lookup_join": """SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey, n_name, r_name
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey""",
        "staged_cast": f"""WITH {RAW}
SELECT order_id, line, quantity, shipped_on, returned, status FROM raw""",
        "cast_failures": f"WITH {CAST_FAILURES} SELECT * FROM fails",
        "hash_split": f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN {unit("o_orderkey", "split", 42)} < 0.2 THEN 'holdout' ELSE 'train' END AS split
FROM orders""",
        "time_split": f"""WITH {ORDERS}
SELECT CASE WHEN day < DATE '1998-01-01' THEN 'train' ELSE 'holdout' END AS split,
  strftime(month, '%Y-%m-%d') AS month, count(*) AS n_rows,
  CAST(sum(label) AS BIGINT) AS n_positive, round(avg(label), 6) AS positive_rate
FROM ord WHERE label IS NOT NULL GROUP BY 1, 2""",
        "training_window": """SELECT o_orderkey AS order_id,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS purchase_ts,
  '1997-01-01' AS window_start, '1998-01-01' AS window_end
FROM orders WHERE year(o_orderdate) = 1997""",
        "training_dataset": f"""WITH {ORDERS}
SELECT order_id, strftime(day, '%Y-%m-%d') AS purchase_date,
  CAST(label AS BIGINT) AS is_late_delivery,
  CASE WHEN {unit_split} < 0.2 THEN 'holdout' ELSE 'train' END AS split
FROM ord WHERE label IS NOT NULL AND year(day) IN (1996, 1997)""",
        "sample_connected_counts": f"WITH {SAMPLE} {SAMPLE_COUNTS}",
        "sample_orphans": """SELECT unnest(['orders.order_id->items', 'orders.customer_id->customers',
  'items.product_id->products', 'items.seller_id->sellers', 'customers.customer_nation->nations',
  'sellers.seller_nation->nations']) AS relation, CAST(0 AS BIGINT) AS n_orphans""",
        "cap_rows": f"""SELECT c_custkey AS customer_id, CAST(c_nationkey AS BIGINT) AS customer_nation
FROM customer ORDER BY {unit("c_custkey", "cap", 42)}, c_custkey LIMIT 100""",
        "cap_rows_large": f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id
FROM orders ORDER BY {unit("o_orderkey", "cap", 42)}, o_orderkey LIMIT 12000""",
        "dq_checks": f"WITH {CHECKS} SELECT {CHECK_COLUMNS} FROM checks",
        "dq_stages": f"""WITH {ALL_CHECKS}
SELECT stage, severity, count(*) AS n_checks, count(*) FILTER (NOT passed) AS n_failed,
  round(sum(observed), 6) AS observed FROM all_checks GROUP BY stage, severity""",
        "dq_blocking": f"""WITH {ALL_CHECKS}
SELECT {CHECK_COLUMNS} FROM all_checks WHERE NOT passed AND severity = 'ERROR'""",
        "freshness": f"""WITH a AS ({FRESH}),
f AS (SELECT 'freshness' AS "check", subject, 'quality' AS stage,
  CASE WHEN age IS NULL OR age > 72 THEN 'ERROR' WHEN age > 24 THEN 'WARN' ELSE 'OK' END
    AS severity, age FROM a)
SELECT "check", subject, stage, severity, severity = 'OK' AS passed, round(age, 6) AS observed,
  CASE WHEN severity = 'ERROR' THEN 72.0::DOUBLE ELSE 24.0::DOUBLE END AS threshold FROM f""",
        "duplicate_audit": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
        "dataset_fingerprint": f"""WITH {ORDERS},
ds AS (SELECT order_id, CASE WHEN {unit_split} < 0.2 THEN 'holdout' ELSE 'train' END AS split
  FROM ord WHERE label IS NOT NULL AND year(day) IN (1996, 1997)),
{fingerprint("ds", "CAST(order_id AS VARCHAR)",
             '{"levels": [6, 3], "model": "gbt", "seed": 42}', "split")}
SELECT split, n_rows, n_keys, fingerprint FROM f""",
        "fingerprint_repeated_keys": f"""WITH {fingerprint(
            "lineitem", "CAST(l_orderkey AS VARCHAR)", '{"levels": [6, 3], "table": "items"}')}
SELECT n_rows, n_keys, fingerprint FROM f""",
        "changed_partitions": """WITH o AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
n AS (SELECT month, string_agg(o_orderkey || '@' || day, ',' ORDER BY o_orderkey) AS c
  FROM o WHERE day >= DATE '1995-02-01' GROUP BY month),
p AS (SELECT month, string_agg(o_orderkey || '@' || day, ',' ORDER BY o_orderkey) AS c
  FROM o WHERE day <= DATE '2000-06-15' GROUP BY month)
SELECT strftime(coalesce(n.month, p.month), '%Y-%m-%d') AS month,
  CASE WHEN p.c IS NULL THEN 'added' WHEN n.c IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM n FULL JOIN p ON n.month = p.month WHERE n.c IS DISTINCT FROM p.c""",
        "roc_auc_by_type": f"""WITH {EVENTS}, e AS (SELECT *, value AS score FROM ev),
{evaluation("e", "event_type")}
SELECT event_type, n_rows, n_positive, round(roc_auc, 6) AS roc_auc FROM m""",
        "pr_auc_by_type": f"""WITH {EVENTS}, e AS (SELECT *, value AS score FROM ev),
{evaluation("e", "event_type")}
SELECT event_type, n_rows, n_positive, round(pr_auc, 6) AS pr_auc FROM m""",
        "evaluate": f"WITH {SCORED}, {evaluation('scored')} SELECT {METRICS} FROM m",
        "evaluate_by_year": f"""WITH {SCORED}, y AS (SELECT *, year(month) AS year FROM scored),
{evaluation("y", "year")} SELECT CAST(year AS BIGINT) AS year, {METRICS} FROM m""",
        "evaluate_documents": f"""WITH d AS (
  SELECT lang, CAST(n_chars AS DOUBLE) AS score, quality AS label
  FROM documents JOIN labels USING (doc_id)),
{evaluation("d", "lang")} SELECT lang, {METRICS} FROM m""",
        "roc_curve": f"WITH {EVENTS}, {curve('', 50)}",
        "roc_curve_by_type": f"WITH {EVENTS}, {curve('event_type', 20)}",
        "leakage_scan": f"""WITH {FEATURES}, wide AS (
  SELECT f.*, date_diff('day', f.purchase_date, CAST(o.delivered_at AS DATE)) AS delivery_days
  FROM feat f JOIN ord o USING (order_id) WHERE f.is_late_delivery IS NOT NULL),
long AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS score, is_late_delivery AS label FROM wide"
    for c in LEAK_COLUMNS)}),
{evaluation("long", "feature")}
SELECT feature, n_rows, round(roc_auc, 6) AS roc_auc,
  round(greatest(roc_auc, 1 - roc_auc), 6) AS separation,
  coalesce(greatest(roc_auc, 1 - roc_auc) >= 0.95, false) AS suspect FROM m""",
        "psi": f"WITH {PSI} SELECT feature, n_base, n_cur, round(psi, 6) AS psi FROM psi",
        "bin_edges": f"""WITH {LONG}, e AS (
  SELECT feature, list_sort(list_distinct(quantile_disc(v, {DECILES}))) AS e FROM long GROUP BY feature)
SELECT feature, unnest(range(len(e))) AS position, round(unnest(e), 6) AS edge FROM e""",
        "ks": f"""WITH {LONG.replace("long AS", "every AS")}, long AS (SELECT * FROM every WHERE v IS NOT NULL),
cdf AS (
  SELECT feature, v, sum(count(*) FILTER (NOT is_cur)) OVER w AS b,
    sum(count(*) FILTER (is_cur)) OVER w AS c
  FROM long GROUP BY feature, v WINDOW w AS (PARTITION BY feature ORDER BY v)),
sizes AS (SELECT feature, count(*) FILTER (NOT is_cur) AS n_base,
  count(*) FILTER (is_cur) AS n_cur FROM long GROUP BY feature)
SELECT feature, n_base, n_cur,
  round(max(abs(CAST(b AS DOUBLE) / n_base - CAST(c AS DOUBLE) / n_cur)), 6) AS ks
FROM cdf JOIN sizes USING (feature) GROUP BY feature, n_base, n_cur""",
        "feature_skew": f"""WITH {FEATURES}, c AS (
  SELECT count(*) AS n, count(*) FILTER (floor(avg_price) <> avg_price) AS price,
    count(*) FILTER (seller_late_rate_before IS NULL) AS rate FROM feat),
k AS (
  SELECT unnest({list(NUMERIC + CATEGORICAL)}) AS feature, n AS n_rows, price, rate FROM c),
m AS (
  SELECT feature, n_rows, CASE feature WHEN 'avg_price' THEN price
    WHEN 'seller_late_rate_before' THEN rate ELSE 0 END AS n_mismatch FROM k)
SELECT feature, n_rows, n_mismatch, round(CAST(n_mismatch AS DOUBLE) / n_rows, 6) AS mismatch_rate FROM m""",
        "drift_checks": f"""WITH {PSI}, stat AS (
  SELECT 'psi' AS "check", feature AS subject, psi AS observed, 0.1::DOUBLE AS warn,
    0.25::DOUBLE AS error FROM psi
  UNION ALL SELECT 'positive_rate', 'is_late_delivery',
    abs(avg(label) FILTER (day >= DATE '1998-01-01') - avg(label) FILTER (day < DATE '1998-01-01')),
    0.02::DOUBLE, 0.05::DOUBLE FROM ord),
lev AS (SELECT *, CASE WHEN observed > error THEN 'ERROR' WHEN observed > warn THEN 'WARN'
  ELSE 'OK' END AS severity FROM stat)
SELECT "check", subject, 'monitoring' AS stage, severity, severity = 'OK' AS passed,
  round(observed, 6) AS observed,
  CASE WHEN severity = 'ERROR' THEN error ELSE warn END AS threshold FROM lev""",
        "drift_checks_gaps": f"""WITH {PSI}, stat AS (
  SELECT 'psi' AS "check", feature AS subject, psi AS observed, 0.1::DOUBLE AS warn,
    0.25::DOUBLE AS error FROM psi
  UNION ALL SELECT 'positive_rate', 'is_late_delivery',
    abs(avg(label) FILTER (day >= DATE '1998-01-01') - avg(label) FILTER (day < DATE '1998-01-01')),
    NULL, NULL FROM ord),
lev AS (SELECT *, CASE WHEN error IS NULL OR observed > error THEN 'ERROR' WHEN observed > warn THEN 'WARN'
  ELSE 'OK' END AS severity FROM stat)
SELECT "check", subject, 'monitoring' AS stage, severity, severity = 'OK' AS passed,
  round(observed, 6) AS observed,
  CASE WHEN severity = 'ERROR' THEN error ELSE warn END AS threshold FROM lev""",
        "prediction_monitoring": f"""WITH {FEATURES}, pred AS (
  SELECT purchase_date >= DATE '1998-01-01' AS is_cur,
    CAST(24100 - month_index - 10 * n_items AS DOUBLE) AS score FROM feat),
binned AS (SELECT is_cur, least(greatest(floor(score / 20), 0), 6) AS bin FROM pred),
sizes AS (SELECT count(*) FILTER (NOT is_cur) AS nb, count(*) FILTER (is_cur) AS nc FROM pred),
shares AS (
  SELECT greatest(count(*) FILTER (NOT is_cur) / CAST(max(nb) AS DOUBLE), 0.0001::DOUBLE) AS e,
    greatest(count(*) FILTER (is_cur) / CAST(max(nc) AS DOUBLE), 0.0001::DOUBLE) AS c
  FROM binned, sizes GROUP BY bin),
stat AS (
  SELECT 'psi' AS "check", 'score' AS subject, sum((c - e) * ln(c / e)) AS observed,
    0.1::DOUBLE AS warn, 0.25::DOUBLE AS error FROM shares
  UNION ALL SELECT 'positive_rate', 'predictions',
    abs(avg(CASE WHEN score >= 100 THEN 1 ELSE 0 END) FILTER (is_cur)
      - avg(CASE WHEN score >= 100 THEN 1 ELSE 0 END) FILTER (NOT is_cur)),
    0.02::DOUBLE, 0.05::DOUBLE FROM pred),
lev AS (SELECT *, CASE WHEN observed > error THEN 'ERROR' WHEN observed > warn THEN 'WARN'
  ELSE 'OK' END AS severity FROM stat)
SELECT "check", subject, 'monitoring' AS stage, severity, severity = 'OK' AS passed,
  round(observed, 6) AS observed,
  CASE WHEN severity = 'ERROR' THEN error ELSE warn END AS threshold FROM lev""",
        "threshold_calibration": f"""WITH {SCORED}, seeded AS ({" UNION ALL ".join(
            f"SELECT {s} AS seed, score, label FROM scored WHERE {unit('order_id', 'split', s)} < 0.2"
            for s in (1, 2, 3, 4, 5))}),
{evaluation("seeded", "seed")}
SELECT count(*) AS n_seeds, round(min(roc_auc), 6) AS min_roc_auc,
  round(min(roc_auc) - 0.02::DOUBLE, 6) AS threshold FROM m""",
        "quality_gate": f"""WITH {SCORED}, {evaluation('scored')}
SELECT 'quality_gate' AS "check", 'roc_auc' AS subject, 'gate' AS stage, 'ERROR' AS severity,
  roc_auc >= 0.60 AS passed, round(roc_auc, 6) AS observed, 0.6::DOUBLE AS threshold FROM m
UNION ALL SELECT 'pr_auc_floor', 'pr_auc', 'gate', 'WARN', pr_auc >= 0.50, round(pr_auc, 6),
  0.5::DOUBLE FROM m""",
        "champion_gate": f"""WITH {SCORED}, hold AS (
  SELECT * FROM scored WHERE {unit_split} < 0.2),
champ AS (SELECT champion_score AS score, label FROM hold),
{evaluation("hold", name="a1")}, {evaluation("champ", name="a2")}
SELECT 'absolute_threshold' AS "check", 'roc_auc' AS subject, 'gate' AS stage,
  'ERROR' AS severity, roc_auc >= 0.6 AS passed, round(roc_auc, 6) AS observed,
  0.6::DOUBLE AS threshold FROM a1
UNION ALL SELECT 'no_regression', 'roc_auc', 'gate', 'ERROR',
  a1.roc_auc >= a2.roc_auc - 0.01::DOUBLE, round(a1.roc_auc, 6),
  round(a2.roc_auc - 0.01::DOUBLE, 6) FROM a1, a2
UNION ALL SELECT 'common_rows', 'holdout', 'gate', 'WARN', true, 0.0::DOUBLE, 0.0::DOUBLE FROM a1""",
        "champion_gate_gaps": f"""WITH {SCORED}, every AS (
  SELECT * FROM scored WHERE {unit_split} < 0.2),
hold AS (SELECT * FROM every WHERE champion_score - score <= 40),
gone AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM every WHERE champion_score - score > 40),
champ AS (SELECT champion_score AS score, label FROM hold),
{evaluation("hold", name="a1")}, {evaluation("champ", name="a2")}
SELECT 'absolute_threshold' AS "check", 'roc_auc' AS subject, 'gate' AS stage,
  'ERROR' AS severity, roc_auc >= 0.6 AS passed, round(roc_auc, 6) AS observed,
  0.6::DOUBLE AS threshold FROM a1
UNION ALL SELECT 'no_regression', 'roc_auc', 'gate', 'ERROR',
  a1.roc_auc >= a2.roc_auc - 0.01::DOUBLE, round(a1.roc_auc, 6),
  round(a2.roc_auc - 0.01::DOUBLE, 6) FROM a1, a2
UNION ALL SELECT 'common_rows', 'holdout', 'gate', 'WARN', n = 0, n, 0.0::DOUBLE FROM gone""",
        "register_version": f"""WITH {CANDIDATES}
SELECT name, fingerprint, row_number() OVER (ORDER BY month) AS version,
  month < DATE '1998-01-01' AS reused_existing FROM cand""",
        "alias_as_of": f"""WITH {ALIASES}
SELECT e.event_id, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS ts, e.event_type AS name,
  'champion' AS alias, (SELECT CAST(arg_max(h.version, h.valid_from) AS BIGINT) FROM hist h
    WHERE h.name = e.event_type AND h.valid_from <= e.ts) AS version
FROM ev e""",
        "current_alias": f"""WITH {ALIASES}
SELECT name, alias, CAST(version AS BIGINT) AS version,
  strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from
FROM hist QUALIFY row_number() OVER (PARTITION BY name, alias ORDER BY valid_from DESC) = 1""",
        "rollback_history": """WITH y AS (
  SELECT year(o_orderdate) AS y, row_number() OVER (ORDER BY year(o_orderdate)) AS version
  FROM orders GROUP BY year(o_orderdate)),
top AS (SELECT max(y) AS y, max(version) AS n FROM y)
SELECT 'late_delivery' AS name, 'champion' AS alias, version, y || '-12-31 00:00:00' AS valid_from, 'set' AS kind FROM y
UNION ALL SELECT 'late_delivery', 'champion', n - 1, (y + 1) || '-01-01 00:00:00', 'rollback' FROM top
UNION ALL SELECT 'late_delivery', 'champion', n - 2, (y + 1) || '-01-02 00:00:00', 'rollback' FROM top""",
        "latest_by": f"""WITH {EVENTS}
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type,
  round(value, 6) AS value, CAST(label AS BIGINT) AS label
FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "late_label_join": f"""WITH {LATE}
SELECT order_id, strftime(day, '%Y-%m-%d') AS day, strftime(month, '%Y-%m-%d') AS month,
  CAST(model_version AS BIGINT) AS model_version, CAST(score AS BIGINT) AS score,
  CAST(label AS BIGINT) AS is_late_delivery FROM matured""",
        "model_performance": f"""WITH {LATE},
{evaluation("matured", "month, model_version")}
SELECT strftime(month, '%Y-%m-%d') AS month, CAST(model_version AS BIGINT) AS model_version,
  {METRICS} FROM m""",
        "retrain_triggers": f"""WITH RECURSIVE {EVENTS}, e AS (
  SELECT CAST(ts AS DATE) AS day, event_type, value AS score, label FROM ev),
{evaluation("e", "day, event_type")},
d AS (
  SELECT event_type, day, coalesce(roc_auc < 0.45, false) AS failed,
    date_diff('day', min(day) OVER (PARTITION BY event_type), day) % 10 = 0 AS scheduled,
    row_number() OVER (PARTITION BY event_type ORDER BY day) AS i
  FROM m),
walk AS (
  SELECT event_type, i, day, failed, (failed OR scheduled) AS fired,
    CASE WHEN failed OR scheduled THEN day END AS last
  FROM d WHERE i = 1
  UNION ALL
  SELECT d.event_type, d.i, d.day, d.failed,
    (d.failed OR d.scheduled) AND (w.last IS NULL OR d.day - w.last >= 4),
    CASE WHEN (d.failed OR d.scheduled) AND (w.last IS NULL OR d.day - w.last >= 4)
      THEN d.day ELSE w.last END
  FROM walk w JOIN d ON d.event_type = w.event_type AND d.i = w.i + 1)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
  CASE WHEN failed THEN 'degradation' ELSE 'schedule' END AS reason FROM walk WHERE fired""",
        "layer_tables": f"""WITH {ORDERS}
SELECT strftime(month, '%Y-%m-%d') AS month, count(*) AS n_rows,
  CAST(sum(label) AS BIGINT) AS n_positive FROM ord WHERE label IS NOT NULL GROUP BY month""",
        "replace_partitions": f"""WITH {SCORED}
SELECT strftime(month, '%Y-%m-%d') AS day, count(*) AS n_rows,
  CAST(sum(score + CASE WHEN year(month) = 1996 THEN 1000 ELSE 0 END) AS BIGINT) AS score_sum
FROM scored WHERE month <> DATE '1996-03-01' GROUP BY month""",
        "score_days": scored_days(
            "o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-04-01'"
        ),
        "backfill": scored_days("year(o_orderdate) = 1998"),
        "score_changed": scored_days("o_orderdate >= DATE '2001-06-01'"),
        "score_stream": scored_days("true"),
        "register_and_promote": f"""WITH {ORDERS},
ds AS (SELECT order_id FROM ord
  WHERE label IS NOT NULL AND day >= DATE '1995-01-01' AND day < DATE '1998-01-01'),
{fingerprint("ds", "CAST(order_id AS VARCHAR)",
             '{"levels": [6, 3], "model": "gbt", "seed": 42, '
             '"window_end": "1998-01-01", "window_start": "1995-01-01"}')},
a AS (SELECT unnest(['champion', 'challenger']) AS alias)
SELECT 'late_delivery' AS name, CAST(1 AS BIGINT) AS version, alias,
  '2002-01-01 00:00:00' AS valid_from, 'set' AS kind, fingerprint, '1995-01-01' AS window_start,
  '1998-01-01' AS window_end, md5('{{"model": "gbt", "seed": 42, "window_end": "1998-01-01", '
    || '"window_start": "1995-01-01"}}') AS config, true AS has_code FROM a, f""",
        "feature_origins": f"""WITH {FEATURES},
made(feature, origins) AS (VALUES
  ('purchase_month', 'orders.o_orderdate'), ('purchase_quarter', 'orders.o_orderdate'), ('purchase_dow', 'orders.o_orderdate'),
  ('purchase_day', 'orders.o_orderdate'), ('month_index', 'orders.o_orderdate'), ('order_priority', 'orders.o_orderpriority'),
  ('n_items', ''), ('n_products', ''), ('n_sellers', ''), ('sum_price', 'lineitem.l_extendedprice'),
  ('avg_price', 'lineitem.l_extendedprice'), ('max_price', 'lineitem.l_extendedprice'), ('sum_qty', 'lineitem.l_quantity'),
  ('avg_discount', 'lineitem.l_discount'), ('sum_tax', 'lineitem.l_tax'), ('avg_retail_price', 'part.p_retailprice'),
  ('max_size', 'part.p_size'), ('n_brands', 'part.p_brand'), ('customer_segment', 'customer.c_mktsegment'),
  ('customer_acctbal', 'customer.c_acctbal'), ('same_nation_share', 'customer.c_nationkey, supplier.s_nationkey'),
  ('seller_late_rate_before', 'lineitem.l_shipdate, lineitem.l_suppkey, orders.o_orderdate')),
known AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) AS n_rows, count({c}) AS n_known FROM feat" for c in NUMERIC + CATEGORICAL)})
SELECT feature, origins, CASE WHEN feature = 'seller_late_rate_before' THEN 'declared' ELSE 'ok' END AS verdict, n_rows, n_known
FROM made JOIN known USING (feature)""",
        "drift_by_day": f"""WITH {FEATURES},
long AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, purchase_date AS day FROM feat" for c in NUMERIC)}),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_disc(v, {DECILES}))) AS e
  FROM long WHERE day < DATE '1998-01-01' GROUP BY feature),
binned AS (
  SELECT feature, day, CASE WHEN v IS NULL THEN 'none' ELSE '' || len(list_filter(e, lambda x: x <= v)) END AS bin
  FROM long JOIN edges USING (feature)
  {" ".join(f"UNION ALL SELECT '{c}', purchase_date, coalesce('=' || {c}, 'none') FROM feat" for c in CATEGORICAL)}),
base AS (
  SELECT feature, bin, greatest(count(*) / CAST(sum(count(*)) OVER (PARTITION BY feature) AS DOUBLE), 0.0001::DOUBLE) AS e
  FROM binned WHERE day < DATE '1998-01-01' GROUP BY feature, bin),
cur AS (
  SELECT feature, day, bin, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature, day) AS total
  FROM binned WHERE day >= DATE '1998-01-01' GROUP BY feature, day, bin),
grid AS (
  SELECT feature, day, bin FROM base JOIN (SELECT DISTINCT feature, day FROM cur) USING (feature)
  UNION SELECT feature, day, bin FROM cur),
totals AS (SELECT feature, day, max(total) AS total FROM cur GROUP BY feature, day),
shares AS (
  SELECT g.feature, g.day, t.total, coalesce(b.e, 0.0001::DOUBLE) AS e,
    greatest(coalesce(c.n, 0) / CAST(t.total AS DOUBLE), 0.0001::DOUBLE) AS c
  FROM grid g JOIN totals t USING (feature, day) LEFT JOIN base b ON b.feature = g.feature AND b.bin = g.bin
  LEFT JOIN cur c ON c.feature = g.feature AND c.day = g.day AND c.bin = g.bin),
psi AS (SELECT feature, day, total, sum((c - e) * ln(c / e)) AS psi FROM shares GROUP BY feature, day, total)
SELECT strftime(day, '%Y-%m-%d') AS purchase_date, strftime(date_trunc('month', day), '%Y-%m-%d') AS month,
  CAST(total AS BIGINT) AS n_cur, 'psi' AS "check", feature AS subject, 'monitoring' AS stage,
  CASE WHEN psi > 0.25 THEN 'ERROR' WHEN psi > 0.1 THEN 'WARN' ELSE 'OK' END AS severity, psi <= 0.1 AS passed,
  round(psi, 6) AS observed, CASE WHEN psi > 0.25 THEN 0.25::DOUBLE ELSE 0.1::DOUBLE END AS threshold FROM psi""",
        "performance_refresh": f"""WITH {FACTS},
runs AS (SELECT unnest([1, 2, 3, 4]) AS run, unnest([false, false, false, true]) AS whole,
  unnest([DATE '1999-06-30', DATE '2000-06-30', DATE '2000-06-30', DATE '2000-06-30']) AS today),
known AS (
  SELECT run, month, count(*) AS n FROM runs JOIN facts ON month <= today - 1000 AND known_at < today + 1
    AND (whole OR year(known_at) <> 1997 OR order_id % 50 <> 0)
  GROUP BY run, month),
changed AS (
  SELECT k.month, string_agg('' || k.run, ',' ORDER BY k.run) AS runs
  FROM known k LEFT JOIN known b ON b.run = k.run - 1 AND b.month = k.month WHERE b.n IS DISTINCT FROM k.n GROUP BY k.month),
rows_ AS (
  SELECT month, model_version, score, label FROM late_scores JOIN facts USING (order_id, month)
  WHERE month <= DATE '2000-06-30' - 1000 AND known_at < DATE '2000-07-01'),
{evaluation("rows_", "month, model_version")}
SELECT strftime(coalesce(m.month, c.month), '%Y-%m-%d') AS day, runs, CAST(model_version AS BIGINT) AS model_version, {METRICS}
FROM m FULL JOIN changed c ON c.month = m.month""",
        "closed_loop": f"""WITH RECURSIVE {FACTS},
days AS (
  SELECT i, [DATE '1999-12-31', DATE '2001-06-30', DATE '2002-06-30', DATE '2003-06-30', DATE '2004-06-30'][i] AS today,
    [DATE '1997-12-31', DATE '1999-12-31', DATE '2001-06-30', DATE '2002-06-30', DATE '2003-06-30'][i] AS before
  FROM range(1, 6) r(i)),
months AS (SELECT DISTINCT month FROM facts WHERE month >= DATE '1998-01-01'),
seen AS (
  SELECT i, today, count(*) FILTER (month > before) AS fresh, count(*) FILTER (month > today - 1000) AS still_open
  FROM days JOIN months ON month <= today GROUP BY i, today),
known AS (
  SELECT i, month, count(*) AS n FROM days JOIN facts ON i > 1 AND month >= DATE '1998-01-01' AND month <= today - 1000 AND known_at < today + 1
  GROUP BY i, month),
measured AS (
  SELECT k.i, count(*) AS n_measured FROM known k LEFT JOIN known b ON b.i = k.i - 1 AND b.month = k.month
  WHERE b.n IS DISTINCT FROM k.n GROUP BY k.i),
due AS (
  SELECT i, order_id, label FROM days JOIN facts ON i > 1 AND month >= DATE '1998-01-01'
    AND month <= today - 1000 AND month > today - 1270 AND known_at < today + 1),
judged AS (SELECT i, count(*) AS n_rows, sum(label) AS n_positive FROM due GROUP BY i),
guessed AS (
  SELECT i, label, -coalesce(n, 0) AS score FROM due
  LEFT JOIN (SELECT l_orderkey AS order_id, count(*) AS n FROM lineitem GROUP BY l_orderkey) USING (order_id)),
{evaluation("guessed", "i")},
every AS (
  SELECT s.*, coalesce(judged.n_rows, 0) AS n_rows, coalesce(judged.n_positive, 0) AS n_positive, coalesce(n_measured, 0) AS n_measured,
    coalesce(roc_auc < 0.72, false) AS fell
  FROM seen s LEFT JOIN measured USING (i) LEFT JOIN judged USING (i) LEFT JOIN m USING (i)),
walk AS (
  SELECT e.*, 'bootstrap' AS reason, today AS last, 1 AS version FROM every e WHERE i = 1
  UNION ALL
  SELECT e.*, CASE WHEN e.today - w.last >= 400 AND e.fell THEN 'degradation' END,
    CASE WHEN e.today - w.last >= 400 AND e.fell THEN e.today ELSE w.last END,
    w.version + CASE WHEN e.today - w.last >= 400 AND e.fell THEN 1 ELSE 0 END
  FROM walk w JOIN every e ON e.i = w.i + 1)
SELECT strftime(today, '%Y-%m-%d') AS today, reason, strftime(today - 1269, '%Y-%m-%d') AS measured_from,
  strftime(today - 1000, '%Y-%m-%d') AS measured_to, n_rows, CAST(n_positive AS BIGINT) AS n_positive,
  CASE WHEN i = 1 THEN 0 ELSE fresh END AS n_scored, n_measured,
  CASE WHEN reason IS NULL THEN 'kept' ELSE 'promoted' END AS outcome, CAST(version AS BIGINT) AS version,
  CASE WHEN i = 1 THEN fresh WHEN reason IS NULL THEN 0 ELSE still_open END AS n_backfilled
FROM walk""",
        "ingest_log_late": """WITH ev AS (
  SELECT event_id, ts, (day(ts) - 1) // 8 + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END AS part FROM events),
del AS (SELECT event_id, ts, part AS b FROM ev UNION ALL SELECT event_id, ts, part + 1 FROM ev WHERE event_id % 7 = 0),
marks AS (
  SELECT n.b, (SELECT max(ts) FROM del WHERE del.b < n.b) - INTERVAL 1 DAY AS watermark FROM range(0, 6) n(b)),
judged AS (SELECT d.*, coalesce(ts < watermark, false) AS late FROM del d JOIN marks USING (b)),
taken AS (SELECT event_id, min(b) AS b FROM judged WHERE NOT late GROUP BY event_id),
accepted AS (SELECT b, count(*) AS n, sum(event_id) AS ids FROM taken GROUP BY b),
counts AS (
  SELECT b, max(ts) AS newest, count(*) AS n, count(*) FILTER (late) AS n_late, sum(event_id) FILTER (late) AS late_ids FROM judged GROUP BY b)
SELECT m.b AS batch_id, strftime(watermark, '%Y-%m-%d %H:%M:%S') AS watermark, strftime(newest, '%Y-%m-%d %H:%M:%S') AS newest,
  coalesce(c.n, 0) AS n_delivered, coalesce(a.n, 0) AS n_accepted, coalesce(c.n, 0) - coalesce(a.n, 0) - coalesce(n_late, 0) AS n_repeated,
  coalesce(n_late, 0) AS n_late, a.n AS accepted_rows, CAST(a.ids AS BIGINT) AS accepted_ids, nullif(n_late, 0) AS late_rows, CAST(late_ids AS BIGINT) AS late_ids
FROM marks m LEFT JOIN counts c USING (b) LEFT JOIN accepted a USING (b)""",
        "raw_to_staging": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey,
  round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer""",
        "ingest_landing": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id,
  event_type, round(value, 6) AS value, props FROM events""",
        "ingest_log": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id,
  event_type, round(value, 6) AS value FROM events""",
        "stream_positive_rate": f"""WITH {EVENTS}
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n_rows,
  CAST(sum(label) AS BIGINT) AS n_positive, round(avg(label), 6) AS positive_rate
FROM ev GROUP BY CAST(ts AS DATE)""",
        "stream_label_join": f"""WITH {ORDERS}
SELECT order_id, strftime(purchase_ts, '%Y-%m-%d %H:%M:%S') AS purchase_ts,
  strftime(least(coalesce(delivered_at, day + 1000), CAST(day + 1000 AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS known_at,
  CAST(CASE WHEN delivered_at <= day + 1000 THEN 0 ELSE 1 END AS BIGINT) AS is_late_delivery
FROM ord""",
    }
    return sql
