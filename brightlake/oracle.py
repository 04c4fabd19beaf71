"""Independent DuckDB SQL for every registered query (the correctness oracle).

Money stays DECIMAL. Divisions are written as exact integer arithmetic with
HALF_UP (away from zero) rounding, because DuckDB turns a decimal division
into a binary double. Final values are cast to DOUBLE on both sides.
"""

from __future__ import annotations

ORDERS_AS_OF = "DATE '2001-08-01'"
EVENTS_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _unit(digits: int) -> str:
    return "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"


def round_ratio(num: str, den: str, scale: int, digits: int) -> str:
    """Exact HALF_UP ``round(num / den, digits)``; both have at most ``scale`` decimals."""
    n = f"CAST(({num}) * {10 ** scale} AS HUGEINT)"
    d = f"CAST(NULLIF(({den}), 0) * {10 ** scale} AS HUGEINT)"
    q = (f"(SIGN({n}) * SIGN({d}) * ((2 * ABS({n}) * {10 ** digits} + ABS({d})) "
         f"// (2 * ABS({d}))))")
    return f"(CAST({q} AS DECIMAL(38,0)) * {_unit(digits)})"


def round_div(num: str, num_scale: int, den: str, digits: int) -> str:
    """Exact ``round(num / den, digits)``; ``num`` has ``num_scale`` decimals, ``den`` integral."""
    return round_ratio(num, den, num_scale, digits)


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


UNIT_PRICE = round_div("CAST(l.l_extendedprice AS DECIMAL(18,2))", 2,
                       "CAST(l.l_quantity AS BIGINT)", 2)

ORDERS_CTE = f"""o AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
         l.l_orderkey AS order_key, l.l_linenumber AS line_number,
         od.o_custkey AS customer_id, l.l_partkey AS product_id,
         {UNIT_PRICE} AS unit_price,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))), 2) AS total_amount,
         CASE l.l_returnflag WHEN 'N' THEN 'completed' WHEN 'R' THEN 'refunded'
                             WHEN 'A' THEN 'cancelled' END AS status,
         od.o_orderdate AS created_at, CAST(od.o_orderdate AS DATE) AS order_date,
         p.p_name AS product_name, p.p_type AS category
  FROM lineitem l JOIN orders od ON l.l_orderkey = od.o_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey)"""

def daily_cte(src: str = "o") -> str:
    return DAILY_TEMPLATE.replace("{src}", src)


DAILY_TEMPLATE = f"""c AS (SELECT * FROM {{src}} WHERE status = 'completed'),
dd AS (SELECT order_date AS date, COUNT(order_id) AS total_orders, SUM(total_amount) AS rev,
              COUNT(DISTINCT customer_id) AS unique_customers FROM c GROUP BY 1),
dcat AS (SELECT order_date AS date, category, SUM(total_amount) AS cat_revenue FROM c GROUP BY 1, 2),
dtop AS (SELECT date, category AS top_category FROM (
           SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY cat_revenue DESC, category ASC) AS rn
           FROM dcat WHERE cat_revenue IS NOT NULL) WHERE rn = 1),
daily AS (SELECT dd.date, dd.total_orders, ROUND(dd.rev, 2) AS total_revenue,
                 {round_div('dd.rev', 2, 'dd.total_orders', 2)} AS avg_order,
                 dd.unique_customers, dtop.top_category
          FROM dd LEFT JOIN dtop ON dd.date = dtop.date)"""
DAILY_CTE = daily_cte("o")

SQL: dict[str, str] = {}

SQL["daily_sales"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}
SELECT date, total_orders, {dbl('total_revenue')} AS total_revenue, {dbl('avg_order')} AS avg_order,
       unique_customers, top_category FROM daily"""


def nullsafe_least(expr: str, cap: str) -> str:
    return f"(CASE WHEN ({expr}) IS NULL THEN NULL ELSE LEAST(({expr}), {cap}) END)"


PERF_CTE = f"""perf0 AS (
  SELECT product_id, strftime(created_at, '%Y-%m') AS period,
         CAST(SUM(quantity) AS INTEGER) AS units_sold, ROUND(SUM(total_amount), 2) AS revenue,
         {round_div('SUM(unit_price)', 2, 'COUNT(unit_price)', 2)} AS avg_price,
         {round_ratio("COUNT(*) FILTER (WHERE status = 'refunded')", 'COUNT(order_id)', 0, 4)} AS return_rate
  FROM o GROUP BY 1, 2),
perf AS (SELECT perf0.*, p.p_name AS product_name, p.p_type AS category
         FROM perf0 LEFT JOIN part p ON p.p_partkey = perf0.product_id)"""

# Segment thresholds used by the registered queries (the defaults 3000/1000 would
# make every customer of the driver tables a vip).
SEG_T = (3000000, 2000000, 180, 1)


def seg_cte(orders: str = "o", as_of: str = ORDERS_AS_OF) -> str:
    vip, prem, risk, new = SEG_T
    clv = nullsafe_least(round_ratio("total_spent * order_count", "days_since_last + 1", 2, 4),
                         "999999.9999")
    return f"""agg AS (SELECT customer_id, ROUND(SUM(total_amount), 2) AS total_spent,
                CAST(COUNT(order_id) AS INTEGER) AS order_count, MAX(created_at) AS last_order_at
         FROM {orders} WHERE status <> 'cancelled' GROUP BY 1),
agg2 AS (SELECT *, CAST(date_diff('day', CAST(last_order_at AS DATE), {as_of}) AS INTEGER) AS days_since_last FROM agg),
agg3 AS (SELECT *, {clv} AS clv_score,
                CASE WHEN total_spent > {vip} THEN 'vip' WHEN total_spent > {prem} THEN 'premium'
                     WHEN days_since_last > {risk} THEN 'at_risk' WHEN order_count <= {new} THEN 'new'
                     ELSE 'regular' END AS segment FROM agg2),
seg AS (SELECT cu.c_custkey AS customer_id, COALESCE(a.total_spent, 0) AS total_spent,
               COALESCE(a.order_count, 0) AS order_count, a.last_order_at, a.days_since_last,
               COALESCE(a.clv_score, 0) AS clv_score, COALESCE(a.segment, 'new') AS segment
        FROM customer cu LEFT JOIN agg3 a ON a.customer_id = cu.c_custkey)"""


SEG_CTE = seg_cte()

SQL["product_performance"] = f"""WITH {ORDERS_CTE}, {PERF_CTE}
SELECT product_id, period, units_sold, {dbl('revenue')} AS revenue, {dbl('avg_price')} AS avg_price,
       {dbl('return_rate')} AS return_rate, product_name, category FROM perf"""

SQL["customer_segments"] = f"""WITH {ORDERS_CTE}, {SEG_CTE}
SELECT customer_id, {dbl('total_spent')} AS total_spent, order_count, last_order_at, days_since_last,
       {dbl('clv_score')} AS clv_score, segment FROM seg"""

TRENDS_CTE = f"""rt AS (SELECT *, SUM(total_revenue) OVER w7 AS s7, COUNT(total_revenue) OVER w7 AS n7,
                  LAG(total_revenue, 30) OVER (ORDER BY date) AS prev
           FROM daily WINDOW w7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
trends AS (SELECT date, total_orders, total_revenue, avg_order, unique_customers, top_category,
                  {round_div('s7', 2, 'n7', 2)} AS revenue_7d_avg, ROUND(s7, 2) AS revenue_7d_sum,
                  CASE WHEN prev > 0 THEN {round_ratio('(total_revenue - prev) * 100', 'prev', 2, 2)} END AS mom_growth_pct
           FROM rt)"""

SQL["revenue_trends"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}, {TRENDS_CTE}
SELECT date, total_orders, {dbl('total_revenue')} AS total_revenue, {dbl('avg_order')} AS avg_order,
       unique_customers, top_category, {dbl('revenue_7d_avg')} AS revenue_7d_avg,
       {dbl('revenue_7d_sum')} AS revenue_7d_sum, {dbl('mom_growth_pct')} AS mom_growth_pct FROM trends"""

TOPP_CTE = f"""topp AS (
  SELECT product_id, product_name, category, period, units_sold, revenue, avg_price,
         ROUND(return_rate * 100, 2) AS return_rate_pct,
         CAST(RANK() OVER (PARTITION BY period ORDER BY revenue DESC NULLS FIRST) AS INTEGER) AS revenue_rank,
         CAST(RANK() OVER (PARTITION BY period ORDER BY units_sold DESC NULLS FIRST) AS INTEGER) AS volume_rank,
         {round_ratio('revenue * 100', 'SUM(revenue) OVER (PARTITION BY period)', 2, 2)} AS revenue_share_pct
  FROM perf)"""

SQL["top_products"] = f"""WITH {ORDERS_CTE}, {PERF_CTE}, {TOPP_CTE}
SELECT product_id, product_name, category, period, units_sold, {dbl('revenue')} AS revenue,
       {dbl('avg_price')} AS avg_price, {dbl('return_rate_pct')} AS return_rate_pct, revenue_rank,
       volume_rank, {dbl('revenue_share_pct')} AS revenue_share_pct FROM topp"""

# Segment names and the order of the branches.
LTV_CTE = f"""rfm AS (SELECT *,
    CAST(NTILE(4) OVER (ORDER BY total_spent DESC NULLS LAST, customer_id) AS INTEGER) AS mq,
    CAST(NTILE(4) OVER (ORDER BY order_count DESC NULLS LAST, customer_id) AS INTEGER) AS fq,
    CAST(NTILE(4) OVER (ORDER BY last_order_at DESC NULLS LAST, customer_id) AS INTEGER) AS rq
  FROM seg),
ltv AS (SELECT customer_id, segment,
    CASE WHEN mq = 4 AND fq = 4 THEN 'champion' WHEN mq >= 3 AND fq >= 3 THEN 'loyal'
         WHEN rq = 4 THEN 'new' WHEN rq <= 2 AND mq >= 3 THEN 'at_risk' ELSE 'regular' END AS rfm_segment,
    mq + fq + rq AS rfm_score, total_spent, order_count,
    {round_div('total_spent', 2, 'order_count', 2)} AS avg_order_value, last_order_at,
    ROUND(clv_score, 4) AS clv_score, mq AS monetary_quartile, fq AS frequency_quartile,
    rq AS recency_quartile FROM rfm)"""

SQL["customer_ltv"] = f"""WITH {ORDERS_CTE}, {SEG_CTE}, {LTV_CTE}
SELECT customer_id, segment, rfm_segment, rfm_score, {dbl('total_spent')} AS total_spent, order_count,
       {dbl('avg_order_value')} AS avg_order_value, last_order_at, {dbl('clv_score')} AS clv_score,
       monetary_quartile, frequency_quartile, recency_quartile FROM ltv"""

SQL["ntile_distributed"] = """SELECT o_orderkey, o_totalprice,
  CAST(NTILE(10) OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS INTEGER) AS decile
FROM orders"""

SQL["top_category_window"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}
SELECT date, category AS top_category, {dbl('cat_revenue')} AS cat_revenue, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY cat_revenue DESC NULLS LAST, category) AS rn
  FROM dcat) WHERE rn = 1"""

SQL["top_k_products_per_month"] = f"""WITH {ORDERS_CTE}, {PERF_CTE}
SELECT period, product_id, product_name, {dbl('revenue')} AS revenue, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY period ORDER BY revenue DESC NULLS LAST, product_id) AS rn
  FROM perf) WHERE rn <= 3"""

CLEAN_CTE = """bz AS (SELECT order_id, customer_id, product_id, product_name, category, unit_price, quantity,
                discount, total_amount, status, created_at FROM o),
bz1 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY
          created_at NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST, product_name NULLS FIRST,
          category NULLS FIRST, unit_price NULLS FIRST, quantity NULLS FIRST, discount NULLS FIRST,
          total_amount NULLS FIRST, status NULLS FIRST) AS rn FROM bz) WHERE rn = 1),
clean AS (SELECT order_id, customer_id, product_id, product_name, category, unit_price, quantity, discount,
                 total_amount, lower(trim(status)) AS status, created_at,
                 ROUND(total_amount * (1 - CAST(discount AS DECIMAL(6,4))), 2) AS revenue_net,
                 lower(trim(status)) = 'refunded' AS is_refunded, CAST(created_at AS DATE) AS order_date,
                 TIMESTAMP '2001-08-01 00:00:00' AS _ingested_at
          FROM bz1 WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL
                     AND unit_price > 0 AND quantity > 0 AND total_amount > 0)"""

SQL["clean_orders"] = f"""WITH {ORDERS_CTE}, {CLEAN_CTE}
SELECT order_id, customer_id, product_id, product_name, category, {dbl('unit_price')} AS unit_price,
       quantity, {dbl('discount')} AS discount, {dbl('total_amount')} AS total_amount, status, created_at,
       {dbl('revenue_net')} AS revenue_net, is_refunded, order_date, _ingested_at FROM clean"""

CPROD_CTE = """cp AS (SELECT * FROM (SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
                  CAST(p_retailprice AS DECIMAL(18,2)) AS base_price, CAST(p_size AS BIGINT) AS stock,
                  CAST(NULL AS DOUBLE) AS rating,
                  ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY p_name, p_type, p_retailprice, p_size) AS rn
           FROM part) WHERE rn = 1 AND product_id IS NOT NULL AND name IS NOT NULL AND base_price > 0),
cprod AS (SELECT product_id, name, category, base_price, stock, rating,
                 CASE WHEN base_price < 920 THEN 'budget' WHEN base_price < 950 THEN 'mid'
                      WHEN base_price < 980 THEN 'premium' ELSE 'luxury' END AS price_tier,
                 TIMESTAMP '2001-08-01 00:00:00' AS _ingested_at FROM cp)"""

SQL["clean_products"] = f"""WITH {CPROD_CTE}
SELECT product_id, name, category, {dbl('base_price')} AS base_price, stock, rating, price_tier,
       _ingested_at FROM cprod"""

SQL["clean_customers"] = """SELECT customer_id, name, lower(trim(segment)) AS segment, country,
       CAST(NULL AS INTEGER) AS days_since_joined, TIMESTAMP '2001-08-01 00:00:00' AS _ingested_at
FROM (SELECT c.c_custkey AS customer_id, c.c_name AS name, c.c_mktsegment AS segment, n.n_name AS country,
             ROW_NUMBER() OVER (PARTITION BY c.c_custkey ORDER BY c.c_name, c.c_mktsegment, n.n_name) AS rn
      FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey) WHERE rn = 1 AND customer_id IS NOT NULL"""


def dq_sql(table: str, src: str, rules: list[tuple[str, str]], layer: str = "silver") -> str:
    counts = ", ".join(f"COUNT(*) FILTER (WHERE NOT ({pred})) AS {name}" for name, pred in rules)
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, t, {name} AS f FROM {table}_dqc" for name, _ in rules)
    return f"""{table}_dqc AS (SELECT COUNT(*) AS t, {counts} FROM {src}),
{table}_dq AS (SELECT '{table}' AS table_name, '{layer}' AS layer, check_name,
       CASE WHEN f = 0 THEN 'pass' WHEN f * 100 < t THEN 'warn' ELSE 'fail' END AS status,
       t AS rows_tested, f AS rows_failed, TIMESTAMP '2001-08-01 00:00:00' AS run_at FROM ({parts}))"""


ORDER_RULES_SQL = [("no_null_order_id", "order_id IS NOT NULL"), ("positive_amount", "total_amount > 0"),
                   ("valid_status", "status IN ('completed', 'refunded', 'cancelled')"),
                   ("valid_quantity", "quantity BETWEEN 1 AND 100"),
                   ("non_negative_discount", "discount BETWEEN 0 AND 1")]
PRODUCT_RULES_SQL = [("no_null_product_id", "product_id IS NOT NULL"), ("positive_price", "base_price > 0"),
                     ("valid_rating", "rating BETWEEN 0 AND 5")]
DQ_CTE = f"""{dq_sql('orders', 'clean', ORDER_RULES_SQL)}, {CPROD_CTE}, {dq_sql('products', 'cprod', PRODUCT_RULES_SQL)},
dq_all AS (SELECT * FROM orders_dq UNION ALL SELECT * FROM products_dq)"""

SQL["dq_orders"] = f"""WITH {ORDERS_CTE}, {CLEAN_CTE}, {dq_sql('orders', 'clean', ORDER_RULES_SQL)}
SELECT * FROM orders_dq"""

SQL["dq_gate"] = f"""WITH {ORDERS_CTE}, {CLEAN_CTE}, {DQ_CTE}
SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'fail') AS failures,
       COUNT(*) FILTER (WHERE status = 'warn') AS warnings,
       COALESCE(string_agg(DISTINCT check_name, ',' ORDER BY check_name) FILTER (WHERE status = 'fail'), '') AS failed_checks,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'fail') > 0 THEN 'dq_failed' ELSE 'dq_passed' END AS decision
FROM dq_all WHERE run_at >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 1 HOUR
              AND run_at <= TIMESTAMP '2001-08-01 00:00:00' AND layer = 'silver'"""

SQL["dq_pass_rate"] = f"""WITH {ORDERS_CTE}, {CLEAN_CTE}, {DQ_CTE}
SELECT AVG(CASE WHEN status = 'pass' THEN 100.0 ELSE 0.0 END)::DOUBLE AS pass_rate FROM dq_all"""


def _nn(table: str, src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS test, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM {src}" for c in cols)


def _uq(table: str, src: str, col: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'unique' AS test, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS failures FROM "
            f"(SELECT {col}, COUNT(*) AS n FROM {src} WHERE {col} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)")


SQL["unique_not_null"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}, {TRENDS_CTE}, {PERF_CTE}, {TOPP_CTE}, {SEG_CTE}, {LTV_CTE},
t AS ({_nn('revenue_trends', 'trends', ['date', 'total_revenue', 'total_orders'])} UNION ALL
      {_uq('revenue_trends', 'trends', 'date')} UNION ALL
      {_nn('top_products', 'topp', ['product_id', 'period', 'revenue'])} UNION ALL
      {_nn('customer_ltv', 'ltv', ['customer_id', 'rfm_score'])} UNION ALL
      {_uq('customer_ltv', 'ltv', 'customer_id')})
SELECT table_name, column_name, test, CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM t"""


def feat_cte(p: str, as_of: str = ORDERS_AS_OF, where: str = "TRUE") -> str:
    """Customer features (A12) over order lines ``o`` filtered by ``where``; CTEs prefixed ``p``."""
    age = f"date_diff('day', order_date, {as_of})"
    clv = nullsafe_least(round_ratio("total_spent_all * order_count_30d", "days_since_last + 1", 2, 2),
                         "999999.0")
    return f"""{p}o AS (SELECT * FROM o WHERE status <> 'cancelled' AND {where}),
{p}a AS (SELECT customer_id, MAX(order_date) AS _last,
   CAST(COUNT(*) FILTER (WHERE {age} <= 7) AS INTEGER) AS order_count_7d,
   CAST(COUNT(*) FILTER (WHERE {age} <= 30) AS INTEGER) AS order_count_30d,
   CAST(COUNT(*) FILTER (WHERE {age} <= 90) AS INTEGER) AS order_count_90d,
   SUM(CASE WHEN {age} <= 30 THEN total_amount ELSE 0 END) AS _spent30,
   SUM(total_amount) AS _spent, COUNT(total_amount) AS _n_amount,
   COUNT(*) FILTER (WHERE status = 'refunded') AS _refunded, COUNT(order_id) AS _n
 FROM {p}o GROUP BY 1),
{p}b AS (SELECT customer_id, CAST(date_diff('day', _last, {as_of}) AS INTEGER) AS days_since_last,
   order_count_7d, order_count_30d, order_count_90d, ROUND(_spent30, 2) AS total_spent_30d,
   {round_div('_spent', 2, '_n_amount', 2)} AS avg_basket_size, ROUND(_spent, 2) AS total_spent_all,
   {round_ratio('_refunded', '_n', 0, 4)} AS return_rate FROM {p}a),
{p}c AS (SELECT *, ROUND({clv}, 2) AS clv_score FROM {p}b),
{p}pc AS (SELECT customer_id, category, COUNT(*) AS n FROM {p}o WHERE category IS NOT NULL GROUP BY 1, 2),
{p}pref AS (SELECT customer_id, category AS preferred_category FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY n DESC, category) AS rn FROM {p}pc) WHERE rn = 1),
{p}feat AS (SELECT {p}c.*, {p}pref.preferred_category, CAST({as_of} AS TIMESTAMP) AS computed_at
   FROM {p}c LEFT JOIN {p}pref ON {p}c.customer_id = {p}pref.customer_id)"""


FEAT_COLS = ["customer_id", "days_since_last", "order_count_7d", "order_count_30d", "order_count_90d",
             "total_spent_30d", "avg_basket_size", "total_spent_all", "return_rate", "clv_score",
             "preferred_category", "computed_at"]
FEAT_MONEY = {"total_spent_30d", "avg_basket_size", "total_spent_all", "return_rate", "clv_score",
              "churn_probability"}


def cols_out(cols: list[str], money: set[str], prefix: str = "") -> str:
    return ", ".join(f"{dbl(prefix + c)} AS {c}" if c in money else f"{prefix}{c}" for c in cols)


SCORED_CTE = f"""{feat_cte('f')},
scored AS (SELECT customer_id, COALESCE(days_since_last, 999) AS days_since_last,
   order_count_7d, order_count_30d, order_count_90d, total_spent_30d, avg_basket_size, total_spent_all,
   return_rate, clv_score, COALESCE(preferred_category, 'unknown') AS preferred_category, computed_at,
   {round_ratio('GREATEST(days_since_last, 0)', 'GREATEST(days_since_last, 0) + 180', 0, 4)} AS churn_probability
 FROM ffeat)"""

SQL["customer_features"] = f"""WITH {ORDERS_CTE}, {feat_cte('f')}
SELECT {cols_out(FEAT_COLS, FEAT_MONEY)} FROM ffeat"""

SQL["product_features"] = f"""WITH {ORDERS_CTE},
pa AS (SELECT product_id,
   SUM(CASE WHEN date_diff('day', order_date, {ORDERS_AS_OF}) <= 7 THEN quantity ELSE 0 END) AS u7,
   SUM(CASE WHEN date_diff('day', order_date, {ORDERS_AS_OF}) <= 30 THEN quantity ELSE 0 END) AS u30,
   SUM(CASE WHEN date_diff('day', order_date, {ORDERS_AS_OF}) <= 30 THEN total_amount ELSE 0 END) AS r30,
   COUNT(*) FILTER (WHERE status = 'refunded') AS rf, COUNT(order_id) AS n FROM o GROUP BY 1)
SELECT p.p_partkey AS product_id, CAST(COALESCE(u7, 0) AS BIGINT) AS units_sold_7d,
   CAST(COALESCE(u30, 0) AS BIGINT) AS units_sold_30d, {dbl('COALESCE(r30, 0)')} AS revenue_30d,
   CAST(NULL AS DOUBLE) AS avg_rating, {dbl(round_ratio('rf', 'n', 0, 4))} AS return_rate,
   CAST(p.p_size AS BIGINT) AS stock_level,
   CASE WHEN CAST(p.p_retailprice AS DECIMAL(18,2)) < 920 THEN 'budget'
        WHEN CAST(p.p_retailprice AS DECIMAL(18,2)) < 950 THEN 'mid'
        WHEN CAST(p.p_retailprice AS DECIMAL(18,2)) < 980 THEN 'premium' ELSE 'luxury' END AS price_tier,
   p.p_type AS category, CAST({ORDERS_AS_OF} AS TIMESTAMP) AS event_timestamp
FROM part p LEFT JOIN pa ON pa.product_id = p.p_partkey"""

SQL["preferred_category"] = f"""WITH {ORDERS_CTE}, {feat_cte('f')}
SELECT customer_id, preferred_category FROM fpref"""

PURCH_CTE = """purch AS (SELECT user_id, ts AS purchase_ts, value AS purchase_value, event_id AS purchase_id
                  FROM events WHERE event_type = 'purchase')"""

SQL["asof_features"] = f"""WITH {PURCH_CTE},
spine AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
m AS (SELECT s.event_id, s.user_id, s.ts, p.purchase_ts, p.purchase_value,
             ROW_NUMBER() OVER (PARTITION BY s.event_id ORDER BY p.purchase_ts DESC NULLS LAST,
                                p.purchase_id DESC NULLS LAST) AS rn
      FROM spine s LEFT JOIN purch p ON p.user_id = s.user_id AND p.purchase_ts <= s.ts
                                     AND p.purchase_ts >= s.ts - INTERVAL 1 DAY)
SELECT event_id, user_id, ts, purchase_ts, purchase_value FROM m WHERE rn = 1"""

SQL["asof_features_by_time"] = """WITH c AS (SELECT user_id, date_trunc('hour', ts) AS click_hour,
    event_id AS click_id, date_trunc('day', ts) + to_seconds(event_id % 86400) AS created_at
  FROM events WHERE event_type = 'click'),
m AS (SELECT s.event_id, s.event_type, s.user_id, s.ts, c.click_hour, c.click_id, c.created_at,
        ROW_NUMBER() OVER (PARTITION BY s.event_id ORDER BY c.click_hour DESC NULLS LAST,
                           c.created_at DESC NULLS LAST) AS rn
      FROM events s LEFT JOIN c ON c.user_id = s.user_id AND c.click_hour <= s.ts
                                AND c.click_hour >= s.ts - INTERVAL 100 HOUR)
SELECT event_id, event_type, user_id, ts, click_hour, click_id, created_at FROM m WHERE rn = 1"""

SQL["online_features"] = f"""WITH {PURCH_CTE}
SELECT user_id, purchase_ts, purchase_value, purchase_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY purchase_ts DESC, purchase_id DESC,
                               purchase_value DESC) AS rn
  FROM purch WHERE purchase_ts <= {EVENTS_AS_OF} AND purchase_ts >= {EVENTS_AS_OF} - INTERVAL 7 DAY)
WHERE rn = 1"""

SQL["latest_version"] = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
      l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
      l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, l_tax DESC NULLS LAST,
      l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn FROM lineitem) WHERE rn = 1"""

SQL["upsert_merge"] = f"""WITH {ORDERS_CTE},
{feat_cte('tg', "DATE '1998-01-01'", "order_date < DATE '1998-01-01'")},
{feat_cte('sr', ORDERS_AS_OF, "order_date >= DATE '1998-01-01'")}
SELECT COALESCE(t.customer_id, s.customer_id) AS customer_id,
       CASE WHEN t.customer_id IS NOT NULL THEN t.order_count_30d ELSE s.order_count_30d END AS order_count_30d,
       {dbl('CASE WHEN t.customer_id IS NOT NULL THEN t.total_spent_30d ELSE s.total_spent_30d END')} AS total_spent_30d,
       {dbl('CASE WHEN s.customer_id IS NOT NULL THEN s.clv_score ELSE t.clv_score END')} AS clv_score,
       CASE WHEN s.customer_id IS NOT NULL THEN s.computed_at ELSE t.computed_at END AS computed_at
FROM tgfeat t FULL OUTER JOIN srfeat s ON t.customer_id = s.customer_id"""

CCOPY_CTE = f"""ccopy AS (SELECT COALESCE(CAST(seg.customer_id AS VARCHAR), '') AS customer_id,
       COALESCE(seg.segment, 'unknown') AS segment, {dbl('COALESCE(seg.total_spent, 0)')} AS total_spent,
       CAST(COALESCE(seg.order_count, 0) AS BIGINT) AS order_count,
       {dbl('COALESCE(seg.clv_score, 0)')} AS clv_score,
       {dbl('COALESCE(sc.churn_probability, 0)')} AS churn_probability,
       COALESCE(seg.last_order_at, TIMESTAMP '2000-01-01 00:00:00') AS last_order_at,
       TIMESTAMP '2001-08-01 00:00:00' AS inserted_at
  FROM seg LEFT JOIN scored sc ON CAST(seg.customer_id AS VARCHAR) = CAST(sc.customer_id AS VARCHAR))"""

SQL["olap_copy"] = f"""WITH {ORDERS_CTE}, {SEG_CTE}, {SCORED_CTE}, {CCOPY_CTE}
SELECT * FROM ccopy"""

SQL["q_summary"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}, {SEG_CTE},
a AS (SELECT COALESCE(SUM(total_revenue), 0) AS total_revenue,
             CAST(COALESCE(SUM(total_orders), 0) AS BIGINT) AS total_orders,
             COALESCE({round_div('SUM(avg_order)', 2, 'COUNT(avg_order)', 4)}, 0) AS avg_order_value,
             COALESCE(MAX(unique_customers), 0) AS unique_customers
      FROM daily WHERE date >= {ORDERS_AS_OF} - INTERVAL 30 DAY),
b AS (SELECT COUNT(*) FILTER (WHERE segment = 'vip') AS vip_customers,
             COUNT(*) FILTER (WHERE segment = 'at_risk') AS at_risk_customers FROM seg)
SELECT {dbl('a.total_revenue')} AS total_revenue, a.total_orders, {dbl('a.avg_order_value')} AS avg_order_value,
       a.unique_customers, b.vip_customers, b.at_risk_customers FROM a, b"""

SQL["q_daily_sales"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}
SELECT date, total_orders, {dbl('total_revenue')} AS total_revenue, {dbl('avg_order')} AS avg_order,
       unique_customers, top_category FROM daily WHERE date >= {ORDERS_AS_OF} - INTERVAL 30 DAY"""

SQL["q_revenue_trends"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}, {TRENDS_CTE}
SELECT date, {dbl('total_revenue')} AS total_revenue,
       {dbl('COALESCE(revenue_7d_avg, total_revenue)')} AS revenue_7d_avg,
       {dbl('COALESCE(revenue_7d_sum, total_revenue)')} AS revenue_7d_sum,
       {dbl('mom_growth_pct')} AS mom_growth_pct FROM trends ORDER BY date DESC LIMIT 90"""

TOPLATEST_CTE = """toplatest AS (SELECT product_id, product_name, category, period, units_sold, revenue, avg_price,
       return_rate_pct, revenue_rank FROM topp WHERE period = (SELECT MAX(period) FROM topp)
       ORDER BY revenue_rank, product_id LIMIT 10)"""

SQL["q_top_products"] = f"""WITH {ORDERS_CTE}, {PERF_CTE}, {TOPP_CTE}, {TOPLATEST_CTE}
SELECT product_id, product_name, category, period, units_sold, {dbl('revenue')} AS revenue,
       {dbl('avg_price')} AS avg_price, {dbl('return_rate_pct')} AS return_rate_pct, revenue_rank
FROM toplatest"""

SQL["category_rollup"] = f"""WITH {ORDERS_CTE}, {PERF_CTE}, {TOPP_CTE}, {TOPLATEST_CTE}
SELECT category, {dbl('SUM(revenue)')} AS revenue, CAST(SUM(units_sold) AS BIGINT) AS units FROM toplatest GROUP BY 1"""

SQL["q_customer_segments"] = f"""WITH {ORDERS_CTE}, {SEG_CTE}
SELECT segment, COUNT(*) AS count, {dbl(round_div('SUM(total_spent)', 2, 'COUNT(total_spent)', 2))} AS avg_spent,
       {dbl(round_ratio('SUM(order_count)', 'COUNT(order_count)', 0, 1))} AS avg_orders,
       {dbl(round_div('SUM(clv_score)', 4, 'COUNT(clv_score)', 4))} AS avg_clv
FROM seg GROUP BY 1"""

SQL["q_customer_ltv"] = f"""WITH {ORDERS_CTE}, {SEG_CTE}, {LTV_CTE}
SELECT customer_id, segment, rfm_segment, rfm_score, {dbl('total_spent')} AS total_spent,
       {dbl('avg_order_value')} AS avg_order_value, order_count, last_order_at, {dbl('clv_score')} AS clv_score
FROM ltv WHERE customer_id = 42"""

SQL["q_ml_summary"] = f"""WITH {ORDERS_CTE}, {SCORED_CTE}
SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (WHERE churn_probability > 0.7) AS high_risk_count,
       COUNT(*) FILTER (WHERE churn_probability BETWEEN 0.4 AND 0.7) AS medium_risk_count,
       COUNT(*) FILTER (WHERE churn_probability < 0.4) AS low_risk_count,
       {dbl(round_div('SUM(churn_probability)', 4, 'COUNT(churn_probability)', 4))} AS avg_churn_probability,
       {dbl(round_div('SUM(clv_score)', 2, 'COUNT(clv_score)', 2))} AS avg_clv_score FROM scored"""

SQL["q_churn_risk"] = f"""WITH {ORDERS_CTE}, {SCORED_CTE}
SELECT customer_id, {dbl('churn_probability')} AS churn_probability, {dbl('clv_score')} AS clv_score,
       days_since_last, preferred_category FROM scored WHERE churn_probability > 0.5
ORDER BY churn_probability DESC, customer_id LIMIT 20"""

SQL["q_customer_ml"] = f"""WITH {ORDERS_CTE}, {SCORED_CTE}
SELECT customer_id, order_count_30d, {dbl('avg_basket_size')} AS avg_basket_size,
       {dbl('churn_probability')} AS churn_probability, {dbl('clv_score')} AS clv_score, preferred_category,
       days_since_last, computed_at,
       CASE WHEN churn_probability > 0.7 THEN 'high' WHEN churn_probability > 0.4 THEN 'medium' ELSE 'low' END AS risk_level
FROM scored WHERE customer_id = 42"""

SQL["q_olap_stats"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}
SELECT COUNT(*) AS total_rows, {dbl('SUM(CAST(CAST(total_revenue AS DOUBLE) AS DECIMAL(18,2)))')} AS total_revenue,
       MAX(date) AS latest_date FROM daily"""

SQL["q_olap_top_products"] = f"""WITH {ORDERS_CTE}, {PERF_CTE}
SELECT COALESCE(product_name, '') AS product_name, COALESCE(category, '') AS category,
       {dbl('SUM(CAST(CAST(revenue AS DOUBLE) AS DECIMAL(18,2)))')} AS revenue, CAST(SUM(units_sold) AS BIGINT) AS units
FROM perf GROUP BY 1, 2 ORDER BY revenue DESC, product_name, category LIMIT 10"""

SQL["q_olap_churn_stats"] = f"""WITH {ORDERS_CTE}, {SEG_CTE}, {SCORED_CTE}, {CCOPY_CTE}
SELECT COUNT(*) FILTER (WHERE CAST(churn_probability AS DECIMAL(10,4)) > 0.7) AS high_risk,
       COUNT(*) FILTER (WHERE CAST(churn_probability AS DECIMAL(10,4)) BETWEEN 0.4 AND 0.7) AS medium_risk,
       COUNT(*) FILTER (WHERE CAST(churn_probability AS DECIMAL(10,4)) < 0.4) AS low_risk,
       {dbl(round_div('SUM(CAST(churn_probability AS DECIMAL(10,4)))', 4, 'COUNT(churn_probability)', 6))} AS avg_churn,
       {dbl(round_div('SUM(CAST(clv_score AS DECIMAL(24,4)))', 4, 'COUNT(clv_score)', 6))} AS avg_clv FROM ccopy"""

SQL["feature_summary"] = f"""WITH {ORDERS_CTE}, {SCORED_CTE}
SELECT COUNT(*) AS customers,
       {dbl(round_div('SUM(churn_probability)', 4, 'COUNT(churn_probability)', 4))} AS avg_churn,
       {dbl(round_div('SUM(clv_score)', 2, 'COUNT(clv_score)', 2))} AS avg_clv,
       COUNT(*) FILTER (WHERE churn_probability > 0.7) AS high_risk FROM scored"""

SQL["churn_label"] = f"""WITH {ORDERS_CTE}, {feat_cte('f')},
med AS (SELECT GREATEST(1, CAST(FLOOR(MEDIAN(days_since_last)) AS INTEGER)) AS churn_threshold FROM ffeat)
SELECT customer_id, days_since_last, churn_threshold,
       CAST(days_since_last > churn_threshold AS INTEGER) AS churned FROM ffeat, med"""

SQL["stream_daily"] = f"""WITH {ORDERS_CTE}, {CLEAN_CTE}, {daily_cte('clean')}
SELECT date, total_orders, {dbl('total_revenue')} AS total_revenue, {dbl('avg_order')} AS avg_order,
       unique_customers, top_category FROM daily"""

SQL["snapshot_as_of"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}
SELECT date, total_orders, {dbl('total_revenue')} AS total_revenue, {dbl('avg_order')} AS avg_order,
       unique_customers, top_category FROM daily WHERE date < DATE '2001-07-01'"""

SQL["snapshot_list"] = f"""WITH {ORDERS_CTE}, {DAILY_CTE}
SELECT DATE '2001-06-01' AS snapshot_date, COUNT(*) AS row_count FROM daily WHERE date < DATE '2001-06-01'
UNION ALL SELECT DATE '2001-07-01', COUNT(*) FROM daily WHERE date < DATE '2001-07-01'
UNION ALL SELECT DATE '2001-08-01', COUNT(*) FROM daily WHERE date < DATE '2001-08-01'"""

SQL["storage_stats"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, TRUE AS has_files, TRUE AS has_bytes FROM {t}"
    for t in ("customer", "orders", "lineitem", "part"))

SQL["retention"] = f"""SELECT 'events' AS table_name, 'kept' AS part, COUNT(*) AS row_count FROM events
WHERE ts >= {EVENTS_AS_OF} - INTERVAL 7 DAY
UNION ALL SELECT 'events', 'deleted', COUNT(*) FROM events WHERE ts < {EVENTS_AS_OF} - INTERVAL 7 DAY"""

SQL["compact"] = "SELECT * FROM lineitem"


def perf_cte(src: str) -> str:
    return PERF_CTE.replace("FROM o GROUP BY 1, 2", f"FROM {src} GROUP BY 1, 2")


CCUST_CTE = f"ccust AS ({SQL['clean_customers']})"
RUNS_CTE = f"""{CLEAN_CTE}, {CPROD_CTE}, {CCUST_CTE}, {daily_cte('clean')}, {perf_cte('clean')}, {seg_cte('clean')},
runs AS (
  SELECT 'bronze_to_silver_orders' AS pipeline_name, 'orders' AS table_name, 'silver' AS layer, 'success' AS status,
         (SELECT COUNT(*) FROM o) AS rows_read, (SELECT COUNT(*) FROM clean) AS rows_written
  UNION ALL SELECT 'bronze_to_silver_customers', 'customers', 'silver', 'success',
         (SELECT COUNT(*) FROM customer), (SELECT COUNT(*) FROM ccust)
  UNION ALL SELECT 'bronze_to_silver_products', 'products', 'silver', 'success',
         (SELECT COUNT(*) FROM part), (SELECT COUNT(*) FROM cprod)
  UNION ALL SELECT 'silver_to_gold_daily_sales', 'daily_sales', 'gold', 'success',
         (SELECT COUNT(*) FROM clean), (SELECT COUNT(*) FROM daily)
  UNION ALL SELECT 'silver_to_gold_product_perf', 'product_performance', 'gold', 'success',
         (SELECT COUNT(*) FROM clean), (SELECT COUNT(*) FROM perf)
  UNION ALL SELECT 'silver_to_gold_customer_seg', 'customer_segments', 'gold', 'success',
         (SELECT COUNT(*) FROM clean), (SELECT COUNT(*) FROM seg))"""

SQL["q_run_history"] = f"""WITH {ORDERS_CTE}, {RUNS_CTE}
SELECT pipeline_name, layer, status, rows_read, rows_written FROM runs"""

SQL["q_catalog"] = f"""WITH {ORDERS_CTE}, {RUNS_CTE}
SELECT table_name, layer, 'parquet' AS format, rows_written AS row_count, TRUE AS has_bytes,
       TIMESTAMP '2001-08-01 00:00:00' AS last_updated FROM runs"""

SQL["run_status"] = f"""WITH {ORDERS_CTE}, {RUNS_CTE}
SELECT COUNT(*) FILTER (WHERE status = 'success') AS success,
       COUNT(*) FILTER (WHERE status = 'failed') AS failed,
       COUNT(*) FILTER (WHERE status = 'running') AS running FROM runs"""

CUSTOMER_RULES_SQL = [("no_null_customer_id", "customer_id IS NOT NULL"),
                      ("valid_segment", "segment IN ('standard', 'premium', 'vip')")]
SQL["q_dq_results"] = f"""WITH {ORDERS_CTE}, {CLEAN_CTE}, {DQ_CTE}, {CCUST_CTE},
{dq_sql('customers', 'ccust', CUSTOMER_RULES_SQL)}
SELECT table_name, layer, check_name, status, rows_tested, rows_failed, run_at
FROM (SELECT * FROM dq_all UNION ALL SELECT * FROM customers_dq)
ORDER BY run_at DESC, table_name, check_name LIMIT 100"""

RAW_RULES_SQL = [(n, {"valid_quantity": "quantity BETWEEN 1 AND 49",
                      "non_negative_discount": "discount BETWEEN 0 AND 0.05"}.get(n, p))
                 for n, p in ORDER_RULES_SQL] + [("amount_limit", "total_amount <= 100000")]
SQL["dq_raw_orders"] = f"""WITH {ORDERS_CTE}, {dq_sql('orders', 'o', RAW_RULES_SQL, 'raw')}
SELECT * FROM orders_dq"""

SQL["dq_gate_stops"] = f"""WITH {ORDERS_CTE}, {dq_sql('orders', 'o', RAW_RULES_SQL, 'raw')}
SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'fail') AS failures,
       COUNT(*) FILTER (WHERE status = 'warn') AS warnings,
       COALESCE(string_agg(DISTINCT check_name, ',' ORDER BY check_name) FILTER (WHERE status = 'fail'), '') AS failed_checks,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'fail') > 0 THEN 'dq_failed' ELSE 'dq_passed' END AS decision
FROM orders_dq"""

SQL["save_scored_features"] = f"""WITH {ORDERS_CTE},
{feat_cte('f', ORDERS_AS_OF, "order_date >= DATE '1998-01-01'")}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, COALESCE(days_since_last, 999) AS days_since_last,
       order_count_7d, order_count_30d, order_count_90d, {cols_out(['total_spent_30d', 'avg_basket_size',
       'total_spent_all', 'return_rate', 'clv_score'], FEAT_MONEY)},
       COALESCE(preferred_category, 'unknown') AS preferred_category, computed_at,
       {dbl(round_ratio('GREATEST(days_since_last, 0)', 'GREATEST(days_since_last, 0) + 180', 0, 4))} AS churn_probability
FROM ffeat"""

IN_TRAINING = "('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 8))::BIGINT % 10 < 8"
MED_CTE = """med AS (SELECT GREATEST(1, CAST(FLOOR(MEDIAN(days_since_last)) AS INTEGER)) AS churn_threshold FROM ffeat),
lab AS (SELECT *, CAST(days_since_last > churn_threshold AS INTEGER) AS churned FROM ffeat, med)"""
SQL["ml_split"] = f"""WITH {ORDERS_CTE}, {feat_cte('f')}, {MED_CTE}
SELECT {IN_TRAINING} AS in_training, COUNT(*) AS customers, CAST(SUM(churned) AS BIGINT) AS churned
FROM lab GROUP BY 1"""

_CHURN_FEATURES = ["order_count_7d", "order_count_30d", "order_count_90d", "total_spent_30d",
                   "avg_basket_size", "return_rate", "days_since_last", "clv_score"]
SQL["ml_features"] = f"""WITH {ORDERS_CTE}, {feat_cte('f')}, {MED_CTE}
SELECT customer_id, churned, {IN_TRAINING} AS in_training,
       {", ".join(f"COALESCE({dbl(c)}, 0.0) AS {c}" for c in _CHURN_FEATURES)} FROM lab"""

SQL["model_metrics"] = f"""WITH {ORDERS_CTE}, {feat_cte('f')}, {MED_CTE},
ml AS (SELECT churned, {IN_TRAINING} AS train, CAST(COALESCE(total_spent_all, 0) AS DOUBLE) AS spent FROM lab),
m AS (SELECT AVG(spent) FILTER (WHERE train) AS mean FROM ml),
k AS (SELECT CAST(COUNT(*) AS DOUBLE) AS customers, CAST(COUNT(*) FILTER (WHERE train) AS DOUBLE) AS training_rows,
  ROUND(AVG(CAST(churned AS DOUBLE)), 6) AS churn_rate,
  ROUND(AVG(ABS(spent - mean)) FILTER (WHERE NOT train), 2) AS mae_of_mean FROM ml, m)
""" + " UNION ALL ".join(
    [f"SELECT 'churn' AS model_name, '{c}' AS metric_name, {c} AS exact_value, CAST(NULL AS BOOLEAN) AS within_bounds FROM k"
     for c in ("customers", "training_rows", "churn_rate", "mae_of_mean")]
    + [f"SELECT '{model}', '{metric}', CAST(NULL AS DOUBLE), TRUE"
       for model, metric in [("churn", "auc"), ("ltv", "mae"),
                             *[("churn", f"importance_{c}") for c in _CHURN_FEATURES]]])


# ---- file by file, features at many dates, distinct customers of periods ----------------

SQL["upsert_files"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
   CASE WHEN o_orderdate >= TIMESTAMP '1997-07-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
   CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders"""
SQL["compact_small_files"] = "SELECT * FROM lineitem"
SQL["retention_partitions"] = SQL["retention"]
SQL["lookup_customer_ltv"] = SQL["q_customer_ltv"]
SQL["lookup_customer_ml"] = SQL["q_customer_ml"]


def _at(i: int, d: str) -> tuple[str, str]:
    return (feat_cte(f"t{i}_", f"DATE '{d}'", f"order_date < DATE '{d}'"),
            f"SELECT {cols_out(FEAT_COLS, FEAT_MONEY)} FROM t{i}_feat")


TRAINING_DATES = [f"{y}-{m:02d}-01" for y in range(1996, 2002) for m in (1, 4, 7, 10) if (y, m) < (2001, 10)]
SQL["training_features"] = (f"WITH {ORDERS_CTE}, " + ", ".join(_at(i, d)[0] for i, d in enumerate(TRAINING_DATES))
                            + "\n" + " UNION ALL ".join(_at(i, d)[1] for i, d in enumerate(TRAINING_DATES)))

SQL["rolling_customers"] = f"""WITH {ORDERS_CTE},
c AS (SELECT DISTINCT order_date, customer_id FROM o WHERE status = 'completed' AND customer_id IS NOT NULL),
d AS (SELECT DISTINCT order_date FROM c WHERE order_date IS NOT NULL)
SELECT d.order_date, COUNT(DISTINCT c.customer_id) FILTER (WHERE c.order_date = d.order_date) AS customers_1d,
  COUNT(DISTINCT c.customer_id) FILTER (WHERE c.order_date > d.order_date - 7) AS customers_7d,
  COUNT(DISTINCT c.customer_id) AS customers_30d
FROM d JOIN c ON c.order_date <= d.order_date AND c.order_date > d.order_date - 30 GROUP BY 1"""

# Batches of the stream: deliveries since 1997, before it, and ids that end in -1 again.
_DELIVERIES = ["created_at >= TIMESTAMP '1997-01-01' OR created_at IS NULL",
               "created_at < TIMESTAMP '1997-01-01'", "order_id LIKE '%-1'"]
_TIGHT = [r for r in RAW_RULES_SQL if r[0] != "amount_limit"]
_BATCHES = ", ".join(
    f"c{i} AS (SELECT * FROM clean WHERE {'FALSE' if i == 2 else cond}), {dq_sql(f'b{i}', f'c{i}', _TIGHT)}"
    for i, cond in enumerate(_DELIVERIES))
SQL["stream_quality"] = f"WITH {ORDERS_CTE}, {CLEAN_CTE}, {_BATCHES}\n" + " UNION ALL ".join(
    f"""SELECT CAST({i} AS BIGINT) AS batch, check_name, status, rows_tested, rows_failed FROM b{i}_dq
UNION ALL SELECT {i}, 'run', 'success', COUNT(*), COUNT(*) - (SELECT COUNT(*) FROM c{i}) FROM o WHERE {cond}"""
    for i, cond in enumerate(_DELIVERIES))

SQL["landed_generations"] = f"""WITH {ORDERS_CTE}
SELECT order_id, customer_id, quantity, created_at,
  {dbl("CASE WHEN created_at >= TIMESTAMP '1997-01-01' THEN discount END")} AS discount,
  {dbl("CASE WHEN created_at >= TIMESTAMP '1997-01-01' OR quantity <= 45 THEN total_amount END")} AS total_amount,
  CASE WHEN created_at < TIMESTAMP '1997-01-01' THEN 1 WHEN created_at < TIMESTAMP '1999-01-01' THEN 2 ELSE 3 END
    AS generation
FROM o"""
