"""Shared common table expressions of the oracle SQL."""

SNAP = "TIMESTAMP '2001-08-02 00:00:00'"


def money(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,4))) AS DOUBLE)"


def mean(expr: str) -> str:
    return f"(CAST(SUM(CAST({expr} AS DECIMAL(18,4))) AS DOUBLE) / NULLIF(COUNT({expr}), 0))"


CTE = {}
CTE["txn"] = """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS customer_id, l_partkey AS product_id,
  p_type AS category, o_orderdate AS transaction_date, l_quantity AS quantity, l_extendedprice AS list_amount,
  l_discount AS discount_pct,
  l_extendedprice * (1 - l_discount) * (CASE WHEN l_returnflag = 'R' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END) AS revenue,
  l_extendedprice * 0.6::DOUBLE AS cogs,
  l_extendedprice * (1 - l_discount) * (CASE WHEN l_returnflag = 'R' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END)
    - l_extendedprice * 0.6::DOUBLE AS gross_profit,
  l_linestatus AS device_type, o_orderpriority AS payment_method, l_returnflag = 'R' AS is_returned,
  round(1 + 0.3::DOUBLE * sin((month(o_orderdate) - 3) * 3.141592653589793::DOUBLE / 6), 3) AS seasonality_factor
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""
CTE["cust"] = """
SELECT c_custkey AS customer_id, ' ' || replace(c_name, '#', '.') || '@Example.COM ' AS email, n_name AS country,
  r_name AS region, c_mktsegment AS acquisition_channel, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
CTE["rfm0"] = f"""
SELECT customer_id, max(transaction_date) AS last_purchase, min(transaction_date) AS first_purchase,
  count(DISTINCT order_id) AS frequency, {money("revenue")} AS monetary, {mean("revenue")} AS avg_order_value,
  {money("quantity")} AS total_items, CAST(count(DISTINCT category) AS INT) AS distinct_categories,
  date_diff('day', max(transaction_date), {SNAP}) AS recency,
  date_diff('day', min(transaction_date), {SNAP}) AS customer_age_days
FROM txn WHERE revenue > 0 GROUP BY customer_id
"""
CTE["rfm1"] = """
SELECT *, frequency / greatest(customer_age_days / 30, 1.0) AS purchase_rate,
  total_items / frequency AS avg_items_per_order, ln(1 + recency) AS log_recency, ln(1 + frequency) AS log_frequency,
  ln(1 + monetary) AS log_monetary,
  row_number() OVER (ORDER BY frequency, customer_id) AS rf, row_number() OVER (ORDER BY monetary, customer_id) AS rm,
  count(*) OVER () AS n,
  (SELECT quantile_cont(recency, 0.2) FROM rfm0) AS e1, (SELECT quantile_cont(recency, 0.4) FROM rfm0) AS e2,
  (SELECT quantile_cont(recency, 0.6) FROM rfm0) AS e3, (SELECT quantile_cont(recency, 0.8) FROM rfm0) AS e4
FROM rfm0
"""
CTE["rfm2"] = """
SELECT * EXCLUDE (rf, rm, n, e1, e2, e3, e4),
  CAST(5 - (recency > e1)::INT - (recency > e2)::INT - (recency > e3)::INT - (recency > e4)::INT AS INT) AS R_score,
  CAST(greatest(1, ((rf - 1) * 5 + n - 2) // (n - 1)) AS INT) AS F_score,
  CAST(greatest(1, ((rm - 1) * 5 + n - 2) // (n - 1)) AS INT) AS M_score
FROM rfm1
"""
CTE["rfm"] = """
SELECT *, R_score * 100 + F_score * 10 + M_score AS RFM_score, (R_score + F_score + M_score) / 3 AS RFM_composite,
  CASE WHEN R_score >= 4 AND F_score >= 4 THEN 'Champions' WHEN R_score >= 3 AND F_score >= 3 THEN 'Loyal Customers'
    WHEN R_score >= 4 AND F_score <= 2 THEN 'Potential Loyalists' WHEN R_score <= 2 AND F_score >= 3 THEN 'At Risk'
    WHEN R_score <= 2 AND F_score <= 2 THEN 'Hibernating' WHEN R_score = 1 THEN 'Lost' ELSE 'Regular' END AS segment,
  round(monetary / greatest(customer_age_days, 30) * 365 * 0.85::DOUBLE, 2) AS clv_12m
FROM rfm2
"""
CTE["gold0"] = f"""
SELECT customer_id, max(transaction_date) AS last_purchase, count(*) AS frequency, {money("revenue")} AS monetary,
  {mean("revenue")} AS avg_order_value, date_diff('day', max(transaction_date), {SNAP}) AS recency
FROM txn WHERE revenue > 0 GROUP BY customer_id
"""
CTE["gold1"] = """
SELECT *, row_number() OVER (ORDER BY recency, customer_id) AS rr,
  row_number() OVER (ORDER BY frequency, customer_id) AS rf, row_number() OVER (ORDER BY monetary, customer_id) AS rm,
  count(*) OVER () AS n
FROM gold0
"""
CTE["gold2"] = """
SELECT * EXCLUDE (rr, rf, rm, n), CAST(6 - greatest(1, ((rr - 1) * 5 + n - 2) // (n - 1)) AS INT) AS R_score,
  CAST(greatest(1, ((rf - 1) * 5 + n - 2) // (n - 1)) AS INT) AS F_score,
  CAST(greatest(1, ((rm - 1) * 5 + n - 2) // (n - 1)) AS INT) AS M_score
FROM gold1
"""
CTE["gold"] = """
SELECT g.*, R_score * 100 + F_score * 10 + M_score AS RFM_score, R_score + F_score + M_score AS RFM_composite,
  CASE WHEN R_score >= 4 AND F_score >= 4 THEN 'Champions' WHEN R_score >= 3 AND F_score >= 3 THEN 'Loyal'
    WHEN R_score >= 4 AND F_score <= 2 THEN 'Potential Loyalist' WHEN R_score <= 2 AND F_score >= 3 THEN 'At Risk'
    WHEN R_score <= 2 AND F_score <= 2 THEN 'Hibernating' ELSE 'Regular' END AS segment,
  c.acquisition_channel, c.country, c.region
FROM gold2 g LEFT JOIN cust c USING (customer_id)
"""
NAMES = [
    "checkout_redesign",
    "email_personalization",
    "price_discount_5pct",
    "free_shipping_threshold",
    "product_recommendation_algo",
    "push_notification_timing",
    "cart_abandonment_email",
    "homepage_hero_banner",
]
CTE["ses"] = f"""
SELECT event_id AS session_id, ({NAMES!r})[CAST(event_id % 8 AS INT) + 1] AS experiment_name,
  CASE WHEN (event_id // 8) % 2 = 0 THEN 'control' ELSE 'treatment' END AS variant, user_id AS customer_id,
  event_type = 'purchase' AS converted, value AS revenue,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS pre_metric, event_type AS device_type,
  CAST(ts AS DATE) AS session_date, ts
FROM events
"""
DEPENDS = {
    "rfm0": ["txn"],
    "rfm1": ["rfm0"],
    "rfm2": ["rfm1"],
    "rfm": ["rfm2"],
    "gold0": ["txn"],
    "gold1": ["gold0"],
    "gold2": ["gold1"],
    "gold": ["gold2", "cust"],
}


def sql(body: str, *bases: str, **extra: str) -> str:
    """``body`` behind the named shared expressions and further ones given by keyword, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for b in bases:
        add(b)
    ctes = [f"{n} AS ({CTE[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in extra.items()]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
