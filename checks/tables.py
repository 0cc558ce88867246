"""Cleaning, quality checks, formulas, point-in-time lookups, control charts and scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartwright.functions import exact_sum, surrogate_key
from cartwright.operators import cleaning as C
from cartwright.operators import quality as Q
from cartwright.operators import scenarios as W
from cartwright.operators import segments as S
from cartwright.operators import timeline as L
from cartwright.plans import medallion
from cartwright.session import scratch_path
from cartwright.sources import testtables as T
from checks.reports import scored
from checks.sqlbase import mean, money, sql

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def raw_customers(spark, d):
    """Every customer twice, the second time with the e-mail in capitals."""
    base = T.customers(spark, d)
    return base.unionByName(base.withColumn("email", F.upper("email")))


@query(
    "clean_customers",
    sql(
        "SELECT customer_id, lower(trim(email)) AS email, country, region, acquisition_channel, balance FROM cust", "cust"
    ),
)
def _(spark, d):
    return C.clean_customers(raw_customers(spark, d))


# Line numbers repeat within an order here, so a line is what its order, number, product and amounts say.
LINE_KEY = ["order_id", "line_number", "product_id", "quantity", "revenue"]
LINE = ["order_id", "line_number", "customer_id", "product_id", "transaction_date", "quantity", "revenue"]


def raw_lines(spark, d):
    """Every order line twice; the lines are joined once, not once per copy."""
    lines = T.transactions(spark, d).select(*LINE)
    return lines.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")


@query(
    "clean_transactions",
    sql(
        f"""SELECT DISTINCT {", ".join(LINE)} FROM txn
        WHERE revenue > 0 AND transaction_date <= TIMESTAMP '2000-12-31'""",
        "txn",
    ),
)
def _(spark, d):
    out = C.clean_transactions(raw_lines(spark, d), "2000-12-31", LINE_KEY)
    return out.withColumn("transaction_date", F.col("transaction_date").cast("timestamp_ntz"))


@query(
    "medallion_gold",
    sql("SELECT * FROM gold", "gold"),
)
def _(spark, d):
    out = scratch_path(spark, "medallion")
    medallion.run(spark, raw_customers(spark, d), T.products(spark, d), raw_lines(spark, d), out, T.SNAPSHOT, LINE_KEY)
    scored = spark.read.parquet(f"{out}/gold/rfm_segmented")
    return scored.withColumn("last_purchase", F.col("last_purchase").cast("timestamp_ntz"))


def cents(x):
    return f"CAST(round(CAST({x} AS DECIMAL(20,6)), 2) AS DOUBLE)"


@query(
    "priced_order_lines",
    f"""SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
    {cents("p_retailprice * (1 - l_discount)")} AS final_price,
    {cents("p_retailprice * (1 - l_discount) * l_quantity")}
      * (CASE WHEN l_returnflag = 'R' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END) AS revenue,
    {cents("round(p_retailprice * 0.6::DOUBLE, 2) * l_quantity")} AS cogs,
    {cents("(p_retailprice * (1 - l_discount) - round(p_retailprice * 0.6::DOUBLE, 2)) * l_quantity")} AS gross_profit,
    round(1 + 0.3::DOUBLE * sin((month(o_orderdate) - 3) * 3.141592653589793::DOUBLE / 6), 3) AS seasonality_factor
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
)
def _(spark, d):
    prices = T.products(spark, d).select("product_id", "unit_price")
    lines = T.transactions(spark, d).select(
        "order_id", "line_number", "product_id", "discount_pct", "quantity", "is_returned", "transaction_date"
    )
    priced = C.price_lines(lines.join(prices, "product_id").withColumn("unit_cost", F.round(F.col("unit_price") * 0.6, 2)))
    return priced.select(
        "order_id", "line_number", "product_id", "final_price", "revenue", "cogs", "gross_profit", "seasonality_factor"
    )


@query(
    "quality_customers",
    """SELECT * FROM (VALUES ('customer_id', 'type bigint'), ('customer_id', 'null values'),
      ('customer_id', 'duplicate values'), ('email', 'type string'), ('email', 'null values'),
      ('registration_date', 'missing column'), ('acquisition_channel', 'type string'),
      ('acquisition_channel', 'value not in list')) AS t("column", "check"),
    LATERAL (SELECT count(*) * 2 AS n_records, CASE WHEN "check" = 'duplicate values' THEN count(*)
      WHEN "check" = 'value not in list' THEN count(*) * 2 WHEN "check" = 'missing column' THEN 1 ELSE 0 END AS failures
      FROM customer)""",
)
def _(spark, d):
    return Q.check_table(raw_customers(spark, d), Q.CUSTOMER_RULES)


QT = """SELECT * FROM (VALUES ('order_id', 'null values'), ('customer_id', 'null values'),
  ('transaction_date', 'future dates'), ('revenue', 'null values'), ('revenue', 'non-positive values')) AS t("column", "check"),
  LATERAL (SELECT count(*) AS n_records, CASE WHEN "check" = 'non-positive values' THEN count(*) FILTER (revenue <= 0)
  WHEN "check" = 'future dates' THEN count(*) FILTER (transaction_date > TIMESTAMP '2001-01-01') ELSE 0 END AS failures
  FROM txn)"""


@query("quality_transactions", sql(QT, "txn"))
def _(spark, d):
    return Q.check_table(T.transactions(spark, d), Q.transaction_rules("2001-01-01"))


@query(
    "quality_verdict",
    sql(
        """SELECT false AS valid, 'Column revenue failed: non-positive values; Column transaction_date failed: future dates'
        AS issues, count(*) AS n_records FROM txn HAVING count(*) FILTER (revenue <= 0) > 0
        AND count(*) FILTER (transaction_date > TIMESTAMP '2001-01-01') > 0""",
        "txn",
    ),
)
def _(spark, d):
    out = Q.verdict(Q.check_table(T.transactions(spark, d), Q.transaction_rules("2001-01-01")))
    return out.withColumn("issues", F.array_join("issues", "; "))


@query(
    "non_positive_rows",
    sql("SELECT order_id, line_number, product_id, revenue FROM txn WHERE revenue <= 0", "txn"),
)
def _(spark, d):
    return Q.non_positive_rows(T.transactions(spark, d), "revenue").select(
        "order_id", "line_number", "product_id", "revenue"
    )


@query(
    "out_of_range_rows",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate < '1996-01-01' OR o_orderdate > '2000-12-31'",
)
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    low, high = (F.lit(x).cast("timestamp_ntz") for x in ("1996-01-01", "2000-12-31"))
    return Q.out_of_range_rows(orders, "o_orderdate", low, high).select("o_orderkey", "o_custkey")


@query(
    "orphan_rows",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey")
    return Q.orphan_rows(orders, "o_orderkey", spark.read.parquet(f"{d}/lineitem.parquet"), "l_orderkey")


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, d):
    return Q.duplicate_keys(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query("customer_sample")
def _(spark, d):
    return C.at_most(T.customers(spark, d), 300, "customer_id")


@query(
    "surrogate_keys",
    "SELECT c_custkey, md5(c_custkey::VARCHAR || '-' || c_mktsegment) AS key FROM customer",
)
def _(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet").select(
        "c_custkey", surrogate_key("c_custkey", "c_mktsegment").alias("key")
    )


@query(
    "segment_formulas",
    sql(
        """SELECT customer_id, segment, date_diff('day', last_purchase::DATE, DATE '2001-08-02')::INT AS recency_days,
        avg_order_value * frequency * 0.3::DOUBLE * (12 / 12.0::DOUBLE) AS simple_clv,
        coalesce(multiplier, 0.7::DOUBLE) AS multiplier, coalesce(priority, 3) AS priority
        FROM rfm LEFT JOIN (VALUES ('Champions', 1.5::DOUBLE, 1), ('Loyal Customers', 1.2, 2),
          ('Potential Loyalists', 1.0, 3), ('At Risk', 0.5, 4), ('Hibernating', 0.3, 5), ('Lost', 0.1, 6),
          ('Regular', 0.7, 3)) AS t(segment, multiplier, priority) USING (segment)""",
        "rfm",
    ),
)
def _(spark, d):
    rfm = scored(spark, d).select("customer_id", "segment", "last_purchase", "avg_order_value", "frequency")
    clv = S.simple_clv(F.col("avg_order_value"), F.col("frequency"), F.lit(0.3), F.lit(12))
    return S.with_segment_metrics(rfm).select(
        "customer_id",
        "segment",
        S.recency_days(F.to_date("last_purchase"), F.lit(T.SNAPSHOT).cast("date")).alias("recency_days"),
        clv.alias("simple_clv"),
        "multiplier",
        "priority",
    )


@query(
    "as_of_features",
    """WITH f AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    g AS (SELECT user_id, ts AS at, value, event_id AS view_id FROM events WHERE event_type = 'view')
    SELECT f.event_id, f.user_id, f.ts, g.at AS feature_time, g.value, g.view_id
    FROM f ASOF LEFT JOIN g ON f.user_id = g.user_id AND f.ts >= g.at""",
)
def _(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    facts = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.filter("event_type = 'view'").select(
        "user_id", F.col("ts").alias("at"), "value", F.col("event_id").alias("view_id")
    )
    out = L.as_of_join(facts, views, "user_id", "ts", "at")
    return out.withColumn("feature_time", F.col("feature_time").cast("timestamp_ntz"))


CUSUM = {
    "day": f"SELECT category, transaction_date::DATE AS d, {money('revenue')} AS v FROM txn WHERE revenue > 0 GROUP BY 1, 2",
    "num": "SELECT *, row_number() OVER (PARTITION BY category ORDER BY d) AS no FROM day",
    "base": "SELECT category, avg(v) AS mu, stddev_samp(v) AS sd FROM num WHERE no <= 50 GROUP BY 1",
    "zed": "SELECT category, d, v, (v - mu) / sd AS z FROM num JOIN base USING (category)",
    "run": """SELECT *, sum(z - 0.5::DOUBLE) OVER w AS up, sum(-z - 0.5::DOUBLE) OVER w AS dn FROM zed
      WINDOW w AS (PARTITION BY category ORDER BY d ROWS UNBOUNDED PRECEDING)""",
    "cus": """SELECT *, up - least(0, min(up) OVER w) AS su, dn - least(0, min(dn) OVER w) AS sl FROM run
      WINDOW w AS (PARTITION BY category ORDER BY d ROWS UNBOUNDED PRECEDING)""",
}


@query(
    "revenue_cusum",
    sql(
        """SELECT category, d AS date, v AS revenue, round(su, 6) AS cusum_upper, round(sl, 6) AS cusum_lower,
        round(z, 6) AS deviation, su > 5 OR sl > 5 AS is_anomaly,
        CASE WHEN su > 5 THEN 'increase' WHEN sl > 5 THEN 'decrease' END AS anomaly_type FROM cus""",
        "txn",
        **CUSUM,
    ),
)
def _(spark, d):
    daily = (
        T.transactions(spark, d, with_category=True)
        .filter("revenue > 0")
        .groupBy("category", F.to_date("transaction_date").alias("date"))
        .agg(exact_sum("revenue").alias("revenue"))
    )
    out = L.cusum(daily, ["category"], "date", "revenue")
    return out.withColumns({c: F.round(c, 6) for c in ("cusum_upper", "cusum_lower", "deviation")})


@query(
    "scenario_segment_conversion",
    sql(
        """SELECT a.segment AS from_segment, b.segment AS to_segment, rate AS conversion_rate,
        round(a.n * rate, 6) AS customers_converted, round(b.clv - a.clv, 6) AS clv_lift_per_customer,
        round(a.n * rate * (b.clv - a.clv), 4) AS annual_revenue_impact
        FROM (VALUES ('At Risk', 'Loyal Customers', 0.10::DOUBLE), ('Hibernating', 'At Risk', 0.05)) AS s(f, t, rate)
        JOIN m a ON a.segment = f JOIN m b ON b.segment = t""",
        "rfm",
        m=f"SELECT segment, count(*) AS n, {mean('clv_12m')} AS clv FROM rfm GROUP BY 1",
    ),
)
def _(spark, d):
    asked = [("At Risk", "Loyal Customers", 0.10), ("Hibernating", "At Risk", 0.05)]
    scenarios = spark.createDataFrame(asked, "from_segment string, to_segment string, conversion_rate double")
    out = W.segment_conversions(scored(spark, d), scenarios)
    out = out.withColumns({c: F.round(c, 6) for c in ("customers_converted", "clv_lift_per_customer")})
    return out.withColumn("annual_revenue_impact", F.round("annual_revenue_impact", 4))


@query(
    "scenario_churn_reduction",
    sql(
        f"""SELECT round(count(*) * 0.25::DOUBLE, 6) AS customers_retained,
        round(count(*) * 0.25::DOUBLE * {mean("clv_12m")}, 4) AS annual_revenue_impact
        FROM rfm WHERE segment IN ('At Risk', 'Hibernating')""",
        "rfm",
    ),
)
def _(spark, d):
    out = W.churn_reduction(scored(spark, d), 0.25, ["At Risk", "Hibernating"])
    return out.select(F.round("customers_retained", 6).alias("customers_retained"),
                      F.round("annual_revenue_impact", 4).alias("annual_revenue_impact"))


@query(
    "scenario_price_change",
    sql(
        """SELECT category, round(r, 2) AS affected_revenue, round(r * (1.05::DOUBLE * 0.96::DOUBLE - 1), 2) AS revenue_change,
        round(r * (1.05::DOUBLE * 0.96::DOUBLE - 1) - c * (0.96::DOUBLE - 1), 2) AS profit_change FROM m""",
        "txn",
        m=f"SELECT category, {money('revenue')} AS r, {money('cogs')} AS c FROM txn WHERE revenue > 0 GROUP BY 1",
    ),
)
def _(spark, d):
    return W.price_change(T.transactions(spark, d, with_category=True), 0.05, elasticity=-0.8)
