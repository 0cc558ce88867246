"""The star-schema test tables seen as commerce tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "2001-08-02"  # the day after the last order, in place of "now"
COGS_SHARE = 0.6  # cost of goods as a share of list price; the test tables carry no cost

# Experiment names and the metric each one is judged by.
EXPERIMENTS = [
    ("checkout_redesign", "conversion_rate"),
    ("email_personalization", "click_through_rate"),
    ("price_discount_5pct", "conversion_rate"),
    ("free_shipping_threshold", "average_order_value"),
    ("product_recommendation_algo", "revenue_per_session"),
    ("push_notification_timing", "open_rate"),
    ("cart_abandonment_email", "recovery_rate"),
    ("homepage_hero_banner", "engagement_rate"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return (
        _table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@Example.COM ")).alias("email"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("acquisition_channel"),
            F.col("c_acctbal").alias("balance"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("unit_price"),
    )


def transactions(spark: SparkSession, sf_dir: str, with_category: bool = False) -> DataFrame:
    """Order lines with customer, date and money columns; ``with_category`` adds the product join."""
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    sign = F.when(F.col("l_returnflag") == "R", -1.0).otherwise(1.0)
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount")) * sign
    cogs = F.col("l_extendedprice") * COGS_SHARE
    month = F.month("o_orderdate")
    out = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("timestamp").alias("transaction_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("list_amount"),
        F.col("l_discount").alias("discount_pct"),
        revenue.alias("revenue"),
        cogs.alias("cogs"),
        (revenue - cogs).alias("gross_profit"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_linestatus").alias("device_type"),
        (F.col("l_returnflag") == "R").alias("is_returned"),
        F.round(1 + 0.3 * F.sin((month - 3) * F.lit(3.141592653589793) / 6), 3).alias("seasonality_factor"),
    )
    if with_category:
        catalogue = products(spark, sf_dir).select("product_id", "category")
        out = out.join(catalogue, "product_id")
    return out


def experiment_config(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXPERIMENTS, "experiment_name string, metric string").withColumn(
        "description", F.concat(F.lit("Test on "), F.replace("metric", F.lit("_"), F.lit(" ")))
    )


def web_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_sessions_from(_table(spark, sf_dir, "events"))


def web_sessions_from(events: DataFrame) -> DataFrame:
    """Events split over the eight experiments and two arms by event id."""
    names = F.array(*[F.lit(name) for name, _ in EXPERIMENTS])
    return events.select(
        F.col("event_id").alias("session_id"),
        names[F.pmod("event_id", F.lit(8)).cast("int")].alias("experiment_name"),
        F.when(F.pmod(F.floor(F.col("event_id") / 8), F.lit(2)) == 0, "control")
        .otherwise("treatment")
        .alias("variant"),
        F.col("user_id").alias("customer_id"),
        (F.col("event_type") == "purchase").alias("converted"),
        F.col("value").alias("revenue"),
        F.get_json_object("props", "$.k").cast("double").alias("pre_metric"),
        F.col("event_type").alias("device_type"),
        F.to_date("ts").alias("session_date"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
