"""Typed table contracts and column-name aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType,
    "int": T.IntegerType,
    "double": T.DoubleType,
    "string": T.StringType,
    "boolean": T.BooleanType,
    "date": T.DateType,
    "timestamp": T.TimestampType,
}


def _struct(spec: str) -> T.StructType:
    """Contract from ``name type, ...``; unlike ``fromDDL`` it needs no running session."""
    fields = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]()) for name, kind in fields])


CUSTOMERS = _struct(
    "customer_id bigint, email string, first_name string, last_name string, age int, gender string, city string,"
    " state string, country string, region string, registration_date date, acquisition_channel string,"
    " income_bracket string, true_segment string, is_email_opted_in boolean, is_push_opted_in boolean"
)
PRODUCTS = _struct(
    "product_id bigint, product_name string, category string, subcategory string, brand string, unit_price double,"
    " unit_cost double, margin_pct double, weight_kg double, is_active boolean, launch_date date, avg_rating double,"
    " review_count int"
)
TRANSACTIONS = _struct(
    "order_id bigint, customer_id bigint, product_id bigint, category string, transaction_date timestamp,"
    " quantity double, unit_price double, discount_pct double, final_price double, revenue double, cogs double,"
    " gross_profit double, payment_method string, device_type string, is_returned boolean, return_reason string,"
    " seasonality_factor double"
)
WEB_SESSIONS = _struct(
    "session_id bigint, experiment_name string, variant string, customer_id bigint, converted boolean,"
    " revenue double, time_on_site_sec int, pages_viewed int, bounce boolean, device_type string, session_date date"
)
RFM_SEGMENTS = _struct(
    "customer_id bigint, last_purchase timestamp, first_purchase timestamp, recency bigint, frequency bigint,"
    " monetary double, avg_order_value double, total_items double, distinct_categories int, customer_age_days bigint,"
    " purchase_rate double, avg_items_per_order double, log_recency double, log_frequency double,"
    " log_monetary double, R_score int, F_score int, M_score int, RFM_score int, RFM_composite double,"
    " segment string, clv_12m double"
)
SEGMENT_PROFILES = _struct(
    "segment string, n_customers bigint, avg_recency double, avg_frequency double, avg_monetary double,"
    " avg_aov double, avg_rfm_score double"
)
AB_TEST_RESULTS = _struct(
    "experiment_name string, description string, metric_type string, n_control bigint, n_treatment bigint,"
    " control_mean double, treatment_mean double, absolute_lift double, relative_lift double, p_value_ttest double,"
    " p_value_adjusted double, observed_power double, required_sample_size bigint,"
    " bayesian_prob_treatment_better double, is_significant boolean, is_practical boolean, recommendation string"
)
CONTRACTS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "transactions": TRANSACTIONS,
    "web_sessions": WEB_SESSIONS,
    "rfm_segments": RFM_SEGMENTS,
    "segment_profiles": SEGMENT_PROFILES,
    "ab_test_results": AB_TEST_RESULTS,
}
PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "transactions": ["order_id", "line_number"],
    "web_sessions": ["session_id"],
    "rfm_segments": ["customer_id"],
    "segment_profiles": ["segment"],
    "ab_test_results": ["experiment_name"],
}

# Accepted names per canonical column, first match wins.
ALIASES = {
    "order_id": ("order_id", "transaction_id"),
    "revenue": ("total_amount", "revenue"),
    "transaction_date": ("order_date", "transaction_date"),
}


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project to the contract: cast what is there, null for what is missing."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.fields
        ]
    )


def line_key(columns: list[str]) -> list[str]:
    """What identifies a line: its own id, else order and line number; one row an order where neither is there."""
    if "transaction_id" in columns and "order_id" in columns:
        return ["transaction_id"]
    return [c for c in PRIMARY_KEYS["transactions"] if c in columns]


def resolve_aliases(df: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """Rename whichever accepted spelling is present to the canonical column name.

    A line id beside a real order id stays a column of its own; it stands for the order only where there is no other.
    """
    have, renames = set(df.columns), {}
    for canonical, names in aliases.items():
        present = next((n for n in names if n in have), None)
        if present and present != canonical:
            if canonical in have:
                df = df.drop(canonical)
            renames[present] = canonical
    return df.withColumnsRenamed(renames)
