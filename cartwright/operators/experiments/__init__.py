"""Experiment evaluation: data shrinks to one row per experiment in Spark, closed forms finish on those rows."""

ALPHA = 0.05
POWER = 0.80
MDE = 0.05
Z_975 = 1.959963984540054
# Metrics judged as proportions; any other metric is continuous.
PROPORTION_METRICS = ["conversion_rate", "click_through_rate", "open_rate", "recovery_rate", "engagement_rate"]
