"""Subscriber and network features, as column expressions and as pipeline stages."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.functions.numeric import clip, cut, flag, lookup, np_round, ratio

INF = float("inf")

# Bin edges, labels, thresholds and weights of the feature definitions.
TENURE_BINS = ([0, 3, 12, 24, 48, 200], ["0-3m", "3-12m", "12-24m", "24-48m", "48m+"])
CHARGE_BINS = ([0, 30, 50, 75, 100, 200], ["<30", "30-50", "50-75", "75-100", "100+"])
RSRQ_BINS = ([-INF, -15, -12, -9, INF], ["poor", "fair", "good", "excellent"])
RSRP_BINS = (
    [-INF, -110, -100, -90, -80, INF],
    ["very_poor", "poor", "fair", "good", "excellent"],
)
DROP_BINS = ([0, 1, 3, 5, 10, 100], ["<1%", "1-3%", "3-5%", "5-10%", "10%+"])
OUTAGE_BINS = (
    [0, 15, 30, 60, 120, 1000],
    ["<15min", "15-30min", "30-60min", "1-2hr", "2hr+"],
)
TENURE_GROUP_BINS = ([0, 6, 12, 24, 48, 100], ["0-6m", "6-12m", "12-24m", "24-48m", "48m+"])
CONTRACT_RISK = {"month-to-month": 3, "one-year": 2, "two-year": 1}
CONTRACT_RISK_DEFAULT = 2
NEW_SUBSCRIBER_MONTHS, LONG_TERM_MONTHS = 3, 24
HIGH_SUPPORT_CALLS, HIGH_DROP_RATE, HIGH_OUTAGE_MINUTES = 3, 5.0, 60
RSRQ_RANGE, RSRP_RANGE, THROUGHPUT_REFERENCE = (-20.0, -3.0), (-130.0, -60.0), 150.0
QUALITY_WEIGHTS = (0.40, 0.35, 0.25)


def subscriber_features(df: DataFrame, include_lowest: bool = False) -> DataFrame:
    """Tenure, charge, usage, contract and support features."""
    return df.withColumns(
        {
            "is_new_subscriber": flag(F.col("tenure_months") <= NEW_SUBSCRIBER_MONTHS),
            "is_long_term": flag(F.col("tenure_months") >= LONG_TERM_MONTHS),
            "tenure_bucket": cut("tenure_months", *TENURE_BINS, include_lowest=include_lowest),
            "charge_per_month_tenure": ratio("total_charges", "tenure_months", 2),
            "monthly_charge_bucket": cut("monthly_charges", *CHARGE_BINS, include_lowest=include_lowest),
            "data_charge_ratio": ratio("data_usage_gb", "monthly_charges", 4),
            "call_intensity": ratio("call_minutes_monthly", "tenure_months", 2),
            "contract_risk_score": lookup("contract_type", CONTRACT_RISK, CONTRACT_RISK_DEFAULT),
            "is_high_support": flag(F.col("tech_support_calls") >= HIGH_SUPPORT_CALLS),
            "support_per_month": ratio("tech_support_calls", "tenure_months", 4),
        }
    )


def network_quality_score():
    """0 to 100, higher is better; each indicator is clipped to its range first."""
    low_q, high_q = RSRQ_RANGE
    low_p, high_p = RSRP_RANGE
    rsrq = (clip("rsrq_avg", low_q, high_q) - F.lit(low_q)) / F.lit(high_q - low_q)
    rsrp = (clip("rsrp_avg", low_p, high_p) - F.lit(low_p)) / F.lit(high_p - low_p)
    throughput = F.log1p("dl_throughput_mbps") / F.log1p(F.lit(THROUGHPUT_REFERENCE))
    wq, wp, wt = (F.lit(w) for w in QUALITY_WEIGHTS)
    return np_round((rsrq * wq + rsrp * wp + throughput * wt) * F.lit(100.0), 1)


def network_features(df: DataFrame, include_lowest: bool = False) -> DataFrame:
    """Signal buckets, quality score, drop and outage features, frustration index."""
    scored = df.withColumns(
        {
            "rsrq_quality": cut("rsrq_avg", *RSRQ_BINS),
            "rsrp_quality": cut("rsrp_avg", *RSRP_BINS),
            "network_quality_score": network_quality_score(),
            "is_high_drop_rate": flag(F.col("call_drop_rate_pct") > HIGH_DROP_RATE),
            "drop_rate_bucket": cut("call_drop_rate_pct", *DROP_BINS, include_lowest=include_lowest),
            "is_high_outage": flag(F.col("outage_minutes_monthly") > HIGH_OUTAGE_MINUTES),
            "outage_bucket": cut("outage_minutes_monthly", *OUTAGE_BINS, include_lowest=include_lowest),
        }
    )
    index = (
        F.col("call_drops_monthly") * F.lit(2.0)
        + F.col("outage_minutes_monthly") / F.lit(30.0)
        + F.col("is_high_drop_rate") * F.lit(3.0)
        + (F.lit(100.0) - F.col("network_quality_score")) / F.lit(20.0)
    )
    return scored.withColumn("network_frustration_index", np_round(index, 2))


def all_features(df: DataFrame, include_lowest: bool = False) -> DataFrame:
    return network_features(subscriber_features(df, include_lowest), include_lowest)


class SubscriberFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """`subscriber_features` as a stateless pipeline stage."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return subscriber_features(dataset)


class NetworkFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """`network_features` as a stateless pipeline stage."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return network_features(dataset)
