"""Scores, labels, tiers and money at risk as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellrisk.functions.numeric import col_of, lookup, np_round

# Published weights of the known-logit score.
LOGIT_INTERCEPT = -2.5
LOGIT_CONTRACT = {"month-to-month": 1.5, "one-year": 0.8}
LOGIT_TENURE = -0.02
LOGIT_MONTHLY_CHARGES = 0.015
LOGIT_FIBER = -0.5
LOGIT_CALL_DROPS = 0.04
LOGIT_OUTAGE_PER_10_MIN = 0.03
LOGIT_RSRQ = -0.03
LOGIT_RSRQ_CENTRE = -11.0
LOGIT_ELECTRONIC_CHECK = 0.4
LOGIT_SENIOR = 0.3
LOGIT_SUPPORT_CALL = 0.05

# Lower bounds and colours of the risk tiers, and the usual decision threshold.
TIER_MEDIUM = 0.25
TIER_HIGH = 0.50
TIER_CRITICAL = 0.70
TIER_COLORS = {
    "LOW": "#2ecc71",
    "MEDIUM": "#f39c12",
    "HIGH": "#e74c3c",
    "CRITICAL": "#8e44ad",
}
TIERS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
DEFAULT_THRESHOLD = 0.45


def churn_logit() -> Column:
    """Linear score from the subscriber columns (no noise term, no rate scaling)."""
    contract, internet = F.col("contract_type"), F.col("internet_service")
    return (
        F.lit(LOGIT_INTERCEPT)
        + lookup(contract, LOGIT_CONTRACT, 0.0)
        + F.lit(LOGIT_TENURE) * F.col("tenure_months")
        + F.lit(LOGIT_MONTHLY_CHARGES) * F.col("monthly_charges")
        + F.when(internet == "fiber_optic", F.lit(LOGIT_FIBER)).otherwise(F.lit(0.0))
        + F.lit(LOGIT_CALL_DROPS) * F.col("call_drops_monthly")
        + F.lit(LOGIT_OUTAGE_PER_10_MIN) * F.col("outage_minutes_monthly") / F.lit(10.0)
        + F.lit(LOGIT_RSRQ) * (F.col("rsrq_avg") - F.lit(LOGIT_RSRQ_CENTRE))
        + F.when(
            F.col("payment_method") == "electronic_check", F.lit(LOGIT_ELECTRONIC_CHECK)
        ).otherwise(F.lit(0.0))
        + F.lit(LOGIT_SENIOR) * F.col("senior_citizen")
        + F.lit(LOGIT_SUPPORT_CALL) * F.col("tech_support_calls")
    )


def logit_score(digits: int | None = 4) -> Column:
    """Probability of the logit; `digits=None` leaves it unrounded, for decisions."""
    raw = F.lit(1.0) / (F.lit(1.0) + F.exp(-churn_logit()))
    return raw if digits is None else np_round(raw, digits)


def logit_share() -> Column:
    """The logit on a scale from 0 to 1 by a fraction: orders rows as the probability does, from exact divisions alone."""
    z = churn_logit()
    return F.lit(0.5) + F.lit(0.5) * z / (F.lit(1.0) + F.abs(z))


def label_at(probability: Column | str, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return (col_of(probability) >= F.lit(threshold)).cast("int")


def risk_tier(probability: Column | str) -> Column:
    """Half-open tiers; anything that falls through, NULL included, is CRITICAL."""
    p = col_of(probability)
    return (
        F.when((p >= 0.0) & (p < TIER_MEDIUM), F.lit("LOW"))
        .when((p >= TIER_MEDIUM) & (p < TIER_HIGH), F.lit("MEDIUM"))
        .when((p >= TIER_HIGH) & (p < TIER_CRITICAL), F.lit("HIGH"))
        .otherwise(F.lit("CRITICAL"))
    )


def tier_color(tier: Column | str) -> Column:
    return lookup(tier, TIER_COLORS)


def revenue_at_risk(probability: Column | str, charges: Column | str = "monthly_charges") -> Column:
    return np_round(col_of(charges) * col_of(probability), 2)


def with_predictions(
    df, probability: str = "churn_probability", threshold: float = DEFAULT_THRESHOLD, digits: int | None = None
):
    """Add label, tier and revenue at risk to rows that already carry a probability.

    All three are decided on the probability as it comes; `digits` rounds the shown one afterwards.
    """
    out = df.withColumns(
        {
            "churn_predicted": label_at(probability, threshold),
            "risk_tier": risk_tier(probability),
            "revenue_at_risk": revenue_at_risk(probability),
        }
    )
    return out if digits is None else out.withColumn(probability, np_round(probability, digits))
