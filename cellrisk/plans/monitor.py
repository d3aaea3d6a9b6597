"""The weekly run: validate, score, roll up, check drift, and say whether to retrain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrisk.functions.scoring import with_predictions
from cellrisk.operators import drift, quality, risk


def weekly_report(
    scored: DataFrame, is_reference: Column, features: Sequence[str] = drift.DRIFT_FEATURES, min_rows: int = quality.MIN_ROWS
) -> DataFrame:
    """One row: the quality gate, high-risk counts, highest stability index and the retrain decision."""
    suite = quality.subscriber_suite(scored, min_rows).summary()
    counts = risk.high_risk_count(with_predictions(scored))
    drifted = drift.drift_report(drift.psi_tagged(scored, is_reference, features))
    return drifted.withColumns(
        {
            **{c: suite.select(c).scalar() for c in ("n_errors", "ok")},
            **{c: counts.select(c).scalar() for c in counts.columns},
        }
    )


def run(scored: DataFrame, is_reference: Column, **options) -> tuple[DataFrame, bool]:
    """The report and whether to retrain. A failed quality gate stops the run."""
    report = weekly_report(scored, is_reference, **options)
    row = report.first()
    if not row["ok"]:
        raise ValueError(f"data validation failed: {row['n_errors']} rules")
    return report, bool(row["retrain"])


def summary(scored: DataFrame) -> DataFrame:
    """Counts, predicted rate and revenue at risk of a scored table, and its tiers."""
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("churn_predicted").cast("bigint")).alias("predicted"),
        F.sum(F.col("revenue_at_risk").cast("decimal(18,2)")).cast("double").alias("revenue_at_risk"),
    )
