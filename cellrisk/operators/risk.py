"""Risk grids, tiers, rankings and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.numeric import money_sum, np_round, steady_mean
from cellrisk.functions.scoring import TIER_HIGH, TIERS, risk_tier, tier_color
from cellrisk.operators.ordered import running
from cellrisk.session import checkpointed

MIN_CELL_SIZE = 10
ALERT_TIERS = ["HIGH", "CRITICAL"]


def risk_grid(df: DataFrame, cell: str, min_subscribers: int = MIN_CELL_SIZE) -> DataFrame:
    """Scored rows rolled up per cell; cells below the minimum size are left out.

    Needs `churn_predicted`, `churn_probability` and the network columns; the month-to-month share
    comes from `contract_risk_score` or `contract_type`.
    """
    monthly = (
        F.col("contract_risk_score") == 3
        if "contract_risk_score" in df.columns
        else F.col("contract_type") == "month-to-month"
    )
    grid = (
        df.where(F.col(cell).isNotNull())
        .groupBy(cell)
        .agg(
            F.count(cell).alias("subscriber_count"),
            F.sum(F.col("churn_predicted").cast("bigint")).alias("predicted_churners"),
            np_round(steady_mean("churn_probability"), 4).alias("avg_churn_probability"),
            np_round(steady_mean("rsrq_avg"), 2).alias("avg_rsrq"),
            np_round(steady_mean("dl_throughput_mbps"), 2).alias("avg_throughput"),
            np_round(steady_mean("monthly_charges"), 2).alias("avg_monthly_charges"),
            np_round(steady_mean("outage_minutes_monthly"), 1).alias("avg_outage_minutes"),
            np_round(steady_mean(F.coalesce(monthly, F.lit(False)).cast("int")), 3).alias("pct_month_to_month"),
        )
        .filter(F.col("subscriber_count") >= min_subscribers)
    )
    return grid.withColumns(
        {
            "predicted_churn_rate": np_round(F.col("predicted_churners") / F.col("subscriber_count"), 4),
            "estimated_revenue_at_risk": np_round(
                F.col("avg_monthly_charges") * F.col("predicted_churners"), 2
            ),
        }
    )


def with_tier(grid: DataFrame, probability: str = "avg_churn_probability") -> DataFrame:
    tiered = grid.withColumn("risk_tier", risk_tier(probability))
    return tiered.withColumn("color", tier_color("risk_tier"))


def observed_grid(df: DataFrame, cell: str, min_subscribers: int = MIN_CELL_SIZE) -> DataFrame:
    """Observed label rate per cell with revenue at risk = total charges x rate."""
    grid = (
        df.where(F.col(cell).isNotNull())
        .groupBy(cell)
        .agg(
            F.count(cell).alias("n_subscribers"),
            F.sum(F.col("churned").cast("bigint")).alias("n_churned"),
            np_round(steady_mean("churned"), 6).alias("churn_rate"),
            np_round(steady_mean("rsrq_avg"), 6).alias("avg_rsrq"),
            np_round(steady_mean("dl_throughput_mbps"), 6).alias("avg_throughput"),
            np_round(steady_mean("monthly_charges"), 6).alias("avg_monthly_charges"),
            np_round(steady_mean("outage_minutes_monthly"), 6).alias("avg_outage"),
            money_sum("monthly_charges").alias("total_monthly_revenue"),
        )
        .filter(F.col("n_subscribers") >= min_subscribers)
    )
    share = F.col("n_churned") / F.col("n_subscribers")
    return grid.withColumn("revenue_at_risk", np_round(F.col("total_monthly_revenue") * share, 4))


def top_k(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """Largest `k` rows; ties go to the smaller key. Each task keeps its own `k` rows only."""
    return df.orderBy(F.col(value).desc_nulls_last(), F.col(key)).limit(k)


def ranked_zones(df: DataFrame, value: str, key: str, k: int = 20) -> DataFrame:
    """The top rows numbered Zone 1, Zone 2, ... The unpartitioned window sees `k` rows."""
    top = top_k(df, value, key, k)
    number = F.row_number().over(Window.orderBy(F.col(value).desc_nulls_last(), F.col(key)))
    return top.withColumn("zone", F.concat(F.lit("Zone "), number.cast("string")))


def zone_report(grid: DataFrame, cell: str, k: int = 20) -> DataFrame:
    """Formatted table of the `k` cells with most revenue at risk."""
    top = ranked_zones(grid, "revenue_at_risk", cell, k)
    percent = F.format_string("%.1f%%", np_round(F.col("churn_rate") * 100.0, 1))
    whole_dollars = F.concat(F.lit("$"), np_round("revenue_at_risk", 0).cast("bigint").cast("string"))
    return top.select(
        "zone",
        F.col(cell).alias("cell"),
        F.col("n_subscribers").alias("subscribers"),
        percent.alias("churn_rate"),
        np_round("avg_rsrq", 1).alias("avg_rsrq_db"),
        np_round("avg_outage", 0).cast("bigint").alias("avg_outage_min"),
        whole_dollars.alias("monthly_revenue_at_risk"),
    )


def risk_alerts(grid: DataFrame, cell: str, k: int = 50, tiers: Sequence[str] = ALERT_TIERS) -> DataFrame:
    """Cells in the alert tiers, by revenue, each with the number and revenue of all such cells."""
    alerts = with_tier(grid).drop("color").filter(F.col("risk_tier").isin(*tiers))
    totals = alerts.agg(
        F.count(F.lit(1)).alias("alert_zones"),
        money_sum("estimated_revenue_at_risk").alias("alert_revenue"),
    )
    return top_k(alerts, "estimated_revenue_at_risk", cell, k).withColumns(
        {c: totals.select(c).scalar() for c in ("alert_zones", "alert_revenue")}
    )


def tier_breakdown(df: DataFrame, tier: str, revenue: str) -> DataFrame:
    """Rows, share and revenue per tier; a tier without rows shows zeros."""
    spark = df.sparkSession
    found = df.groupBy(tier).agg(F.count(F.lit(1)).alias("n"), money_sum(revenue).alias("revenue"))
    total = F.sum("n").over(Window.partitionBy())
    names = spark.range(len(TIERS)).select(
        F.element_at(F.array(*[F.lit(t) for t in TIERS]), (F.col("id") + 1).cast("int")).alias(tier)
    )
    filled = names.join(found, tier, "left").select(
        tier,
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
    )
    return filled.withColumn("share_pct", np_round(F.try_divide(F.col("n") * F.lit(100.0), total), 1))


def high_risk_count(df: DataFrame, tier: str = "risk_tier", probability: str = "churn_probability") -> DataFrame:
    return df.agg(
        F.count_if(F.col(tier).isin(*ALERT_TIERS)).alias("high_or_critical"),
        F.count_if(F.col(probability) >= F.lit(TIER_HIGH)).alias("probability_at_least_half"),
    )


def highest_risk(df: DataFrame, key: str, probability: str = "churn_probability") -> DataFrame:
    """The whole row with the highest probability, smallest key first among ties."""
    return df.orderBy(F.col(probability).desc_nulls_last(), F.col(key)).limit(1)


def concentration(cells: DataFrame, rows: DataFrame, key: str, share: float = 0.2, label: str = "churned") -> DataFrame:
    """Share of all positives that sits in the top `share` of the kept cells, by rate.

    The cut is found from the rate distribution: cells are counted per distinct rate (few, rounded
    values), and only the cells at the cutting rate are numbered, by key, in no single task.
    """
    cells = checkpointed(cells.select(key, "churn_rate", "n_churned"))
    by_rate = cells.groupBy("churn_rate").agg(
        F.count(F.lit(1)).alias("cells_at"), F.sum("n_churned").alias("churned_at")
    )
    descending = Window.orderBy(F.col("churn_rate").desc())
    steps = by_rate.withColumns(
        {
            "cells_before": F.coalesce(
                F.sum("cells_at").over(descending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
            "kept": F.floor(F.sum("cells_at").over(Window.partitionBy()) * F.lit(share)),
        }
    )
    full = steps.filter(F.col("cells_before") + F.col("cells_at") <= F.col("kept"))
    partial = steps.filter(
        (F.col("cells_before") < F.col("kept")) & (F.col("cells_before") + F.col("cells_at") > F.col("kept"))
    ).select("churn_rate", (F.col("kept") - F.col("cells_before")).alias("take"))
    # One cutting rate at most; its cells are numbered by ranges of the key with carried offsets.
    tied = cells.join(F.broadcast(partial), "churn_rate").withColumn("one", F.lit(1))
    partial_churned = (
        running(tied, [F.col(key)], {"rn": "one"})
        .filter(F.col("rn") <= F.col("take"))
        .agg(F.coalesce(F.sum("n_churned"), F.lit(0)).alias("partial_churned"))
    )
    full_churned = full.agg(F.coalesce(F.sum("churned_at"), F.lit(0)).alias("full_churned"))
    total = rows.agg(F.sum(F.col(label).cast("bigint")).alias("total_churned"))
    top = F.col("full_churned") + F.col("partial_churned")
    return (
        cells.agg(F.count(F.lit(1)).alias("n_cells"))
        .withColumns(
            {
                "full_churned": full_churned.scalar(),
                "partial_churned": partial_churned.scalar(),
                "total_churned": total.scalar(),
            }
        )
        .select(
            "n_cells",
            F.floor(F.col("n_cells") * F.lit(share)).alias("top_cells"),
            top.alias("top_churned"),
            "total_churned",
            np_round(top / (F.col("total_churned") + F.lit(1e-10)), 6).alias("concentration"),
        )
    )


def heat_points(df: DataFrame, weight: str, key: str) -> DataFrame:
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        key, "latitude", "longitude", F.col(weight).alias("weight")
    )


def map_center(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.agg(
        np_round(steady_mean("latitude"), digits).alias("center_lat"),
        np_round(steady_mean("longitude"), digits).alias("center_lon"),
    )

