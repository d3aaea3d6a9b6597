"""Builds the logical tables (subscribers, towers, points of interest, usage) from the star schema.

Each builder is one lazy plan. `subscribers` takes the columns a caller wants and leaves out the
joins they do not need: without usage there is no scan of `lineitem`, and without order-derived
columns none of `orders`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.functions.numeric import money_sum
from cellrisk.functions.scoring import logit_score
from cellrisk.sources.schemas import STAR

SUBSCRIBER_COLUMNS = [
    "c_custkey", "subscriber_id", "snapshot_date", "contract_type", "payment_method",
    "internet_service", "senior_citizen", "phone_service", "multiple_lines", "international_calls",
    "tenure_months", "monthly_charges", "total_charges", "data_usage_gb", "call_minutes_monthly",
    "sms_monthly", "tech_support_calls", "rsrp_avg", "rsrq_avg", "dl_throughput_mbps",
    "call_drop_rate_pct", "call_drops_monthly", "outage_minutes_monthly", "latitude", "longitude",
    "churn_probability", "churned",
]

_SCORE_INPUTS = {
    "contract_type", "tenure_months", "monthly_charges", "internet_service", "call_drops_monthly",
    "outage_minutes_monthly", "rsrq_avg", "payment_method", "senior_citizen", "tech_support_calls",
}
_FROM_ORDERS = {"tenure_months", "total_charges", "tech_support_calls", "data_usage_gb"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(STAR[name]) if name in STAR else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mixed(key: str, factor: int, modulus: int) -> Column:
    """(key * factor) mod modulus, reduced first so that large keys cannot overflow a bigint."""
    reduced = F.col(key) % F.lit(modulus)
    return (reduced * F.lit(factor % modulus)) % F.lit(modulus)


def _order_facts(spark: SparkSession, sf_dir: str, with_usage: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    aggs = [
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_orderdate").alias("first_order"),
        money_sum("o_totalprice").alias("spend"),
        F.sum((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("urgent"),
    ]
    if with_usage:
        # One row per order before the join, so a long order adds no rows to the shuffle.
        lines = (
            table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty"))
        )
        orders = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        aggs.append(F.sum("qty").alias("qty"))
    return orders.groupBy("o_custkey").agg(*aggs)


def subscribers(
    spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """The subscriber table, or only `columns` of it."""
    wanted = list(columns) if columns is not None else SUBSCRIBER_COLUMNS
    needed = set(wanted)
    if "churned" in needed:
        needed.add("churn_probability")
    if "churn_probability" in needed:
        needed |= _SCORE_INPUTS

    base = table(spark, sf_dir, "customer")
    if needed & _FROM_ORDERS:
        facts = _order_facts(spark, sf_dir, "data_usage_gb" in needed)
        base = base.join(facts, base.c_custkey == facts.o_custkey, "left")

    segment = F.col("c_mktsegment")
    key4, nation = F.col("c_custkey") % 4, F.col("c_nationkey")
    month_index = F.year("first_order") * 12 + F.month("first_order")
    orders_at_least_one = F.greatest(F.coalesce(F.col("n_orders"), F.lit(1)), F.lit(1))
    definitions = {
        "c_custkey": lambda: F.col("c_custkey"),
        "subscriber_id": lambda: F.concat(
            F.lit("SUB_"),
            F.when(F.col("c_custkey") > 9999999, F.col("c_custkey").cast("string")).otherwise(
                F.lpad(F.col("c_custkey").cast("string"), 7, "0")
            ),
        ),
        "snapshot_date": lambda: F.expr("timestamp '2024-01-01 00:00:00'"),
        "contract_type": lambda: F.when(segment.isin("BUILDING", "MACHINERY"), "month-to-month")
        .when(segment == "HOUSEHOLD", "two-year")
        .otherwise("one-year"),
        "payment_method": lambda: F.when(key4 == 0, "electronic_check")
        .when(key4 == 1, "mailed_check")
        .when(key4 == 2, "bank_transfer")
        .otherwise("credit_card"),
        "internet_service": lambda: F.when(nation % 3 == 0, "fiber_optic")
        .when(nation % 3 == 1, "DSL")
        .otherwise("none"),
        "senior_citizen": lambda: (_mixed("c_custkey", 48611, 100) < 16).cast("int"),
        "phone_service": lambda: (F.col("c_custkey") % 10 < 9).cast("int"),
        "multiple_lines": lambda: (F.col("c_custkey") % 2).cast("int"),
        "international_calls": lambda: (F.col("c_custkey") % 25 < 7).cast("int"),
        "tenure_months": lambda: F.coalesce(F.lit(2001 * 12 + 8) - month_index, F.lit(1)).cast("int"),
        "monthly_charges": lambda: F.lit(20.0)
        + ((F.round(F.col("c_acctbal") * 100.0).cast("bigint") + 100000) % 10000) / F.lit(100.0),
        "total_charges": lambda: F.coalesce(F.col("spend"), F.lit(0.0)),
        "data_usage_gb": lambda: F.coalesce(F.col("qty"), F.lit(0.0)) / orders_at_least_one,
        "call_minutes_monthly": lambda: _mixed("c_custkey", 7907, 1201).cast("double"),
        "sms_monthly": lambda: _mixed("c_custkey", 7901, 501).cast("double"),
        "tech_support_calls": lambda: F.coalesce(F.col("urgent"), F.lit(0)).cast("int"),
        "rsrp_avg": lambda: F.lit(-130.0) + _mixed("c_custkey", 104729, 701) / F.lit(10.0),
        "rsrq_avg": lambda: F.lit(-20.0) + _mixed("c_custkey", 15485863, 171) / F.lit(10.0),
        "dl_throughput_mbps": lambda: F.lit(0.5) + _mixed("c_custkey", 611953, 14950) / F.lit(100.0),
        "call_drop_rate_pct": lambda: _mixed("c_custkey", 1299709, 2001) / F.lit(100.0),
        "call_drops_monthly": lambda: _mixed("c_custkey", 179424673, 21).cast("int"),
        "outage_minutes_monthly": lambda: _mixed("c_custkey", 32452843, 301).cast("int"),
        "latitude": lambda: F.lit(-7.0)
        + (nation * 37) % 25 / F.lit(25.0) * F.lit(1.4)
        + _mixed("c_custkey", 7919, 1000) / F.lit(10000.0),
        "longitude": lambda: F.lit(106.4)
        + (nation * 11) % 25 / F.lit(25.0) * F.lit(1.0)
        + _mixed("c_custkey", 6101, 1000) / F.lit(10000.0),
    }
    keep = [c for c in definitions if c in needed or c == "c_custkey"]
    out = base.select(*[definitions[c]().alias(c) for c in keep])
    if "churn_probability" in needed:
        out = out.withColumn("churn_probability", logit_score())
    if "churned" in needed:
        draw = _mixed("c_custkey", 48271, 1000) / F.lit(1000.0)
        out = out.withColumn("churned", (draw < F.col("churn_probability")).cast("int"))
    return out.select(*wanted)


def cell_towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(
            F.lit("TOWER_"),
            F.when(key > 99999, key.cast("string")).otherwise(F.lpad(key.cast("string"), 5, "0")),
        ).alias("tower_id"),
        key.alias("s_suppkey"),
        F.when(key % 3 == 0, "LTE").when(key % 3 == 1, "NR").otherwise("UMTS").alias("radio"),
        F.lit(510).alias("mcc"),
        F.when(key % 3 == 0, 10).when(key % 3 == 1, 8).otherwise(1).alias("mnc"),
        (F.lit(-7.0) + _mixed("s_suppkey", 7919, 1500) / F.lit(1000.0)).alias("latitude"),
        (F.lit(106.4) + _mixed("s_suppkey", 6101, 1100) / F.lit(1000.0)).alias("longitude"),
        F.when(key % 4 == 0, 500)
        .when(key % 4 == 1, 1000)
        .when(key % 4 == 2, 2000)
        .otherwise(5000)
        .alias("range_m"),
        (F.lit(50) + _mixed("s_suppkey", 48611, 4950)).cast("int").alias("samples"),
        F.lit(1672531200).cast("bigint").alias("created"),
        F.lit(1704067200).cast("bigint").alias("updated"),
    )


# Point-of-interest categories.
POI_TYPES = ["shopping", "transport", "education", "healthcare", "recreation", "food_beverage"]


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    kind = F.element_at(F.array(*[F.lit(t) for t in POI_TYPES]), (key % 6 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        key.alias("osm_id"),
        kind.alias("poi_type"),
        F.col("p_name").alias("name"),
        (F.lit(-7.0) + _mixed("p_partkey", 104729, 1500) / F.lit(1000.0)).alias("latitude"),
        (F.lit(106.4) + _mixed("p_partkey", 48611, 1100) / F.lit(1000.0)).alias("longitude"),
    )


def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the half of the observation span they fall into."""
    return table(spark, sf_dir, "events").withColumn(
        "period",
        F.when(F.col("ts") < F.expr("timestamp '2024-01-16 00:00:00'"), "reference").otherwise("current"),
    )


def usage_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        usage_events(spark, sf_dir)
        .groupBy((F.col("user_id") % 5).alias("g"), "period")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum((F.col("event_type") == "error").cast("int")).alias("call_drops"),
            money_sum("value").alias("spend"),
        )
    )
