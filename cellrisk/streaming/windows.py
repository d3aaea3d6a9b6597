"""Weekly windows over an event stream: indicators, and drift against fixed reference edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellrisk.functions.numeric import money_sum
from cellrisk.operators import drift
from cellrisk.sources.schemas import EVENT

WEEK = "7 days"
LATENESS = "1 hour"


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def weekly_kpi(events: DataFrame, watermark: str | None = LATENESS) -> DataFrame:
    """Counts, errors and value per week; windows align to the epoch, in UTC."""
    timed = events.withWatermark("ts", watermark) if watermark else events
    return (
        timed.groupBy(F.window("ts", WEEK).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count_if(F.col("event_type") == "error").alias("n_errors"),
            money_sum("value").alias("total_value"),
        )
        .select(F.col("w.start").alias("week_start"), "n_events", "n_errors", "total_value")
    )


def weekly_kpi_stream(
    events: DataFrame, output: str, checkpoint: str, watermark: str = LATENESS
) -> StreamingQuery:
    """Update mode: every micro-batch writes the weeks it changed, tagged with its number. `latest_weeks`
    takes the last state of each, the still open week included."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return (
        weekly_kpi(events, watermark)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_weeks(spark: SparkSession, output: str) -> DataFrame:
    rows = spark.read.parquet(output)
    values = [c for c in rows.columns if c not in ("week_start", "batch_id")]
    last = rows.groupBy("week_start").agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return last.select("week_start", "v.*")


def drift_stream(
    events: DataFrame, edges: DataFrame, features: Sequence[str], output: str, checkpoint: str
) -> StreamingQuery:
    """Binned counts per week and micro-batch. Counts add up, so `weekly_drift` has the index of every
    week over all its batches, not over one batch's part of it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        weekly = batch.withColumn("week_start", F.window("ts", WEEK)["start"])
        counted = drift.binned_counts_by(weekly, features, edges, ["week_start"])
        counted.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def weekly_drift(spark: SparkSession, output: str, expected: DataFrame) -> DataFrame:
    """(week_start, feature, psi, n_reference, n_current) of every week seen so far."""
    counted = spark.read.parquet(output).groupBy("week_start", "name", "bin").agg(F.sum("n").alias("n"))
    return drift.psi_by(expected, counted, ["week_start"])
