"""Scoring of arriving subscriber files, with a quarantine for rows that fail the request checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellrisk.functions.geo import grid_cell
from cellrisk.functions.scoring import DEFAULT_THRESHOLD, logit_score, with_predictions
from cellrisk.operators import requests
from cellrisk.operators.features import all_features

CELL_RESOLUTION = 8
RESULT_COLUMNS = [
    "subscriber_id", "churn_probability", "churn_predicted", "risk_tier", "cell", "cell_churn_rate",
    "network_quality_score", "revenue_at_risk", "scored_at",
]

Scorer = Callable[[DataFrame], DataFrame]


def read_requests(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def read_json_requests(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Requests as lines of JSON. Nothing fails on a bad line: its faults come as reasons with the row."""
    lines = (
        spark.readStream.schema(requests.text_schema(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", requests.CORRUPT)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )
    return requests.with_types(lines, schema)


def with_cell_context(rows: DataFrame, grid: DataFrame | None, resolution: int = CELL_RESOLUTION) -> DataFrame:
    """Neighbourhood values of the last batch grid; a new cell keeps them NULL and gets the defaults."""
    placed = rows.withColumn("cell", grid_cell("latitude", "longitude", resolution))
    return placed if grid is None else placed.join(grid, "cell", "left")


def logit_scorer(rows: DataFrame) -> DataFrame:
    return rows.withColumn("churn_probability", logit_score(digits=None))


def score_rows(
    rows: DataFrame, grid: DataFrame | None = None, scorer: Scorer = logit_scorer, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Accepted rows through defaults, features and score. Works on a batch and on a stream alike."""
    good = requests.accepted(requests.check_rows(rows))
    completed = requests.with_defaults(with_cell_context(good, grid))
    scored = with_predictions(scorer(all_features(completed)), threshold=threshold, digits=4)
    return scored.withColumn("scored_at", F.current_timestamp()).select(*RESULT_COLUMNS)


def score_stream(
    requests_stream: DataFrame, output: str, checkpoint: str, grid: DataFrame | None = None,
    scorer: Scorer = logit_scorer, threshold: float = DEFAULT_THRESHOLD,
) -> StreamingQuery:
    """Append scored rows as Parquet; files and offsets make the output exactly-once across restarts."""
    return (
        score_rows(requests_stream, grid, scorer, threshold)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quarantine_stream(
    requests_stream: DataFrame, accepted_path: str, quarantine_path: str, checkpoint: str
) -> StreamingQuery:
    """Two-way write per micro-batch. Each batch overwrites its own folder, so a replay adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Read and checked once for both writes; blocks lost with an executor are computed again from the files.
        checked = requests.check_rows(batch).persist()
        try:
            for rows, path in (
                (requests.accepted(checked), accepted_path),
                (requests.quarantined(checked), quarantine_path),
            ):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            checked.unpersist()

    return (
        requests_stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
