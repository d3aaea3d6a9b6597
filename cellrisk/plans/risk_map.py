"""From raw or scored subscribers to the tiered risk grid and its files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.functions.geo import cell_polygon
from cellrisk.functions.scoring import DEFAULT_THRESHOLD, with_predictions
from cellrisk.operators.neighborhood import add_cells
from cellrisk.operators.risk import MIN_CELL_SIZE, risk_grid, with_tier
from cellrisk.sources import sinks
from cellrisk.sources.testbed import subscribers

DEFAULT_RESOLUTION = 7

# Columns the grid reads; naming them keeps the usage join out of the plan.
GRID_INPUTS = [
    "subscriber_id", "contract_type", "monthly_charges", "rsrq_avg", "dl_throughput_mbps",
    "outage_minutes_monthly", "latitude", "longitude", "churn_probability",
]


def scored_subscribers(spark: SparkSession, sf_dir: str, columns=None, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    wanted = list(columns or GRID_INPUTS)
    for c in ("churn_probability", "monthly_charges"):
        if c not in wanted:
            wanted.append(c)
    return with_predictions(subscribers(spark, sf_dir, wanted), threshold=threshold)


def risk_map(
    scored: DataFrame,
    resolution: int = DEFAULT_RESOLUTION,
    min_subscribers: int = MIN_CELL_SIZE,
    shape: str = "grid",
) -> DataFrame:
    """Risk grid per cell with tier and colour; works on any frame with a probability and a place."""
    cell = f"cell_r{resolution}"
    with_cell = scored if cell in scored.columns else add_cells(scored, [resolution], shape)
    return with_tier(risk_grid(with_cell, cell, min_subscribers)).withColumnRenamed(cell, "cell")


def write_risk_map(grid: DataFrame, path: str) -> None:
    """Parquet of the grid and newline-delimited GeoJSON of its cells below `path`."""
    sinks.write_parquet(grid.drop("risk_tier", "color"), f"{path}/risk_grid.parquet")
    geometry = sinks.polygon_geometry(cell_polygon("cell"))
    sinks.write_geojson(sinks.geojson_features(grid, geometry, grid.columns), f"{path}/risk_grid.geojsonl")


def flagship(spark: SparkSession, sf_dir: str, resolution: int, min_subscribers: int) -> DataFrame:
    grid = risk_map(scored_subscribers(spark, sf_dir), resolution, min_subscribers)
    return grid.orderBy(F.col("estimated_revenue_at_risk").desc(), F.col("cell"))
