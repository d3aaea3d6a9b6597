"""Per-cell aggregates and their join back to the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.geo import grid_cell, hex_cell
from cellrisk.functions.numeric import np_round, steady_mean

# Column and output name of the neighbourhood means.
CELL_MEANS = {
    "rsrq_avg": "cell_avg_rsrq",
    "rsrp_avg": "cell_avg_rsrp",
    "dl_throughput_mbps": "cell_avg_throughput",
    "outage_minutes_monthly": "cell_avg_outage",
    "monthly_charges": "cell_avg_monthly_charges",
    "data_usage_gb": "cell_avg_data_usage",
    "churned": "cell_churn_rate",
}


def add_cells(
    df: DataFrame, resolutions: Sequence[int] = (7, 8), shape: str = "grid", prefix: str = "cell_r"
) -> DataFrame:
    """One cell-id column per resolution, `cell_r7` and so on."""
    make = {"grid": grid_cell, "hex": hex_cell}[shape]
    return df.withColumns({f"{prefix}{k}": make("latitude", "longitude", k) for k in resolutions})


def cell_stats(df: DataFrame, cell: str, means: Mapping[str, str] = CELL_MEANS, digits: int = 6) -> DataFrame:
    """Row count and means per cell. Partial sums are combined before the shuffle, so a cell with a
    third of all rows sends one small row per task."""
    return df.where(F.col(cell).isNotNull()).groupBy(cell).agg(
        F.count(cell).alias("cell_subscriber_count"),
        *[np_round(steady_mean(c), digits).alias(name) for c, name in means.items() if c in df.columns],
    )


def join_cells(df: DataFrame, per_cell: DataFrame, cell: str) -> DataFrame:
    """Attach a cell-keyed table (one row per cell). AQE broadcasts it when it turns out small and
    splits a hot cell's rows when it does not."""
    return df.join(per_cell, cell, "left")


def cell_neighborhood(df: DataFrame, cell: str) -> DataFrame:
    return join_cells(df, cell_stats(df, cell), cell)


def leave_one_out_rate(df: DataFrame, cell: str, label: str = "churned", name: str = "cell_churn_rate_loo") -> DataFrame:
    """Cell rate without the row's own label; NULL for a cell of one.

    Sums per cell are joined back, where a window would gather every row of a hot cell in one task.
    """
    sums = df.where(F.col(cell).isNotNull()).groupBy(cell).agg(
        F.sum(F.col(label).cast("bigint")).alias("_positives"), F.count(label).alias("_n")
    )
    others = F.col("_n") - F.when(F.col(label).isNotNull(), 1).otherwise(0)
    own = F.coalesce(F.col(label), F.lit(0))
    return (
        df.join(sums, cell, "left")
        .withColumn(name, F.try_divide((F.col("_positives") - own).cast("double"), others))
        .drop("_positives", "_n")
    )


def with_cell_context(rows: DataFrame, base: DataFrame, cell: str, leave_one_out: bool = True, label: str = "churned") -> DataFrame:
    """Join the cell statistics of `base` to `rows`, with the row's own label left out of the rate.

    `base` is the plain table with its cells: statistics then do not depend on the joins that made
    `rows`, and one aggregation gives means and the leave-one-out sums together.
    """
    sums = [F.sum(F.col(label).cast("bigint")).alias("_positives"), F.count(label).alias("_labelled")]
    means = [np_round(steady_mean(c), 6).alias(n) for c, n in CELL_MEANS.items() if c in base.columns]
    stats = base.where(F.col(cell).isNotNull()).groupBy(cell).agg(F.count(cell).alias("cell_subscriber_count"), *means, *sums)
    joined = join_cells(rows, stats, cell)
    if leave_one_out:
        others = F.col("_labelled") - F.when(F.col(label).isNotNull(), 1).otherwise(0)
        left = F.col("_positives") - F.coalesce(F.col(label), F.lit(0))
        joined = joined.withColumn("cell_churn_rate", F.try_divide(left.cast("double"), others))
    return joined.drop("_positives", "_labelled")


def lagged_rate(
    df: DataFrame, cell: str, period: str, label: Column, name: str = "rate", step: str = "interval 7 days"
) -> DataFrame:
    """Rate per cell and period next to that of the period one `step` earlier, NULL where the cell had no rows then.

    The window runs over aggregated rows: its partitions hold one row per period."""
    per_period = df.groupBy(cell, period).agg(
        F.count(F.lit(1)).alias("n_rows"),
        np_round(F.sum(label.cast("bigint")) / F.count(label), 6).alias(name),
    )
    order = Window.partitionBy(cell).orderBy(period)
    follows = F.lag(period).over(order) == F.col(period) - F.expr(step)
    return per_period.withColumn(f"previous_{name}", F.when(follows, F.lag(name).over(order)))


def poi_density(df: DataFrame, pois: DataFrame, resolution: int, shape: str = "grid") -> DataFrame:
    """Points of interest in the row's own cell; 0 where there are none."""
    cell = f"cell_r{resolution}"
    counts = add_cells(pois, [resolution], shape).groupBy(cell).agg(F.count(F.lit(1)).alias("poi_density"))
    with_cell = df if cell in df.columns else add_cells(df, [resolution], shape)
    return with_cell.join(counts, cell, "left").withColumn(
        "poi_density", F.coalesce("poi_density", F.lit(0))
    )


def cells_per_resolution(df: DataFrame, resolutions: Sequence[int], approximate: bool = False) -> DataFrame:
    """Distinct cells per resolution. Each row gives one id per resolution; duplicates are removed
    by a grouped, map-side combined distinct."""
    ids = F.explode(
        F.array(
            *[
                F.struct(F.lit(k).alias("resolution"), grid_cell("latitude", "longitude", k).alias("cell"))
                for k in resolutions
            ]
        )
    )
    long = df.select(ids.alias("c")).select("c.*")
    if approximate:
        return long.groupBy("resolution").agg(F.approx_count_distinct("cell").alias("n_cells"))
    return long.distinct().groupBy("resolution").agg(F.count("cell").alias("n_cells"))
