"""Population stability of features between a reference and a current set of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.numeric import np_round
from cellrisk.operators.quantiles import approximate_quantiles, quantiles_of_counts, value_counts_long
from cellrisk.session import checkpointed

# Features watched, alert level, number of bins and the guard against empty bins.
DRIFT_FEATURES = ["data_usage_gb", "monthly_charges", "call_drops_monthly", "rsrp_avg"]
PSI_THRESHOLD = 0.2
PSI_BINS = 10
EPS = 1e-10


def _edges_of(counts: DataFrame, bins: int) -> DataFrame:
    points = [i / bins for i in range(bins + 1)]
    return quantiles_of_counts(counts, points).select("name", F.array_distinct("q").alias("edges"))


def reference_edges(reference: DataFrame, features: Sequence[str], bins: int = PSI_BINS, exact: bool = True) -> DataFrame:
    """(name, edges): distinct quantile edges of each feature in the reference rows."""
    if exact:
        return _edges_of(checkpointed(value_counts_long(reference, features)), bins)
    sketched = approximate_quantiles(reference, features, [i / bins for i in range(bins + 1)])
    return sketched.select("name", F.array_distinct("q").alias("edges"))


def with_bins(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """Add `bin` from 1 up, or 0 for a value outside the reference range. The last bin is closed."""
    # One row per feature.
    joined = counts.join(F.broadcast(edges), "name")
    value, last = F.col("value"), F.element_at("edges", -1)
    position = F.size(F.filter("edges", lambda e: e <= value))
    bin_no = (
        F.when((value < F.col("edges")[0]) | (value > last), F.lit(0))
        .when(value == last, F.size("edges") - 1)
        .otherwise(position)
    )
    return joined.withColumn("bin", bin_no).drop("edges")


def binned_counts_by(rows: DataFrame, features: Sequence[str], edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by.., name, bin, n)"""
    counts = with_bins(value_counts_long(rows, features, by), edges)
    return counts.groupBy(*by, "name", "bin").agg(F.sum("n").alias("n"))


def binned_counts(rows: DataFrame, features: Sequence[str], edges: DataFrame) -> DataFrame:
    return binned_counts_by(rows, features, edges, [])


def psi_by(expected: DataFrame, actual: DataFrame, by: Sequence[str], digits: int = 6) -> DataFrame:
    """(by.., feature, psi, n_reference, n_current) from binned counts, per group of `actual`."""
    groups = actual.select(*by, "name").distinct()
    known = groups.join(expected.withColumnRenamed("n", "_e"), "name")
    both = known.join(actual.withColumnRenamed("n", "_a"), [*by, "name", "bin"], "full")
    return _psi(both.na.fill(0, ["_e", "_a"]), digits, by)


def psi_from_counts(expected: DataFrame, actual: DataFrame, digits: int = 6) -> DataFrame:
    """(feature, psi, n_reference, n_current) from two binned counts."""
    both = expected.withColumnRenamed("n", "_e").join(
        actual.withColumnRenamed("n", "_a"), ["name", "bin"], "full"
    )
    return _psi(both.na.fill(0, ["_e", "_a"]), digits)


def _psi(both: DataFrame, digits: int, by: Sequence[str] = ()) -> DataFrame:
    """`both` has (by.., name, bin, _e, _a), a few rows per feature. A bin that is empty on both sides
    adds nothing; rows outside the bins (bin 0) count in the denominators only."""
    feature = Window.partitionBy(*by, "name")
    totals = {"_te": F.sum("_e").over(feature), "_ta": F.sum("_a").over(feature)}
    eps = F.lit(EPS)
    e, a = F.col("_e") / (F.col("_te") + eps), F.col("_a") / (F.col("_ta") + eps)
    part = F.when(F.col("bin") > 0, (a - e) * F.ln((a + eps) / (e + eps))).otherwise(F.lit(0.0))
    return (
        both.withColumns(totals)
        .groupBy(*by, F.col("name").alias("feature"))
        .agg(
            np_round(F.sum(part), digits).alias("psi"),
            F.first("_te").alias("n_reference"),
            F.first("_ta").alias("n_current"),
        )
    )


def psi(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = DRIFT_FEATURES,
    bins: int = PSI_BINS,
    exact: bool = True,
    digits: int = 6,
) -> DataFrame:
    """One row per feature. The caller names two disjoint sets of rows."""
    names = list(features)
    tagged = reference.select(*names, F.lit(1).alias("_ref")).unionByName(
        current.select(*names, F.lit(0).alias("_ref"))
    )
    return psi_tagged(tagged, F.col("_ref") == 1, names, bins, exact, digits)


def psi_tagged(
    rows: DataFrame,
    is_reference: Column,
    features: Sequence[str] = DRIFT_FEATURES,
    bins: int = PSI_BINS,
    exact: bool = True,
    digits: int = 6,
) -> DataFrame:
    """Same, for one table whose rows are reference or current by a condition.

    All rows are counted by value in one pass; edges and bins are then found on those counts.
    """
    names = list(features)
    tagged = rows.select(*names, is_reference.cast("int").alias("_ref")).filter(F.col("_ref").isNotNull())
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in names])
    )
    counts = checkpointed(
        tagged.select("_ref", pairs.alias("p"))
        .select("_ref", "p.*")
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.sum("_ref").alias("_e"), F.sum(F.lit(1) - F.col("_ref")).alias("_a"))
    )
    if exact:
        known = counts.filter(F.col("_e") > 0).select("name", "value", F.col("_e").alias("n"))
        edges = _edges_of(known, bins)
    else:
        edges = reference_edges(tagged.filter(F.col("_ref") == 1), names, bins, exact=False)
    both = with_bins(counts, edges).groupBy("name", "bin").agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))
    return _psi(both, digits)


def drift_report(psi_rows: DataFrame, threshold: float = PSI_THRESHOLD) -> DataFrame:
    """Highest index, the features above the threshold, and whether to retrain."""
    drifted = F.filter(
        F.array_sort(F.collect_list(F.when(F.col("psi") > threshold, F.col("feature")))), lambda f: f.isNotNull()
    )
    return psi_rows.agg(
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.concat_ws(",", drifted).alias("drifted_features"),
        F.coalesce(F.bool_or(F.col("psi") > threshold), F.lit(False)).alias("retrain"),
    )
