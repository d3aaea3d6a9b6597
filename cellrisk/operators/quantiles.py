"""Exact quantiles without gathering a column in one task.

Spark's exact `percentile` keeps every distinct value of a group in one aggregation buffer. Here the
distinct values are counted first (combined map-side, spread by value), then cut into buckets at
approximate quantiles of those distinct values. Bucket totals tell which buckets hold the wanted
ranks, and only those buckets are ordered, one task per bucket. The counts are checkpointed, so the
rows themselves are read once however many steps follow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.session import checkpointed

STEP = 32
BUCKETS = STEP * STEP
SKETCH_ACCURACY = 10000


def value_counts_long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., name, value, n): how often each value of each column occurs, NULL left out."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    long = df.select(*by, pairs.alias("p")).select(*by, "p.name", "p.value")
    return long.filter(F.col("value").isNotNull()).groupBy(*by, "name", "value").agg(F.count(F.lit(1)).alias("n"))


def _bucketed(counts: DataFrame) -> DataFrame:
    fractions = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    edges = counts.groupBy("name").agg(
        F.percentile_approx("value", fractions, F.lit(SKETCH_ACCURACY)).alias("_edges")
    )
    coarse = F.transform(F.sequence(F.lit(STEP), F.lit(BUCKETS - STEP), F.lit(STEP)), lambda i: F.element_at("_edges", i))
    # One row per column name.
    joined = counts.join(F.broadcast(edges.withColumn("_coarse", coarse)), "name")
    # Two short searches in place of one long one.
    first = joined.withColumn("_first", F.size(F.filter("_coarse", lambda e: e < F.col("value"))))
    nearby = F.slice("_edges", F.col("_first") * STEP + 1, F.lit(STEP - 1))
    below = F.size(F.filter(nearby, lambda e: e < F.col("value")))
    return first.withColumn("_bucket", F.col("_first") * STEP + below).drop("_edges", "_coarse", "_first")


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by.., name, n, q): `q` is the array of quantiles, linear between neighbouring ranks.

    `counts` is read three times: pass a checkpointed frame.
    """
    keys = [*by, "name"]
    bucketed = _bucketed(counts)
    totals = bucketed.groupBy(*keys, "_bucket").agg(F.sum("n").alias("_bn"))
    ordered = Window.partitionBy(*keys).orderBy("_bucket")
    before = F.coalesce(F.sum("_bn").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_bn").over(Window.partitionBy(*keys))

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    ranks = F.array_distinct(
        F.flatten(F.array(*[F.array(F.floor(position(p)), F.ceil(position(p))) for p in probabilities]))
    )
    wanted = (
        totals.withColumns({"_before": before, "_total": total})
        .withColumn("_ranks", ranks)
        .withColumn(
            "_ranks",
            F.filter("_ranks", lambda k: (k >= F.col("_before")) & (k < F.col("_before") + F.col("_bn"))),
        )
        .filter(F.size("_ranks") > 0)
    )
    # At most two rows per probability and group.
    hit = bucketed.join(wanted, [*keys, "_bucket"])
    inside = Window.partitionBy(*keys, "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = hit.withColumn("_upto", F.col("_before") + F.sum("n").over(inside))
    found = upto.select(
        *keys,
        "_total",
        "value",
        F.explode(
            F.filter("_ranks", lambda k: (k < F.col("_upto")) & (k >= F.col("_upto") - F.col("n")))
        ).alias("_rank"),
    )
    per_group = found.groupBy(*keys).agg(
        F.first("_total").alias("_total"),
        F.map_from_entries(F.collect_list(F.struct("_rank", "value"))).alias("_at"),
    )

    def quantile(p: float) -> Column:
        low = F.floor(position(p))
        at_low, at_high = F.element_at("_at", low), F.element_at("_at", F.ceil(position(p)))
        return at_low + (at_high - at_low) * (position(p) - low)

    return per_group.select(*keys, F.col("_total").alias("n"), F.array(*[quantile(p) for p in probabilities]).alias("q"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    return quantiles_of_counts(checkpointed(value_counts_long(df, columns, by)), probabilities, by)


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (), accuracy: int = 10000
) -> DataFrame:
    """Same shape from a mergeable sketch, in one pass."""
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    sketches = df.groupBy(*by).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.percentile_approx(F.col(c).cast("double"), points, F.lit(accuracy)).alias("q"),
            ).alias(c)
            for c in columns
        ]
    )
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("s")) for c in columns]))
    return sketches.select(*by, entries.alias("e")).select(*by, "e.name", "e.s.n", "e.s.q")
