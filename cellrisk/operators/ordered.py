"""Running sums in the order of a column, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.session import checkpointed


def in_parts(df: DataFrame, *order: Column) -> DataFrame:
    """Adds `_part`: ranges of `order`, numbered in that order, sampled so that they hold about as many rows each.

    Rows that are equal in all of `order` share a part, so the last column of `order` should tell rows apart. The
    table is written, which fixes the numbers; adaptive execution sizes the parts by their bytes.
    """
    return checkpointed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def running(df: DataFrame, order: list[Column], sums: Mapping[str, str], totals: Mapping[str, str] | None = None) -> DataFrame:
    """Adds, for each entry of `sums`, the sum of that column over all rows up to and including this one.

    `totals` adds sums over all rows. Each part is summed in its own task; the parts' totals, one row per part, give
    the sums carried into each. No rows: no rows.
    """
    parted = in_parts(df, *order)
    columns = sorted({*sums.values(), *(totals or {}).values()})
    whole = parted.groupBy("_part").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as there are parts.
    carried = whole.select(
        "_part",
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in columns],
        *[F.sum(f"_sum_{c}").over(Window.partitionBy()).alias(name) for name, c in (totals or {}).items()],
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = parted.join(F.broadcast(carried), "_part")
    out = joined.withColumns({name: F.col(f"_before_{c}") + F.sum(c).over(inside) for name, c in sums.items()})
    return out.drop("_part", *[f"_before_{c}" for c in columns])
