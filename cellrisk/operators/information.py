"""Mutual information of numeric features and a label from distances to neighbours, without bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.numeric import np_round
from cellrisk.operators.ordered import running
from cellrisk.operators.quantiles import value_counts_long
from cellrisk.session import checkpointed

#: Values that one task puts in order with those around them.
BLOCK = 100_000
#: Steps of the recurrence of digamma before its series is used.
SHIFT = 8


def digamma(n: Column) -> Column:
    """Digamma of a whole number above 0, to about 12 digits."""
    x = n.cast("double")
    steps = sum((F.lit(1.0) / (x + F.lit(float(i))) for i in range(SHIFT)), F.lit(0.0))
    far = x + F.lit(float(SHIFT))
    square = far * far
    tail = F.lit(1.0) / (square * F.lit(12.0)) - F.lit(1.0) / (square * square * F.lit(120.0))
    tail = tail + F.lit(1.0) / (square * square * square * F.lit(252.0))
    return F.ln(far) - F.lit(0.5) / far - tail - steps


def _balls(counts: DataFrame, label: str, k: int, block: int) -> DataFrame:
    """Per feature, label and value the open interval up to the k-th nearest row of that label, and the rows in it.

    Values are numbered over the whole table, cut into blocks of `block` numbers, and those next to a border are copied
    to the block behind it: the k-th nearest row is among the k values on either side.
    """
    order = [F.col("name"), F.col(label), F.col("value")]
    placed = running(counts.withColumn("_one", F.lit(1)), order, {"_at": "_one"}).drop("_one")
    home = F.floor(F.col("_at") / F.lit(block))
    blocks = F.array_distinct(
        F.array(*[F.floor((F.col("_at") + F.lit(step)) / F.lit(block)) for step in (-k, 0, k)])
    )
    spread = placed.withColumns({"_home": home, "_block": F.explode(blocks)})
    around = Window.partitionBy("_block").orderBy("_at").rowsBetween(-k, k)
    entry = F.struct("name", F.col(label).alias("label"), "value", "n")
    seen = spread.withColumn("_seen", F.collect_list(entry).over(around)).filter(F.col("_block") == F.col("_home"))
    mates = F.filter(
        "_seen",
        lambda e: (e["name"] == F.col("name")) & (e["label"] == F.col(label)) & (e["value"] != F.col("value")),
    )
    far = F.transform(
        "_mates",
        lambda e: F.array_repeat(F.abs(e["value"] - F.col("value")), F.least(e["n"], F.lit(k)).cast("int")),
    )
    own = F.array_repeat(F.lit(0.0), F.least(F.col("n") - 1, F.lit(k)).cast("int"))
    reach = F.element_at(F.array_sort(F.concat(own, F.flatten(far))), F.least(F.lit(k), F.col("n_label") - 1).cast("int"))
    measured = seen.withColumn("_mates", mates).withColumn("_reach", reach)
    # Where the k-th row itself ends the interval its value does, not a sum that rounding may push past it.
    ends = F.filter("_mates", lambda e: F.abs(e["value"] - F.col("value")) == F.col("_reach"))
    below = F.array_max(F.transform(F.filter(ends, lambda e: e["value"] < F.col("value")), lambda e: e["value"]))
    above = F.array_min(F.transform(F.filter(ends, lambda e: e["value"] > F.col("value")), lambda e: e["value"]))
    nearer = F.filter("_mates", lambda e: F.abs(e["value"] - F.col("value")) < F.col("_reach"))
    return measured.select(
        "name", label, "value", "n", "n_label", "n_all",
        (F.col("_reach") == 0).alias("_point"),
        F.when(F.col("_reach") == 0, F.col("value")).otherwise(F.coalesce(below, F.col("value") - F.col("_reach"))).alias("_low"),
        F.when(F.col("_reach") == 0, F.col("value")).otherwise(F.coalesce(above, F.col("value") + F.col("_reach"))).alias("_high"),
        (F.col("n") + F.aggregate(nearer, F.lit(0).cast("bigint"), lambda total, e: total + e["n"])).alias("_same"),
    )


def neighbour_information(
    df: DataFrame, columns: Sequence[str], label: str = "churned", k: int = 3, digits: int = 6, block: int = BLOCK
) -> DataFrame:
    """(feature, mi): information in nats between each numeric column and a discrete label, highest first.

    For every row: the distance to the k-th nearest row of its own label (the farthest, if there are fewer), and the rows
    of any label strictly nearer than that; with N rows, L of the row's label, S of that label and M in all inside,
    information is the mean of digamma(N) - digamma(L) + digamma(S) - digamma(M), and not below 0. Where the k-th row has
    the same value, the interval is that value. Rows with a NULL or NaN value or a NULL label are left out, as are
    labels with one row; a column without rows has NULL.

    Rows meet as counts of values. The rows inside an interval are the difference of two running counts over values and
    interval ends in one order, so no rows are paired and no task sees a whole column.
    """
    if k < 1 or block < 2 * k:
        raise ValueError("k must be 1 or more, and a block must hold 2 k values")
    long = value_counts_long(df, columns, [label]).filter(F.col(label).isNotNull() & ~F.isnan("value"))
    counts = checkpointed(long)
    sizes = counts.groupBy("name", label).agg(F.sum("n").alias("n_label")).filter("n_label > 1")
    totals = sizes.groupBy("name").agg(F.sum("n_label").alias("n_all"))
    balls = checkpointed(_balls(counts.join(sizes.join(totals, "name"), ["name", label]), label, k, block))
    # Ends before the rows of their own value count what is below it, ends after them count it too.
    row = ["name", label, "value"]
    before, at, after = F.lit(0), F.lit(1), F.lit(2)
    ends = F.explode(
        F.array(
            F.struct(F.col("_low").alias("point"), F.when(F.col("_point"), before).otherwise(after).alias("edge"), F.lit(-1).alias("sign")),
            F.struct(F.col("_high").alias("point"), F.when(F.col("_point"), after).otherwise(before).alias("edge"), F.lit(1).alias("sign")),
        )
    )
    asked = balls.select(*row, ends.alias("_end")).select(*row, "_end.*", F.lit(0).cast("bigint").alias("n"))
    given = balls.select(*row, F.col("value").alias("point"), at.alias("edge"), F.lit(0).alias("sign"), "n")
    events = running(asked.unionByName(given), [F.col("name"), F.col("point"), F.col("edge")], {"_upto": "n"})
    inside = events.filter("sign <> 0").groupBy(*row).agg(F.sum(F.col("sign") * F.col("_upto")).alias("_inside"))
    part = digamma(F.col("_same")) - digamma(F.col("_inside")) - digamma(F.col("n_label"))
    scores = (
        balls.join(inside, row)
        .groupBy("name", "n_all")
        .agg(F.sum(F.col("n") * part).alias("_sum"))
        .select("name", F.greatest(digamma(F.col("n_all")) + F.col("_sum") / F.col("n_all"), F.lit(0.0)).alias("mi"))
    )
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    found = every.join(scores, every["feature"] == scores["name"], "left")
    return found.select("feature", np_round("mi", digits).alias("mi")).orderBy(F.col("mi").desc_nulls_last(), "feature")
