"""Profiling: rates by category, summaries, distributions, correlation, information, trend."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.numeric import clip, money_sum, np_round, steady_mean
from cellrisk.operators.quantiles import exact_quantiles, quantiles_of_counts, value_counts_long
from cellrisk.session import checkpointed

# Columns of the correlation matrix, the threshold for strongly correlated pairs,
# and the whisker length of box statistics.
CORRELATION_COLUMNS = [
    "tenure_months", "monthly_charges", "data_usage_gb", "call_minutes_monthly", "rsrp_avg",
    "rsrq_avg", "dl_throughput_mbps", "call_drop_rate_pct", "call_drops_monthly",
    "outage_minutes_monthly", "tech_support_calls", "churned",
]
PAIR_THRESHOLD = 0.80
WHISKER_IQR = 1.5


def churn_by(df: DataFrame, category: str, label: str = "churned") -> DataFrame:
    """Label rate and row count per category, highest rate first."""
    rates = df.groupBy(category).agg(
        np_round(steady_mean(label), 6).alias("churn_rate"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label).cast("bigint")).alias("n_churned"),
    )
    return rates.orderBy(F.col("churn_rate").desc(), F.col(category))


def kpi_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("churned").cast("bigint")).alias("churned"),
        np_round(steady_mean("churned"), 6).alias("churn_rate"),
        np_round(steady_mean("monthly_charges"), 6).alias("avg_monthly_charges"),
        money_sum(F.when(F.col("churned") == 1, F.col("monthly_charges"))).alias("revenue_at_risk"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(column))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that have NULL or NaN, with their counts; all columns in one pass."""
    names = df.columns
    real = {c for c, kind in df.dtypes if kind in ("double", "float")}
    missing = {c: F.col(c).isNull() | F.isnan(c) if c in real else F.col(c).isNull() for c in names}
    counts = df.agg(*[F.count_if(bad).alias(c) for c, bad in missing.items()])
    return counts.unpivot([], names, "column", "n_null").filter(F.col("n_null") > 0)


def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    counts = checkpointed(value_counts_long(df, list(columns)))
    n, weighted = F.sum("n"), F.col("value") * F.col("n")
    centre = counts.groupBy("name").agg(
        n.alias("count"),
        (F.sum(weighted) / n).alias("_mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row per column.
    off = F.col("value") - F.col("_mean")
    squares = (
        counts.join(F.broadcast(centre), "name").groupBy("name").agg(F.sum(off * off * F.col("n")).alias("_squares"))
    )
    quartiles = quantiles_of_counts(counts, [0.25, 0.5, 0.75]).drop("n")
    # One row per column asked for, so that an all-NULL column shows up with count 0.
    asked = df.sparkSession.createDataFrame([(c,) for c in columns], "name string")
    return (
        asked.join(centre, "name", "left")
        .join(squares, "name", "left")
        .join(quartiles, "name", "left")
        .select(
            F.col("name").alias("column"),
            F.coalesce("count", F.lit(0)).alias("count"),
            np_round("_mean", digits).alias("mean"),
            np_round(F.sqrt(F.try_divide(F.col("_squares"), F.col("count") - 1)), digits).alias("std"),
            "min",
            *[np_round(F.col("q")[i], digits).alias(q) for i, q in enumerate(["q25", "q50", "q75"])],
            "max",
        )
    )


def winsorize(
    df: DataFrame, column: str, by: str | None = None, low: float | None = 0.01, high: float | None = 0.99, digits: int = 6
) -> DataFrame:
    """Add `<column>_clipped`, cut to the quantiles of the row's own group."""
    probabilities = [p for p in (low, high) if p is not None]
    keys = [by] if by else []
    limits = exact_quantiles(df, [column], probabilities, keys).select(
        *keys,
        (F.col("q")[0] if low is not None else F.lit(None).cast("double")).alias("_low"),
        (F.col("q")[len(probabilities) - 1] if high is not None else F.lit(None).cast("double")).alias("_high"),
    )
    if by:
        joined = df.join(limits, by, "left")
    else:
        joined = df.withColumns({c: limits.select(c).scalar() for c in ("_low", "_high")})
    value = F.col(column).cast("double")
    clipped = F.when(value.isNotNull(), F.least(F.greatest(value, F.col("_low")), F.col("_high")))
    return joined.withColumn(f"{column}_clipped", np_round(clipped, digits)).drop("_low", "_high")


def box_stats(df: DataFrame, columns: Sequence[str], by: str, digits: int = 6) -> DataFrame:
    """Quartiles, whisker ends and number of outliers per column and group, from value counts."""
    keys = [by, "name"]
    counts = checkpointed(value_counts_long(df, columns, [by]))
    boxes = quantiles_of_counts(counts, [0.25, 0.5, 0.75], [by]).select(
        *keys, F.col("n").alias("_n"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = (F.col("q3") - F.col("q1")) * F.lit(WHISKER_IQR)
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    return (
        counts.join(boxes, keys)
        .groupBy(*keys, "_n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
        )
        .select(
            by,
            F.col("name").alias("column"),
            F.col("_n").alias("n"),
            *[np_round(c, digits).alias(c) for c in ("q1", "median", "q3")],
            "whisker_low",
            "whisker_high",
            "n_outliers",
        )
    )


def histogram(df: DataFrame, column: str, by: str, bins: int = 50, digits: int = 9) -> DataFrame:
    """Counts and densities in equal-width bins over each group's own range; the last bin is closed."""
    counts = checkpointed(value_counts_long(df, [column], [by]))
    # One row per group, with the bin numbers to fill the empty bins from.
    ranges = counts.groupBy(by).agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.sum("n").alias("_n")
    )
    width = F.col("_hi") - F.col("_lo")
    raw = F.floor((F.col("value") - F.col("_lo")) / width * F.lit(float(bins)))
    bin_no = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    found = (
        counts.join(ranges.select(by, "_lo", "_hi"), by)
        .groupBy(by, bin_no.alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    every = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = width / F.lit(float(bins))
    return every.join(found, [by, "bin"], "left").select(
        by,
        "bin",
        np_round(F.col("_lo") + F.col("bin") * step, 6).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
        np_round(F.try_divide(F.coalesce("n", F.lit(0)), F.col("_n") * step), digits).alias("density"),
    )


def corr_matrix(df: DataFrame, columns: Sequence[str] = CORRELATION_COLUMNS, digits: int = 6) -> DataFrame:
    """Lower triangle with diagonal of Pearson's r over the rows that hold both values; NULL where one is constant.

    A first pass reads mean, range and NULLs of each column. Columns without NULL share their centred sums of squares,
    so a pair of them costs one sum of products; pairs with a NULL column are summed over their own rows.
    """
    number = {c: F.col(c).cast("double") for c in columns}
    facts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[f(x).alias(f"{c}:{name}") for c, x in number.items()
          for name, f in (("n", F.count), ("mean", F.avg), ("low", F.min), ("high", F.max))],
    ).first()
    full = {c for c in columns if facts["_rows"] and facts[f"{c}:n"] == facts["_rows"]}
    fixed = {c for c in full if facts[f"{c}:low"] == facts[f"{c}:high"]}
    centred = df.select(*[(x - F.lit(facts[f"{c}:mean"])).alias(c) if c in full else x.alias(c) for c, x in number.items()])
    pairs = [(b, a) for a, b in combinations_with_replacement(columns, 2)]
    shared = {p for p in pairs if full.issuperset(p) and not fixed.intersection(p)}
    alone = [p for p in pairs if not full.issuperset(p) and not fixed.intersection(p)]
    sums = centred.agg(
        *[F.sum(c).alias(f"{c}:sum") for c in sorted(full - fixed)],
        *[F.sum(F.col(a) * F.col(b)).alias(f"{a}:{b}") for a, b in pairs if (a, b) in shared],
        *[F.corr(a, b).alias(f"{a}:{b}") for a, b in alone],
    )

    missing = F.lit(None).cast("double")

    def entry(a: str, b: str) -> Column:
        known = (a, b) in shared
        pick = {"ab": f"{a}:{b}", "aa": f"{a}:{a}", "bb": f"{b}:{b}", "sum_a": f"{a}:sum", "sum_b": f"{b}:sum"}
        other = missing if known or fixed.intersection((a, b)) else F.col(f"{a}:{b}")
        return F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"), other.alias("other"),
            *[(F.col(c) if known else missing).alias(name) for name, c in pick.items()],
        )

    long = sums.select(F.explode(F.array(*[entry(a, b) for a, b in pairs])).alias("p")).select("p.*")
    # What rounding left of the centred sums is taken off again.
    rows = F.lit(float(facts["_rows"]))
    covariance = F.col("ab") - F.col("sum_a") * F.col("sum_b") / rows
    spread = (F.col("aa") - F.col("sum_a") * F.col("sum_a") / rows) * (F.col("bb") - F.col("sum_b") * F.col("sum_b") / rows)
    own = F.when((F.col("a") == F.col("b")) & F.col("ab").isNotNull() & ~F.isnan("ab"), F.lit(1.0))
    r = F.coalesce(own, F.try_divide(covariance, F.sqrt(spread)), "other")
    return long.select("a", "b", np_round(r, digits).alias("r"))


def corr_pairs(df: DataFrame, columns: Sequence[str], threshold: float = PAIR_THRESHOLD) -> DataFrame:
    strong = corr_matrix(df, columns).filter((F.col("a") != F.col("b")) & (F.abs("r") > threshold))
    return strong.orderBy(F.abs("r").desc(), "a", "b")


def corr_target(df: DataFrame, columns: Sequence[str], target: str = "churned", k: int = 10, digits: int = 6) -> DataFrame:
    """Features by absolute correlation with the target."""
    wide = df.agg(*[np_round(F.corr(c, target), digits).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "feature", "r")
    return long.orderBy(F.abs("r").desc_nulls_last(), "feature").limit(k)


def mutual_information(
    df: DataFrame, columns: Sequence[str], label: str = "churned", bins: int = 10, k: int | None = None, digits: int = 6
) -> DataFrame:
    """Information (nats) between a feature's quantile bin and the label, for screening."""
    counts = checkpointed(value_counts_long(df, columns, [label]))
    values = counts.groupBy("name", "value").agg(F.sum("n").alias("n"))
    inner = [i / bins for i in range(1, bins)]
    edges = quantiles_of_counts(values, inner).select("name", F.array_distinct("q").alias("_edges"))
    # One row per feature.
    binned = counts.join(F.broadcast(edges), "name").withColumn(
        "bin", F.size(F.filter("_edges", lambda e: e < F.col("value")))
    )
    cells = binned.groupBy("name", "bin", label).agg(F.sum("n").alias("n"))
    n_bin = F.sum("n").over(Window.partitionBy("name", "bin"))
    n_label = F.sum("n").over(Window.partitionBy("name", label))
    n_all = F.sum("n").over(Window.partitionBy("name"))
    parts = cells.select(
        "name",
        (F.col("n") / n_all * F.ln(F.col("n").cast("double") * n_all / (n_bin.cast("double") * n_label))).alias("part"),
    )
    scores = parts.groupBy(F.col("name").alias("feature")).agg(np_round(F.sum("part"), digits).alias("mi"))
    ranked = scores.orderBy(F.col("mi").desc(), "feature")
    return ranked.limit(k) if k else ranked


def linear_trend(df: DataFrame, x: str, y: str, digits: int = 6) -> DataFrame:
    """Slope and intercept of the degree-1 fit of `y` on `x`."""
    return df.agg(
        np_round(F.regr_slope(y, x), digits).alias("slope"),
        np_round(F.regr_intercept(y, x), digits).alias("intercept"),
        F.count(F.lit(1)).alias("n_cells"),
    )


def cell_summary(cells: DataFrame, columns: Sequence[str] = ("n_subscribers", "churn_rate"), digits: int = 6) -> DataFrame:
    """Count, mean, spread, median and maximum of cell-level columns."""
    return describe(cells, columns, digits).select("column", "count", "mean", "std", F.col("q50").alias("median"), "max")


def clipped(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.withColumn(f"{column}_clipped", clip(column, low, high))
