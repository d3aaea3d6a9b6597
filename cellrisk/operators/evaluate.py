"""Evaluation of a scored, labelled table.

All curves and metrics start from `score_steps`, one row per distinct score as it is, unrounded; rows that share a
score are counted before any shuffle. Running sums go by ranges of the score (`ordered.running`), so neither a task nor the
driver sees all steps. Where single rows matter, rows are ranked in ranges of score, hash and key, so a score that a
third of all rows share is split as well. Rows without a score (NULL or NaN) or label are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.numeric import np_round
from cellrisk.operators.ordered import running
from cellrisk.session import checkpointed

# Sweep and tuning ranges in hundredths, both ends included.
SWEEP_HUNDREDTHS = (10, 79)
TUNE_HUNDREDTHS = (20, 69)
FALLBACK_THRESHOLD = 0.5


def _known(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull())


def score_steps(df: DataFrame, label: str = "churned", score: str = "churn_probability") -> DataFrame:
    """(step, n, pos): rows and positives per distinct score; -0 counts as 0."""
    step = (F.col(score).cast("double") + F.lit(0.0)).alias("step")
    return _known(df, label, score).groupBy(step).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )


def cumulative_steps(steps: DataFrame) -> DataFrame:
    """Add totals and the counts at and above each step."""
    return running(steps, [F.col("step").desc()], {"cum_n": "n", "cum_pos": "pos"}, {"total_n": "n", "total_pos": "pos"})


def _share(a: Column, b: Column) -> Column:
    """a / b as a double, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _auc() -> Column:
    """Mid-rank area: each positive wins over the negatives below it, and half over its ties."""
    neg = (F.col("n") - F.col("pos")).cast("double")
    total_neg = (F.col("total_n") - F.col("total_pos")).cast("double")
    below = total_neg - (F.col("cum_n") - F.col("cum_pos")).cast("double")
    won = F.sum(F.col("pos") * (below + neg / F.lit(2.0)))
    return F.try_divide(won, F.max(F.col("total_pos").cast("double") * total_neg))


def _average_precision() -> Column:
    gained = F.col("pos").cast("double") * (F.col("cum_pos") / F.col("cum_n"))
    return F.try_divide(F.sum(gained), F.max("total_pos").cast("double"))


def _brier() -> Column:
    p, neg = F.col("step"), F.col("n") - F.col("pos")
    missed = (F.lit(1.0) - p) * (F.lit(1.0) - p)
    return F.try_divide(F.sum(neg * p * p + F.col("pos") * missed), F.sum("n").cast("double"))


def roc_auc(df: DataFrame, digits: int = 6, **columns) -> DataFrame:
    return cumulative_steps(score_steps(df, **columns)).agg(np_round(_auc(), digits).alias("roc_auc"))


def average_precision(df: DataFrame, digits: int = 6, **columns) -> DataFrame:
    steps = cumulative_steps(score_steps(df, **columns))
    return steps.agg(np_round(_average_precision(), digits).alias("average_precision"))


def brier(df: DataFrame, digits: int = 6, **columns) -> DataFrame:
    return score_steps(df, **columns).agg(np_round(_brier(), digits).alias("brier"))


def _at_threshold(threshold: float) -> dict[str, Column]:
    hit = F.col("step") >= F.lit(threshold)
    neg = F.col("n") - F.col("pos")
    return {
        "tp": F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)),
        "fp": F.coalesce(F.sum(F.when(hit, neg)), F.lit(0)),
        "fn": F.coalesce(F.sum(F.when(~hit, F.col("pos"))), F.lit(0)),
        "tn": F.coalesce(F.sum(F.when(~hit, neg)), F.lit(0)),
    }


def classification_metrics(df: DataFrame, threshold: float, digits: int = 4, **columns) -> DataFrame:
    """One row: areas, precision, recall, F1, Brier score, row count and rates."""
    steps = cumulative_steps(score_steps(df, **columns))
    counts = steps.agg(
        _auc().alias("auc"),
        _average_precision().alias("ap"),
        _brier().alias("brier"),
        *[c.alias(name) for name, c in _at_threshold(threshold).items()],
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return counts.select(
        np_round("auc", digits).alias("roc_auc"),
        np_round("ap", digits).alias("pr_auc"),
        np_round(_share(tp * 2, tp * 2 + fp + fn), digits).alias("f1"),
        np_round(_share(tp, tp + fp), digits).alias("precision"),
        np_round(_share(tp, tp + fn), digits).alias("recall"),
        np_round("brier", digits).alias("brier"),
        F.lit(float(threshold)).alias("threshold"),
        n.alias("n_test"),
        np_round(_share(tp + fn, n), digits).alias("churn_rate_actual"),
        np_round(_share(tp + fp, n), digits).alias("churn_rate_predicted"),
    )


def confusion_matrix(df: DataFrame, threshold: float, digits: int = 6, **columns) -> DataFrame:
    """Four rows with counts and their share of the actual class (specificity is the 0/0 share)."""
    counts = score_steps(df, **columns).agg(*[c.alias(n) for n, c in _at_threshold(threshold).items()])
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = F.array(
        *[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n")) for a, p, c in cells]
    )
    actual_total = F.sum("n").over(Window.partitionBy("actual"))
    out = counts.select(F.explode(rows).alias("r")).select("r.*")
    return out.withColumn("share_of_actual", np_round(_share(F.col("n"), actual_total), digits))


def class_report(df: DataFrame, threshold: float, digits: int = 4, **columns) -> DataFrame:
    """Per-class precision, recall, F1, support, then accuracy, macro and weighted averages."""
    counts = score_steps(df, **columns).agg(*[c.alias(n) for n, c in _at_threshold(threshold).items()])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def per_class(hit, wrong, missed, support):
        return {
            "precision": _share(hit, hit + wrong),
            "recall": _share(hit, hit + missed),
            "f1_score": _share(hit * 2, hit * 2 + wrong + missed),
            "support": support,
        }

    kept, lost = per_class(tn, fn, fp, tn + fp), per_class(tp, fp, fn, tp + fn)
    n = tp + fp + fn + tn
    measures = ["precision", "recall", "f1_score"]
    accuracy = {m: _share(tp + tn, n) for m in measures} | {"support": n}
    macro = {m: (kept[m] + lost[m]) / F.lit(2.0) for m in measures} | {"support": n}
    weighted = {
        m: _share(kept[m] * kept["support"] + lost[m] * lost["support"], n) for m in measures
    } | {"support": n}
    lines = {"Retained": kept, "Churned": lost, "accuracy": accuracy, "macro avg": macro, "weighted avg": weighted}
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                *[np_round(line[m], digits).alias(m) for m in measures],
                line["support"].alias("support"),
            )
            for name, line in lines.items()
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def roc_curve(df: DataFrame, digits: int = 6, **columns) -> DataFrame:
    """Point per distinct threshold, with the origin as the point without one."""
    steps = cumulative_steps(score_steps(df, **columns))
    neg, total_neg = F.col("cum_n") - F.col("cum_pos"), F.col("total_n") - F.col("total_pos")
    points = steps.select(
        F.col("step").alias("threshold"),
        np_round(F.try_divide(neg, total_neg), digits).alias("fpr"),
        np_round(F.try_divide(F.col("cum_pos"), F.col("total_pos")), digits).alias("tpr"),
    )
    return _with_end_point(points, {"fpr": 0.0, "tpr": 0.0})


def pr_curve(df: DataFrame, digits: int = 6, **columns) -> DataFrame:
    """Point per distinct threshold, closed by precision 1 at recall 0."""
    steps = cumulative_steps(score_steps(df, **columns))
    points = steps.select(
        F.col("step").alias("threshold"),
        np_round(F.col("cum_pos") / F.col("cum_n"), digits).alias("precision"),
        np_round(F.try_divide(F.col("cum_pos"), F.col("total_pos")), digits).alias("recall"),
    )
    return _with_end_point(points, {"precision": 1.0, "recall": 0.0})


def _with_end_point(points: DataFrame, values: dict[str, float]) -> DataFrame:
    one = points.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(c) for c, v in values.items()]
    )
    return points.unionByName(one)


def threshold_sweep(
    df: DataFrame, hundredths: tuple[int, int] = SWEEP_HUNDREDTHS, digits: int = 6, **columns
) -> DataFrame:
    """Precision, recall and F1 at each threshold, from one histogram of the scores.

    Thresholds are whole hundredths, and a score counts from its threshold upwards.
    """
    scores = score_steps(df, **columns)
    # The product may round across a threshold; the comparison decides.
    near = F.floor(F.col("step") * 100.0)
    at_least = lambda i: F.col("step") >= (near + i) / F.lit(100.0)
    whole = near + F.when(at_least(1), 1).when(at_least(0), 0).otherwise(-1)
    per_bin = scores.groupBy(whole.cast("int").alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos")
    )
    bins = df.sparkSession.range(101).select(F.col("id").cast("int").alias("bin"))
    filled = bins.join(per_bin, "bin", "left").na.fill(0, ["n", "pos"])
    down = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = filled.select(
        "bin",
        F.sum("n").over(down).alias("flagged"),
        F.sum("pos").over(down).alias("tp"),
        F.sum("pos").over(Window.partitionBy()).alias("total_pos"),
    )
    tp, flagged, total = F.col("tp"), F.col("flagged"), F.col("total_pos")
    return sums.filter(F.col("bin").between(*hundredths)).select(
        (F.col("bin") / F.lit(100.0)).alias("threshold"),
        np_round(_share(tp, flagged), digits).alias("precision"),
        np_round(_share(tp, total), digits).alias("recall"),
        np_round(_share(tp * 2, flagged + total), digits).alias("f1"),
    )


def best_threshold(df: DataFrame, hundredths: tuple[int, int] = TUNE_HUNDREDTHS, **columns) -> DataFrame:
    """Lowest threshold with the highest F1; 0.5 when no threshold finds a positive."""
    sweep = threshold_sweep(df, hundredths, digits=10, **columns)
    best = sweep.agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold"))).alias("b"))
    found = F.col("b.f1") > 0
    return best.select(
        F.when(found, F.col("b.threshold")).otherwise(F.lit(FALLBACK_THRESHOLD)).alias("threshold"),
        np_round(F.col("b.f1"), 6).alias("f1"),
    )


def calibration(df: DataFrame, bins: int = 10, digits: int = 6, **columns) -> DataFrame:
    """Mean score and positive share per equal-width bin; a score on an edge belongs to the bin below."""
    steps = score_steps(df, **columns)
    near = F.ceil(F.col("step") * F.lit(float(bins)))
    above = lambda i: F.col("step") > (near + i) / F.lit(float(bins))
    bin_no = F.greatest(near + F.when(above(0), 0).when(above(-1), -1).otherwise(-2), F.lit(0)).cast("int")
    return (
        steps.groupBy(bin_no.alias("bin"))
        .agg(
            F.sum("n").alias("n"),
            np_round(F.sum(F.col("step") * F.col("n")) / F.sum("n"), digits).alias("mean_predicted"),
            np_round(F.sum("pos") / F.sum("n"), digits).alias("fraction_positive"),
        )
    )


def _offsets(steps: DataFrame) -> DataFrame:
    cumulative = cumulative_steps(steps)
    return cumulative.withColumns(
        {"n_before": F.col("cum_n") - F.col("n"), "pos_before": F.col("cum_pos") - F.col("pos")}
    )


def ranked_rows(
    df: DataFrame, key: str, label: str = "churned", score: str = "churn_probability", steps: DataFrame | None = None
) -> DataFrame:
    """Rank and running positives of rows by score, then by the hash of the key, then by the key.

    With `steps`, a few scores with what lies before them, only the rows of those are ranked.
    """
    step = (F.col(score).cast("double") + F.lit(0.0)).alias("step")
    rows = _known(df, label, score).select(
        key, label, step, F.md5(F.col(key).cast("string").cast("binary")).alias("_h"),
        F.lit(1).cast("bigint").alias("_one"), F.col(label).cast("bigint").alias("_pos"),
    )
    order = [F.col("step").desc(), F.col("_h"), F.col(key)]
    sums = {"rank": "_one", "cum_pos": "_pos"}
    if steps is None:
        return running(rows, order, sums, {"total_n": "_one", "total_pos": "_pos"}).drop("_h", "_one", "_pos")
    # One row per wanted cut. Each of its steps is counted on from the rows that lie before it.
    wanted = F.broadcast(steps.select("step", "n_before", "pos_before", "total_n", "total_pos").dropDuplicates(["step"]))
    some = running(rows.join(F.broadcast(steps.select("step").distinct()), "step", "left_semi"), order, sums)
    first = some.groupBy("step").agg(F.min("rank").alias("_first"), F.min(F.col("cum_pos") - F.col("_pos")).alias("_had"))
    return some.join(F.broadcast(first), "step").join(wanted, "step").select(
        key, label, "step",
        (F.col("rank") - F.col("_first") + 1 + F.col("n_before")).alias("rank"),
        (F.col("cum_pos") - F.col("_had") + F.col("pos_before")).alias("cum_pos"), "total_n", "total_pos",
    )


def cumulative_gain(df: DataFrame, key: str, digits: int = 6, **columns) -> DataFrame:
    """Gain, share contacted and lift after every single row."""
    ranked = ranked_rows(df, key, **columns)
    return _gains(ranked, F.col("rank"), digits, key, "rank")


def lift_curve(df: DataFrame, digits: int = 6, **columns) -> DataFrame:
    """Gain, share contacted and lift after every distinct score."""
    steps = cumulative_steps(score_steps(df, **columns)).withColumnRenamed("step", "score")
    return _gains(steps, F.col("cum_n"), digits, "score")


def _gains(df: DataFrame, contacted: Column, digits: int, *keep: str) -> DataFrame:
    gain = F.try_divide(F.col("cum_pos"), F.col("total_pos"))
    share = contacted / F.col("total_n")
    return df.select(
        *keep,
        np_round(gain, digits).alias("cum_gain"),
        np_round(share, digits).alias("pct_pop"),
        np_round(gain / (share + F.lit(1e-10)), digits).alias("lift"),
    )


def gain_at_k(df: DataFrame, key: str, percents: Sequence[int] = (10, 20), digits: int = 6, **columns) -> DataFrame:
    """Share of positives in the top k percent of rows (row count rounded down), and the lift."""
    wanted = F.explode(F.array(*[F.lit(k) for k in percents])).alias("percent")
    steps = checkpointed(_offsets(score_steps(df, **columns))).select("*", wanted)
    steps = steps.withColumn("cut", F.floor(F.col("total_n") * F.col("percent") / 100))
    whole = steps.groupBy("percent", "cut", "total_n", "total_pos").agg(
        F.sum(F.when(F.col("cum_n") <= F.col("cut"), F.col("pos")).otherwise(0)).alias("whole_pos")
    )
    cut_steps = steps.filter((F.col("n_before") < F.col("cut")) & (F.col("cum_n") > F.col("cut")))
    ranked = ranked_rows(df, key, steps=cut_steps, **columns)
    last = ranked.join(F.broadcast(cut_steps.select("step", "percent", "cut", "pos_before")), "step").filter(
        F.col("rank") == F.col("cut")
    )
    partial = last.select("percent", (F.col("cum_pos") - F.col("pos_before")).alias("partial_pos"))
    top = F.col("whole_pos") + F.coalesce("partial_pos", F.lit(0))
    gain = F.try_divide(top, F.col("total_pos"))
    return whole.join(partial, "percent", "left").select(
        "percent",
        F.col("cut").alias("contacted"),
        np_round(gain, digits).alias("gain"),
        np_round(gain / (F.col("percent") / F.lit(100.0)), digits).alias("lift"),
    )


def contacts_for_recall(
    df: DataFrame, key: str, percents: Sequence[int] = (50, 70, 80), digits: int = 6, **columns
) -> DataFrame:
    """Fewest rows, from the top, that hold the wanted percent of positives."""
    wanted = F.explode(F.array(*[F.lit(k) for k in percents])).alias("recall_pct")
    steps = checkpointed(_offsets(score_steps(df, **columns))).select("*", wanted)
    steps = steps.withColumn("goal", F.ceil(F.col("total_pos") * F.col("recall_pct") / 100))
    crossing = steps.filter((F.col("pos_before") < F.col("goal")) & (F.col("cum_pos") >= F.col("goal")))
    ranked = ranked_rows(df, key, steps=crossing, **columns)
    reached = ranked.join(F.broadcast(crossing.select("step", "recall_pct", "goal")), "step").filter(
        F.col("cum_pos") >= F.col("goal")
    )
    return (
        reached.groupBy("recall_pct")
        .agg(F.min("rank").alias("contacts"), F.first("total_n").alias("_n"))
        .select("recall_pct", "contacts", np_round(F.col("contacts") * 100.0 / F.col("_n"), digits).alias("pct_contacted"))
    )
