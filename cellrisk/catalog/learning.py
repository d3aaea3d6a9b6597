"""Queries for samples, splits, training, scoring and explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellrisk.catalog.registry import query
from cellrisk.catalog.tables import r
from cellrisk.operators import learn, splits
from cellrisk.session import checkpointed, scratch_path
from cellrisk.sources.testbed import subscribers

# Production settings: rounds at most (boosting stops early on validation rows), depth and step; twenty trials of tuning.
ITERATIONS, DEPTH, STEP = 500, 6, 0.05
# Boosting stops when so many rounds have not lowered the validation loss.
PATIENCE = 50
TRIAL_DEPTHS, TRIAL_STEPS = (3, 4, 5, 6, 8), (0.01, 0.03, 0.08, 0.2)
MODEL_COLUMNS = [
    "subscriber_id", "senior_citizen", "contract_type", "payment_method", "internet_service", "tenure_months",
    "monthly_charges", "total_charges", "data_usage_gb", "call_minutes_monthly", "tech_support_calls", "rsrp_avg",
    "rsrq_avg", "dl_throughput_mbps", "call_drop_rate_pct", "call_drops_monthly", "outage_minutes_monthly", "churned",
]


def rows(spark, sf_dir):
    """The subscribers, written once: splits, encoders and models read them many times."""
    return checkpointed(subscribers(spark, sf_dir, MODEL_COLUMNS))


def trees(validation: str | None = "is_validation"):
    return learn.boosted_trees(iterations=ITERATIONS, depth=DEPTH, step=STEP, validation=validation, patience=PATIENCE)


@query("seeded_sample")
def seeded_sample(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "latitude", "longitude", "churned"])
    return splits.seeded_sample(base, "subscriber_id", 5000)


@query(
    "sample_per_class",
    """select subscriber_id, latitude, longitude, churned from (
         select *, row_number() over (partition by churned order by md5('42:' || subscriber_id)) as place from subscribers)
       where place <= 300""",
)
def sample_per_class(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "latitude", "longitude", "churned"])
    return splits.sample_per_group(base, "subscriber_id", "churned", 300)


@query("stratified_split")
def stratified_split(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "churned"])
    return splits.stratified_split(base, "subscriber_id")


@query(
    "stratified_split_shares",
    """select churned, count(*) as n, cast(round_even(count(*) * 2e-1, 0) as bigint) as n_test from subscribers group by 1""",
)
def stratified_split_shares(spark, sf_dir):
    return stratified_split(spark, sf_dir).groupBy("churned").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test")
    )


@query("stratified_folds")
def stratified_folds(spark, sf_dir):
    return splits.stratified_folds(subscribers(spark, sf_dir, ["subscriber_id", "churned"]), "subscriber_id")


@query(
    "stratified_fold_sizes",
    """select churned, cast(f as int) as fold, cast((n + 4 - f) // 5 as bigint) as n from
    (select churned, count(*) as n from subscribers group by 1), (select unnest(range(5)) as f)""",
)
def stratified_fold_sizes(spark, sf_dir):
    return stratified_folds(spark, sf_dir).groupBy("churned", "fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "class_weights",
    f"""select cast(sum(1 - churned) as bigint) as n_negative, cast(sum(churned) as bigint) as n_positive,
    {r('sum(1 - churned) / cast(sum(churned) as double)', 6)} as weight from subscribers""",
)
def class_weights(spark, sf_dir):
    return learn.class_weights(subscribers(spark, sf_dir, ["churned"]))


_OVERSAMPLED = ["tenure_months", "monthly_charges", "call_drops_monthly", "outage_minutes_monthly", "rsrq_avg"]


def _oversampled(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "churned", *_OVERSAMPLED])
    # Positives made scarce, so that there is something to add.
    scarce = base.withColumn("churned", F.when(F.col("tenure_months") % 4 == 0, F.col("churned")).otherwise(F.lit(0)))
    return learn.oversample(scarce, _OVERSAMPLED, "subscriber_id")


@query("oversample")
def oversample(spark, sf_dir):
    return _oversampled(spark, sf_dir)


@query(
    "oversample_counts",
    """with s as (select case when tenure_months % 4 = 0 then churned else 0 end as y from subscribers)
    select y as churned, false as synthetic, count(*) as n from s group by 1
    union all select 1, true, cast(floor(5e-1 * sum(1 - y)) - sum(y) as bigint) from s
    having floor(5e-1 * sum(1 - y)) - sum(y) > 0""",
)
def oversample_counts(spark, sf_dir):
    return _oversampled(spark, sf_dir).groupBy("churned", "synthetic").agg(F.count(F.lit(1)).alias("n"))


def _trained(spark, sf_dir, every=None):
    marked = checkpointed(splits.stratified_split(rows(spark, sf_dir) if every is None else every, "subscriber_id"))
    bundle = learn.fit_bundle(marked.filter(~F.col("is_test")).drop("is_test"), "subscriber_id", trees())
    return bundle, marked.filter("is_test").drop("is_test")


@query("train_gbt")
def train_gbt(spark, sf_dir):
    bundle, test = _trained(spark, sf_dir)
    return learn.quality(learn.score(bundle.model, test, digits=None), threshold=bundle.threshold)


@query("model_compare")
def model_compare(spark, sf_dir):
    return learn.compare_models(rows(spark, sf_dir), "subscriber_id", iterations=ITERATIONS, depth=DEPTH, step=STEP, patience=PATIENCE)


@query("tune")
def tune(spark, sf_dir):
    return learn.tune(rows(spark, sf_dir), "subscriber_id", TRIAL_DEPTHS, TRIAL_STEPS, iterations=ITERATIONS, patience=PATIENCE)


@query("tuned_model")
def tuned_model(spark, sf_dir):
    """Test metrics of the best trial's settings, fitted again on all training rows."""
    marked = checkpointed(splits.stratified_split(rows(spark, sf_dir), "subscriber_id"))
    known, test = marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")
    bundle = learn.fit_tuned(known, "subscriber_id", TRIAL_DEPTHS, TRIAL_STEPS, iterations=ITERATIONS, patience=PATIENCE)
    return learn.quality(learn.score(bundle.model, test, digits=None), threshold=bundle.threshold)


@query("cross_validate")
def cross_validate(spark, sf_dir):
    return learn.cross_validate(rows(spark, sf_dir), "subscriber_id", iterations=ITERATIONS, depth=DEPTH, step=STEP, patience=PATIENCE)


@query("batch_score")
def batch_score(spark, sf_dir):
    every = rows(spark, sf_dir)
    bundle, _ = _trained(spark, sf_dir, every)
    return learn.batch_score(bundle, every).select(
        "subscriber_id", "churn_probability", "churn_predicted", "risk_tier", "revenue_at_risk", "scored_at"
    )


@query("feature_importance")
def feature_importance(spark, sf_dir):
    bundle, _ = _trained(spark, sf_dir)
    return learn.feature_importance(bundle.model, spark)


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    bundle, test = _trained(spark, sf_dir)
    return learn.permutation_importance(bundle.model, test, "subscriber_id")


@query("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """Scores before and after saving and loading, side by side."""
    every = rows(spark, sf_dir)
    bundle, _ = _trained(spark, sf_dir, every)
    path = scratch_path(spark, "model")
    bundle.save(path)
    loaded = learn.ModelBundle.load(spark, path)
    before = learn.score(bundle.model, every).select("subscriber_id", F.col("churn_probability").alias("before"))
    after = learn.score(loaded.model, every).select("subscriber_id", F.col("churn_probability").alias("after"))
    return before.join(after, "subscriber_id")


# Plain weights in place of a model's importances.
FACTOR_WEIGHTS = {"tenure_months": 0.02, "monthly_charges": 0.015, "call_drops_monthly": 0.04, "outage_minutes_monthly": 0.003, "rsrq_avg": 0.03}


@query(
    "top_factors",
    f"""select subscriber_id, array_to_string(ranked_factors[1:3], ',') as top_factors from (
      select subscriber_id, [x.f for x in list_sort([{', '.join(f"{{'s': -({w}e0)*abs(cast({c} as double)), 'f': '{c}'}}" for c, w in FACTOR_WEIGHTS.items())}])] as ranked_factors
      from subscribers)""",
)
def top_factors(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", *FACTOR_WEIGHTS])
    found = learn.top_factors(base, FACTOR_WEIGHTS)
    return found.select("subscriber_id", F.concat_ws(",", "top_factors").alias("top_factors"))
