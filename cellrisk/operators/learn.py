"""Training, scoring, tuning and explanation on Spark ML."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellrisk.functions.numeric import np_round
from cellrisk.functions.scoring import with_predictions
from cellrisk.operators import evaluate
from cellrisk.operators.boosting import Binned, Boosting, EarlyStopping, spread
from cellrisk.operators.encode import ABSENT_VALUE, NON_FEATURES, NULL_VALUE, OneHotLevels, feature_list
from cellrisk.operators.features import NetworkFeatures, SubscriberFeatures
from cellrisk.operators.ordered import running
from cellrisk.operators.splits import SEED, hash_ranks, stratified_folds, stratified_split, uniform
from cellrisk.session import checkpointed

# Class weight of positives, oversampling target and neighbours.
POSITIVE_WEIGHT = 4.5
OVERSAMPLE_RATIO = 0.5
NEIGHBORS = 5


class FeatureArray(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Aligned features as one vector: an absent column counts 0, NULL counts -999."""

    features = Param(Params._dummy(), "features", "feature names, as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(features="[]", outputCol="features")

    def names(self) -> list[str]:
        return json.loads(self.getOrDefault("features"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(
            self.getOrDefault("outputCol"), array_to_vector(feature_array(dataset, self.names()))
        )


def feature_array(df: DataFrame, names: Sequence[str]) -> Column:
    have = set(df.columns)
    values = [
        F.coalesce(F.col(c).cast("double"), F.lit(float(NULL_VALUE))) if c in have else F.lit(float(ABSENT_VALUE))
        for c in names
    ]
    return F.array(*values)


def fit_features(train: DataFrame, exclude: Sequence[str] = ()) -> PipelineModel:
    """Feature stages with the levels and the feature list of the training rows."""
    encoder = Pipeline(stages=[SubscriberFeatures(), NetworkFeatures(), OneHotLevels()]).fit(train)
    names = feature_list(encoder.transform(train.limit(0)), [*NON_FEATURES, *exclude])
    aligned = FeatureArray()
    aligned._set(features=json.dumps(names))
    return PipelineModel([*encoder.stages, aligned])


def feature_names(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, FeatureArray)).names()


def class_weights(df: DataFrame, label: str = "churned") -> DataFrame:
    """One row: counts of both classes and their ratio."""
    positives = F.sum(F.col(label).cast("bigint"))
    return df.agg(
        (F.count(label) - positives).alias("n_negative"),
        positives.alias("n_positive"),
        np_round(F.try_divide((F.count(label) - positives).cast("double"), positives), 6).alias("weight"),
    )


def with_class_weight(df: DataFrame, label: str = "churned", weight: float | None = None) -> DataFrame:
    """Add `class_weight`: 1 for negatives, `weight` or the class ratio for positives."""
    value = F.lit(float(weight)) if weight is not None else class_weights(df, label).select("weight").scalar()
    return df.withColumn("class_weight", F.when(F.col(label) == 1, value).otherwise(F.lit(1.0)))


def boosted_trees(
    label: str = "churned", iterations: int = 20, depth: int = 5, step: float = 0.1, subsample: float = 0.8,
    weight: str | None = "class_weight", validation: str | None = None, seed: int = SEED,
    patience: int | None = None, beside: int = 1,
) -> Estimator:
    """Without `patience`, boosting with `validation` stops at the first round that gains less than a hundredth.

    `beside`: learners that are fitted at the same time and share the cores.
    """
    if validation and patience:
        return EarlyStopping(label, weight, validation, iterations, depth, step, subsample, seed, patience, beside)
    learner = GBTClassifier(
        featuresCol="features", labelCol=label, maxIter=iterations, maxDepth=depth, stepSize=step,
        subsamplingRate=subsample, seed=seed, cacheNodeIds=False, maxMemoryInMB=512,
    )
    if weight:
        learner = learner.setWeightCol(weight)
    return learner.setValidationIndicatorCol(validation) if validation else learner


def random_forest(label: str = "churned", trees: int = 30, depth: int = 6, weight: str | None = "class_weight", seed: int = SEED) -> RandomForestClassifier:
    learner = RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    return learner.setWeightCol(weight) if weight else learner


def train(
    rows: DataFrame, key: str, learner: Estimator | None = None, label: str = "churned", validation_share: float = 0.15
) -> PipelineModel:
    """Split off validation rows first, then weight classes and fit; boosting stops early on them."""
    features = fit_features(rows)
    marked = stratified_split(rows, key, label, validation_share).withColumnRenamed("is_test", "is_validation")
    prepared = with_class_weight(features.transform(marked), label).select(
        label, "class_weight", "is_validation", "features"
    )
    chosen = learner or boosted_trees(label, validation="is_validation")
    # Training reads its input again for every level of every tree: give it a written table.
    written = checkpointed(prepared)
    stops = isinstance(chosen, EarlyStopping) or (chosen.hasParam("validationIndicatorCol") and chosen.isSet("validationIndicatorCol"))
    # A learner that does not stop by them is not shown the validation rows either, so learners compare on equal terms.
    fitted = chosen.fit(written if stops else written.filter(~F.col("is_validation")))
    return PipelineModel([*features.stages, fitted])


def probability_column(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def score(model: PipelineModel, rows: DataFrame, digits: int | None = 4) -> DataFrame:
    """Adds churn_probability; `digits=None` leaves it unrounded, for decisions."""
    raw = probability_column()
    scored = model.transform(rows).withColumn("churn_probability", raw if digits is None else np_round(raw, digits))
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def batch_score(bundle: ModelBundle, rows: DataFrame) -> DataFrame:
    """Probability, label, tier, revenue at risk and time of scoring."""
    scored = with_predictions(score(bundle.model, rows, digits=None), threshold=bundle.threshold, digits=4)
    return scored.withColumn("scored_at", F.current_timestamp())


@dataclass(frozen=True)
class ModelBundle:
    """Fitted pipeline with the decision threshold and the feature names it was trained on."""

    model: PipelineModel
    threshold: float
    features: list[str]

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        side = spark.createDataFrame([(self.threshold, self.features)], "threshold double, features array<string>")
        side.coalesce(1).write.mode("overwrite").parquet(f"{path}/sidecar")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ModelBundle:
        side = spark.read.parquet(f"{path}/sidecar").first()
        return ModelBundle(PipelineModel.load(f"{path}/model"), side["threshold"], list(side["features"]))


def fit_bundle(rows: DataFrame, key: str, learner: Estimator | None = None, label: str = "churned") -> ModelBundle:
    """Train on a share of the rows, and tune the threshold on the rows kept apart."""
    marked = checkpointed(stratified_split(rows, key, label, 0.15, seed=SEED + 1))
    model = train(marked.filter(~F.col("is_test")).drop("is_test"), key, learner, label)
    held_out = checkpointed(score(model, marked.filter("is_test").drop("is_test"), digits=None).select(label, "churn_probability"))
    threshold = evaluate.best_threshold(held_out, label=label).first()["threshold"]
    return ModelBundle(model, float(threshold), feature_names(model))


def search(
    rows: DataFrame, key: str, trials: Sequence[tuple[int, float]], label: str = "churned", iterations: int = 500, patience: int = 50,
    rounds: int | None = None, parallelism: int = 8, seed: int = SEED,
) -> list[tuple[int, float, int, float]]:
    """(depth, step, rounds, average precision on rows kept apart) of each trial, best first.

    Every trial grows until `iterations` rounds, or `patience` rounds without a lower loss. Trials share one written table of
    prepared rows; a hash of the key sets a share of each class apart, the same for all. Equal results go to the shallower,
    then slower trial. With `rounds`, trials are left behind by successive halving: all grow for `rounds` rounds, the better
    half goes on from there for as many again, and so on, each time with twice the rounds, until one is left.
    """
    features = fit_features(rows)
    marked = stratified_split(rows, key, label, 0.15, seed=seed).withColumnRenamed("is_test", "is_validation")
    written = checkpointed(
        with_class_weight(features.transform(marked), label).select(label, "class_weight", "is_validation", "features")
    )
    prepared = spread(written)
    binned = Binned(prepared, label, seed=seed, beside=max(1, min(parallelism, len(set(trials)))))
    runs = {t: Boosting(prepared, label, depth=t[0], step=t[1], subsample=0.8, seed=seed, shared=binned) for t in dict.fromkeys(trials)}
    done: dict[tuple[int, float], tuple[int, float]] = {}
    turns = dict.fromkeys(runs, 0)

    def go(trial: tuple[int, float]) -> tuple[int, float, int, float]:
        run = runs[trial]
        run.grow(min(more, iterations - len(run.trees)), patience)
        scored = checkpointed(run.held_scores())
        found = evaluate.average_precision(scored, digits=10, label="label", score="score").first()["average_precision"]
        turns[trial] += 1
        if more >= iterations:
            run.close()
        return (*trial, run.best(), float(found or 0.0))

    # The deepest take longest: they begin first.
    left, more, grown = sorted(runs, key=lambda t: -t[0]), rounds or iterations, 0
    while True:
        with ThreadPoolExecutor(parallelism) as pool:
            results = sorted(pool.map(go, left), key=lambda r: (-r[3], r[0], r[1]))
        done.update({r[:2]: r[2:] for r in results})
        grown += more
        if len(left) == 1 or grown >= iterations:
            break
        for r in results[(len(left) + 1) // 2 :]:
            runs[r[:2]].close()
        left = [r[:2] for r in results[: (len(left) + 1) // 2]]
        more = grown
    for trial in left:
        runs[trial].close()
    binned.close()
    prepared.unpersist()
    # A trial that went on further is ahead of one that was left behind.
    places = {r[:2]: i for i, r in enumerate(results)}
    told = [(*t, *done[t], places.get(t, len(runs)), turns[t]) for t in runs]
    told.sort(key=lambda r: (-r[5], r[4], -r[3], r[0], r[1]))
    return [r[:4] for r in told]


def tune(rows: DataFrame, key: str, depths: Sequence[int] = (3, 5), steps: Sequence[float] = (0.05, 0.1), label: str = "churned", **settings) -> DataFrame:
    """All pairs of `depths` and `steps`, as `search` orders them: one row per trial."""
    found = search(rows, key, [(d, s) for d in depths for s in steps], label, **settings)
    listed = [(i, *r[:3], round(r[3], 6)) for i, r in enumerate(found, 1)]
    return rows.sparkSession.createDataFrame(listed, "place int, max_depth int, step_size double, rounds int, average_precision double")


def fit_tuned(
    rows: DataFrame, key: str, depths: Sequence[int] = (3, 5), steps: Sequence[float] = (0.05, 0.1), label: str = "churned",
    iterations: int = 500, patience: int = 50, **settings,
) -> ModelBundle:
    """Search, then fit the best trial's settings again on all of `rows` with early stopping and a tuned threshold."""
    trials = [(d, s) for d in depths for s in steps]
    depth, step, *_ = search(rows, key, trials, label, iterations, patience, **settings)[0]
    return fit_bundle(rows, key, boosted_trees(label, iterations, depth, step, validation="is_validation", patience=patience), label)


def quality(scored: DataFrame, label: str = "churned", threshold: float = 0.5) -> DataFrame:
    # Scored once and written: the metrics then read two narrow columns.
    narrow = checkpointed(scored.select(label, "churn_probability"))
    return evaluate.classification_metrics(narrow, threshold, label=label)


def compare_models(
    rows: DataFrame, key: str, label: str = "churned", iterations: int = 10, depth: int = 5, step: float = 0.1,
    patience: int | None = None,
) -> DataFrame:
    """Test metrics of boosted trees and a random forest on the same split and features."""
    marked = checkpointed(stratified_split(rows, key, label, 0.2))
    test = marked.filter("is_test").drop("is_test")
    learners = {
        "boosted_trees": boosted_trees(label, iterations, depth, step, validation="is_validation", patience=patience),
        "random_forest": random_forest(label, trees=iterations),
    }

    def go(name: str) -> DataFrame:
        model = train(marked.filter(~F.col("is_test")).drop("is_test"), key, learners[name], label)
        return quality(score(model, test, digits=None), label).select(F.lit(name).alias("model"), "*")

    with ThreadPoolExecutor(len(learners)) as pool:
        return reduce(DataFrame.unionByName, pool.map(go, learners))


def cross_validate(
    rows: DataFrame, key: str, k: int = 5, label: str = "churned", iterations: int = 10, depth: int = 5, step: float = 0.1,
    patience: int | None = None, parallelism: int = 5,
) -> DataFrame:
    """Mean and standard deviation of AUC, average precision and F1 over k balanced folds."""
    folds = checkpointed(stratified_folds(rows, key, label, k))
    beside = max(1, min(k, parallelism))

    def go(i: int) -> DataFrame:
        learner = boosted_trees(label, iterations, depth, step, validation="is_validation", patience=patience, beside=beside)
        model = train(folds.filter(F.col("fold") != i).drop("fold"), key, learner, label)
        return quality(score(model, folds.filter(F.col("fold") == i), digits=None), label).select(F.lit(i).alias("fold"), "roc_auc", "pr_auc", "f1")

    # Rounds of boosting are many short jobs: folds side by side keep the cores busy.
    with ThreadPoolExecutor(beside) as pool:
        lines = list(pool.map(go, range(k)))
    long = checkpointed(reduce(DataFrame.unionByName, lines)).unpivot(["fold"], ["roc_auc", "pr_auc", "f1"], "metric", "value")
    return long.groupBy("metric").agg(
        np_round(F.avg("value"), 4).alias("mean"),
        np_round(F.stddev_pop("value"), 4).alias("std"),
        F.count("value").alias("folds"),
    )


def feature_importance(model: PipelineModel, spark: SparkSession, k: int = 30) -> DataFrame:
    """Importance per feature; as many rows as the model has features."""
    values = model.stages[-1].featureImportances.toArray()
    pairs = sorted(zip(feature_names(model), map(float, values), strict=True), key=lambda p: (-p[1], p[0]))[:k]
    return spark.createDataFrame(pairs, "feature string, importance double")


def permutation_importance(
    model: PipelineModel, rows: DataFrame, key: str, label: str = "churned", features: Sequence[str] | None = None
) -> DataFrame:
    """Loss of average precision when one feature's values are dealt out to other rows.

    Every row gets one donor row by joining two hash ranks, one-to-one. All features are then scored
    in one pass, each on a copy of the row with that feature replaced.
    """
    names = feature_names(model)
    wanted = list(features or names)
    stages = PipelineModel(list(model.stages[:-1]))
    vectors = stages.transform(rows).select(key, label, vector_to_array("features").alias("x"))
    keyed = checkpointed(vectors.withColumn("_all", F.lit(0)))
    receivers = hash_ranks(keyed, key, "_all", SEED, "r")
    donors = hash_ranks(keyed.select(key, "_all", F.col("x").alias("donor")), key, "_all", SEED + 1, "r")
    paired = checkpointed(receivers.select(label, "x", "r").join(donors.select("donor", "r"), "r"))
    # -1 keeps the row as it is, for the score to compare with.
    copies = F.explode(F.array(F.lit(-1), *[F.lit(names.index(f)) for f in wanted])).alias("j")
    changed = paired.select(label, "x", "donor", copies).select(
        label,
        "j",
        array_to_vector(
            F.transform("x", lambda v, i: F.when(i == F.col("j"), F.get(F.col("donor"), i)).otherwise(v))
        ).alias("features"),
    )
    scored = model.stages[-1].transform(changed).select(label, "j", probability_column().alias("step"))
    steps = scored.groupBy("j", "step").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )
    summed = running(steps, [F.col("j"), F.col("step").desc()], {"cum_n": "n", "cum_pos": "pos"})
    # Sums run on from feature to feature: each counts from where it begins.
    had = summed.groupBy("j").agg(F.min(F.col("cum_n") - F.col("n")).alias("n0"), F.min(F.col("cum_pos") - F.col("pos")).alias("pos0"))
    steps = summed.join(F.broadcast(had), "j")
    gained = F.col("pos") * ((F.col("cum_pos") - F.col("pos0")) / (F.col("cum_n") - F.col("n0")))
    precision = checkpointed(
        steps.withColumn("g", gained).groupBy("j").agg(F.try_divide(F.sum("g"), F.sum("pos")).alias("ap"))
    )
    whole = precision.filter("j = -1").select("ap").scalar()
    listed = F.array(*[F.lit(n) for n in names])
    return (
        precision.filter("j >= 0")
        .select(F.get(listed, F.col("j")).alias("feature"), np_round(whole - F.col("ap"), 6).alias("loss"))
        .orderBy(F.col("loss").desc(), "feature")
    )


def top_factors(df: DataFrame, weights: dict[str, float], k: int = 3, name: str = "top_factors") -> DataFrame:
    """The k features with the largest weight x |value| of each row, largest first."""
    scored = F.array(
        *[
            F.struct((-F.lit(float(w)) * F.abs(F.coalesce(F.col(c).cast("double"), F.lit(float(NULL_VALUE))))).alias("s"), F.lit(c).alias("f"))
            for c, w in weights.items()
        ]
    )
    return df.withColumn(name, F.transform(F.slice(F.array_sort(scored), 1, k), lambda e: e["f"]))


def near_along(
    points: DataFrame, key: str, dims: int, k: int = NEIGHBORS, projections: int = 6, reach: int = 8, block: int = 4096,
    refine: int = 2, seed: int = SEED,
) -> DataFrame:
    """(key, other, place): up to `k` close rows of each row of `points` (key, z array of `dims` numbers), nearest first.

    Along each of a few random directions all rows get a rank, over the whole table; equal projections are ordered by a
    second one. Ranks are cut into blocks of `block` rows, and the `reach` rows at a block's border are copied to the block
    beyond it, so every row meets the same rows wherever the borders lie. Then, `refine` times, each row also looks at the
    close rows of its close rows (twice `k` are kept until the end), which makes up for what few directions miss as
    rows become more. No group is paired with itself, however many rows look alike.
    """
    block, pool = max(block, reach), 2 * k
    draw = random.Random(seed)
    directions = [[draw.gauss(0.0, 1.0) for _ in range(dims)] for _ in range(projections)]
    dot = lambda d: F.aggregate(F.zip_with("z", F.array(*map(F.lit, d)), lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    along = [F.struct(dot(d).alias("at"), dot(directions[i - 1]).alias("then")) for i, d in enumerate(directions)]
    long = points.select(key, "z", F.posexplode(F.array(*along)).alias("direction", "on"), F.lit(1).cast("bigint").alias("one"))
    ranked = running(long, [F.col("direction"), F.col("on.at"), F.col("on.then"), F.col(key)], {"rank": "one"})
    own = F.floor((F.col("rank") - 1) / block)
    offset = (F.col("rank") - 1) % block
    met = F.array_compact(F.array(own, F.when(offset < reach, own - 1), F.when(offset >= block - reach, own + 1)))
    copied = ranked.withColumns({"own": own, "block": F.explode(met)})
    order = Window.partitionBy("block").orderBy("rank")
    other = F.struct("direction", F.col(key).alias("k"), "z")
    beside = F.array(*[f(other, i).over(order) for i in range(1, reach + 1) for f in (F.lag, F.lead)])
    sides = copied.withColumn("sides", beside).filter(F.col("block") == F.col("own"))
    pairs = sides.select(key, "z", "direction", F.explode("sides").alias("o")).filter(F.col("o.direction") == F.col("direction"))
    gap = lambda z: F.aggregate(F.zip_with("z", z, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v).alias("gap")
    nearest = Window.partitionBy(key).orderBy("gap", "other")
    best = lambda found: found.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= pool)
    near = checkpointed(best(pairs.select(key, F.col("o.k").alias("other"), gap(F.col("o.z"))).dropDuplicates([key, "other"])))
    for _ in range(refine):
        beyond = near.select(F.col(key).alias("other"), F.col("other").alias("next"))
        new = near.select(key, "other").join(beyond, "other").filter(F.col("next") != F.col(key)).select(key, F.col("next").alias("other")).distinct()
        new = new.join(near.select(key, "other"), [key, "other"], "left_anti")
        new = new.join(points.select(key, "z"), key).join(points.select(F.col(key).alias("other"), F.col("z").alias("y")), "other")
        near = checkpointed(best(near.drop("place").unionByName(new.select(key, "other", gap(F.col("y"))))))
    return near.filter(F.col("place") <= k).select(key, "other", "place")


def oversample(
    df: DataFrame, columns: Sequence[str], key: str, label: str = "churned", ratio: float = OVERSAMPLE_RATIO,
    k: int = NEIGHBORS, projections: int = 6, reach: int = 8, block: int = 4096, seed: int = SEED,
) -> DataFrame:
    """(label, columns.., synthetic): the rows plus interpolated positives until positives / negatives
    reaches `ratio`.

    A synthetic row lies between a positive row and one of its neighbours (`near_along`, on scaled columns). A column that
    either of the two has no value in keeps the first row's value or NULL.
    """
    names = list(columns)
    # One row of counts.
    counts = class_weights(df, label).first()
    n_new = max(int(math.floor(ratio * counts["n_negative"])) - (counts["n_positive"] or 0), 0)
    original = df.select(label, *[F.col(c).cast("double") for c in names], F.lit(False).alias("synthetic"))
    if n_new == 0 or counts["n_positive"] < 2:
        return original
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in names}
    positives = df.filter(F.col(label) == 1).select(key, *[known[c].alias(f"_c{i}") for i, c in enumerate(names)])
    # One row of moments per column.
    moments = positives.agg(
        *[
            F.struct(F.coalesce(F.avg(f"_c{i}"), F.lit(0.0)).alias("m"), F.coalesce(F.nullif(F.stddev_samp(f"_c{i}"), F.lit(0.0)), F.lit(1.0)).alias("s")).alias(f"_c{i}")
            for i in range(len(names))
        ]
    ).first()
    raw = F.array(*[F.col(f"_c{i}") for i in range(len(names))])
    scaled = F.array(*[F.coalesce((F.col(c) - F.lit(moments[c]["m"])) / F.lit(moments[c]["s"]), F.lit(0.0)) for c in positives.columns[1:]])
    minority = checkpointed(positives.select(key, raw.alias("x"), scaled.alias("z")))
    near = near_along(minority.select(key, "z"), key, len(names), k, projections, reach, block, seed=seed)
    told = near.join(minority.select(F.col(key).alias("other"), F.col("x").alias("y")), "other")
    lists = told.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", F.col("y").alias("x")))).alias("near"))
    neighbors = lists.join(minority.select(key, "x"), key)
    base, rest = divmod(n_new, counts["n_positive"])
    ranked = hash_ranks(neighbors.withColumn("_all", F.lit(0)), key, "_all", seed, "r")
    copies = F.lit(base) + F.when(F.col("r") < rest, 1).otherwise(0)
    made = ranked.withColumn("copies", copies).filter(F.col("copies") > 0).select(
        key, "x", "near", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("i")
    )
    pick = F.floor(uniform(key, F.col("i"), seed) * F.size("near")).cast("int")
    share = uniform(key, F.col("i"), seed + 1)
    placed = made.withColumns({"to": F.get(F.col("near"), pick)["x"], "u": share})
    mixed = placed.withColumn("v", F.zip_with("x", "to", lambda a, b: F.coalesce(a + F.col("u") * (b - a), a)))
    synthetic = mixed.select(
        F.lit(1).alias(label), *[F.get(F.col("v"), i).alias(c) for i, c in enumerate(names)], F.lit(True).alias("synthetic")
    )
    return original.unionByName(synthetic)
