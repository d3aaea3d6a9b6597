import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cellrisk.operators import boosting, learn
from cellrisk.session import checkpointed, scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(800, 4))
    y = (rng.uniform(size=800) < 1 / (1 + np.exp(-x[:, 0] * 1.5 - x[:, 1] * x[:, 2]))).astype(int)
    data = [(f"k{i}", int(a), 1.0 + (i % 3), i % 5 == 0, *map(float, b)) for i, (a, b) in enumerate(zip(y, x))]
    df = spark.createDataFrame(data, "id string, churned int, class_weight double, is_validation boolean, a double, b double, c double, d double")
    return checkpointed(df.withColumn("features", array_to_vector(F.array("a", "b", "c", "d"))).coalesce(1))


def scores(model, rows):
    return np.array([r[0] for r in model.transform(rows).select(vector_to_array("probability")[1]).collect()])


def test_rounds_go_on_as_the_library_does(rows, monkeypatch):
    known = rows.filter("not is_validation")
    plain = GBTClassifier(featuresCol="features", labelCol="churned", weightCol="class_weight", maxIter=9, maxDepth=3, stepSize=0.1, seed=42).fit(known)
    grown = boosting.Boosting(rows, depth=3)
    grown.grow(2)
    grown.grow(4)
    grown.grow(3)
    assert len(grown.trees) == len(grown.losses) == 9
    assert scores(grown.model(9), rows) == pytest.approx(scores(plain, rows), abs=1e-9)
    assert grown.losses == pytest.approx(plain.evaluateEachIteration(rows.filter("is_validation")), abs=1e-9)


def test_a_prefix_is_the_shorter_fit(rows, spark):
    grown = boosting.Boosting(rows, depth=3)
    grown.grow(8)
    short = GBTClassifier(featuresCol="features", labelCol="churned", weightCol="class_weight", maxIter=5, maxDepth=3, stepSize=0.1, seed=42)
    cut = grown.model(5)
    assert cut.getNumTrees == 5 and cut.numFeatures == 4
    assert scores(cut, rows) == pytest.approx(scores(short.fit(rows.filter("not is_validation")), rows), abs=1e-12)
    path = scratch_path(spark, "cut")
    cut.write().save(path)
    assert (scores(GBTClassificationModel.load(path), rows) == scores(cut, rows)).all()


def test_stops_after_patience_and_keeps_the_best(rows, monkeypatch):
    monkeypatch.setattr(boosting, "AHEAD", 1)
    grown = boosting.Boosting(rows, depth=4, step=0.5)
    assert grown.grow(60, patience=4)
    assert len(grown.losses) - grown.best() == 4 and grown.losses[grown.best() - 1] == min(grown.losses)
    assert grown.model().getNumTrees == grown.best()


def test_without_validation_rows_all_rounds_stay(rows):
    grown = boosting.Boosting(rows.withColumn("is_validation", F.lit(None).cast("boolean")), depth=2)
    assert not grown.grow(3, patience=1) and grown.losses == [] and grown.model().getNumTrees == 3


def test_halving_gives_more_rounds_to_the_better(spark, sf_dir):
    from cellrisk.catalog.learning import rows as subscribers

    table = checkpointed(subscribers(spark, sf_dir))
    trials = [(1, 0.001), (2, 0.1), (3, 0.1), (1, 0.0001)]
    found = learn.search(table, "subscriber_id", trials, iterations=8, rounds=2)
    assert sorted(r[:2] for r in found) == sorted(trials) and found == learn.search(table, "subscriber_id", trials, iterations=8, rounds=2)
    assert found[0][3] >= found[1][3] and {r[0] for r in found[:1]} <= {2, 3} and all(r[2] <= 2 for r in found[2:])


def test_margins_stored_on_the_way_change_nothing(rows, monkeypatch):
    monkeypatch.setattr(boosting, "STORED_EVERY", 3)
    known = rows.filter("not is_validation")
    plain = GBTClassifier(featuresCol="features", labelCol="churned", weightCol="class_weight", maxIter=9, maxDepth=3, stepSize=0.1, seed=42).fit(known)
    kept = boosting.spread(rows)
    grown = boosting.Boosting(kept, depth=3)
    grown.grow(1)
    grown.grow(8)
    assert grown.stored == 6 and scores(grown.model(9), rows) == pytest.approx(scores(plain, rows), abs=1e-9)
    grown.close()
    # The given table is shared with other ensembles and stays kept.
    assert kept.storageLevel.useMemory and not grown.known.storageLevel.useMemory


def test_rows_are_spread_over_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    uneven = spark.range(1000).repartition(cores + 1)
    kept = boosting.spread(uneven)
    sizes = [len(x) for x in kept.rdd.glom().collect()]
    assert len(sizes) == 2 * cores and max(sizes) - min(sizes) <= cores + 1 and sum(sizes) == 1000
    assert boosting.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 1


def test_folds_are_trained_side_by_side(spark, sf_dir, monkeypatch):
    import threading

    from cellrisk.catalog.learning import rows as subscribers

    both, trained = threading.Barrier(2, timeout=120), learn.train

    def meet(*args, **settings):
        both.wait()
        return trained(*args, **settings)

    monkeypatch.setattr(learn, "train", meet)
    got = learn.cross_validate(subscribers(spark, sf_dir), "subscriber_id", k=2, iterations=2, depth=2)
    assert {(r["metric"], r["folds"]) for r in got.collect()} == {("roc_auc", 2), ("pr_auc", 2), ("f1", 2)}


@pytest.mark.parametrize("task", [1 << 14, 100])
def test_draws_bins_and_deep_trees_are_those_of_the_library(rows, monkeypatch, task):
    monkeypatch.setattr(boosting, "STORED_EVERY", 4)
    monkeypatch.setattr(boosting, "TASK", task)
    known = rows.filter("not is_validation")
    plain = GBTClassifier(
        featuresCol="features", labelCol="churned", weightCol="class_weight", maxIter=10, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, seed=42
    ).fit(known)
    grown = boosting.Boosting(rows, depth=5, subsample=0.8)
    grown.grow(3)
    grown.grow(7)
    made = grown.model(10)
    assert scores(made, rows) == pytest.approx(scores(plain, rows), abs=1e-9)
    assert made.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=1e-9)


def test_further_rounds_cost_no_fit_each(rows, monkeypatch):
    # A fit of the library turns all rows into its own form again.
    monkeypatch.setattr(boosting.GBTClassifier, "fit", None)
    tracker, context = rows.sparkSession.sparkContext.statusTracker(), rows.sparkSession.sparkContext
    context.setJobGroup("rounds", "further rounds")
    grown = boosting.Boosting(rows, depth=3)
    grown.grow(2)
    before = len(tracker.getJobIdsForGroup("rounds"))
    grown.grow(6)
    # A job for each level of each tree, and one look at the losses.
    assert len(tracker.getJobIdsForGroup("rounds")) - before <= 6 * 3 + 1
    context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("task", [1 << 14, 1000])
def test_thresholds_of_many_rows_are_those_of_the_library(spark, monkeypatch, task):
    monkeypatch.setattr(boosting, "TASK", task)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(12_000, 2)).round(3)
    data = [(int(a > b + e), float(1.0 + a % 1), False, float(a), float(b)) for (a, b), e in zip(x, rng.normal(size=len(x)))]
    df = spark.createDataFrame(data, "churned int, class_weight double, is_validation boolean, a double, b double").repartition(3)
    many = checkpointed(df.withColumn("features", array_to_vector(F.array("a", "b")))).persist()
    plain = GBTClassifier(featuresCol="features", labelCol="churned", weightCol="class_weight", maxIter=2, maxDepth=4, subsamplingRate=0.8, seed=42).fit(many)
    grown = boosting.Boosting(many, depth=4, subsample=0.8)
    grown.grow(2)
    assert scores(grown.model(2), many) == pytest.approx(scores(plain, many), abs=1e-9)
    grown.close()


def test_every_trial_of_a_search_grows_whole(spark, sf_dir):
    from cellrisk.catalog.learning import rows as subscribers

    table = checkpointed(subscribers(spark, sf_dir))
    trials = [(1, 0.001), (2, 0.002), (3, 0.002), (1, 0.0001)]
    found = learn.search(table, "subscriber_id", trials, iterations=12)
    # Steps so small lower the loss in each round: none is left behind after the first eight.
    assert sorted(r[:3] for r in found) == sorted((*t, 12) for t in trials)
    assert [r[3] for r in found] == sorted((r[3] for r in found), reverse=True)


def test_codes_of_several_features_have_the_sums_of_each():
    rng = np.random.default_rng(3)
    sizes = [2, 32, 1, 2, 7, 2, 32, 3, 2]
    bins, n = [rng.integers(0, s, 5000) for s in sizes], 5000
    block = rng.choice([-1.0, 1.0], n), rng.choice([1.0, 4.5], n), rng.normal(size=n), rng.integers(0, 4, n)
    tree, found = boosting.grow_tree(lambda *_: [], 0), []
    for most in (1, 64, 256):
        coding = boosting.Coding(sizes, most)
        blocks = [(coding.codes(bins), *block)]
        sums = lambda tree, slots, known: boosting.level_sums(blocks, tree, slots, len(known), coding, True, 1)  # noqa: B023, E731
        grown = boosting.grow_tree(lambda *level: boosting.best_splits(sums(*level), level[2], sizes), 3)  # noqa: B023
        found.append((len(coding.groups), sums(tree, np.zeros(1, int), [None]), grown, grown.nodes(blocks[0][0], coding)))
    assert [f[0] for f in found] == [9, 4, 3]
    for _, sums, grown, nodes in found[1:]:
        assert sums == pytest.approx(found[0][1], rel=1e-12, abs=1e-9)
        assert grown.feature.tolist() == found[0][2].feature.tolist() and grown.bin.tolist() == found[0][2].bin.tolist()
        assert (nodes == found[0][3]).all()


def test_ensembles_side_by_side_take_a_task_each(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TASK", 500)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=4000) > 0).astype(int)
    data = [(int(a), 1.0 + i % 2, i % 7 == 0, *map(float, b)) for i, (a, b) in enumerate(zip(y, x))]
    df = spark.createDataFrame(data, "churned int, class_weight double, is_validation boolean, a double, b double, c double").repartition(8)
    kept = checkpointed(df.withColumn("features", array_to_vector(F.array("a", "b", "c")))).persist()
    alone, beside = (boosting.Boosting(kept, depth=3, subsample=0.8, beside=n) for n in (1, spark.sparkContext.defaultParallelism))
    assert alone.binned.tasks > 1 and beside.binned.tasks == 1
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("beside", "rounds side by side")
    beside.grow(2)
    before = len(tracker.getJobIdsForGroup("beside"))
    beside.grow(6)
    assert len(tracker.getJobIdsForGroup("beside")) - before <= 2
    context.setLocalProperty("spark.jobGroup.id", None)
    alone.grow(8)
    assert scores(alone.model(8), kept) == pytest.approx(scores(beside.model(8), kept), abs=1e-9)
    assert alone.losses == pytest.approx(beside.losses, abs=1e-12)
    # More rows than one task should hold are dealt to several again.
    monkeypatch.setattr(boosting, "MOST", 1000)
    many = boosting.Binned(kept, beside=spark.sparkContext.defaultParallelism)
    assert many.tasks == 4
    for run in (alone, beside, many):
        run.close()
