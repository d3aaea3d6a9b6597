import numpy as np
import pytest
from pyspark.sql import functions as F

from cellrisk.operators import evaluate as ev


def frame(spark, y, p):
    rows = [(f"k{i}", int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "id string, churned int, churn_probability double")


def auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def ap(y, p):
    total, out, last = y.sum(), 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / total
        out += (recall - last) * y[hit].mean()
        last = recall
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    p = rng.uniform(0, 1, 400).round(2)
    p[:150] = 0.37
    y = (rng.uniform(0, 1, 400) < p).astype(int)
    return y, p


def test_areas_with_ties(spark, data):
    y, p = data
    df = frame(spark, y, p)
    assert ev.roc_auc(df).first()[0] == pytest.approx(auc(y, p), abs=1e-6)
    assert ev.average_precision(df).first()[0] == pytest.approx(ap(y, p), abs=1e-6)
    assert ev.brier(df).first()[0] == pytest.approx(((p - y) ** 2).mean(), abs=1e-6)


def test_metrics_have_keys_and_ranges(spark, data):
    row = ev.classification_metrics(frame(spark, *data), 0.5).first().asDict()
    assert set(row) == {
        "roc_auc", "pr_auc", "f1", "precision", "recall", "brier", "threshold", "n_test", "churn_rate_actual",
        "churn_rate_predicted",
    }
    assert all(0 <= row[k] <= 1 for k in row if k != "n_test") and row["n_test"] == 400


def test_best_threshold_is_no_worse_than_half(spark, data):
    y, p = data
    best = ev.best_threshold(frame(spark, y, p)).first()
    assert 0.2 <= best["threshold"] <= 0.69

    def f1(t):
        hit = p >= t
        return 2 * y[hit].sum() / (hit.sum() + y.sum())

    assert best["f1"] >= f1(0.5) - 1e-6


def test_single_class_and_empty(spark):
    df = frame(spark, [0, 0, 0], [0.1, 0.6, 0.6])
    row = ev.classification_metrics(df, 0.5).first()
    assert row["roc_auc"] is None and row["precision"] == 0.0 and row["recall"] == 0.0
    assert ev.best_threshold(df).first()["threshold"] == 0.5
    assert ev.roc_auc(df.limit(0)).first()[0] is None
    assert ev.cumulative_gain(df, "id").count() == 3


def test_gain_is_complete_and_monotone_under_a_hot_score(spark, data):
    y, p = data
    rows = ev.cumulative_gain(frame(spark, y, p), "id").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 401))
    gains = [r["cum_gain"] for r in rows]
    assert gains == sorted(gains) and gains[-1] == 1.0
    by_id = {r["id"]: r["rank"] for r in rows}
    order = sorted(range(400), key=lambda i: by_id[f"k{i}"])
    assert all(p[a] >= p[b] for a, b in zip(order, order[1:]))
    reach = {r["recall_pct"]: r["contacts"] for r in ev.contacts_for_recall(frame(spark, y, p), "id").collect()}
    cum = np.cumsum(y[order])
    for pct, contacts in reach.items():
        assert contacts == int(np.argmax(cum * 100 >= pct * y.sum())) + 1
    for r in ev.gain_at_k(frame(spark, y, p), "id").collect():
        assert r["gain"] == pytest.approx(cum[r["contacted"] - 1] / y.sum(), abs=1e-6)


def test_calibration_edges_belong_below(spark):
    rows = ev.calibration(frame(spark, [0, 1, 1, 0], [0.0, 0.1, 0.11, 1.0])).orderBy("bin").collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(0, 2), (1, 1), (9, 1)]


@pytest.fixture
def many_parts(spark):
    had = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    for c, value in had.items():
        spark.conf.set(c, value)


def test_scores_closer_than_any_rounding(spark, many_parts):
    rng = np.random.default_rng(5)
    p = 0.5 + rng.permutation(600) * 1e-12
    y = (rng.uniform(0, 1, 600) < 0.3 + 0.4 * (p > np.median(p))).astype(int)
    df = frame(spark, y, p)
    assert ev.roc_auc(df).first()[0] == pytest.approx(auc(y, p), abs=1e-6)
    assert ev.average_precision(df).first()[0] == pytest.approx(ap(y, p), abs=1e-6)
    at = float(np.sort(p)[217])
    row = ev.classification_metrics(df, at).first()
    assert row["recall"] == pytest.approx(y[p >= at].sum() / y.sum(), abs=1e-4)
    order = np.argsort(-p)
    gains = {r["id"]: r["cum_gain"] for r in ev.cumulative_gain(df, "id").collect()}
    for i, g in zip(order, np.cumsum(y[order]) / y.sum()):
        assert gains[f"k{i}"] == pytest.approx(g, abs=1e-6)


def test_rows_of_one_score_are_ranked_by_hash(spark, many_parts):
    import hashlib

    rng = np.random.default_rng(6)
    p = rng.uniform(0, 1, 900)
    p[:300] = 0.5
    y = rng.integers(0, 2, 900)
    df = frame(spark, y, p)
    order = sorted(range(900), key=lambda i: (-p[i], hashlib.md5(f"k{i}".encode()).hexdigest()))
    ranks = {r["id"]: r["rank"] for r in ev.ranked_rows(df, "id").collect()}
    assert [ranks[f"k{i}"] for i in order] == list(range(1, 901))
    cut = int(np.floor(900 * 0.5))
    top = ev.gain_at_k(df, "id", (50,)).first()
    assert (top["contacted"], top["gain"]) == (cut, pytest.approx(y[order[:cut]].sum() / y.sum(), abs=1e-6))


def test_running_sums_never_meet_in_one_task(spark, many_parts):
    steps = ev.score_steps(spark.range(4000).selectExpr("id % 2 as churned", "rand(3) as churn_probability"))
    parted = ev.running(steps, [F.col("step").desc()], {"cum_n": "n"})
    sizes = [len(list(x)) for x in parted.rdd.glom().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500
    assert sorted(r["cum_n"] for r in parted.collect()) == list(range(1, 4001))


def test_scores_without_a_number_are_left_out(spark):
    df = spark.createDataFrame([("a", 1, float("nan")), ("b", 1, None), ("c", None, 0.5), ("d", 1, 0.9), ("e", 0, 0.0), ("f", 0, -0.0)], "id string, churned int, churn_probability double")
    assert sorted(map(tuple, ev.score_steps(df).collect())) == [(0.0, 2, 0), (0.9, 1, 1)]
    assert ev.roc_auc(df).first()[0] == 1.0
    assert ev.cumulative_gain(df.where("false"), "id").count() == 0 and ev.roc_auc(df.where("false")).first()[0] is None


def test_thresholds_meet_the_scores_they_equal(spark):
    p = [i / 100 for i in range(101)] + [np.nextafter(i / 100, -1) for i in range(1, 101)]
    df = spark.createDataFrame([(str(i), 1, float(x)) for i, x in enumerate(p)], "id string, churned int, churn_probability double")
    for r in ev.threshold_sweep(df, (1, 99)).collect():
        assert r["recall"] == pytest.approx(sum(x >= r["threshold"] for x in p) / len(p), abs=1e-6)
    bins = {r["bin"]: r["n"] for r in ev.calibration(df).collect()}
    assert bins == {b: sum(x > b / 10 and x <= (b + 1) / 10 or (b == 0 and x <= 0) for x in p) for b in range(10)}

def test_numeric_keys_rank_too(spark, data):
    y, p = data
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    df = spark.createDataFrame(rows, "id long, churned int, churn_probability double")
    ranks = [r["rank"] for r in ev.cumulative_gain(df, "id").collect()]
    assert sorted(ranks) == list(range(1, 401))
