import numpy as np
import pytest
from pyspark.sql import functions as F

from cellrisk.operators import drift, profile, quality, risk
from cellrisk.operators.quantiles import exact_quantiles
from cellrisk.sources.testbed import subscribers


def numbers(spark, values, name="x", extra=0):
    return spark.createDataFrame([(float(v), extra) for v in values], f"{name} double, g int")


@pytest.mark.parametrize("kind", ["smooth", "hot", "tiny", "constant"])
def test_quantiles_equal_numpy(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "smooth": rng.normal(0, 10, 3000),
        "hot": np.concatenate([np.full(1000, 5.0), rng.exponential(3, 2000)]),
        "tiny": np.array([3.0, 1.0]),
        "constant": np.full(50, 2.5),
    }[kind]
    points = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    row = exact_quantiles(numbers(spark, values), ["x"], points).first()
    assert row["n"] == len(values)
    assert np.allclose(row["q"], np.percentile(values, [p * 100 for p in points]))


def numpy_psi(expected, actual, bins=10):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, bins + 1)))
    e = np.histogram(expected, edges)[0] / (len(expected) + 1e-10)
    a = np.histogram(actual, edges)[0] / (len(actual) + 1e-10)
    return float(np.sum((a - e) * np.log((a + 1e-10) / (e + 1e-10))))


@pytest.mark.parametrize("shift", [0.0, 1.5])
def test_psi_equals_numpy(spark, shift):
    rng = np.random.default_rng(4)
    ref, cur = rng.normal(0, 1, 800).round(3), rng.normal(shift, 1, 500).round(3)
    row = drift.psi(numbers(spark, ref), numbers(spark, cur), ["x"]).first()
    assert row["psi"] == pytest.approx(numpy_psi(ref, cur), abs=1e-6)
    assert (row["n_reference"], row["n_current"]) == (800, 500)
    report = drift.drift_report(drift.psi(numbers(spark, ref), numbers(spark, cur), ["x"])).first()
    assert report["retrain"] == (numpy_psi(ref, cur) > 0.2)


def test_psi_of_a_constant_is_zero(spark):
    row = drift.psi(numbers(spark, [1.0] * 10), numbers(spark, [1.0, 2.0]), ["x"]).first()
    assert row["psi"] == 0.0


def test_describe_with_an_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    rows = {r["column"]: r for r in profile.describe(df, ["a", "b"]).collect()}
    assert rows["a"]["mean"] == 2.0 and rows["a"]["q50"] == 2.0 and rows["b"]["count"] == 0


def test_histogram_counts_everything_and_closes_the_last_bin(spark):
    rows = profile.histogram(numbers(spark, [0, 1, 2, 3, 4, 5, 10]), "x", "g", bins=5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 2, 2, 0, 1]
    assert sum(r["density"] for r in rows) * 2 == pytest.approx(1.0)


def test_suite_passes_on_good_rows(spark, sf_dir):
    rows = subscribers(spark, sf_dir)
    assert quality.gate(rows)
    report = quality.subscriber_suite(rows).report().collect()
    assert len(report) == 21 and all(r["passed"] for r in report)


def test_duplicates_and_ranges_fail(spark):
    df = spark.createDataFrame([("A", 0), ("A", 1), ("B", 0)], "subscriber_id string, churned int")
    rows = {r["rule"]: r for r in quality.Suite(df).expect_unique("subscriber_id").report().collect()}
    assert not rows["unique:subscriber_id"]["passed"] and rows["unique:subscriber_id"]["n_bad"] == 1
    bad = spark.createDataFrame([(0,), (1,), (5,), (-1,)], "churned int")
    row = quality.Suite(bad).expect_between("churned", 0, 1).report().first()
    assert (row["passed"], row["n_bad"], row["severity"]) == (False, 2, "ERROR")


def test_unexpected_values_show_few_examples(spark):
    df = spark.createDataFrame([(f"v{i % 9}",) for i in range(90)] + [(None,)], "c string")
    row = quality.Suite(df).expect_values_in("c", ["v0"]).report().first()
    assert row["n_bad"] == 81 and row["message"] == "81 unexpected values: ['NULL', 'v1', 'v2', 'v3', 'v4']"


def test_suite_on_no_rows(spark, sf_dir):
    report = quality.subscriber_suite(subscribers(spark, sf_dir).limit(0)).summary().first()
    assert report["n_errors"] == 1 and not report["ok"]


def test_thin_cells_are_left_out_and_revenue_adds_up(spark):
    rows = [("a", 1 if i < 10 else 0) for i in range(50)] + [("b", 1)] * 5
    df = spark.createDataFrame(rows, "cell string, churn_predicted int").withColumns(
        {
            "churn_probability": F.lit(0.3), "rsrq_avg": F.lit(-10.0), "dl_throughput_mbps": F.lit(20.0),
            "monthly_charges": F.lit(100.0), "outage_minutes_monthly": F.lit(30.0), "contract_risk_score": F.lit(3),
        }
    )
    grid = risk.risk_grid(df, "cell", 15).collect()
    assert [(g["cell"], g["subscriber_count"], g["estimated_revenue_at_risk"]) for g in grid] == [("a", 50, 1000.0)]
    assert grid[0]["pct_month_to_month"] == 1.0


def test_leave_one_out_of_a_single_row_is_null(spark):
    from cellrisk.operators.neighborhood import leave_one_out_rate

    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), ("b", 1)], "cell string, churned int")
    got = leave_one_out_rate(df, "cell").orderBy("cell", "churned").collect()
    assert [r["cell_churn_rate_loo"] for r in got] == [0.5, 0.5, 0.0, None]


def test_correlations_with_null_constant_and_far_values(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, 500)
    rows = [(float(a), float(1e9 + a + e), None if i % 3 == 0 else float(a * e), 7.5) for i, (a, e) in enumerate(zip(x, rng.normal(0, 1, 500)))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = {(r["a"], r["b"]): r["r"] for r in profile.corr_matrix(df, ["a", "b", "c", "d"]).collect()}
    frame = df.toPandas()
    assert len(found) == 10
    for (a, b), r in found.items():
        if "d" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(frame[a].corr(frame[b]), abs=1e-5)
    assert all(r["r"] is None for r in profile.corr_matrix(df.limit(0), ["a", "b"]).collect())
