"""NULL, NaN and large values: no invented cells, no perfect signal, no overflow; decisions on the raw probability."""

import pytest
from pyspark.sql import functions as F

from cellrisk.functions import geo
from cellrisk.functions.numeric import clip, cut, steady_mean
from cellrisk.functions.scoring import with_predictions
from cellrisk.operators import neighborhood, profile, requests, risk
from cellrisk.operators.quality import Suite

NAN, INF = float("nan"), float("inf")


def test_no_place_no_cell(spark):
    df = spark.createDataFrame([(None, 106.8), (-6.0, None), (NAN, 106.8), (-6.0, INF), (None, None)], "lat double, lon double")
    cells = df.select(geo.grid_cell("lat", "lon", 8).alias("g"), geo.hex_cell("lat", "lon", 8).alias("h")).collect()
    assert all(r["g"] is None and r["h"] is None for r in cells)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(NAN,), (None,), (5.0,)], "x double")
    got = df.select(clip("x", 0.0, 1.0).alias("c"), cut("x", [0.0, 1.0, INF], ["low", "high"]).alias("b")).collect()
    assert [tuple(r) for r in got] == [(None, "nan"), (None, "nan"), (1.0, "high")]


@pytest.mark.parametrize("values, mean", [([1e12] * 10, 1e12), ([NAN, 2.0, 4.0], 3.0), ([NAN], None)])
def test_means_of_large_and_faulty_values(spark, values, mean):
    assert spark.createDataFrame([(v,) for v in values], "x double").agg(steady_mean("x")).first()[0] == mean


def test_nan_in_checks(spark):
    df = spark.createDataFrame([("A", NAN), ("B", 5.0), ("C", None), ("D", 500.0)], "subscriber_id string, x double")
    suite = Suite(df).expect_no_nulls(["x"]).expect_between("x", 0, 10)
    counts = df.agg(*[c.alias(n) for n, c in suite._aggs.items()]).first()
    assert counts["null:x"] == 2 and counts["range:x"] == 1


def test_nan_request_is_refused(spark):
    df = spark.createDataFrame([(NAN,), (50.0,)], "monthly_charges double")
    errors = [r[0] for r in df.select(requests.request_errors(df).alias("e")).collect()]
    assert "monthly_charges: out of range" in errors[0] and "monthly_charges: out of range" not in errors[1]


def test_decisions_on_the_raw_probability(spark):
    df = spark.createDataFrame([(0.69996, 100.0)], "churn_probability double, monthly_charges double")
    row = with_predictions(df, threshold=0.69998, digits=4).first()
    assert (row["churn_probability"], row["risk_tier"], row["churn_predicted"]) == (0.7, "HIGH", 0)


def test_nan_signal_is_refused(spark):
    df = spark.createDataFrame([(NAN, -9.0), (-95.0, NAN), (-95.0, -9.0)], "rsrp_avg double, rsrq_avg double")
    got = [r[0] for r in df.select(requests.request_errors(df)).collect()]
    assert "rsrp_avg: not a number" in got[0] and "rsrq_avg: not a number" in got[1]
    assert not any("not a number" in x for x in got[2])


def test_null_counts_count_nan(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 2), (1.0, None)], "x double, k int")
    assert {r["column"]: r["n_null"] for r in profile.null_counts(df).collect()} == {"x": 2, "k": 1}


def test_lag_is_of_the_period_before_not_of_the_row_before(spark):
    weeks = [("a", "2024-01-01", 1), ("a", "2024-01-08", 0), ("a", "2024-01-22", 1)]
    df = spark.createDataFrame(weeks, "cell string, day string, bad int").withColumn("week", F.col("day").cast("timestamp"))
    found = neighborhood.lagged_rate(df, "cell", "week", F.col("bad")).orderBy("week").collect()
    assert [r["previous_rate"] for r in found] == [None, 1.0, None]


def test_concentration_with_all_cells_tied(spark):
    cells = spark.range(1000).selectExpr("concat('c', lpad(id, 4, '0')) as cell", "1.0D as churn_rate", "cast(id % 7 as bigint) as n_churned")
    rows = spark.range(5000).selectExpr("cast(1 as int) as churned")
    found = risk.concentration(cells.repartition(9), rows, "cell").first()
    assert (found["top_cells"], found["top_churned"]) == (200, sum(i % 7 for i in range(200)))
