import math

import pytest
from pyspark.sql import functions as F

from cellrisk.functions import geo
from cellrisk.functions.numeric import clip, cut, flag, np_round, ratio
from cellrisk.functions.scoring import risk_tier, with_predictions
from cellrisk.operators import encode, requests
from cellrisk.operators import features as ft
from cellrisk.sources.testbed import subscribers


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return subscribers(spark, sf_dir)


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_round_is_half_even_after_scaling(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (3.5,), (-0.5,), (None,)], "x double")
    assert [r[0] for r in one(df, np_round("x", 0))] == [1.0, 2.0, 4.0, 0.0, None]
    assert one(df.limit(1), np_round("x", 2)) == [(1.0,)]


def test_clip_keeps_null_and_flag_counts_unknown_as_zero(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (50.0,)], "x double")
    assert [r[0] for r in one(df, clip("x", 0.0, 10.0))] == [None, 0.0, 10.0]
    assert [r[0] for r in one(df, flag(F.col("x") > 0))] == [0, 0, 1]


def test_cut_is_right_closed_and_outside_is_nan(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (3.1,), (200.0,), (201.0,), (None,)], "x double")
    got = [r[0] for r in one(df, cut("x", *ft.TENURE_BINS))]
    assert got == ["nan", "0-3m", "3-12m", "48m+", "nan", "nan"]
    assert one(df.limit(1), cut("x", *ft.TENURE_BINS, include_lowest=True)) == [("0-3m",)]


def test_ratio_clips_the_denominator(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, 4)], "a double, b int")
    assert [r[0] for r in one(df, ratio("a", "b", 2))] == [10.0, 2.5]


def test_subscriber_features(rows):
    out = ft.subscriber_features(rows).cache()
    names = [
        "is_new_subscriber", "is_long_term", "tenure_bucket", "charge_per_month_tenure", "monthly_charge_bucket",
        "data_charge_ratio", "call_intensity", "contract_risk_score", "is_high_support", "support_per_month",
    ]
    assert set(names) <= set(out.columns)
    assert out.filter(" or ".join(f"{c} is null" for c in names)).count() == 0
    assert out.filter("tenure_months <= 3 and is_new_subscriber <> 1").count() == 0
    scores = {r[0]: r[1] for r in one(out.select("contract_type", "contract_risk_score").distinct(), "*")}
    assert scores == {"month-to-month": 3, "one-year": 2, "two-year": 1}


def test_network_features(rows):
    out = ft.network_features(rows)
    low, high, index = out.agg(
        F.min("network_quality_score"), F.max("network_quality_score"), F.min("network_frustration_index")
    ).first()
    assert 0 <= low <= high <= 100 and index >= 0
    assert {r[0] for r in out.select("rsrq_quality").distinct().collect()} <= {"poor", "fair", "good", "excellent"}


def test_one_hot_drops_sources_and_is_numeric(rows):
    featured = ft.all_features(rows)
    levels = encode.fit_levels(featured)
    encoded = encode.one_hot(featured, levels)
    assert not set(encode.CATEGORICAL_COLUMNS) & set(encoded.columns)
    added = [encode.level_name(c, v) for c, vs in levels.items() for v in vs]
    assert set(added) <= set(encode.numeric_columns(encoded))
    assert not any(ch in name for name in added for ch in "<>%+-")
    per_row = sum(F.col(encode.level_name("contract_type", v)) for v in levels["contract_type"])
    assert encoded.filter(per_row != 1).count() == 0


def test_fit_levels_refuses_an_identifier(rows):
    with pytest.raises(ValueError):
        encode.fit_levels(rows, ["subscriber_id"], max_levels=50)


def test_align_fills_absent_and_null(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    assert one(encode.align_features(df, ["a", "b", "c"]), "*") == [(1.0, -999.0, 0.0)]


@pytest.mark.parametrize(
    "field,value,reason",
    [
        ("contract_type", "weekly", "contract_type: not allowed"),
        ("internet_service", "satellite", "internet_service: not allowed"),
        ("tenure_months", -5, "tenure_months: out of range"),
        ("latitude", 200.0, "latitude: out of range"),
        ("monthly_charges", None, "monthly_charges: missing"),
    ],
)
def test_request_checks(rows, field, value, reason):
    kind = rows.schema[field].dataType
    bad = requests.check_rows(rows.limit(3).withColumn(field, F.lit(value).cast(kind)))
    assert {tuple(r[0]) for r in one(bad, "errors")} == {(reason,)}
    assert requests.accepted(bad).count() == 0 and requests.quarantined(bad).count() == 3


def test_good_requests_pass(rows):
    assert requests.quarantined(requests.check_rows(rows)).count() == 0


def test_tier_boundaries_and_fall_through(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (0.5,), (0.7,), (1.0,), (None,), (-0.1,)], "p double")
    got = [r[0] for r in one(df, risk_tier("p"))]
    assert got == ["LOW", "MEDIUM", "HIGH", "CRITICAL", "CRITICAL", "CRITICAL", "CRITICAL"]


def test_request_scoring_example(spark):
    df = spark.createDataFrame([(0.6999, 100.0)], "churn_probability double, monthly_charges double")
    row = with_predictions(df).first()
    assert (row["churn_predicted"], row["risk_tier"], row["revenue_at_risk"]) == (1, "HIGH", 69.99)


def test_haversine_against_the_formula(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 11.0, 21.0)], "a double, b double, c double, d double")
    got = [r[0] for r in one(df, geo.haversine_km("a", "b", "c", "d"))]
    assert got[0] == pytest.approx(math.pi * 6371.0)
    p1, p2 = math.radians(10), math.radians(11)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(1) / 2) ** 2
    assert got[1] == pytest.approx(2 * 6371.0 * math.asin(math.sqrt(a)))


def test_hexagon_ring_surrounds_its_points(rows):
    cells = rows.select("latitude", "longitude", geo.hex_cell("latitude", "longitude", 7).alias("cell"))
    ringed = cells.withColumn("ring", geo.cell_polygon("cell")).limit(200).collect()
    for r in ringed:
        lons, lats = [p["lon"] for p in r["ring"]], [p["lat"] for p in r["ring"]]
        assert r["ring"][0] == r["ring"][-1] and len(r["ring"]) == 7
        assert min(lons) <= r["longitude"] <= max(lons) and min(lats) <= r["latitude"] <= max(lats)


def test_grid_ring_has_the_point(rows):
    cells = rows.select("latitude", "longitude", geo.grid_cell("latitude", "longitude", 6).alias("cell"))
    for r in cells.withColumn("ring", geo.cell_polygon("cell")).limit(50).collect():
        assert r["ring"][0]["lon"] <= r["longitude"] <= r["ring"][1]["lon"]
        assert r["ring"][0]["lat"] <= r["latitude"] <= r["ring"][2]["lat"]
