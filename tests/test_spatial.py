import numpy as np
import pytest
from pyspark.sql import functions as F

from cellrisk.operators import spatial

RADII = (1.0, 2.0)


def brute(rows, sites):
    """Distances between every row and every site, by the great-circle formula."""
    p, s = np.radians(np.array(rows, float)), np.radians(np.array(sites, float))
    dlat, dlon = s[None, :, 0] - p[:, None, 0], s[None, :, 1] - p[:, None, 1]
    a = np.sin(dlat / 2) ** 2 + np.cos(p[:, None, 0]) * np.cos(s[None, :, 0]) * np.sin(dlon / 2) ** 2
    return 12742.0 * np.arcsin(np.sqrt(np.clip(a, 0, 1)))


def run(spark, rows, sites):
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rows)], "id int, latitude double, longitude double")
    places = spark.createDataFrame(
        [(f"T{i:06d}", "R", float(a), float(b)) for i, (a, b) in enumerate(sites)],
        "tower_id string, radio string, latitude double, longitude double",
    )
    index = spatial.index_sites(places, "tower_id", "radio")
    near = spatial.with_nearest(df, index, site_id="tower")
    out = spatial.with_radius_counts(near, index, RADII).orderBy("id").collect()
    d = brute(rows, sites)
    assert len(out) == len(rows)
    rounded = np.round(d, 9)
    for i, r in enumerate(out):
        assert r["id"] == i
        assert r["dist_to_nearest_tower_km"] == pytest.approx(d[i].min(), abs=6e-4)
        assert r["tower"] == f"T{int(np.argmin(rounded[i])):06d}"
        assert r["towers_within_1km"] == int((d[i] <= 1.0).sum())
        assert r["towers_within_2km"] == int((d[i] <= 2.0).sum())


def points(rng, n, lat, lon, spread):
    return np.column_stack([lat + rng.uniform(-spread, spread, n), lon + rng.uniform(-spread, spread, n)]).round(6)


def test_scattered(spark):
    rng = np.random.default_rng(1)
    run(spark, points(rng, 300, -6.2, 106.8, 0.5), points(rng, 150, -6.2, 106.8, 0.5))


def test_hot_spot_of_sites_and_rows(spark, monkeypatch):
    """A third of the rows and sites within 100 m, another third of rows some km away from the spot."""
    monkeypatch.setattr(spatial, "LONGEST_LIST", 64)
    monkeypatch.setattr(spatial, "SHORT_LIST", 16)
    monkeypatch.setattr(spatial, "CELL_WORK", 500)
    rng = np.random.default_rng(2)
    rows = np.vstack([points(rng, 200, -6.2, 106.8, 0.0005), points(rng, 200, -6.23, 106.83, 0.002), points(rng, 200, -6.2, 106.8, 1.0)])
    sites = np.vstack([points(rng, 400, -6.2, 106.8, 0.0005), points(rng, 100, -6.2, 106.8, 1.0)])
    run(spark, rows, sites)


def test_ring_of_sites_around_a_hot_spot_of_rows(spark, monkeypatch):
    monkeypatch.setattr(spatial, "LONGEST_LIST", 32)
    rng = np.random.default_rng(3)
    angle = rng.uniform(0, 2 * np.pi, 300)
    ring = np.column_stack([-6.2 + 0.018 * np.sin(angle), 106.8 + 0.018 * np.cos(angle)]).round(6)
    run(spark, points(rng, 200, -6.2, 106.8, 0.003), ring)


def test_copies_at_one_place(spark):
    sites = np.array([[-6.2, 106.8]] * 500 + [[-6.21, 106.8]])
    run(spark, np.array([[-6.2, 106.8]] * 300 + [[-6.2005, 106.8005], [-7.0, 110.0]]), sites)


def test_date_line_poles_and_far_rows(spark):
    sites = np.array([[0.0, 179.995], [89.999, 10.0], [-89.99, -50.0], [51.0, 0.001]])
    rows = np.array([[0.0, -179.999], [90.0, -170.0], [-90.0, 0.0], [51.0, -0.001], [-30.0, -60.0], [0.0, 0.0]])
    run(spark, rows, sites)


def test_one_site_and_equal_distances(spark):
    run(spark, np.array([[1.0, 1.0], [-45.0, 100.0]]), np.array([[1.0, 1.0]]))
    run(spark, np.array([[0.0, 0.0]]), np.array([[0.01, 0.0], [-0.01, 0.0], [0.0, 0.01], [0.0, -0.01]]))


def test_bounds_are_inclusive(spark):
    step = np.degrees(1.0 / 6371.0)
    rows, sites = np.array([[0.0, 0.0]]), np.array([[step * 0.999999, 0.0], [step * 2.000001, 0.0], [0.0, 0.0]])
    run(spark, rows, sites)


def test_rows_without_place_and_no_sites(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 1.0, 1.0)], "id int, latitude double, longitude double")
    sites = spark.createDataFrame([("a", "R", 1.0, 1.0)], "tower_id string, radio string, latitude double, longitude double")
    out = {r["id"]: r for r in spatial.tower_features(df, sites).collect()}
    assert out[1]["dist_to_nearest_tower_km"] is None and out[1]["towers_within_1km"] == 0
    assert out[2]["dist_to_nearest_tower_km"] == 0.0 and out[2]["nearest_tower_radio"] == "R"
    none = spatial.tower_features(df, sites.filter(F.lit(False))).collect()
    assert [(r["dist_to_nearest_tower_km"], r["towers_within_2km"]) for r in none] == [(None, 0)] * 2


def test_by_kind(spark):
    rng = np.random.default_rng(5)
    rows, sites = points(rng, 100, -6.2, 106.8, 0.3), points(rng, 120, -6.2, 106.8, 0.3)
    kinds = np.array(["a", "b", "b"] * 40)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(rows)], "id int, latitude double, longitude double")
    places = spark.createDataFrame(
        [(i, str(k), float(a), float(b)) for i, ((a, b), k) in enumerate(zip(sites, kinds))],
        "osm_id int, poi_type string, latitude double, longitude double",
    )
    index = spatial.index_sites(places, "osm_id", kind="poi_type")
    out = spatial.nearest_by_kind(df, "id", index, ["a", "b", "c"]).orderBy("id").collect()
    for k in "ab":
        d = brute(rows, sites[kinds == k]).min(axis=1)
        assert np.allclose([r[f"dist_to_{k}_km"] for r in out], d, atol=6e-4)
    assert len(out) == 100 and all(r["dist_to_c_km"] is None for r in out)


def test_rows_of_one_part_are_measured_by_many_tasks(spark):
    rows = [(-7 + i % 40 / 100, 106.4 + i // 40 / 100) for i in range(1200)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "id int, latitude double, longitude double").coalesce(1)
    sites = spark.createDataFrame([(f"T{i}", -7 + i / 100, 106.5) for i in range(40)], "tower_id string, latitude double, longitude double")
    found = spatial.with_radius_counts(df, spatial.index_sites(sites, "tower_id"))
    sizes = [len(p) for p in found.rdd.glom().collect()]
    assert sum(sizes) == 1200 and max(sizes) < 600
