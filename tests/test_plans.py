import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrisk.operators import encode, learn
from cellrisk.plans import feature_build, monitor, training
from cellrisk.plans.risk_map import risk_map, scored_subscribers, write_risk_map
from cellrisk.session import checkpointed, shared_dir
from cellrisk.sources import sinks
from cellrisk.sources.testbed import POI_TYPES, cell_towers, pois, subscribers


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    return checkpointed(subscribers(spark, sf_dir))


def test_risk_map_files(spark, sf_dir, tmp_path):
    for shape, corners in (("grid", 5), ("hex", 7)):
        grid = risk_map(scored_subscribers(spark, sf_dir), 6, 2, shape)
        path = str(tmp_path / shape)
        write_risk_map(grid, path)
        n = spark.read.parquet(f"{path}/risk_grid.parquet").count()
        fields = T.StructType([f for f in grid.schema.fields if f.name in ("cell", "risk_tier", "color")])
        back = sinks.read_geojson(spark, f"{path}/risk_grid.geojsonl", fields)
        assert n == back.count() > 0
        assert back.filter(F.size(F.col("coordinates")[0]) != corners).count() == 0


def test_feature_tables(spark, sf_dir, stored, tmp_path):
    featured = feature_build.build_features(stored, cell_towers(spark, sf_dir), pois(spark, sf_dir), POI_TYPES)
    tables = feature_build.feature_tables(featured)
    assert tables.train.count() + tables.test.count() == tables.full.count() == stored.count()
    assert tables.train.select("subscriber_id").intersect(tables.test.select("subscriber_id")).count() == 0
    assert not {"churned", "subscriber_id", "churn_probability", "cell_r8"} & set(tables.features)
    assert {"nearest_tower_radio_LTE", "dist_to_nearest_tower_km", "poi_density"} <= set(tables.features)
    assert set(tables.features) <= set(encode.numeric_columns(tables.full))
    feature_build.write_feature_tables(tables, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/features_full.parquet").count() == stored.count()
    assert spark.read.parquet(f"{tmp_path}/feature_list.parquet").count() == len(tables.features)


def test_training_plan(spark, stored, tmp_path):
    learner = learn.boosted_trees(iterations=2, depth=2)
    bundle, metrics = training.train_and_evaluate(stored, "subscriber_id", learner, str(tmp_path))
    row = metrics.first()
    assert row["n_test"] == pytest.approx(stored.count() * 0.2, abs=2) and row["threshold"] == bundle.threshold
    assert learn.ModelBundle.load(spark, str(tmp_path)).features == bundle.features


def test_weekly_run_decides_and_stops_on_bad_data(stored):
    _, retrain = monitor.run(stored, F.col("c_custkey") % 2 == 0)
    assert retrain is False
    west = F.col("longitude") < 106.9
    _, retrain = monitor.run(stored, west, features=["longitude"])
    assert retrain is True
    with pytest.raises(ValueError):
        monitor.run(stored.withColumn("contract_type", F.lit("weekly")), west)


def test_shared_folder_follows_the_setting(spark):
    assert shared_dir(spark) == shared_dir(spark)
