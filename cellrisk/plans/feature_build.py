"""From raw tables to the feature tables that training and scoring read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellrisk.operators import encode, neighborhood, spatial
from cellrisk.operators.features import all_features
from cellrisk.operators.splits import SEED, stratified_split
from cellrisk.session import checkpointed
from cellrisk.sources import sinks

CELL_COLUMN = "cell_r8"
ENCODED = [*encode.CATEGORICAL_COLUMNS, "nearest_tower_radio"]
NON_FEATURES = [*encode.NON_FEATURES, "cell_r7", "cell_r8"]


def place_features(
    subscribers: DataFrame, towers: DataFrame, pois: DataFrame | None = None, poi_types: Sequence[str] = ()
) -> DataFrame:
    """Cells, tower features and, when there are points of interest, distances and density."""
    placed = neighborhood.add_cells(subscribers, (7, 8))
    near = spatial.tower_features(placed, towers)
    if pois is None or not poi_types:
        return near
    index = spatial.index_sites(pois, "osm_id", kind="poi_type")
    distances = spatial.nearest_by_kind(subscribers, "subscriber_id", index, poi_types)
    dense = neighborhood.poi_density(near, pois, 8)
    return dense.join(distances, "subscriber_id", "left")


def build_features(
    subscribers: DataFrame,
    towers: DataFrame,
    pois: DataFrame | None = None,
    poi_types: Sequence[str] = (),
    leave_one_out: bool = True,
) -> DataFrame:
    """All features of every subscriber, source columns kept. The cell's churn rate leaves out the
    row's own label unless told otherwise.

    The subscriber table is read several times (places, cells, rows): pass one that is stored.
    """
    featured = all_features(place_features(subscribers, towers, pois, poi_types))
    plain = neighborhood.add_cells(subscribers, (8,))
    return neighborhood.with_cell_context(featured, plain, CELL_COLUMN, leave_one_out)


@dataclass(frozen=True)
class FeatureTables:
    train: DataFrame
    test: DataFrame
    full: DataFrame
    features: list[str]
    levels: dict[str, list[str]]


def feature_tables(featured: DataFrame, test_share: float = 0.2, seed: int = SEED) -> FeatureTables:
    """Split first, learn the one-hot levels on the training rows, and encode all rows with them."""
    marked = checkpointed(stratified_split(featured, "subscriber_id", "churned", test_share, seed))
    levels = encode.fit_levels(marked.filter(~F.col("is_test")), ENCODED)
    encoded = encode.one_hot(marked, levels)
    names = encode.feature_list(encoded, NON_FEATURES)
    full = encoded.drop("is_test")
    return FeatureTables(
        encoded.filter(~F.col("is_test")).drop("is_test"),
        encoded.filter("is_test").drop("is_test"),
        full,
        names,
        levels,
    )


def write_feature_tables(tables: FeatureTables, path: str) -> None:
    sinks.write_parquet(tables.train, f"{path}/features_train.parquet")
    sinks.write_parquet(tables.test, f"{path}/features_test.parquet")
    sinks.write_parquet(tables.full, f"{path}/features_full.parquet")
    spark = tables.full.sparkSession
    names = spark.createDataFrame([(i, n) for i, n in enumerate(tables.features)], "position int, feature string")
    sinks.write_parquet(names.coalesce(1), f"{path}/feature_list.parquet")
