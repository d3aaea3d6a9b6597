"""Queries that go through files: tower and POI ingest, Parquet, CSV and GeoJSON round trips."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrisk.catalog.registry import query
from cellrisk.functions.geo import cell_polygon
from cellrisk.plans.risk_map import risk_map, scored_subscribers
from cellrisk.session import scratch_path
from cellrisk.sources import sinks, testbed
from cellrisk.sources.pois import read_pois
from cellrisk.sources.towers import ingest_towers

RESOLUTION = 4


def write_raw_towers(spark, sf_dir, path: str, compression: str | None) -> None:
    """The tower table as the headerless file, with faults: no latitude, latitude 95, an epoch that is
    no number, a foreign network, an unknown radio."""
    key = F.col("s_suppkey")
    towers = testbed.cell_towers(spark, sf_dir)
    lat = F.when(key % 50 == 7, F.lit(None)).when(key % 50 == 11, F.lit(95.0)).otherwise(F.col("latitude"))
    raw = towers.select(
        F.when(key % 7 == 3, "CDMA").otherwise(F.col("radio")).alias("radio"),
        F.when(key % 10 == 0, 525).otherwise(F.col("mcc")).alias("mcc"),
        F.col("mnc").alias("net"),
        (key % 100).cast("int").alias("area"),
        key.alias("cell"),
        F.lit(0).alias("unit"),
        F.col("longitude").alias("lon"),
        lat.alias("lat"),
        F.col("range_m").alias("range"),
        "samples",
        F.lit(1).alias("changeable"),
        F.when(key % 50 == 13, "n/a").otherwise(F.col("created").cast("string")).alias("created"),
        F.col("updated").cast("string").alias("updated"),
        F.lit(0).alias("averageSignal"),
    )
    writer = raw.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).csv(path, header=False)


_TOWERS_SQL = """select case when s_suppkey % 7 = 3 then 'CDMA' else radio end as radio, mcc, mnc,
    cast(s_suppkey % 100 as int) as lac, s_suppkey as cell_id, 0 as unit, longitude, latitude, range_m, samples,
    1 as changeable, case when s_suppkey % 50 = 13 then null else timestamp '2023-01-01 00:00:00' end as created,
    timestamp '2024-01-01 00:00:00' as updated, 0 as avg_signal,
    case when s_suppkey % 7 = 3 then 'Unknown' when radio = 'LTE' then '4G' when radio = 'NR' then '5G' else '3G' end as generation
    from cell_towers where s_suppkey % 10 <> 0 and s_suppkey % 50 not in (7, 11)"""


@query("tower_ingest", _TOWERS_SQL)
def tower_ingest(spark, sf_dir):
    path = scratch_path(spark, "towers")
    write_raw_towers(spark, sf_dir, path, "gzip")
    return ingest_towers(spark, path, "ID")


@query("tower_ingest_plain", _TOWERS_SQL)
def tower_ingest_plain(spark, sf_dir):
    path = scratch_path(spark, "towers")
    write_raw_towers(spark, sf_dir, path, None)
    return ingest_towers(spark, path, "ID")


def write_raw_pois(spark, sf_dir, path: str) -> None:
    """JSON documents of up to 500 elements in one folder per category, with a way, a node without
    name and a node without latitude among them."""
    key = F.col("osm_id")
    tags = F.when(key % 10 == 5, F.create_map(F.lit("amenity"), F.col("poi_type"))).otherwise(
        F.create_map(F.lit("name"), F.col("name"))
    )
    element = F.struct(
        F.when(key % 20 == 3, "way").otherwise("node").alias("type"),
        key.alias("id"),
        F.when(key % 25 != 6, F.col("latitude")).alias("lat"),
        F.col("longitude").alias("lon"),
        tags.alias("tags"),
    )
    documents = (
        testbed.pois(spark, sf_dir)
        .groupBy("poi_type", F.floor(key / 500).alias("page"))
        .agg(F.collect_list(element).alias("elements"))
    )
    documents.drop("page").write.mode("overwrite").partitionBy("poi_type").json(path)


_POIS_SQL = """select osm_id, poi_type, case when osm_id % 10 = 5 then '' else name end as name, latitude, longitude
    from pois where osm_id % 20 <> 3 and osm_id % 25 <> 6"""


@query("poi_ingest", _POIS_SQL)
def poi_ingest(spark, sf_dir):
    path = scratch_path(spark, "pois")
    write_raw_pois(spark, sf_dir, path)
    return read_pois(spark, path)


@query("poi_union", "select osm_id, poi_type, name, latitude, longitude from pois")
def poi_union(spark, sf_dir):
    """Categories read apart and stacked by name; the table comes back whole."""
    from functools import reduce

    table = testbed.pois(spark, sf_dir)
    parts = [table.filter(F.col("poi_type") == kind) for kind in testbed.POI_TYPES]
    return reduce(lambda a, b: a.unionByName(b), parts)


_PREDICTIONS = ["subscriber_id", "churn_probability", "churn_predicted", "risk_tier", "revenue_at_risk"]


@query("sink_parquet_roundtrip", f"select {', '.join(_PREDICTIONS)} from scored")
def sink_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    rows = scored_subscribers(spark, sf_dir, ["subscriber_id"]).select(*_PREDICTIONS)
    sinks.write_parquet(rows, path, partition_by=["risk_tier"])
    return spark.read.schema(rows.schema).parquet(path).select(*_PREDICTIONS)


@query("sink_csv_roundtrip", f"select {', '.join(_PREDICTIONS)} from scored")
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    rows = scored_subscribers(spark, sf_dir, ["subscriber_id"]).select(*_PREDICTIONS)
    sinks.write_csv(rows, path)
    return sinks.read_csv(spark, path, rows.schema)


_PROPERTIES = ["cell", "subscriber_count", "predicted_churners", "avg_churn_probability", "risk_tier", "estimated_revenue_at_risk"]


def _features(spark, sf_dir):
    grid = risk_map(scored_subscribers(spark, sf_dir), RESOLUTION)
    return sinks.geojson_features(grid, sinks.polygon_geometry(cell_polygon("cell")), _PROPERTIES), grid


@query("geojson_features")
def geojson_features(spark, sf_dir):
    return _features(spark, sf_dir)[0]


@query(
    "geojson_read",
    """select 'Polygon' as geometry_type, cell, subscriber_count, predicted_churners, avg_churn_probability,
    case when avg_churn_probability < 25e-2 then 'LOW' when avg_churn_probability < 5e-1 then 'MEDIUM'
      when avg_churn_probability < 7e-1 then 'HIGH' else 'CRITICAL' end as risk_tier, estimated_revenue_at_risk from risk_grid""",
)
def geojson_read(spark, sf_dir):
    features, grid = _features(spark, sf_dir)
    path = scratch_path(spark, "grid")
    sinks.write_geojson(features, path)
    properties = T.StructType([grid.schema[c] for c in _PROPERTIES])
    return sinks.read_geojson(spark, path, properties).drop("coordinates")
