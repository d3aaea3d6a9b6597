"""Queries that join subscribers with towers and points of interest by distance."""

from __future__ import annotations

from cellrisk.catalog.registry import query
from cellrisk.catalog.tables import haversine_sql, mean, r
from cellrisk.operators import profile, spatial
from cellrisk.sources.testbed import POI_TYPES, cell_towers, pois, subscribers

_PLACE = ["subscriber_id", "latitude", "longitude"]
_D = haversine_sql("s.latitude", "s.longitude", "t.latitude", "t.longitude")


@query(
    "nearest_tower",
    f"""with p as (select s.subscriber_id, t.tower_id, t.radio, {_D} as d from subscribers s cross join cell_towers t)
    select subscriber_id, {r('min(d)', 3)} as dist_to_nearest_tower_km,
      arg_min(radio, {{'d': {r('d', 9)}, 'id': tower_id}}) as nearest_tower_radio,
      arg_min(tower_id, {{'d': {r('d', 9)}, 'id': tower_id}}) as nearest_tower_id from p group by 1""",
)
def nearest_tower(spark, sf_dir):
    index = spatial.index_sites(cell_towers(spark, sf_dir), "tower_id", "radio")
    found = spatial.with_nearest(subscribers(spark, sf_dir, _PLACE), index, site_id="nearest_tower_id")
    return found.drop("latitude", "longitude")


_COUNTS = f"""select s.subscriber_id, count(*) filter (where {_D} <= 1e0) as towers_within_1km,
    count(*) filter (where {_D} <= 2e0) as towers_within_2km from subscribers s cross join cell_towers t group by 1"""


@query("towers_in_radius", _COUNTS)
def towers_in_radius(spark, sf_dir):
    index = spatial.index_sites(cell_towers(spark, sf_dir), "tower_id")
    found = spatial.with_radius_counts(subscribers(spark, sf_dir, _PLACE), index)
    return found.drop("latitude", "longitude")


@query(
    "nearest_poi_by_type",
    f"""select s.subscriber_id, {', '.join(
        f"{r(f'min(case when poi_type = {chr(39)}{k}{chr(39)} then {_D} end)', 3)} as dist_to_{k}_km" for k in POI_TYPES)}
    from subscribers s cross join pois t group by 1""",
)
def nearest_poi_by_type(spark, sf_dir):
    index = spatial.index_sites(pois(spark, sf_dir), "osm_id", kind="poi_type")
    return spatial.nearest_by_kind(subscribers(spark, sf_dir, _PLACE), "subscriber_id", index, POI_TYPES)


@query(
    "pois_in_radius",
    f"""select s.subscriber_id, count(*) filter (where {_D} <= 5e-1) as pois_within_500m,
    count(*) filter (where {_D} <= 2e0) as pois_within_2km from subscribers s cross join pois t group by 1""",
)
def pois_in_radius(spark, sf_dir):
    index = spatial.index_sites(pois(spark, sf_dir), "osm_id")
    found = spatial.with_radius_counts(
        subscribers(spark, sf_dir, _PLACE), index, (0.5, 2.0), ("pois_within_500m", "pois_within_2km")
    )
    return found.drop("latitude", "longitude")


@query(
    "churn_by_tower_density",
    f"""select towers_within_2km, {r(mean('churned'), 6)} as churn_rate, count(*) as n, cast(sum(churned) as bigint) as n_churned
    from subscribers s join ({_COUNTS}) c on s.subscriber_id = c.subscriber_id group by 1""",
)
def churn_by_tower_density(spark, sf_dir):
    index = spatial.index_sites(cell_towers(spark, sf_dir), "tower_id")
    base = subscribers(spark, sf_dir, ["latitude", "longitude", "churned"])
    counted = spatial.with_radius_counts(base, index, (2.0,), ("towers_within_2km",))
    return profile.churn_by(counted, "towers_within_2km")
