"""Queries that run whole plans: the feature build and the weekly report."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellrisk.catalog.monitoring import _psi_sql
from cellrisk.catalog.registry import query
from cellrisk.catalog.spatial import _COUNTS, _D
from cellrisk.catalog.tables import grid_sql, mean, r
from cellrisk.operators import drift
from cellrisk.plans import feature_build, monitor
from cellrisk.session import checkpointed
from cellrisk.sources.testbed import POI_TYPES, cell_towers, pois, subscribers

_BUILT = [
    "subscriber_id", "cell_r8", "tenure_bucket", "network_frustration_index", "dist_to_nearest_tower_km",
    "nearest_tower_radio", "towers_within_1km", "towers_within_2km", "poi_density", "dist_to_transport_km",
    "cell_subscriber_count", "cell_avg_rsrq", "cell_churn_rate",
]


@query(
    "feature_build",
    f"""with s as (select *, {grid_sql('latitude', 'longitude', 8)} as cell_r8 from feats),
    n as (select s.subscriber_id, {r(f'min({_D})', 3)} as dist_to_nearest_tower_km,
      arg_min(radio, {{'d': {r(_D, 9)}, 'id': tower_id}}) as nearest_tower_radio from subscribers s cross join cell_towers t group by 1),
    k as ({_COUNTS}),
    p as (select s.subscriber_id, {r(f'min({_D})', 3)} as dist_to_transport_km from subscribers s cross join pois t
      where poi_type = 'transport' group by 1),
    d as (select {grid_sql('latitude', 'longitude', 8)} as cell_r8, count(*) as poi_density from pois group by 1),
    c as (select cell_r8, count(*) as cell_subscriber_count, {r(mean('rsrq_avg'), 6)} as cell_avg_rsrq, sum(churned) as cs from s group by 1)
    select s.subscriber_id, s.cell_r8, tenure_bucket, network_frustration_index, dist_to_nearest_tower_km, nearest_tower_radio,
      towers_within_1km, towers_within_2km, coalesce(poi_density, 0) as poi_density, dist_to_transport_km,
      cell_subscriber_count, cell_avg_rsrq, cast(cs - churned as double) / nullif(cell_subscriber_count - 1, 0) as cell_churn_rate
    from s join n on s.subscriber_id = n.subscriber_id join k on s.subscriber_id = k.subscriber_id
    join p on s.subscriber_id = p.subscriber_id left join d on s.cell_r8 = d.cell_r8 join c on s.cell_r8 = c.cell_r8""",
)
def build(spark, sf_dir):
    stored = checkpointed(subscribers(spark, sf_dir))
    featured = feature_build.build_features(stored, cell_towers(spark, sf_dir), pois(spark, sf_dir), POI_TYPES)
    return featured.select(*_BUILT)


_FEATURES_SQL = " union all ".join(_psi_sql(f, "subscribers", "c_custkey % 2 = 0") for f in drift.DRIFT_FEATURES)


@query(
    "weekly_report",
    f"""with p as ({_FEATURES_SQL})
    select coalesce(max(psi), 0e0) as max_psi, coalesce(string_agg(feature, ',' order by feature) filter (where psi > 2e-1), '') as drifted_features,
      coalesce(bool_or(psi > 2e-1), false) as retrain, cast(0 as bigint) as n_errors, true as ok,
      (select count(*) filter (where risk_tier in ('HIGH', 'CRITICAL')) from scored) as high_or_critical,
      (select count(*) filter (where churn_probability >= 5e-1) from scored) as probability_at_least_half from p""",
)
def weekly_report(spark, sf_dir):
    return monitor.weekly_report(subscribers(spark, sf_dir), F.col("c_custkey") % 2 == 0)


@query(
    "batch_summary",
    """select count(*) as total, cast(sum(churn_predicted) as bigint) as predicted,
    cast(sum(cast(revenue_at_risk as decimal(18,2))) as double) as revenue_at_risk from scored""",
)
def batch_summary(spark, sf_dir):
    from cellrisk.plans.risk_map import scored_subscribers

    return monitor.summary(scored_subscribers(spark, sf_dir, ["subscriber_id"]))
