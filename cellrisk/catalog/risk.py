"""Queries over cells, grids, tiers and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellrisk.catalog.registry import query
from cellrisk.catalog.tables import grid_sql, mean, money, r, tier_sql
from cellrisk.operators import neighborhood as nb
from cellrisk.operators import risk
from cellrisk.plans.risk_map import risk_map, scored_subscribers
from cellrisk.sources.testbed import pois, subscribers, table

# The resolution at which the test tables have cells of ten and more.
RESOLUTION = 4
_CELL = grid_sql("latitude", "longitude", RESOLUTION)
_OBSERVED_IN = [
    "subscriber_id", "churned", "rsrq_avg", "dl_throughput_mbps", "monthly_charges",
    "outage_minutes_monthly", "latitude", "longitude",
]


def grid(spark, sf_dir):
    return risk_map(scored_subscribers(spark, sf_dir), RESOLUTION)


def observed(spark, sf_dir):
    base = nb.add_cells(subscribers(spark, sf_dir, _OBSERVED_IN), [RESOLUTION]).withColumnRenamed(
        f"cell_r{RESOLUTION}", "cell"
    )
    return risk.observed_grid(base, "cell")


_OBSERVED = f"""(select cell, n_subscribers, n_churned, {r('a1', 6)} as churn_rate, {r('a2', 6)} as avg_rsrq,
    {r('a3', 6)} as avg_throughput, {r('a4', 6)} as avg_monthly_charges, {r('a5', 6)} as avg_outage,
    total_monthly_revenue, {r('total_monthly_revenue * (n_churned / cast(n_subscribers as double))', 4)} as revenue_at_risk
  from (select {_CELL} as cell, count(*) as n_subscribers, cast(sum(churned) as bigint) as n_churned,
      {mean('churned')} as a1, {mean('rsrq_avg')} as a2, {mean('dl_throughput_mbps')} as a3,
      {mean('monthly_charges')} as a4, {mean('outage_minutes_monthly')} as a5,
      {money('monthly_charges')} as total_monthly_revenue from subscribers group by 1)
  where n_subscribers >= 10)"""


@query("risk_grid", f"select *, {tier_sql('avg_churn_probability')} as risk_tier from risk_grid")
def risk_grid(spark, sf_dir):
    return grid(spark, sf_dir).drop("color")


@query("observed_grid", f"select * from {_OBSERVED}")
def observed_grid(spark, sf_dir):
    return observed(spark, sf_dir)


@query("top_cells", f"select * from {_OBSERVED} order by churn_rate desc, cell limit 10")
def top_cells(spark, sf_dir):
    return risk.top_k(observed(spark, sf_dir), "churn_rate", "cell", 10)


@query(
    "top_zones",
    """select *, concat('Zone ', row_number() over (order by estimated_revenue_at_risk desc, cell)) as zone
    from risk_grid order by estimated_revenue_at_risk desc, cell limit 20""",
)
def top_zones(spark, sf_dir):
    plain = grid(spark, sf_dir).drop("risk_tier", "color")
    return risk.ranked_zones(plain, "estimated_revenue_at_risk", "cell", 20)


@query(
    "zone_report",
    f"""select concat('Zone ', row_number() over (order by revenue_at_risk desc, cell)) as zone, cell,
    n_subscribers as subscribers, printf('%.1f%%', {r('churn_rate * 1e2', 1)}) as churn_rate, {r('avg_rsrq', 1)} as avg_rsrq_db,
    cast(round_even(avg_outage, 0) as bigint) as avg_outage_min,
    concat('$', cast(round_even(revenue_at_risk, 0) as bigint)) as monthly_revenue_at_risk
    from {_OBSERVED} order by revenue_at_risk desc, cell limit 20""",
)
def zone_report(spark, sf_dir):
    return risk.zone_report(observed(spark, sf_dir), "cell", 20)


@query(
    "risk_alerts",
    f"""with a as (select *, {tier_sql('avg_churn_probability')} as risk_tier from risk_grid_fine)
    select *, count(*) over () as alert_zones,
      cast(sum(cast(estimated_revenue_at_risk as decimal(18,2))) over () as double) as alert_revenue
    from a where risk_tier in ('HIGH', 'CRITICAL') order by estimated_revenue_at_risk desc, cell limit 50""",
)
def risk_alerts(spark, sf_dir):
    fine = risk_map(scored_subscribers(spark, sf_dir), resolution=8, min_subscribers=1)
    return risk.risk_alerts(fine.drop("risk_tier", "color"), "cell", 50)


def _tiers_sql(source: str, revenue: str) -> str:
    return f"""with t as (select unnest(['LOW', 'MEDIUM', 'HIGH', 'CRITICAL']) as risk_tier),
      g as (select risk_tier, count(*) as n, {money(revenue)} as revenue from {source} group by 1)
      select t.risk_tier, coalesce(n, 0) as n, coalesce(revenue, 0e0) as revenue,
        {r('coalesce(n, 0) * 1e2 / sum(coalesce(n, 0)) over ()', 1)} as share_pct
      from t left join g on t.risk_tier = g.risk_tier"""


@query("tier_breakdown", _tiers_sql("scored", "revenue_at_risk"))
def tier_breakdown(spark, sf_dir):
    return risk.tier_breakdown(scored_subscribers(spark, sf_dir, ["subscriber_id"]), "risk_tier", "revenue_at_risk")


@query(
    "tier_breakdown_cells",
    _tiers_sql(
        f"(select *, {tier_sql('avg_churn_probability')} as risk_tier from risk_grid)", "estimated_revenue_at_risk"
    ),
)
def tier_breakdown_cells(spark, sf_dir):
    return risk.tier_breakdown(grid(spark, sf_dir), "risk_tier", "estimated_revenue_at_risk")


@query(
    "high_risk_count",
    """select count(*) filter (where risk_tier in ('HIGH', 'CRITICAL')) as high_or_critical,
    count(*) filter (where churn_probability >= 5e-1) as probability_at_least_half from scored""",
)
def high_risk_count(spark, sf_dir):
    return risk.high_risk_count(scored_subscribers(spark, sf_dir, ["subscriber_id"]))


@query(
    "highest_risk",
    """select subscriber_id, churn_probability, monthly_charges, churn_predicted, risk_tier, revenue_at_risk from scored
    order by churn_probability desc, subscriber_id limit 1""",
)
def highest_risk(spark, sf_dir):
    return risk.highest_risk(scored_subscribers(spark, sf_dir, ["subscriber_id"]), "subscriber_id")


@query(
    "cell_trend",
    f"""select {r('regr_slope(churn_rate, avg_rsrq)', 6)} as slope, {r('regr_intercept(churn_rate, avg_rsrq)', 6)} as intercept,
    count(*) as n_cells from {_OBSERVED}""",
)
def cell_trend(spark, sf_dir):
    from cellrisk.operators.profile import linear_trend

    return linear_trend(observed(spark, sf_dir), "avg_rsrq", "churn_rate")


@query(
    "concentration",
    f"""with o as (select *, row_number() over (order by churn_rate desc, cell) as rn, count(*) over () as n_cells from {_OBSERVED}),
    t as (select cast(max(n_cells) as bigint) as n_cells, cast(floor(max(n_cells) * 2e-1) as bigint) as top_cells,
      cast(coalesce(sum(case when rn <= floor(n_cells * 2e-1) then n_churned end), 0) as bigint) as top_churned from o),
    a as (select cast(sum(churned) as bigint) as total_churned from subscribers)
    select t.*, a.total_churned, {r('top_churned / (total_churned + 1e-10)', 6)} as concentration from t, a""",
)
def concentration(spark, sf_dir):
    rows = subscribers(spark, sf_dir, ["churned"])
    return risk.concentration(observed(spark, sf_dir), rows, "cell")


@query(
    "heat_points",
    "select subscriber_id, latitude, longitude, churn_probability as weight from subscribers where latitude is not null and longitude is not null",
)
def heat_points(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "latitude", "longitude", "churn_probability"])
    return risk.heat_points(base, "churn_probability", "subscriber_id")


@query(
    "map_center",
    f"select {r(mean('latitude'), 6)} as center_lat, {r(mean('longitude'), 6)} as center_lon from subscribers",
)
def map_center(spark, sf_dir):
    return risk.map_center(subscribers(spark, sf_dir, ["latitude", "longitude"]))


_NB_IN = ["subscriber_id", "latitude", "longitude", *nb.CELL_MEANS]


@query(
    "cell_neighborhood",
    f"""with c as (select subscriber_id, {grid_sql('latitude', 'longitude', 8)} as cell_r8,
      {', '.join(nb.CELL_MEANS)} from subscribers)
    select c.subscriber_id, c.cell_r8, g.* exclude (cell_r8) from c join (select cell_r8, count(*) as cell_subscriber_count,
      {', '.join(f"{r(mean(c), 6)} as {name}" for c, name in nb.CELL_MEANS.items())} from c group by 1) g
      on c.cell_r8 = g.cell_r8""",
)
def cell_neighborhood(spark, sf_dir):
    base = nb.add_cells(subscribers(spark, sf_dir, _NB_IN), [8])
    joined = nb.cell_neighborhood(base, "cell_r8")
    return joined.select("subscriber_id", "cell_r8", "cell_subscriber_count", *nb.CELL_MEANS.values())


@query(
    "cell_rate_leave_one_out",
    f"""with c as (select subscriber_id, churned, {grid_sql('latitude', 'longitude', 7)} as cell_r7 from subscribers)
    select subscriber_id, cell_r7, cast(sum(churned) over (partition by cell_r7) - churned as double)
      / nullif(count(*) over (partition by cell_r7) - 1, 0) as cell_churn_rate_loo from c""",
)
def cell_rate_leave_one_out(spark, sf_dir):
    base = nb.add_cells(subscribers(spark, sf_dir, ["subscriber_id", "churned", "latitude", "longitude"]), [7])
    return nb.leave_one_out_rate(base, "cell_r7").select("subscriber_id", "cell_r7", "cell_churn_rate_loo")


@query(
    "cell_rate_lagged",
    f"""with e as (select {_CELL} as cell, date_trunc('week', ts) as period, event_type from events
      join subscribers on user_id = c_custkey),
    g as (select cell, period, count(*) as n_rows,
      {r("sum(case when event_type = 'error' then 1 else 0 end) / cast(count(*) as double)", 6)} as rate from e group by 1, 2)
    select g.cell, cast(g.period as timestamp) as period, g.n_rows, g.rate, b.rate as previous_rate
    from g left join g b on b.cell = g.cell and b.period = g.period - interval 7 days""",
)
def cell_rate_lagged(spark, sf_dir):
    places = subscribers(spark, sf_dir, ["c_custkey", "latitude", "longitude"])
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    located = events.join(places, events.user_id == places.c_custkey)
    keyed = nb.add_cells(located, [RESOLUTION]).withColumnRenamed(f"cell_r{RESOLUTION}", "cell")
    weekly = keyed.withColumn("period", F.date_trunc("week", "ts"))
    return nb.lagged_rate(weekly, "cell", "period", (F.col("event_type") == "error").cast("int"))


@query(
    "poi_density",
    f"""with p as (select {grid_sql('latitude', 'longitude', 6)} as cell_r6, count(*) as k from pois group by 1),
    s as (select subscriber_id, {grid_sql('latitude', 'longitude', 6)} as cell_r6 from subscribers)
    select subscriber_id, s.cell_r6, coalesce(k, 0) as poi_density from s left join p on s.cell_r6 = p.cell_r6""",
)
def poi_density(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "latitude", "longitude"])
    return nb.poi_density(base, pois(spark, sf_dir), 6).select("subscriber_id", "cell_r6", "poi_density")


def cell_attributes(spark, sf_dir):
    """Cell-keyed attributes: population from part sizes and a district name."""
    size = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("osm_id"), "p_size")
    placed = nb.add_cells(pois(spark, sf_dir).join(size, "osm_id"), [RESOLUTION])
    return placed.groupBy(F.col(f"cell_r{RESOLUTION}").alias("cell")).agg(
        F.sum(F.col("p_size") * F.lit(100)).alias("population"),
        F.min("poi_type").alias("district"),
    )


@query(
    "cell_attribute_join",
    f"""with a as (select {_CELL} as cell, cast(sum(p_size * 100) as bigint) as population, min(poi_type) as district
      from pois join part on osm_id = p_partkey group by 1)
    select g.cell, g.subscriber_count, g.avg_churn_probability, a.population, a.district
    from risk_grid g left join a on g.cell = a.cell""",
)
def cell_attribute_join(spark, sf_dir):
    joined = nb.join_cells(grid(spark, sf_dir), cell_attributes(spark, sf_dir), "cell")
    return joined.select("cell", "subscriber_count", "avg_churn_probability", "population", "district")


@query(
    "cells_per_resolution",
    " union all ".join(
        f"select {k} as resolution, count(distinct {grid_sql('latitude', 'longitude', k)}) as n_cells from subscribers"
        for k in (4, 7, 8)
    ),
)
def cells_per_resolution(spark, sf_dir):
    return nb.cells_per_resolution(subscribers(spark, sf_dir, ["latitude", "longitude"]), (4, 7, 8))
