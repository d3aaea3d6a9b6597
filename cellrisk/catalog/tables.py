"""SQL text shared by the stated results: the logical tables as common table expressions."""

from __future__ import annotations

import re

from cellrisk.operators import features as ft


def r(expression: str, digits: int) -> str:
    """Round half to even after scaling."""
    if digits == 0:
        return f"round_even({expression}, 0)"
    return f"(round_even(({expression}) * 1e{digits}, 0) / 1e{digits})"


def money(expression: str) -> str:
    return f"cast(sum(cast({expression} as decimal(18,2))) as double)"


def mean(expression: str, digits: int = 6) -> str:
    scaled = f"sum(cast(round_even(({expression}) * 1e{digits}, 0) as bigint)) / 1e{digits}"
    return f"({scaled} / nullif(count({expression}), 0))"


def cut_sql(column: str, bins: tuple[list, list]) -> str:
    edges, labels = bins
    whens = []
    for i, label in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        tests = []
        if low != float("-inf"):
            tests.append(f"{column} > {low}")
        if high != float("inf"):
            tests.append(f"{column} <= {high}")
        whens.append(f"when {' and '.join(tests)} then '{label}'")
    return f"case {' '.join(whens)} else 'nan' end"


def tier_sql(p: str) -> str:
    return (
        f"case when {p} >= 0 and {p} < 0.25e0 then 'LOW' when {p} >= 0.25e0 and {p} < 0.5e0 then 'MEDIUM' "
        f"when {p} >= 0.5e0 and {p} < 0.7e0 then 'HIGH' else 'CRITICAL' end"
    )


def grid_sql(lat: str, lon: str, resolution: int) -> str:
    step = 2**resolution
    return (
        f"concat('g{resolution}_', cast(round_even({lat}*{step}e0, 0) as bigint), '_', "
        f"cast(round_even({lon}*{step}e0, 0) as bigint))"
    )


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"sin(radians({lat2}-{lat1})/2e0)*sin(radians({lat2}-{lat1})/2e0)"
        f"+cos(radians({lat1}))*cos(radians({lat2}))"
        f"*sin(radians({lon2}-{lon1})/2e0)*sin(radians({lon2}-{lon1})/2e0)"
    )
    return f"12742e0*asin(sqrt(least(greatest({a}, 0e0), 1e0)))"


_ORDER_FACTS = """select o_custkey, count(*) as n_orders, min(o_orderdate) as first_order,
    sum(cast(o_totalprice as decimal(18,2))) as spend,
    sum(case when o_orderpriority = '1-URGENT' then 1 else 0 end) as urgent
  from orders group by o_custkey"""

def _grid_cte(resolution: int, minimum: int) -> str:
    return f"""select cell, subscriber_count, predicted_churners,
    {r('a_prob', 4)} as avg_churn_probability, {r('a_rsrq', 2)} as avg_rsrq, {r('a_thr', 2)} as avg_throughput,
    {r('a_chg', 2)} as avg_monthly_charges, {r('a_out', 1)} as avg_outage_minutes, {r('a_m2m', 3)} as pct_month_to_month,
    {r('predicted_churners / cast(subscriber_count as double)', 4)} as predicted_churn_rate,
    {r(r('a_chg', 2) + ' * predicted_churners', 2)} as estimated_revenue_at_risk
  from (select {grid_sql('latitude', 'longitude', resolution)} as cell, count(*) as subscriber_count,
      cast(sum(churn_predicted) as bigint) as predicted_churners,
      {mean('churn_probability')} as a_prob, {mean('rsrq_avg')} as a_rsrq, {mean('dl_throughput_mbps')} as a_thr,
      {mean('monthly_charges')} as a_chg, {mean('outage_minutes_monthly')} as a_out,
      {mean("case when contract_type = 'month-to-month' then 1 else 0 end")} as a_m2m
    from scored group by 1) where subscriber_count >= {minimum}"""


#: Linear score of a row of subscribers; its probability is 1 / (1 + exp(-score)).
LOGIT_SQL = """-25e-1
   + (case contract_type when 'month-to-month' then 15e-1 when 'one-year' then 8e-1 else 0e0 end)
   - 2e-2*tenure_months + 15e-3*monthly_charges
   - (case when internet_service = 'fiber_optic' then 5e-1 else 0e0 end)
   + 4e-2*call_drops_monthly + 3e-2*outage_minutes_monthly/1e1 - 3e-2*(rsrq_avg+11e0)
   + (case when payment_method = 'electronic_check' then 4e-1 else 0e0 end)
   + 3e-1*senior_citizen + 5e-2*tech_support_calls"""

_CTES: dict[str, str] = {
    "subscribers": f"""select b.*, case when (c_custkey*48271) % 1000 / 1e3 < churn_probability then 1 else 0 end as churned
  from (select a.*, round_even(1e4/(1e0+exp(-({LOGIT_SQL}))), 0)/1e4 as churn_probability
  from (select c_custkey,
  concat('SUB_', lpad(cast(c_custkey as varchar), 7, '0')) as subscriber_id,
  timestamp '2024-01-01 00:00:00' as snapshot_date,
  case when c_mktsegment in ('BUILDING','MACHINERY') then 'month-to-month'
       when c_mktsegment = 'HOUSEHOLD' then 'two-year' else 'one-year' end as contract_type,
  case c_custkey % 4 when 0 then 'electronic_check' when 1 then 'mailed_check'
                     when 2 then 'bank_transfer' else 'credit_card' end as payment_method,
  case c_nationkey % 3 when 0 then 'fiber_optic' when 1 then 'DSL' else 'none' end as internet_service,
  cast(case when (c_custkey*48611) % 100 < 16 then 1 else 0 end as int) as senior_citizen,
  cast(case when c_custkey % 10 < 9 then 1 else 0 end as int) as phone_service,
  cast(c_custkey % 2 as int) as multiple_lines,
  cast(case when c_custkey % 25 < 7 then 1 else 0 end as int) as international_calls,
  cast(coalesce((2001*12+8) - (year(first_order)*12 + month(first_order)), 1) as int) as tenure_months,
  2e1 + (cast(round(c_acctbal*1e2) as bigint) + 100000) % 10000 / 1e2 as monthly_charges,
  cast(coalesce(spend, 0) as double) as total_charges,
  coalesce(qty, 0e0) / (case when coalesce(n_orders, 0) < 1 then 1 else n_orders end) as data_usage_gb,
  cast((c_custkey*7907) % 1201 as double) as call_minutes_monthly,
  cast((c_custkey*7901) % 501 as double) as sms_monthly,
  cast(coalesce(urgent, 0) as int) as tech_support_calls,
  -130e0 + (c_custkey*104729) % 701 / 1e1 as rsrp_avg,
  -20e0 + (c_custkey*15485863) % 171 / 1e1 as rsrq_avg,
  5e-1 + (c_custkey*611953) % 14950 / 1e2 as dl_throughput_mbps,
  (c_custkey*1299709) % 2001 / 1e2 as call_drop_rate_pct,
  cast((c_custkey*179424673) % 21 as int) as call_drops_monthly,
  cast((c_custkey*32452843) % 301 as int) as outage_minutes_monthly,
  -7e0 + (c_nationkey*37) % 25 / 25e0 * 14e-1 + (c_custkey*7919) % 1000 / 1e4 as latitude,
  1064e-1 + (c_nationkey*11) % 25 / 25e0 * 1e0 + (c_custkey*6101) % 1000 / 1e4 as longitude
 from customer left join ({_ORDER_FACTS}) o on c_custkey = o.o_custkey
 left join (select o_custkey, sum(l_quantity) as qty from lineitem join orders on l_orderkey = o_orderkey
            group by o_custkey) l on c_custkey = l.o_custkey) a) b""",
    "cell_towers": """select concat('TOWER_', lpad(cast(s_suppkey as varchar), 5, '0')) as tower_id, s_suppkey,
  case s_suppkey % 3 when 0 then 'LTE' when 1 then 'NR' else 'UMTS' end as radio, 510 as mcc,
  case s_suppkey % 3 when 0 then 10 when 1 then 8 else 1 end as mnc,
  -7e0 + (s_suppkey*7919) % 1500 / 1e3 as latitude,
  1064e-1 + (s_suppkey*6101) % 1100 / 1e3 as longitude,
  case s_suppkey % 4 when 0 then 500 when 1 then 1000 when 2 then 2000 else 5000 end as range_m,
  cast(50 + (s_suppkey*48611) % 4950 as int) as samples,
  cast(1672531200 as bigint) as created, cast(1704067200 as bigint) as updated
  from supplier""",
    "pois": """select p_partkey as osm_id,
  case p_partkey % 6 when 0 then 'shopping' when 1 then 'transport' when 2 then 'education'
    when 3 then 'healthcare' when 4 then 'recreation' else 'food_beverage' end as poi_type,
  p_name as name,
  -7e0 + (p_partkey*104729) % 1500 / 1e3 as latitude,
  1064e-1 + (p_partkey*48611) % 1100 / 1e3 as longitude
  from part""",
    "usage_events": """select *, case when ts < timestamp '2024-01-16 00:00:00' then 'reference' else 'current' end as period
  from events""",
    "feats0": f"""select s.*,
  cast(case when tenure_months <= 3 then 1 else 0 end as int) as is_new_subscriber,
  cast(case when tenure_months >= 24 then 1 else 0 end as int) as is_long_term,
  {cut_sql('tenure_months', ft.TENURE_BINS)} as tenure_bucket,
  {r('total_charges / greatest(tenure_months, 1)', 2)} as charge_per_month_tenure,
  {cut_sql('monthly_charges', ft.CHARGE_BINS)} as monthly_charge_bucket,
  {r('data_usage_gb / greatest(monthly_charges, 1e0)', 4)} as data_charge_ratio,
  {r('call_minutes_monthly / greatest(tenure_months, 1)', 2)} as call_intensity,
  cast(case contract_type when 'month-to-month' then 3 when 'one-year' then 2 when 'two-year' then 1 else 2 end as int) as contract_risk_score,
  cast(case when tech_support_calls >= 3 then 1 else 0 end as int) as is_high_support,
  {r('tech_support_calls / greatest(cast(tenure_months as double), 1e0)', 4)} as support_per_month,
  {cut_sql('rsrq_avg', ft.RSRQ_BINS)} as rsrq_quality,
  {cut_sql('rsrp_avg', ft.RSRP_BINS)} as rsrp_quality,
  {r('((least(greatest(rsrq_avg,-20e0),-3e0)+20e0)/17e0*4e-1 + (least(greatest(rsrp_avg,-130e0),-60e0)+130e0)/70e0*35e-2 + ln(1e0+dl_throughput_mbps)/ln(151e0)*25e-2)*1e2', 1)} as network_quality_score,
  cast(case when call_drop_rate_pct > 5e0 then 1 else 0 end as int) as is_high_drop_rate,
  {cut_sql('call_drop_rate_pct', ft.DROP_BINS)} as drop_rate_bucket,
  cast(case when outage_minutes_monthly > 60 then 1 else 0 end as int) as is_high_outage,
  {cut_sql('outage_minutes_monthly', ft.OUTAGE_BINS)} as outage_bucket
  from subscribers s""",
    "feats": f"""select *, {r('call_drops_monthly*2e0 + outage_minutes_monthly/3e1 + is_high_drop_rate*3e0 + (1e2-network_quality_score)/2e1', 2)} as network_frustration_index
  from feats0""",
    "scored": f"""select *, cast(case when churn_probability >= 45e-2 then 1 else 0 end as int) as churn_predicted,
  {tier_sql('churn_probability')} as risk_tier,
  {r('monthly_charges * churn_probability', 2)} as revenue_at_risk from subscribers""",
    "faulty": """select * replace (
    case when c_custkey % 11 = 0 then 'weekly' else contract_type end as contract_type,
    case when c_custkey % 13 = 0 then -5 else tenure_months end as tenure_months,
    case when c_custkey % 17 = 0 then 200e0 else latitude end as latitude,
    case when c_custkey % 19 = 0 then null else monthly_charges end as monthly_charges,
    case when c_custkey % 23 = 0 then 'SUB_0000000' else subscriber_id end as subscriber_id) from subscribers""",
    "risk_grid": _grid_cte(4, 10),
    "risk_grid_fine": _grid_cte(8, 1),
}
_NEEDS = {
    "feats0": ["subscribers"],
    "feats": ["subscribers", "feats0"],
    "scored": ["subscribers"],
    "faulty": ["subscribers"],
    "risk_grid": ["subscribers", "scored"],
    "risk_grid_fine": ["subscribers", "scored"],
}


def with_tables(body: str) -> str:
    """Prefix `body` with the tables it names. `body` may start with `with` CTEs of its own."""
    words = set(re.findall(r"[a-z_0-9]+", body))
    needed = set()
    for name in _CTES:
        if name in words:
            needed.update([name, *_NEEDS.get(name, [])])
    if not needed:
        return body
    ctes = ", ".join(f"{name} as ({sql})" for name, sql in _CTES.items() if name in needed)
    text = body.strip()
    if text.lower().startswith("with "):
        return f"with {ctes}, {text[5:]}"
    return f"with {ctes} {text}"
