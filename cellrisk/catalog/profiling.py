"""Queries that profile the subscriber table."""

from __future__ import annotations

from cellrisk.catalog.features import faulty_requests
from cellrisk.catalog.registry import query
from cellrisk.catalog.risk import _OBSERVED, observed
from cellrisk.catalog.tables import cut_sql, mean, money, r
from cellrisk.functions.numeric import cut
from cellrisk.operators import features as ft
from cellrisk.operators import information, profile
from cellrisk.sources.testbed import cell_towers, subscribers

_RATE = f"{r(mean('churned'), 6)} as churn_rate, count(*) as n, cast(sum(churned) as bigint) as n_churned"


@query("churn_by_contract", f"select contract_type, {_RATE} from subscribers group by 1")
def churn_by_contract(spark, sf_dir):
    return profile.churn_by(subscribers(spark, sf_dir, ["contract_type", "churned"]), "contract_type")


@query(
    "churn_by_tenure",
    f"select tenure_group, {_RATE} from (select *, {cut_sql('tenure_months', ft.TENURE_GROUP_BINS)} as tenure_group from subscribers) group by 1",
)
def churn_by_tenure(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["tenure_months", "churned"])
    grouped = base.withColumn("tenure_group", cut("tenure_months", *ft.TENURE_GROUP_BINS))
    return profile.churn_by(grouped, "tenure_group")


@query("churn_by_quality", f"select rsrq_quality, {_RATE} from feats group by 1")
def churn_by_quality(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["rsrq_avg", "churned"])
    return profile.churn_by(base.withColumn("rsrq_quality", cut("rsrq_avg", *ft.RSRQ_BINS)), "rsrq_quality")


@query("churn_by_outage", f"select outage_bucket, {_RATE} from feats group by 1")
def churn_by_outage(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["outage_minutes_monthly", "churned"])
    bucketed = base.withColumn("outage_bucket", cut("outage_minutes_monthly", *ft.OUTAGE_BINS))
    return profile.churn_by(bucketed, "outage_bucket")


@query(
    "kpi_overview",
    f"""select count(*) as total, cast(sum(churned) as bigint) as churned, {r(mean('churned'), 6)} as churn_rate,
    {r(mean('monthly_charges'), 6)} as avg_monthly_charges,
    {money('case when churned = 1 then monthly_charges end')} as revenue_at_risk from subscribers""",
)
def kpi_overview(spark, sf_dir):
    return profile.kpi_overview(subscribers(spark, sf_dir, ["churned", "monthly_charges"]))


@query("value_counts", "select radio, count(*) as n from cell_towers group by 1")
def value_counts(spark, sf_dir):
    return profile.value_counts(cell_towers(spark, sf_dir), "radio")


@query(
    "null_counts",
    "select 'monthly_charges' as \"column\", count(*) as n_null from subscribers where c_custkey % 19 = 0 having count(*) > 0",
)
def null_counts(spark, sf_dir):
    return profile.null_counts(faulty_requests(spark, sf_dir))


_NUMERIC = [
    "senior_citizen", "phone_service", "multiple_lines", "international_calls", "tenure_months", "monthly_charges",
    "total_charges", "data_usage_gb", "call_minutes_monthly", "sms_monthly", "tech_support_calls", "rsrp_avg", "rsrq_avg",
    "dl_throughput_mbps", "call_drop_rate_pct", "call_drops_monthly", "outage_minutes_monthly", "latitude", "longitude",
]


def _describe_sql(source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count({c}) as "count", {r(f'avg({c})', 6)} as mean, {r(f'stddev_samp({c})', 6)} as std,
        cast(min({c}) as double) as min, {r(f'quantile_cont(cast({c} as double), 25e-2)', 6)} as q25,
        {r(f'quantile_cont(cast({c} as double), 5e-1)', 6)} as q50, {r(f'quantile_cont(cast({c} as double), 75e-2)', 6)} as q75,
        cast(max({c}) as double) as max from {source}"""
        for c in columns
    )


@query("describe", _describe_sql("subscribers", _NUMERIC))
def describe(spark, sf_dir):
    return profile.describe(subscribers(spark, sf_dir, _NUMERIC), _NUMERIC)


@query(
    "cell_summary",
    f"""select "column", "count", mean, std, q50 as median, max from ({_describe_sql(f'{_OBSERVED} o', ['n_subscribers', 'churn_rate'])})""",
)
def cell_summary(spark, sf_dir):
    return profile.cell_summary(observed(spark, sf_dir))


@query(
    "winsorize",
    f"""with f as (select subscriber_id, churned, data_charge_ratio as v from feats),
    l as (select churned, quantile_cont(v, 1e-2) as lo, quantile_cont(v, 99e-2) as hi from f group by 1)
    select subscriber_id, f.churned, v as data_charge_ratio, {r('least(greatest(v, lo), hi)', 6)} as data_charge_ratio_clipped
    from f join l on f.churned = l.churned""",
)
def winsorize(spark, sf_dir):
    base = subscribers(
        spark, sf_dir,
        ["subscriber_id", "churned", "tenure_months", "total_charges", "monthly_charges", "data_usage_gb",
         "call_minutes_monthly", "contract_type", "tech_support_calls"],
    )
    ratios = ft.subscriber_features(base).select("subscriber_id", "churned", "data_charge_ratio")
    return profile.winsorize(ratios, "data_charge_ratio", "churned")


_BOX = ["rsrq_avg", "rsrp_avg", "dl_throughput_mbps", "call_drop_rate_pct", "outage_minutes_monthly", "call_drops_monthly"]


@query(
    "box_stats",
    " union all ".join(
        f"""select b.churned, '{c}' as "column", count(*) as n, {r('any_value(q1)', 6)} as q1, {r('any_value(m)', 6)} as median,
        {r('any_value(q3)', 6)} as q3,
        min(case when v >= q1-15e-1*(q3-q1) and v <= q3+15e-1*(q3-q1) then v end) as whisker_low,
        max(case when v >= q1-15e-1*(q3-q1) and v <= q3+15e-1*(q3-q1) then v end) as whisker_high,
        count(*) filter (where not (v >= q1-15e-1*(q3-q1) and v <= q3+15e-1*(q3-q1))) as n_outliers
        from (select churned, cast({c} as double) as v from subscribers) s join
        (select churned, quantile_cont(cast({c} as double), 25e-2) as q1, quantile_cont(cast({c} as double), 5e-1) as m,
          quantile_cont(cast({c} as double), 75e-2) as q3 from subscribers group by 1) b on s.churned = b.churned group by 1"""
        for c in _BOX
    ),
)
def box_stats(spark, sf_dir):
    return profile.box_stats(subscribers(spark, sf_dir, ["churned", *_BOX]), _BOX, "churned")


@query(
    "histogram",
    f"""with g as (select churned, min(monthly_charges) as lo, max(monthly_charges) as hi, count(*) as k from subscribers group by 1),
    b as (select s.churned, cast(least(floor((monthly_charges - lo) / (hi - lo) * 50e0), 49) as int) as bin, count(*) as n
      from subscribers s join g on s.churned = g.churned group by 1, 2),
    e as (select *, cast(unnest(range(50)) as int) as bin from g)
    select e.churned, e.bin, {r('lo + e.bin * ((hi - lo) / 50e0)', 6)} as bin_start, coalesce(n, 0) as n,
    {r('coalesce(n, 0) / (k * ((hi - lo) / 50e0))', 9)} as density
    from e left join b on e.churned = b.churned and e.bin = b.bin""",
)
def histogram(spark, sf_dir):
    return profile.histogram(subscribers(spark, sf_dir, ["churned", "monthly_charges"]), "monthly_charges", "churned")


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(columns[j], columns[i]) for i in range(len(columns)) for j in range(i, len(columns))]


def _corr_sql(source: str, columns: list[str]) -> str:
    entries = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': {r(f'corr({a}, {b})', 6)}}}" for a, b in _pairs(columns))
    return f"select x.a as a, x.b as b, x.r as r from (select unnest([{entries}]) as x from {source})"


@query("corr_matrix", _corr_sql("subscribers", profile.CORRELATION_COLUMNS))
def corr_matrix(spark, sf_dir):
    return profile.corr_matrix(subscribers(spark, sf_dir, profile.CORRELATION_COLUMNS))


@query("corr_matrix_numeric", _corr_sql("subscribers", _NUMERIC))
def corr_matrix_numeric(spark, sf_dir):
    return profile.corr_matrix(subscribers(spark, sf_dir, _NUMERIC), _NUMERIC)


_CORR_FEATURES = [
    "tenure_months", "is_long_term", "total_charges", "charge_per_month_tenure", "tech_support_calls",
    "support_per_month", "call_drops_monthly", "network_frustration_index", "network_quality_score", "rsrq_avg",
]
_FEATURE_IN = [
    "churned", "tenure_months", "total_charges", "monthly_charges", "data_usage_gb", "call_minutes_monthly",
    "contract_type", "tech_support_calls", "rsrq_avg", "rsrp_avg", "dl_throughput_mbps", "call_drop_rate_pct",
    "outage_minutes_monthly", "call_drops_monthly",
]


def _features(spark, sf_dir):
    return ft.all_features(subscribers(spark, sf_dir, _FEATURE_IN))


@query(
    "corr_pairs",
    f"select a, b, r from ({_corr_sql('feats', _CORR_FEATURES)}) where a <> b and abs(r) > 8e-1",
)
def corr_pairs(spark, sf_dir):
    return profile.corr_pairs(_features(spark, sf_dir), _CORR_FEATURES)


@query(
    "corr_target",
    " union all ".join(f"select '{c}' as feature, {r(f'corr({c}, churned)', 6)} as r from feats" for c in _CORR_FEATURES),
)
def corr_target(spark, sf_dir):
    return profile.corr_target(_features(spark, sf_dir), _CORR_FEATURES, k=25)


_MI = ["tenure_months", "monthly_charges", "rsrq_avg", "call_drops_monthly", "outage_minutes_monthly", "total_charges"]


def _mi_sql(c: str) -> str:
    return f"""select '{c}' as feature, {r('sum(n / tot * ln(n * tot / (nb * nl)))', 6)} as mi from (
      select n * 1e0 as n, sum(n) over (partition by bin) * 1e0 as nb, sum(n) over (partition by churned) * 1e0 as nl, sum(n) over () * 1e0 as tot
      from (select len([e for e in edges if e < v]) as bin, churned, count(*) as n
        from (select cast({c} as double) as v, churned from subscribers),
             (select list_distinct(quantile_cont(cast({c} as double), [1e-1,2e-1,3e-1,4e-1,5e-1,6e-1,7e-1,8e-1,9e-1])) as edges from subscribers)
        group by 1, 2))"""


@query("mutual_information", " union all ".join(_mi_sql(c) for c in _MI))
def mutual_information(spark, sf_dir):
    return profile.mutual_information(subscribers(spark, sf_dir, ["churned", *_MI]), _MI)


def _neighbour_mi_sql(c: str) -> str:
    return f"""select '{c}' as feature, {r('greatest(avg(pn.y - pl.y + ps.y - pm.y), 0e0)', 6)} as mi from (
      with p as (select row_number() over () as i, cast({c} as double) as v, churned as g from subscribers where {c} is not null),
      d as (select a.i, a.v, a.g, min(abs(b.v - a.v), 3)[3] as reach from p a join p b on a.g = b.g and a.i <> b.i group by 1, 2, 3),
      e as (select a.i, a.v, a.g, a.reach, count(*) as l, count(*) filter (where b.v = a.v or abs(b.v - a.v) < a.reach) as s,
          coalesce(max(b.v) filter (where b.v < a.v and a.v - b.v = a.reach), a.v - a.reach) as low,
          coalesce(min(b.v) filter (where b.v > a.v and b.v - a.v = a.reach), a.v + a.reach) as high
        from d a join p b on a.g = b.g group by 1, 2, 3, 4)
      select a.i, a.l, a.s, (select count(*) from p) as n,
        count(*) filter (where case when a.reach = 0 then b.v = a.v else b.v > a.low and b.v < a.high end) as m
      from e a join p b on b.v >= a.low and b.v <= a.high group by 1, 2, 3) x
      join psi pn on pn.n = x.n join psi pl on pl.n = x.l join psi ps on ps.n = x.s join psi pm on pm.n = x.m"""


@query(
    "mutual_information_neighbours",
    """with psi as (select 1 as n, -0.5772156649015329e0 as y union all
      select i + 1, sum(1e0 / i) over (order by i) - 0.5772156649015329e0
      from (select unnest(range(1, (select count(*) from subscribers))) as i))
    select * from (""" + " union all ".join(_neighbour_mi_sql(c) for c in _NUMERIC) + ")",
)
def mutual_information_neighbours(spark, sf_dir):
    return information.neighbour_information(subscribers(spark, sf_dir, ["churned", *_NUMERIC]), _NUMERIC)
