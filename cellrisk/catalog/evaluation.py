"""Queries over a scored, labelled table."""

from __future__ import annotations

from cellrisk.catalog.registry import query
from cellrisk.catalog.tables import LOGIT_SQL, r
from cellrisk.functions.scoring import logit_share
from cellrisk.operators import evaluate as ev
from cellrisk.sources.testbed import subscribers

_LABELLED = [
    "subscriber_id", "churned", "contract_type", "tenure_months", "monthly_charges", "internet_service", "call_drops_monthly",
    "outage_minutes_monthly", "rsrq_avg", "payment_method", "senior_citizen", "tech_support_calls",
]
_T = 0.45


def labelled(spark, sf_dir):
    """Unrounded scores: two rows may differ by less than 10^-15."""
    rows = subscribers(spark, sf_dir, _LABELLED)
    return rows.select("subscriber_id", "churned", logit_share().alias("churn_probability"))


_Z = f"({LOGIT_SQL})"
_SCORED = f"(select subscriber_id, churned, 5e-1 + 5e-1 * {_Z} / (1e0 + abs({_Z})) as churn_probability from subscribers)"


_STEPS = f"""with steps as (select churn_probability as step, count(*) as n, cast(sum(churned) as bigint) as pos
    from {_SCORED} group by 1),
  cum as (select *, cast(sum(n) over (order by step desc) as bigint) as cum_n,
    cast(sum(pos) over (order by step desc) as bigint) as cum_pos,
    cast(sum(n) over () as bigint) as total_n, cast(sum(pos) over () as bigint) as total_pos from steps)"""
_AUC = "sum(pos * ((total_n-total_pos) - (cum_n-cum_pos) + (n-pos)/2e0)) / max(total_pos * (total_n-total_pos))"
_AP = "sum(pos * (cum_pos / cast(cum_n as double))) / max(total_pos)"
_BRIER = "sum((n-pos)*step*step + pos*(1e0-step)*(1e0-step)) / sum(n)"
_COUNTS = """cast(coalesce(sum(case when step >= 45e-2 then pos end), 0) as bigint) as tp,
  cast(coalesce(sum(case when step >= 45e-2 then n-pos end), 0) as bigint) as fp,
  cast(coalesce(sum(case when step < 45e-2 then pos end), 0) as bigint) as fn,
  cast(coalesce(sum(case when step < 45e-2 then n-pos end), 0) as bigint) as tn"""


def _share(a: str, b: str) -> str:
    return f"coalesce(cast({a} as double) / nullif({b}, 0), 0e0)"


@query("roc_auc", f"{_STEPS} select {r(_AUC, 6)} as roc_auc from cum")
def roc_auc(spark, sf_dir):
    return ev.roc_auc(labelled(spark, sf_dir))


@query("average_precision", f"{_STEPS} select {r(_AP, 6)} as average_precision from cum")
def average_precision(spark, sf_dir):
    return ev.average_precision(labelled(spark, sf_dir))


@query("brier", f"{_STEPS} select {r(_BRIER, 6)} as brier from cum")
def brier(spark, sf_dir):
    return ev.brier(labelled(spark, sf_dir))


@query(
    "classification_metrics",
    f"""{_STEPS} select {r('auc', 4)} as roc_auc, {r('ap', 4)} as pr_auc, {r(_share('2*tp', '2*tp+fp+fn'), 4)} as f1,
    {r(_share('tp', 'tp+fp'), 4)} as "precision", {r(_share('tp', 'tp+fn'), 4)} as recall, {r('b', 4)} as brier,
    45e-2 as threshold, tp+fp+fn+tn as n_test, {r(_share('tp+fn', 'tp+fp+fn+tn'), 4)} as churn_rate_actual,
    {r(_share('tp+fp', 'tp+fp+fn+tn'), 4)} as churn_rate_predicted
    from (select {_AUC} as auc, {_AP} as ap, {_BRIER} as b, {_COUNTS} from cum)""",
)
def classification_metrics(spark, sf_dir):
    return ev.classification_metrics(labelled(spark, sf_dir), _T)


@query(
    "confusion_matrix",
    f"""with cells as (select 0 as actual, 0 as predicted union all select 0, 1 union all select 1, 0 union all select 1, 1),
    c as (select churned as actual, case when churn_probability >= 45e-2 then 1 else 0 end as predicted, count(*) as n
          from {_SCORED} group by 1, 2)
    select cells.actual, cells.predicted, coalesce(n, 0) as n,
      {r('coalesce(n, 0) / cast(sum(coalesce(n, 0)) over (partition by cells.actual) as double)', 6)} as share_of_actual
    from cells left join c on cells.actual = c.actual and cells.predicted = c.predicted""",
)
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(labelled(spark, sf_dir), _T)


_REPORT = f"""{_STEPS}, k as (select {_COUNTS} from cum),
  cl as (select 'Retained' as class, {_share('tn', 'tn+fn')} as p, {_share('tn', 'tn+fp')} as rc,
         {_share('2*tn', '2*tn+fn+fp')} as f, tn+fp as s from k
   union all select 'Churned', {_share('tp', 'tp+fp')}, {_share('tp', 'tp+fn')}, {_share('2*tp', '2*tp+fp+fn')}, tp+fn from k),
  acc as (select {_share('tp+tn', 'tp+fp+fn+tn')} as a, tp+fp+fn+tn as n from k),
  l as (select class, p, rc, f, s from cl union all select 'accuracy', a, a, a, n from acc
   union all select 'macro avg', avg(p), avg(rc), avg(f), cast(sum(s) as bigint) from cl
   union all select 'weighted avg', sum(p*s)/sum(s), sum(rc*s)/sum(s), sum(f*s)/sum(s), cast(sum(s) as bigint) from cl)
  select class, {r('p', 4)} as "precision", {r('rc', 4)} as recall, {r('f', 4)} as f1_score, s as support from l"""


@query("class_report", _REPORT)
def class_report(spark, sf_dir):
    return ev.class_report(labelled(spark, sf_dir), _T)


@query(
    "roc_curve",
    f"""{_STEPS} select step as threshold, {r('(cum_n-cum_pos) / cast(total_n-total_pos as double)', 6)} as fpr,
    {r('cum_pos / cast(total_pos as double)', 6)} as tpr from cum
    union all select cast(null as double), 0e0, 0e0""",
)
def roc_curve(spark, sf_dir):
    return ev.roc_curve(labelled(spark, sf_dir))


@query(
    "pr_curve",
    f"""{_STEPS} select step as threshold, {r('cum_pos / cast(cum_n as double)', 6)} as "precision",
    {r('cum_pos / cast(total_pos as double)', 6)} as recall from cum
    union all select cast(null as double), 1e0, 0e0""",
)
def pr_curve(spark, sf_dir):
    return ev.pr_curve(labelled(spark, sf_dir))


def _sweep(low: int, high: int, digits: int) -> str:
    flagged = f"(select count(*) from {_SCORED} where churn_probability >= h/1e2)"
    hits = f"(select cast(coalesce(sum(churned), 0) as bigint) from {_SCORED} where churn_probability >= h/1e2)"
    total = "(select cast(sum(churned) as bigint) from subscribers)"
    return f"""select h/1e2 as threshold, {r(_share('tp', 'fl'), digits)} as "precision", {r(_share('tp', 'tot'), digits)} as recall,
      {r(_share('2*tp', 'fl+tot'), digits)} as f1
      from (select h, {flagged} as fl, {hits} as tp, {total} as tot from (select unnest(range({low}, {high} + 1)) as h))"""


@query("threshold_sweep", _sweep(10, 79, 6))
def threshold_sweep(spark, sf_dir):
    return ev.threshold_sweep(labelled(spark, sf_dir))


@query(
    "best_threshold",
    f"select threshold, {r('f1', 6)} as f1 from ({_sweep(20, 69, 10)}) order by f1 desc, threshold limit 1",
)
def best_threshold(spark, sf_dir):
    return ev.best_threshold(labelled(spark, sf_dir))


@query(
    "calibration",
    f"""select cast(len([k for k in range(1, 10) if churn_probability > k/1e1]) as int) as bin, count(*) as n,
    {r('sum(churn_probability)/count(*)', 6)} as mean_predicted, {r('sum(churned)/count(*)', 6)} as fraction_positive
    from {_SCORED} group by 1""",
)
def calibration(spark, sf_dir):
    return ev.calibration(labelled(spark, sf_dir))


_RANKED = f"""with ranked as (select subscriber_id, churned, churn_probability,
    row_number() over w as rank, cast(sum(churned) over w as bigint) as cum_pos, count(*) over () as total_n,
    cast(sum(churned) over () as bigint) as total_pos from {_SCORED}
    window w as (order by churn_probability desc, md5(subscriber_id), subscriber_id rows unbounded preceding))"""


@query(
    "cumulative_gain",
    f"""{_RANKED} select subscriber_id, rank, {r('g', 6)} as cum_gain, {r('s', 6)} as pct_pop, {r('g/(s+1e-10)', 6)} as lift
    from (select *, cum_pos/cast(total_pos as double) as g, rank/cast(total_n as double) as s from ranked)""",
)
def cumulative_gain(spark, sf_dir):
    return ev.cumulative_gain(labelled(spark, sf_dir), "subscriber_id")


@query(
    "lift_curve",
    f"""{_STEPS} select step as score, {r('g', 6)} as cum_gain, {r('s', 6)} as pct_pop, {r('g/(s+1e-10)', 6)} as lift
    from (select *, cum_pos/cast(total_pos as double) as g, cum_n/cast(total_n as double) as s from cum)""",
)
def lift_curve(spark, sf_dir):
    return ev.lift_curve(labelled(spark, sf_dir))


@query(
    "gain_at_k",
    f"""{_RANKED} select k as percent, cut as contacted, {r('g', 6)} as gain, {r('g/(k/1e2)', 6)} as lift from (
    select k, cast(floor(total_n * k / 100) as bigint) as cut,
      max(case when rank <= floor(total_n * k / 100) then cum_pos else 0 end) / cast(max(total_pos) as double) as g
    from ranked, (select unnest([10, 20]) as k) group by k, total_n)""",
)
def gain_at_k(spark, sf_dir):
    return ev.gain_at_k(labelled(spark, sf_dir), "subscriber_id")


@query(
    "contacts_for_recall",
    f"""{_RANKED} select k as recall_pct, min(rank) as contacts, {r('min(rank)*1e2/max(total_n)', 6)} as pct_contacted
    from ranked, (select unnest([50, 70, 80]) as k) where cum_pos*100 >= total_pos*k group by k""",
)
def contacts_for_recall(spark, sf_dir):
    return ev.contacts_for_recall(labelled(spark, sf_dir), "subscriber_id")
