"""Queries for data quality and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellrisk.catalog.features import faulty_requests
from cellrisk.catalog.registry import query
from cellrisk.catalog.tables import r
from cellrisk.operators import drift, quality
from cellrisk.sources.testbed import subscribers, usage_events


def _line(rule: str, bad: str, good: str, text: str, severity: str = "'ERROR'", passed: str | None = None) -> str:
    ok = passed or f"{bad} = 0"
    return (
        f"select '{rule}' as rule, {ok} as passed, case when {ok} then {good} else {text} end as message, "
        f"{severity} as severity, cast({bad} as bigint) as n_bad, n as n_total from t"
    )


def _report_sql(source: str) -> str:
    aggs = ["count(*) as n", "avg(churned) as rate"]
    lines = [
        _line("row_count", "0", "format('{:,} rows (expected >= 1,000)', n)", "format('{:,} rows (expected >= 1,000)', n)", passed="n >= 1000"),
        _line("expect_columns", "0", "'All 19 required columns present'", "''"),
        _line("unique:subscriber_id", "dup", "'All values unique'", "format('{:,} duplicates found', dup)"),
    ]
    for c in quality.NO_NULL_COLUMNS:
        aggs.append(f"count(*) filter (where {c} is null) as null_{c}")
        text = f"concat(format('{{:,}}', null_{c}), ' nulls found (', printf('%.2f%%', null_{c} * 1e2 / n), ')')"
        lines.append(_line(f"no_nulls:{c}", f"null_{c}", "'No nulls'", text))
    for c in quality.POSITIVE_COLUMNS:
        aggs.append(f"count(*) filter (where {c} < 0) as neg_{c}")
        lines.append(_line(f"positive:{c}", f"neg_{c}", "'All positive'", f"format('{{:,}} negative values', neg_{c})"))
    for c, (low, high) in quality.COLUMN_LIMITS.items():
        aggs.append(f"count(*) filter (where {c} < {low} or {c} > {high}) as out_{c}")
        lines.append(
            _line(
                f"range:{c}", f"out_{c}", f"'All values in [{low}, {high}]'",
                f"concat(format('{{:,}}', out_{c}), ' values outside [{low}, {high}]')",
                f"case when out_{c} < n * 1e-2 then 'WARNING' else 'ERROR' end",
            )
        )
    for c, values in quality.COLUMN_SETS.items():
        listed = ", ".join(f"'{v}'" for v in values)
        test = f"coalesce({c} not in ({listed}), true)"
        aggs.append(f"count(*) filter (where {test}) as set_{c}")
        aggs.append(f"list_slice(list_sort(list_distinct(list({c}) filter (where {test}))), 1, 5) as few_{c}")
        shown = "[" + ", ".join(f"''{v}''" for v in sorted(values)) + "]"
        text = f"concat(format('{{:,}}', set_{c}), ' unexpected values: [''', array_to_string(few_{c}, ''', '''), ''']')"
        lines.append(_line(f"valid_values:{c}", f"set_{c}", f"'All values in {shown}'", text))
    rate = "concat('Churn rate = ', printf('%.2f%%', rate * 1e2), ' (expected 5%–35%)')"
    lines.append(_line("churn_rate", "0", rate, rate, "'WARNING'", "rate between 5e-2 and 35e-2"))
    return (
        f"with t as (select *, n - (select count(distinct subscriber_id) from {source}) as dup from "
        f"(select {', '.join(aggs)} from {source})) " + " union all ".join(lines)
    )


def faulty(spark, sf_dir):
    """Faulty rows of which some also share an id."""
    rows = faulty_requests(spark, sf_dir)
    shared = F.when(F.col("c_custkey") % 23 == 0, F.lit("SUB_0000000")).otherwise(F.col("subscriber_id"))
    return rows.withColumn("subscriber_id", shared)


@query("dq_report", _report_sql("faulty"))
def dq_report(spark, sf_dir):
    return quality.subscriber_suite(faulty(spark, sf_dir)).report()


@query("dq_report_clean", _report_sql("subscribers"))
def dq_report_clean(spark, sf_dir):
    return quality.subscriber_suite(subscribers(spark, sf_dir)).report()


def _summary_body(source: str) -> str:
    cte, lines = _report_sql(source).split(")) select", 1)
    return f"""{cte})), rep as (select{lines})
    select count(*) filter (where passed) as n_passed, count(*) filter (where not passed and severity = 'WARNING') as n_warnings,
      count(*) filter (where not passed and severity = 'ERROR') as n_errors,
      count(*) filter (where not passed and severity = 'ERROR') = 0 as ok from rep"""


@query("dq_summary", _summary_body("faulty"))
def dq_summary(spark, sf_dir):
    return quality.subscriber_suite(faulty(spark, sf_dir)).summary()


@query(
    "dq_duplicates",
    "select subscriber_id, count(*) as n, count(*) - 1 as n_extra from faulty group by 1 having count(*) > 1",
)
def dq_duplicates(spark, sf_dir):
    return quality.duplicates(faulty(spark, sf_dir), "subscriber_id")


def _psi_sql(feature: str, source: str, is_reference: str) -> str:
    points = ",".join(f"{i}e-1" for i in range(11))
    return f"""select '{feature}' as feature, {r('sum((a-e)*ln((a+1e-10)/(e+1e-10)))', 6)} as psi,
      max(te) as n_reference, max(ta) as n_current from (
      select b.bin, coalesce(ne, 0) / (te + 1e-10) as e, coalesce(na, 0) / (ta + 1e-10) as a, te, ta
      from (select unnest(range(1, len(edges))) as bin from edges_{feature}) b
      left join (select bin, count(*) filter (where ref) as ne, count(*) filter (where not ref) as na from
        (select {is_reference} as ref, case when v < edges[1] or v > edges[-1] then 0 when v = edges[-1] then len(edges) - 1
           else len([x for x in edges if x <= v]) end as bin
         from (select *, cast({feature} as double) as v from {source}), edges_{feature}) group by 1) c on b.bin = c.bin,
      (select count({feature}) filter (where {is_reference}) as te, count({feature}) filter (where not ({is_reference})) as ta from {source}))""".replace(
        f"edges_{feature}",
        f"(select list_sort(list_distinct(quantile_cont(cast({feature} as double), [{points}]))) as edges from {source} where {is_reference}) ed",
    )


_HALVES = " union all ".join(_psi_sql(f, "subscribers", "c_custkey % 2 = 0") for f in drift.DRIFT_FEATURES)


@query("psi", _HALVES)
def psi(spark, sf_dir):
    rows = subscribers(spark, sf_dir, ["c_custkey", *drift.DRIFT_FEATURES])
    return drift.psi_tagged(rows, F.col("c_custkey") % 2 == 0)


@query("psi_usage", _psi_sql("value", "usage_events", "period = 'reference'"))
def psi_usage(spark, sf_dir):
    events = usage_events(spark, sf_dir)
    return drift.psi(
        events.filter(F.col("period") == "reference"), events.filter(F.col("period") == "current"), ["value"]
    )


@query(
    "drift_report",
    f"""select coalesce(max(psi), 0e0) as max_psi, coalesce(string_agg(feature, ',' order by feature) filter (where psi > 2e-1), '') as drifted_features,
    coalesce(bool_or(psi > 2e-1), false) as retrain from ({_psi_sql('rsrq_avg', 'subscribers', 'longitude < 1069e-1')}
    union all {_psi_sql('latitude', 'subscribers', 'longitude < 1069e-1')})""",
)
def drift_report(spark, sf_dir):
    """West against east: place drifts by construction, signal quality does not."""
    rows = subscribers(spark, sf_dir, ["longitude", "latitude", "rsrq_avg"])
    west = F.col("longitude") < 106.9
    return drift.drift_report(drift.psi_tagged(rows, west, ["rsrq_avg", "latitude"]))
