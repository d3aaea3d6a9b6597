"""Queries that run a stream over files derived from the tables, to the end of what is available."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrisk.catalog.features import faulty_requests
from cellrisk.catalog.registry import query
from cellrisk.catalog.tables import LOGIT_SQL, grid_sql, r, tier_sql
from cellrisk.operators import drift
from cellrisk.operators import neighborhood as nb
from cellrisk.session import checkpointed, scratch_path
from cellrisk.sources.testbed import subscribers, table
from cellrisk.streaming import scoring, windows


def _arriving(spark, sf_dir):
    """Request files of the faulty subscriber rows, and the stream that reads them."""
    path = scratch_path(spark, "requests")
    rows = faulty_requests(spark, sf_dir).drop("c_custkey", "snapshot_date", "churned", "churn_probability")
    rows.repartition(4).write.parquet(path)
    return scoring.read_requests(spark, path, rows.schema, files_per_trigger=2)


def _grid(spark, sf_dir):
    base = nb.add_cells(subscribers(spark, sf_dir, ["churned", "latitude", "longitude"]), [scoring.CELL_RESOLUTION])
    stats = nb.cell_stats(base, f"cell_r{scoring.CELL_RESOLUTION}", {"churned": "cell_churn_rate"})
    # Written once; every micro-batch reads the finished table.
    return checkpointed(stats.withColumnRenamed(f"cell_r{scoring.CELL_RESOLUTION}", "cell"))


@query(
    "score_stream",
    f"""with s as (select *, {grid_sql('latitude', 'longitude', 8)} as cell, 1e0/(1e0+exp(-({LOGIT_SQL}))) as p from feats),
    g as (select cell, {r('sum(churned) / cast(count(*) as double)', 6)} as rate from s group by 1)
    select subscriber_id, churn_probability, cast(case when p >= 45e-2 then 1 else 0 end as int) as churn_predicted,
      {tier_sql('p')} as risk_tier, s.cell, rate as cell_churn_rate, network_quality_score,
      {r('monthly_charges * p', 2)} as revenue_at_risk
    from s join g on s.cell = g.cell where c_custkey % 11 <> 0 and c_custkey % 13 <> 0 and c_custkey % 17 <> 0 and c_custkey % 19 <> 0""",
)
def score_stream(spark, sf_dir):
    output = scratch_path(spark, "scored")
    stream = scoring.score_stream(
        _arriving(spark, sf_dir), output, scratch_path(spark, "offsets"), _grid(spark, sf_dir)
    )
    stream.awaitTermination()
    return spark.read.parquet(output).drop("scored_at")


@query(
    "quarantine_stream",
    """select subscriber_id, concat_ws('; ',
         case when c_custkey % 19 = 0 then 'monthly_charges: missing' end,
         case when c_custkey % 13 = 0 then 'tenure_months: out of range' end,
         case when c_custkey % 17 = 0 then 'latitude: out of range' end,
         case when c_custkey % 11 = 0 then 'contract_type: not allowed' end) as reasons
       from subscribers where c_custkey % 19 = 0 or c_custkey % 13 = 0 or c_custkey % 17 = 0 or c_custkey % 11 = 0""",
)
def quarantine_stream(spark, sf_dir):
    good, bad = scratch_path(spark, "accepted"), scratch_path(spark, "quarantine")
    stream = scoring.quarantine_stream(_arriving(spark, sf_dir), good, bad, scratch_path(spark, "offsets"))
    stream.awaitTermination()
    return spark.read.parquet(bad).select("subscriber_id", F.concat_ws("; ", "errors").alias("reasons"))


def json_lines(rows):
    """The rows as lines of JSON of which some are broken, badly typed or hold NaN as their signal."""
    key = F.col("c_custkey")
    names = [c for c in rows.columns if c != "c_custkey"]
    as_text = {"tenure_months": F.when(key % 7 == 0, F.lit("two years")), "rsrp_avg": F.when(key % 5 == 0, F.lit("NaN"))}
    fields = [F.coalesce(as_text[c], F.col(c).cast("string")).alias(c) if c in as_text else F.col(c) for c in names]
    line = F.to_json(F.struct(*fields))
    cut = F.expr("left(line, length(line) - 1)")
    return rows.select(key, line.alias("line")).select(F.when(key % 23 == 0, cut).otherwise(F.col("line")).alias("value"))


@query(
    "json_quarantine",
    """select subscriber_id, reasons, count(*) as n from (
       select case when c_custkey % 23 <> 0 then subscriber_id end as subscriber_id,
       case when c_custkey % 23 = 0 then 'request: not JSON' else concat_ws('; ',
         case when c_custkey % 7 = 0 then 'tenure_months: not a int' end,
         case when c_custkey % 19 = 0 then 'monthly_charges: missing' end,
         case when c_custkey % 13 = 0 and c_custkey % 7 <> 0 then 'tenure_months: out of range' end,
         case when c_custkey % 17 = 0 then 'latitude: out of range' end,
         case when c_custkey % 5 = 0 then 'rsrp_avg: not a number' end,
         case when c_custkey % 11 = 0 then 'contract_type: not allowed' end) end as reasons
       from subscribers) where reasons <> '' group by 1, 2""",
)
def json_quarantine(spark, sf_dir):
    path, good, bad = (scratch_path(spark, n) for n in ("json_requests", "accepted", "quarantine"))
    rows = faulty_requests(spark, sf_dir).drop("snapshot_date", "churned", "churn_probability")
    json_lines(rows).repartition(4).write.text(path)
    schema = T.StructType([f for f in rows.schema.fields if f.name != "c_custkey"])
    arriving = scoring.read_json_requests(spark, path, schema, files_per_trigger=2)
    scoring.quarantine_stream(arriving, good, bad, scratch_path(spark, "offsets")).awaitTermination()
    refused = spark.read.parquet(bad).select("subscriber_id", F.concat_ws("; ", "errors").alias("reasons"))
    return refused.groupBy("subscriber_id", "reasons").agg(F.count(F.lit(1)).alias("n"))


def _event_files(spark, sf_dir):
    """The events as four files in time order."""
    path = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events")
    events.repartitionByRange(4, "ts").write.parquet(path)
    return windows.read_events(spark, path, files_per_trigger=2)


@query(
    "stream_weekly_kpi",
    """select make_timestamp(cast(floor(epoch(ts) / 604800) as bigint) * 604800000000) as week_start, count(*) as n_events,
    count(*) filter (where event_type = 'error') as n_errors, cast(sum(cast(value as decimal(18,2))) as double) as total_value
    from events group by 1""",
)
def stream_weekly_kpi(spark, sf_dir):
    output = scratch_path(spark, "weekly")
    # Files of one write may be picked up in any order, so the watermark spans all of them.
    stream = windows.weekly_kpi_stream(
        _event_files(spark, sf_dir), output, scratch_path(spark, "offsets"), watermark="31 days"
    )
    stream.awaitTermination()
    return windows.latest_weeks(spark, output)


_WEEK = "make_timestamp(cast(floor(epoch(ts) / 604800) as bigint) * 604800000000)"
_POINTS = ",".join(f"{i}e-1" for i in range(11))


@query(
    "stream_psi",
    f"""with ref as (select value from events where ts < timestamp '2024-01-16 00:00:00'),
    ed as (select list_sort(list_distinct(quantile_cont(value, [{_POINTS}]))) as edges from ref),
    b as (select {_WEEK} as week_start, ts < timestamp '2024-01-16 00:00:00' as is_ref,
      case when value < edges[1] or value > edges[-1] then 0 when value = edges[-1] then len(edges) - 1
        else len([x for x in edges if x <= value]) end as bin from events, ed where value is not null),
    bins as (select unnest(range(1, len(edges))) as bin from ed),
    e as (select bin, count(*) as n from b where is_ref group by 1),
    a as (select week_start, bin, count(*) as n from b group by 1, 2),
    w as (select week_start, sum(n) as t from a group by 1),
    p as (select w.week_start, coalesce(e.n, 0) / ((select count(*) from ref) + 1e-10) as x, coalesce(a.n, 0) / (w.t + 1e-10) as y, w.t
      from w cross join bins left join e on e.bin = bins.bin left join a on a.bin = bins.bin and a.week_start = w.week_start)
    select week_start, 'value' as feature, {r('sum((y - x) * ln((y + 1e-10) / (x + 1e-10)))', 6)} as psi,
      (select count(*) from ref) as n_reference, cast(max(t) as bigint) as n_current from p group by 1""",
)
def stream_psi(spark, sf_dir):
    reference = table(spark, sf_dir, "events").filter(F.col("ts") < F.expr("timestamp '2024-01-16 00:00:00'"))
    edges = checkpointed(drift.reference_edges(reference, ["value"]))
    expected = drift.binned_counts(reference, ["value"], edges)
    output = scratch_path(spark, "drift")
    stream = windows.drift_stream(
        _event_files(spark, sf_dir), edges, ["value"], output, scratch_path(spark, "offsets")
    )
    stream.awaitTermination()
    return windows.weekly_drift(spark, output, expected)
