import json

import pytest
from pyspark.sql import functions as F

from cellrisk.catalog.features import faulty_requests
from cellrisk.sources.testbed import table
from cellrisk.streaming import scoring, windows


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_dir, tmp_path):
    rows = faulty_requests(spark, sf_dir).drop("c_custkey", "snapshot_date", "churned", "churn_probability")
    files, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    rows.repartition(3).write.parquet(files)
    for _ in range(2):
        stream = scoring.read_requests(spark, files, rows.schema, files_per_trigger=1)
        scoring.score_stream(stream, out, offsets).awaitTermination()
    streamed = spark.read.parquet(out).drop("scored_at")
    batch = scoring.score_rows(rows).drop("scored_at")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_quarantine_splits_all_rows(spark, sf_dir, tmp_path):
    rows = faulty_requests(spark, sf_dir).drop("c_custkey")
    files, good, bad, offsets = (str(tmp_path / n) for n in ("in", "good", "bad", "offsets"))
    rows.write.parquet(files)
    for _ in range(2):
        stream = scoring.read_requests(spark, files, rows.schema)
        scoring.quarantine_stream(stream, good, bad, offsets).awaitTermination()
    n_good, n_bad = spark.read.parquet(good).count(), spark.read.parquet(bad).count()
    assert n_good + n_bad == rows.count() and n_bad > 0


def test_weekly_windows_equal_batch_over_several_triggers(spark, sf_dir, tmp_path):
    events = table(spark, sf_dir, "events")
    files, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    events.repartitionByRange(4, "ts").write.parquet(files)
    stream = windows.read_events(spark, files, files_per_trigger=1)
    windows.weekly_kpi_stream(stream, out, offsets, watermark="31 days").awaitTermination()
    streamed, batch = windows.latest_weeks(spark, out), windows.weekly_kpi(events, None)
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == batch.count()


def test_late_rows_are_dropped_past_the_watermark(spark, tmp_path):
    files, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))

    def event(i, ts):
        return spark.createDataFrame([(i, ts, 1, "view", 1.0, "{}")], "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.to_timestamp("ts"))

    for i, ts in enumerate(["2024-01-05 00:00:00", "2024-02-20 00:00:00", "2024-01-06 00:00:00"]):
        event(i, ts).coalesce(1).write.mode("append").parquet(files)
        stream = windows.read_events(spark, files)
        windows.weekly_kpi_stream(stream, out, offsets).awaitTermination()
    weeks = {str(r["week_start"])[:10]: r["n_events"] for r in windows.latest_weeks(spark, out).collect()}
    assert weeks == {"2024-01-04": 1, "2024-02-15": 1}


@pytest.mark.parametrize("triggers", [1, 4])
def test_weekly_drift_does_not_depend_on_batches(spark, sf_dir, tmp_path, triggers):
    from cellrisk.operators import drift

    events = table(spark, sf_dir, "events")
    reference = events.filter(F.col("ts") < F.expr("timestamp '2024-01-16'"))
    edges = drift.reference_edges(reference, ["value"])
    files, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    events.repartition(4).write.parquet(files)
    stream = windows.read_events(spark, files, files_per_trigger=4 // triggers)
    windows.drift_stream(stream, edges, ["value"], out, offsets).awaitTermination()
    expected = drift.binned_counts(reference, ["value"], edges)
    got = windows.weekly_drift(spark, out, expected).orderBy("week_start").collect()
    assert all(r["n_reference"] == reference.count() for r in got)
    assert sum(r["n_current"] for r in got) == events.count()


def test_badly_typed_json_is_quarantined_and_the_rest_scored(spark, sf_dir, tmp_path):
    rows = faulty_requests(spark, sf_dir).drop("c_custkey", "snapshot_date", "churned", "churn_probability")
    good = rows.filter("tenure_months >= 0 and latitude <= 90 and monthly_charges is not null and contract_type <> 'weekly'").limit(2)
    first = json.loads(good.toJSON().first())
    lines = [
        first,
        first | {"subscriber_id": "whole", "tenure_months": 12.0},
        first | {"subscriber_id": "text", "tenure_months": "long"},
        first | {"subscriber_id": "part", "tenure_months": 12.5},
        first | {"subscriber_id": "huge", "tenure_months": 10**14},
        first | {"subscriber_id": "list", "rsrq_avg": [1]},
        first | {"subscriber_id": "nan", "rsrp_avg": float("nan")},
        {k: v for k, v in first.items() if k != "latitude"} | {"subscriber_id": "gone"},
    ]
    files, ok, bad, offsets, scored, other = (str(tmp_path / n) for n in ("in", "good", "bad", "offsets", "scored", "other"))
    text = [json.dumps(line) for line in lines] + ["{broken", "[]"]
    spark.createDataFrame([(x,) for x in text], "value string").repartition(3).write.text(files)
    stream = scoring.read_json_requests(spark, files, rows.schema, files_per_trigger=1)
    scoring.quarantine_stream(stream, ok, bad, offsets).awaitTermination()
    reasons = {(r["subscriber_id"], *r["errors"]) for r in spark.read.parquet(bad).collect()}
    assert reasons >= {
        ("text", "tenure_months: not a int"),
        ("part", "tenure_months: not a int"),
        ("huge", "tenure_months: not a int"),
        ("list", "rsrq_avg: not a double"),
        ("nan", "rsrp_avg: not a number"),
        ("gone", "latitude: missing"),
        (None, "request: not JSON"),
    }
    assert {r["subscriber_id"] for r in spark.read.parquet(ok).collect()} == {first["subscriber_id"], "whole"}
    scoring.score_stream(scoring.read_json_requests(spark, files, rows.schema), scored, other).awaitTermination()
    assert spark.read.parquet(scored).count() == 2
