import gzip
import json

import pytest
from pyspark.sql import functions as F

from cellrisk.catalog import oracles, queries
from cellrisk.sources.pois import read_poi_files
from cellrisk.sources.towers import ingest_towers, read_tower_csv

LINES = [
    "LTE,510,10,1,100,0,106.8,-6.2,1000,50,1,1672531200,1704067200,0",
    "GSM,510,10,1,101,0,106.8,,1000,50,1,1672531200,1704067200,0",
    "CDMA,510,10,1,102,0,106.9,-6.3,1000,50,1,n/a,1704067200,0",
    "NR,525,10,1,103,0,103.8,1.3,1000,50,1,1672531200,1704067200,0",
    "NR,510,10,1,104,0,106.9,95.0,1000,50,1,1672531200,1704067200,0",
]


@pytest.mark.parametrize("packed", [False, True])
def test_tower_files(spark, tmp_path, packed):
    path = tmp_path / ("towers.csv.gz" if packed else "towers.csv")
    with (gzip.open if packed else open)(path, "wt") as out:
        out.write("\n".join(LINES) + "\n")
    assert read_tower_csv(spark, str(path)).count() == 5
    rows = {r["cell_id"]: r for r in ingest_towers(spark, str(path), "ID", partitions=2).collect()}
    assert set(rows) == {100, 102}
    assert rows[100]["generation"] == "4G" and rows[102]["generation"] == "Unknown"
    assert rows[102]["created"] is None and str(rows[100]["created"]) == "2023-01-01 00:00:00"
    assert ingest_towers(spark, str(path), "XX").count() == 3


def test_poi_documents(spark, tmp_path):
    document = {
        "elements": [
            {"type": "node", "id": 1, "lat": -6.2, "lon": 106.8, "tags": {"name": "A"}},
            {"type": "node", "id": 2, "lat": -6.2, "lon": 106.8, "tags": {"shop": "x"}},
            {"type": "node", "id": 3, "lat": -6.2, "lon": 106.8},
            {"type": "way", "id": 4, "tags": {"name": "B"}},
            {"type": "node", "id": 5, "lon": 106.8},
        ]
    }
    (tmp_path / "shops.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "none.json").write_text(json.dumps({"elements": []}))
    files = {"shopping": str(tmp_path / "shops.json"), "transport": str(tmp_path / "none.json")}
    rows = read_poi_files(spark, files).orderBy("osm_id").collect()
    assert [(r["osm_id"], r["poi_type"], r["name"]) for r in rows] == [(1, "shopping", "A"), (2, "shopping", ""), (3, "shopping", "")]


def test_registry_is_consistent():
    names, stated = set(queries()), set(oracles())
    assert stated <= names and len(names) > 100


def test_usage_columns_alone_need_lineitem(spark, sf_dir):
    from cellrisk.sources.testbed import subscribers

    def scans(columns):
        plan = subscribers(spark, sf_dir, columns)._jdf.queryExecution().optimizedPlan().toString()
        return [t for t in ("lineitem", "l_quantity", "o_orderkey", "o_orderdate") if t in plan]

    assert scans(["latitude"]) == []
    assert "l_quantity" not in scans(["tenure_months"])
    assert "l_quantity" in scans(["data_usage_gb"])


def test_entry_runs(spark):
    import __spark_entry__ as e

    out = e.entry(spark)
    assert out.count() > 0 and out.filter(F.col("risk_tier").isNull()).count() == 0
