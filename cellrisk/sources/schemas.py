"""Declared schemas of the input tables."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


SUBSCRIBER = _struct(
    "subscriber_id string, snapshot_date timestamp, senior_citizen int, phone_service int,"
    "multiple_lines int, internet_service string, international_calls int, contract_type string,"
    "payment_method string, tenure_months int, monthly_charges double, total_charges double,"
    "data_usage_gb double, call_minutes_monthly double, sms_monthly double, tech_support_calls int,"
    "rsrp_avg double, rsrq_avg double, dl_throughput_mbps double, call_drop_rate_pct double,"
    "call_drops_monthly int, outage_minutes_monthly int, latitude double, longitude double,"
    "churned int, churn_probability double"
)

# Headerless tower file: fixed column order. Epochs are read as text, as bad ones do occur.
TOWER_RAW = _struct(
    "radio string, mcc int, net int, area int, cell bigint, unit int, lon double, lat double,"
    "range int, samples int, changeable int, created string, updated string, averageSignal int"
)

POI_DOCUMENT = T.StructType(
    [
        T.StructField(
            "elements",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("id", T.LongType()),
                        T.StructField("lat", T.DoubleType()),
                        T.StructField("lon", T.DoubleType()),
                        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
                    ]
                )
            ),
        )
    ]
)

EVENT = _struct(
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
)

# The star schema the logical tables are built from. Declared, so that opening a table runs no job.
STAR = {
    "nation": _struct("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _struct("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": _struct("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": _struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        "o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": _struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        "l_linestatus string, l_shipdate timestamp"
    ),
    "events": EVENT,
}
