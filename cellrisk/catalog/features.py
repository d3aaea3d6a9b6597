"""Queries over features, filters, encodings and row checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellrisk.catalog.registry import query
from cellrisk.catalog.tables import grid_sql, haversine_sql, r, tier_sql
from cellrisk.functions import geo
from cellrisk.functions.numeric import lookup, np_round
from cellrisk.functions.scoring import label_at, risk_tier, tier_color, with_predictions
from cellrisk.operators import encode, requests
from cellrisk.operators import features as ft
from cellrisk.sources.testbed import SUBSCRIBER_COLUMNS, cell_towers, subscribers
from cellrisk.sources.towers import RADIO_GENERATION, filter_bbox, filter_country


def _feature_query(name: str, inputs: list[str], outputs: list[str], stage) -> None:
    sql = f"select subscriber_id, {', '.join(outputs)} from feats"

    @query(name, sql)
    def run(spark, sf_dir):
        return stage(subscribers(spark, sf_dir, ["subscriber_id", *inputs])).select("subscriber_id", *outputs)


_SUB_IN = [
    "tenure_months", "total_charges", "monthly_charges", "data_usage_gb", "call_minutes_monthly",
    "contract_type", "tech_support_calls",
]
_NET_IN = [
    "rsrq_avg", "rsrp_avg", "dl_throughput_mbps", "call_drop_rate_pct", "outage_minutes_monthly",
    "call_drops_monthly",
]

_feature_query("feat_tenure_bucket", _SUB_IN, ["tenure_months", "tenure_bucket"], ft.subscriber_features)
_feature_query("feat_charge_bucket", _SUB_IN, ["monthly_charges", "monthly_charge_bucket"], ft.subscriber_features)
_feature_query(
    "feat_ratios", _SUB_IN,
    ["charge_per_month_tenure", "data_charge_ratio", "call_intensity", "support_per_month", "contract_risk_score"],
    ft.subscriber_features,
)
_feature_query("feat_rsrq_quality", _NET_IN, ["rsrq_avg", "rsrq_quality"], ft.network_features)
_feature_query("feat_rsrp_quality", _NET_IN, ["rsrp_avg", "rsrp_quality"], ft.network_features)
_feature_query("feat_drop_bucket", _NET_IN, ["call_drop_rate_pct", "drop_rate_bucket"], ft.network_features)
_feature_query("feat_outage_bucket", _NET_IN, ["outage_minutes_monthly", "outage_bucket"], ft.network_features)
_feature_query("feat_network_quality", _NET_IN, ["network_quality_score"], ft.network_features)
_feature_query("feat_frustration", _NET_IN, ["network_frustration_index"], ft.network_features)
_feature_query(
    "feat_flags", _SUB_IN + [c for c in _NET_IN],
    ["is_new_subscriber", "is_long_term", "is_high_support", "is_high_drop_rate", "is_high_outage"],
    ft.all_features,
)

_ALL = ", ".join(SUBSCRIBER_COLUMNS)


@query("scan_subscribers", f"select {_ALL} from subscribers")
def scan_subscribers(spark, sf_dir):
    return subscribers(spark, sf_dir)


@query("sample_head", f"select {_ALL} from subscribers order by subscriber_id limit 1000")
def sample_head(spark, sf_dir):
    return subscribers(spark, sf_dir).orderBy("subscriber_id").limit(1000)


@query("filter_country", "select * from cell_towers where mcc in (510)")
def q_filter_country(spark, sf_dir):
    return filter_country(cell_towers(spark, sf_dir), "ID")


@query(
    "filter_bbox",
    "select * from cell_towers where latitude between -65e-1 and -6e0 and longitude between 1066e-1 and 107e0",
)
def q_filter_bbox(spark, sf_dir):
    bounds = {"lat_min": -6.5, "lat_max": -6.0, "lon_min": 106.6, "lon_max": 107.0}
    return filter_bbox(cell_towers(spark, sf_dir), bounds)


@query(
    "map_lookup",
    """select tower_id, radio, case radio when 'GSM' then '2G' when 'UMTS' then '3G' when 'LTE' then '4G'
       when 'NR' then '5G' else 'Unknown' end as generation from cell_towers""",
)
def map_lookup(spark, sf_dir):
    return cell_towers(spark, sf_dir).select(
        "tower_id", "radio", lookup("radio", RADIO_GENERATION, "Unknown").alias("generation")
    )


# The declared levels: every bin label plus the bucket for values outside all bins.
DECLARED_LEVELS = {
    "contract_type": ["month-to-month", "one-year", "two-year"],
    "payment_method": ["bank_transfer", "credit_card", "electronic_check", "mailed_check"],
    "internet_service": ["DSL", "fiber_optic", "none"],
    "rsrq_quality": [*ft.RSRQ_BINS[1], "nan"],
    "rsrp_quality": [*ft.RSRP_BINS[1], "nan"],
    "drop_rate_bucket": [*ft.DROP_BINS[1], "nan"],
    "outage_bucket": [*ft.OUTAGE_BINS[1], "nan"],
    "tenure_bucket": [*ft.TENURE_BINS[1], "nan"],
    "monthly_charge_bucket": [*ft.CHARGE_BINS[1], "nan"],
}
_DUMMIES = ", ".join(
    f"cast(case when {c} = '{v}' then 1 else 0 end as int) as {encode.level_name(c, v)}"
    for c, levels in DECLARED_LEVELS.items()
    for v in levels
)


@query("one_hot", f"select subscriber_id, {_DUMMIES} from feats")
def one_hot(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "payment_method", "internet_service", *_SUB_IN, *_NET_IN])
    encoded = encode.one_hot(ft.all_features(base), DECLARED_LEVELS)
    names = [encode.level_name(c, v) for c, levels in DECLARED_LEVELS.items() for v in levels]
    return encoded.select("subscriber_id", *names)


@query(
    "one_hot_levels",
    " union all ".join(
        f"select distinct '{c}' as name, {c} as level from feats" for c in encode.CATEGORICAL_COLUMNS
    ),
)
def one_hot_levels(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["payment_method", "internet_service", *_SUB_IN, *_NET_IN])
    levels = encode.fit_levels(ft.all_features(base))
    pairs = [(c, v) for c, values in levels.items() for v in values]
    return spark.createDataFrame(pairs, "name string, level string")


@query(
    "align_features",
    """select subscriber_id, cast(tenure_months as double) as tenure_months,
       coalesce(case when contract_type = 'two-year' then null else monthly_charges end, -999e0) as monthly_charges,
       0e0 as never_seen from subscribers""",
)
def align_features(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "tenure_months", "monthly_charges", "contract_type"])
    holes = base.withColumn("monthly_charges", F.when(F.col("contract_type") != "two-year", F.col("monthly_charges")))
    return encode.align_features(holes, ["tenure_months", "monthly_charges", "never_seen"], keep=["subscriber_id"])


_DERIVED = [
    "is_new_subscriber", "is_long_term", "charge_per_month_tenure", "data_charge_ratio", "call_intensity",
    "contract_risk_score", "is_high_support", "support_per_month", "network_quality_score", "is_high_drop_rate",
    "is_high_outage", "network_frustration_index",
]
_MODEL_INPUTS = [
    c
    for c in SUBSCRIBER_COLUMNS
    if c not in (*encode.NON_FEATURES, "contract_type", "payment_method", "internet_service")
] + _DERIVED


@query(
    "feature_list",
    "with t as (select count(*) as n from subscribers) "
    + " union all ".join(
        f"select '{name}' as feature, n as n_values from t"
        for name in [*_MODEL_INPUTS, *(encode.level_name(c, v) for c, vs in DECLARED_LEVELS.items() for v in vs)]
    ),
)
def feature_list(spark, sf_dir):
    """Model inputs found by reading the schema of the encoded frame, next to rows that carry them."""
    base = ft.all_features(subscribers(spark, sf_dir))
    encoded = encode.one_hot(base, DECLARED_LEVELS)
    names = encode.feature_list(encoded)
    filled = encoded.agg(*[F.count(c).alias(c) for c in names])
    return filled.unpivot([], names, "feature", "n_values")


@query(
    "request_defaults",
    """select subscriber_id, coalesce(case when c_custkey % 3 = 0 then null else rsrq_avg end, -11e0) as rsrq_avg,
       coalesce(case when c_custkey % 4 = 0 then null else contract_type end, 'month-to-month') as contract_type,
       15e-1 as dist_to_nearest_tower_km, 3 as towers_within_1km, 10 as towers_within_2km,
       'LTE' as nearest_tower_radio, 100 as cell_subscriber_count, 15e-2 as cell_churn_rate from subscribers""",
)
def request_defaults(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["c_custkey", "subscriber_id", "rsrq_avg", "contract_type"])
    holes = base.withColumns(
        {
            "rsrq_avg": F.when(F.col("c_custkey") % 3 != 0, F.col("rsrq_avg")),
            "contract_type": F.when(F.col("c_custkey") % 4 != 0, F.col("contract_type")),
        }
    )
    return requests.with_defaults(holes).select(
        "subscriber_id", "rsrq_avg", "contract_type", "dist_to_nearest_tower_km", "towers_within_1km",
        "towers_within_2km", "nearest_tower_radio", "cell_subscriber_count", "cell_churn_rate",
    )


def faulty_requests(spark, sf_dir):
    """Subscriber rows of which some carry faults: a wrong contract, negative tenure, no charges."""
    key = F.col("c_custkey")
    base = subscribers(spark, sf_dir)
    return base.withColumns(
        {
            "contract_type": F.when(key % 11 == 0, F.lit("weekly")).otherwise(F.col("contract_type")),
            "tenure_months": F.when(key % 13 == 0, F.lit(-5)).otherwise(F.col("tenure_months")),
            "latitude": F.when(key % 17 == 0, F.lit(200.0)).otherwise(F.col("latitude")),
            "monthly_charges": F.when(key % 19 != 0, F.col("monthly_charges")),
        }
    )


@query(
    "row_checks",
    """select subscriber_id, concat_ws('; ',
         case when c_custkey % 19 = 0 then 'monthly_charges: missing' end,
         case when c_custkey % 13 = 0 then 'tenure_months: out of range' end,
         case when c_custkey % 17 = 0 then 'latitude: out of range' end,
         case when c_custkey % 11 = 0 then 'contract_type: not allowed' end) as reasons,
       (c_custkey % 19 <> 0 and c_custkey % 13 <> 0 and c_custkey % 17 <> 0 and c_custkey % 11 <> 0) as accepted
       from subscribers""",
)
def row_checks(spark, sf_dir):
    checked = requests.check_rows(faulty_requests(spark, sf_dir))
    return checked.select(
        "subscriber_id",
        F.concat_ws("; ", "errors").alias("reasons"),
        (F.size("errors") == 0).alias("accepted"),
    )


_PROJECTED = ["subscriber_id", "churn_probability", "churn_predicted", "risk_tier", "revenue_at_risk", "latitude", "longitude"]


@query("project_predictions", f"select {', '.join(_PROJECTED)} from scored")
def project_predictions(spark, sf_dir):
    scored = with_predictions(
        subscribers(spark, sf_dir, ["subscriber_id", "monthly_charges", "churn_probability", "latitude", "longitude"])
    )
    return encode.project_present(scored, [*_PROJECTED, "cell_r8", "cell_r7", "scored_at"])


@query("score_label", "select subscriber_id, churn_probability, churn_predicted from scored")
def score_label(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "churn_probability"])
    return base.withColumn("churn_predicted", label_at("churn_probability"))


@query("logit_score", "select subscriber_id, churn_probability from subscribers")
def q_logit_score(spark, sf_dir):
    return subscribers(spark, sf_dir, ["subscriber_id", "churn_probability"])


@query(
    "risk_tier",
    f"""select subscriber_id, tier as risk_tier, case tier when 'LOW' then '#2ecc71' when 'MEDIUM' then '#f39c12'
        when 'HIGH' then '#e74c3c' else '#8e44ad' end as color
        from (select subscriber_id, {tier_sql('churn_probability')} as tier from subscribers)""",
)
def q_risk_tier(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "churn_probability"])
    tiered = base.select("subscriber_id", risk_tier("churn_probability").alias("risk_tier"))
    return tiered.withColumn("color", tier_color("risk_tier"))


@query("revenue_at_risk", "select subscriber_id, revenue_at_risk from scored")
def q_revenue_at_risk(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "monthly_charges", "churn_probability"])
    return with_predictions(base).select("subscriber_id", "revenue_at_risk")


@query(
    "haversine",
    f"select subscriber_id, {r(haversine_sql('latitude', 'longitude', '-62088e-4', '1068456e-4'), 6)} as km_to_center from subscribers",
)
def haversine(spark, sf_dir):
    km = geo.haversine_km("latitude", "longitude", F.lit(-6.2088), F.lit(106.8456))
    base = subscribers(spark, sf_dir, ["subscriber_id", "latitude", "longitude"])
    return base.select("subscriber_id", np_round(km, 6).alias("km_to_center"))


@query(
    "grid_cell",
    f"select subscriber_id, {grid_sql('latitude', 'longitude', 7)} as cell_r7, {grid_sql('latitude', 'longitude', 8)} as cell_r8 from subscribers",
)
def q_grid_cell(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "latitude", "longitude"])
    return base.select(
        "subscriber_id",
        geo.grid_cell("latitude", "longitude", 7).alias("cell_r7"),
        geo.grid_cell("latitude", "longitude", 8).alias("cell_r8"),
    )


def _hex_sql(resolution: int) -> str:
    """Cube rounding, written out: the coordinate that moved most is set from the other two."""
    edge = repr(geo.hex_edge_km(resolution))
    x, y = "radians(longitude) * 6371e0", "sin(radians(latitude)) * 6371e0"
    third, root = repr(1.0 / 3.0), repr(3.0**0.5 / 3.0)
    return f"""(select subscriber_id, concat('x{resolution}_',
      cast(case when dq > dr and dq > ds then -rr - rs else rq end as bigint), '_',
      cast(case when not (dq > dr and dq > ds) and dr > ds then -rq - rs else rr end as bigint)) as cell
      from (select *, abs(rq - q) as dq, abs(rr - r) as dr, abs(rs - s) as ds
        from (select *, round_even(q, 0) as rq, round_even(r, 0) as rr, round_even(s, 0) as rs
          from (select *, -q - r as s from (select subscriber_id,
            (cast({root} as double) * {x} - cast({third} as double) * {y}) / cast({edge} as double) as q,
            (cast({2.0 / 3.0!r} as double) * {y}) / cast({edge} as double) as r from subscribers)))))"""


@query(
    "hex_cell",
    f"select a.subscriber_id, a.cell as cell_r7, b.cell as cell_r8 from {_hex_sql(7)} a join {_hex_sql(8)} b on a.subscriber_id = b.subscriber_id",
)
def q_hex_cell(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["subscriber_id", "latitude", "longitude"])
    return base.select(
        "subscriber_id",
        geo.hex_cell("latitude", "longitude", 7).alias("cell_r7"),
        geo.hex_cell("latitude", "longitude", 8).alias("cell_r8"),
    )


@query("cell_polygon")
def q_cell_polygon(spark, sf_dir):
    base = subscribers(spark, sf_dir, ["latitude", "longitude"])
    cells = base.select(geo.hex_cell("latitude", "longitude", 7).alias("cell")).distinct()
    return cells.withColumn("ring", geo.cell_polygon("cell"))
