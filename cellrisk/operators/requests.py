"""Checks and defaults for arriving subscriber rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column for the text of a request that is no JSON object.
CORRUPT = "_corrupt_record"
#: Column for the reasons found while types were given; `check_rows` adds its own to them.
TYPE_ERRORS = "_type_errors"

# Request fields (required, lowest, highest), allowed sets and defaults.
REQUIRED = ["subscriber_id", "tenure_months", "monthly_charges", "total_charges", "data_usage_gb", "latitude", "longitude"]
RANGES = {
    "senior_citizen": (0, 1),
    "phone_service": (0, 1),
    "multiple_lines": (0, 1),
    "international_calls": (0, 1),
    "tenure_months": (0, 120),
    "monthly_charges": (0, None),
    "total_charges": (0, None),
    "data_usage_gb": (0, None),
    "call_minutes_monthly": (0, None),
    "sms_monthly": (0, None),
    "tech_support_calls": (0, None),
    "dl_throughput_mbps": (0, None),
    "call_drop_rate_pct": (0, 100),
    "call_drops_monthly": (0, None),
    "outage_minutes_monthly": (0, None),
    "latitude": (-90, 90),
    "longitude": (-180, 180),
}
ALLOWED = {
    "contract_type": ["month-to-month", "one-year", "two-year"],
    "internet_service": ["fiber_optic", "DSL", "none"],
}
FIELD_DEFAULTS = {
    "senior_citizen": 0,
    "phone_service": 1,
    "multiple_lines": 0,
    "internet_service": "fiber_optic",
    "international_calls": 0,
    "contract_type": "month-to-month",
    "payment_method": "electronic_check",
    "call_minutes_monthly": 300.0,
    "sms_monthly": 50.0,
    "tech_support_calls": 0,
    "rsrp_avg": -95.0,
    "rsrq_avg": -11.0,
    "dl_throughput_mbps": 20.0,
    "call_drop_rate_pct": 2.0,
    "call_drops_monthly": 1,
    "outage_minutes_monthly": 30.0,
}
CONTEXT_DEFAULTS = {
    "churned": 0,
    "churn_probability_true": 0,
    "cell_r7": "unknown",
    "cell_r8": "unknown",
    "dist_to_nearest_tower_km": 1.5,
    "towers_within_1km": 3,
    "towers_within_2km": 10,
    "nearest_tower_radio": "LTE",
    "cell_subscriber_count": 100,
    "cell_avg_rsrq": -11.0,
    "cell_avg_rsrp": -95.0,
    "cell_avg_throughput": 20.0,
    "cell_avg_outage": 30.0,
    "cell_avg_monthly_charges": 60.0,
    "cell_churn_rate": 0.15,
}


def request_errors(df: DataFrame) -> Column:
    """Array of reasons a row is refused; empty for a good row."""
    have = set(df.columns)
    checks = [(F.col(c).isNull(), f"{c}: missing") for c in REQUIRED if c in have]
    checks += [(F.lit(True), f"{c}: missing") for c in REQUIRED if c not in have]
    for name, (low, high) in RANGES.items():
        if name not in have:
            continue
        bad = (F.col(name) < F.lit(low)) | F.isnan(name)
        if high is not None:
            bad = bad | (F.col(name) > F.lit(high))
        checks.append((bad, f"{name}: out of range"))
    fields = {*REQUIRED, *FIELD_DEFAULTS, *CONTEXT_DEFAULTS} - set(RANGES)
    checks += [(F.isnan(c), f"{c}: not a number") for c, kind in df.dtypes if c in fields and kind in ("double", "float")]
    for name, values in ALLOWED.items():
        if name in have:
            checks.append((~F.col(name).isin(*values), f"{name}: not allowed"))
    found = F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for bad, reason in checks]))
    if TYPE_ERRORS not in have:
        return found
    # A field of the wrong type is named once: it is not missing, and a broken request has no fields to check.
    typed = F.col(TYPE_ERRORS)
    named = F.transform(typed, lambda e: F.substring_index(e, ":", 1))
    other = F.filter(found, lambda e: ~F.array_contains(named, F.substring_index(e, ":", 1)))
    return F.when(F.array_contains(named, "request"), typed).otherwise(F.concat(typed, other))


def text_schema(schema: T.StructType) -> T.StructType:
    """The fields of `schema` as text, so that a badly typed one arrives as it was sent."""
    return T.StructType([T.StructField(n, T.StringType()) for n in [*schema.fieldNames(), CORRUPT]])


def with_types(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows read by `text_schema` with the types of `schema`, and their type errors.

    A field that does not hold its type becomes NULL with the reason `<field>: not a <type>`; whole numbers may be written
    with a zero fraction. A line that is no JSON object has NULL in all fields and the one reason `request: not JSON`.
    """
    fields, checks = [], [(F.col(CORRUPT).isNotNull(), "request: not JSON")]
    for field in schema.fields:
        given, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            number = given.try_cast("decimal(38,6)")
            value = F.when(number == F.floor(number), number).try_cast(kind)
        else:
            value = given.try_cast(kind)
        fields.append(value.alias(field.name))
        if not isinstance(kind, T.StringType):
            bad = F.col(CORRUPT).isNull() & given.isNotNull() & value.isNull()
            checks.append((bad, f"{field.name}: not a {kind.simpleString()}"))
    errors = F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for bad, reason in checks]))
    return raw.select(*fields, errors.alias(TYPE_ERRORS))


def check_rows(df: DataFrame) -> DataFrame:
    """Add `errors`. Filter on its size for accepted and quarantined rows."""
    return df.withColumn("errors", request_errors(df)).drop(TYPE_ERRORS)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0).drop("errors")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") > 0)


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill optional fields and the neighbourhood context a lone row cannot know."""
    have = set(df.columns)
    defaults = {**FIELD_DEFAULTS, **CONTEXT_DEFAULTS}
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in have else F.lit(value)
            for name, value in defaults.items()
        }
    )
