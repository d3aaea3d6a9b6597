"""Tower file source: headerless CSV, plain or gzip, to the clean tower table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellrisk.functions.numeric import lookup, nan_to_null
from cellrisk.sources.schemas import TOWER_RAW

# Mobile country codes, bounding box, radio generations, published column names.
COUNTRY_MCC = {
    "ID": [510],
    "SG": [525],
    "MY": [502],
    "AU": [505],
    "US": [310, 311, 312],
    "GB": [234, 235],
}
INDONESIA_BOUNDS = {"lat_min": -11.0, "lat_max": 6.0, "lon_min": 95.0, "lon_max": 141.0}
#: Boxes that apply unless others are given; a country without one is filtered by its network codes alone.
COUNTRY_BOUNDS = {"ID": INDONESIA_BOUNDS}
RADIO_GENERATION = {"GSM": "2G", "UMTS": "3G", "LTE": "4G", "NR": "5G"}
TOWER_RENAMES = {
    "net": "mnc",
    "area": "lac",
    "cell": "cell_id",
    "lon": "longitude",
    "lat": "latitude",
    "range": "range_m",
    "averageSignal": "avg_signal",
}


def read_tower_csv(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Read `.csv` or `.csv.gz`. A gzip file cannot be split: `partitions` spreads it after reading."""
    raw = spark.read.schema(TOWER_RAW).csv(path, header=False, mode="PERMISSIVE")
    return raw.repartition(partitions) if partitions else raw


def filter_country(df: DataFrame, country: str, mcc: str = "mcc") -> DataFrame:
    """Keep the country's network codes; a country without codes filters nothing."""
    codes = COUNTRY_MCC.get(country, [])
    return df.filter(F.col(mcc).isin(*codes)) if codes else df


def filter_bbox(
    df: DataFrame, bounds: Mapping[str, float], lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Inclusive on all four sides; rows without coordinates fall out."""
    return df.filter(
        F.col(lat).between(bounds["lat_min"], bounds["lat_max"])
        & F.col(lon).between(bounds["lon_min"], bounds["lon_max"])
    )


def clean_towers(raw: DataFrame) -> DataFrame:
    """Rename, drop impossible coordinates, turn epochs into timestamps, add the generation."""
    renamed = raw.withColumnsRenamed(TOWER_RENAMES).withColumns(
        {"latitude": nan_to_null("latitude"), "longitude": nan_to_null("longitude")}
    )
    valid = renamed.dropna(subset=["latitude", "longitude"]).filter(
        F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    )
    return valid.withColumns(
        {
            "created": F.timestamp_seconds(F.col("created").try_cast("bigint")),
            "updated": F.timestamp_seconds(F.col("updated").try_cast("bigint")),
            "generation": lookup("radio", RADIO_GENERATION, "Unknown"),
        }
    )


def ingest_towers(
    spark: SparkSession,
    path: str | Sequence[str],
    country: str = "ID",
    bounds: Mapping[str, float] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    raw = read_tower_csv(spark, path, partitions)
    box = COUNTRY_BOUNDS.get(country) if bounds is None else bounds
    kept = filter_country(raw, country)
    return clean_towers(filter_bbox(kept, box, "lat", "lon") if box else kept)
