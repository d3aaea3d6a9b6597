"""Point-of-interest source: JSON documents with an `elements` array, one category per folder or file."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellrisk.sources.schemas import POI_DOCUMENT


def elements_to_pois(documents: DataFrame, poi_type) -> DataFrame:
    """Nodes with both coordinates, one row each; a node without a name gets an empty one."""
    el = F.col("el")
    return (
        documents.select(poi_type.alias("poi_type"), F.explode("elements").alias("el"))
        .filter((el.type == "node") & el.lat.isNotNull() & el.lon.isNotNull())
        .select(
            el.id.alias("osm_id"),
            "poi_type",
            F.coalesce(F.try_element_at(el.tags, F.lit("name")), F.lit("")).alias("name"),
            el.lat.alias("latitude"),
            el.lon.alias("longitude"),
        )
    )


def read_pois(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read a folder partitioned as `poi_type=<category>/`."""
    schema = T.StructType([*POI_DOCUMENT.fields, T.StructField("poi_type", T.StringType())])
    documents = spark.read.schema(schema).json(path, multiLine=multiline)
    return elements_to_pois(documents, F.col("poi_type"))


def read_poi_files(spark: SparkSession, files: Mapping[str, str], multiline: bool = True) -> DataFrame:
    """Read one file (or glob) per category and stack them."""
    parts = [
        elements_to_pois(spark.read.schema(POI_DOCUMENT).json(path, multiLine=multiline), F.lit(kind))
        for kind, path in files.items()
    ]
    return reduce(DataFrame.unionByName, parts)
