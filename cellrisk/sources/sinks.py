"""Table sinks: Parquet, CSV and newline-delimited GeoJSON, and the GeoJSON source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite `path`. Name low-cardinality columns only (a cell prefix, a period) to partition by."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def point_geometry(lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.struct(
        F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates")
    )


def polygon_geometry(ring: Column) -> Column:
    positions = F.transform(ring, lambda p: F.array(p["lon"], p["lat"]))
    return F.struct(F.lit("Polygon").alias("type"), F.array(positions).alias("coordinates"))


def geojson_features(df: DataFrame, geometry: Column, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON Feature per row as a text line, in column `value`."""
    return df.select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                geometry.alias("geometry"),
                F.struct(*[F.col(c) for c in properties]).alias("properties"),
            )
        ).alias("value")
    )


def write_geojson(features: DataFrame, path: str) -> None:
    """Newline-delimited features: every task writes its own part, no single collecting writer."""
    features.write.mode("overwrite").text(path)


def read_geojson(spark: SparkSession, path: str, properties: T.StructType, geometry: str = "Polygon") -> DataFrame:
    position = T.ArrayType(T.DoubleType())
    coordinates = {"Point": position, "Polygon": T.ArrayType(T.ArrayType(position))}[geometry]
    shape = T.StructType().add("type", T.StringType()).add("coordinates", coordinates)
    schema = T.StructType().add("type", T.StringType()).add("geometry", shape).add("properties", properties)
    read = spark.read.schema(schema).json(path)
    return read.select(
        F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates").alias("coordinates"),
        "properties.*",
    )

