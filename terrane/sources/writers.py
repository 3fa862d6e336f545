"""Sinks: one folder of Parquet for each table of a set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tables(tables: dict[str, DataFrame], path: str, partition_by: dict[str, list[str]] | None = None) -> None:
    for name, df in tables.items():
        out = df.write.mode("overwrite")
        keys = (partition_by or {}).get(name)
        (out.partitionBy(*keys) if keys else out).parquet(f"{path}/{name}")


#: The tables of the two sets.
ADDRESS_TABLES = ("region", "region_name", "city", "city_name", "street", "street_in_city", "house", "house_removed", "postcode")
POI_TABLES = ("folder_root", "folder_sub", "tag_key", "tag_value", "point", "poi_folder", "poi_tag")


def write_address(tables: dict[str, DataFrame], path: str) -> None:
    write_tables({t: tables[t] for t in ADDRESS_TABLES if t in tables}, path)


def write_poi(tables: dict[str, DataFrame], path: str) -> None:
    write_tables({t: tables[t] for t in POI_TABLES if t in tables}, path)


def dataset_metadata(spark: SparkSession, region_id: str, country: str, description: str, languages: list[str], date: str, version: int, area: str) -> DataFrame:
    """``name, value`` rows that describe a data set."""
    rows = {"area": area, "country": country, "description": description, "language": ",".join(languages), "osm_date": date, "region_id": region_id, "version": str(version)}
    from terrane.functions.tags import version_ms

    out = spark.createDataFrame(list(rows.items()), "name string, value string")
    return out.withColumn("value", F.when(F.col("name") == "osm_date", version_ms(F.col("value")).cast("string")).otherwise(F.col("value")))
