"""Daily weather tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.schemas import WEATHER_SCHEMA

# Fixed value: file names of staged weather.
WEATHER_GLOB = "weather_daily_*.parquet"


def read_weather(spark: SparkSession, path: str, file_format: str | None = None) -> DataFrame:
    """(Date, Latitude, Longitude) with the seven daily variables, from Parquet, CSV or JSON."""
    kind = file_format or next((k for k in ("csv", "json") if path.rstrip("/").endswith(f".{k}")), "parquet")
    if kind == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[col(f.name).cast(f.dataType) for f in WEATHER_SCHEMA])
    reader = spark.read.schema(WEATHER_SCHEMA)
    return reader.csv(path, header=True) if kind == "csv" else reader.json(path)


def latest_weather(spark: SparkSession, folder: str, pattern: str = WEATHER_GLOB) -> str | None:
    """Path of the newest staged weather table, a file or a folder of parts; None without any.

    Lists names and times only: the content column of the file source is never read.
    """
    root = folder.rstrip("/")
    spec = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = spec.load(f"{root}/{pattern}").select("path", "modificationTime")
    except Exception as e:  # no file matches the pattern
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    name = F.regexp_extract("path", f"/({pattern.replace('.', '[.]').replace('*', '[^/]*')})(/|$)", 1)
    newest = files.groupBy(name.alias("name")).agg(F.max("modificationTime").alias("at"))
    row = newest.filter("name <> ''").orderBy(F.desc("at"), F.desc("name")).first()
    return f"{root}/{row['name']}" if row else None
