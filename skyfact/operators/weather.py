"""Which weather is wanted, which is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.functions import col, coord_key
from skyfact.operators.filters import valid_coords
from skyfact.schemas import WEATHER_KEY


def _keyed(df: DataFrame) -> DataFrame:
    date = F.col("Date")
    if dict(df.dtypes)["Date"] == "string":
        date = F.try_to_date(date, "yyyy-MM-dd")
    return df.select(
        F.date_format(date, "yyyy-MM-dd").alias("Date"),
        coord_key(F.col("Latitude")).alias("_lat"),
        coord_key(F.col("Longitude")).alias("_lon"),
    )


def _require(df: DataFrame) -> None:
    absent = [c for c in WEATHER_KEY if c not in df.columns]
    if absent:
        raise ValueError(f"weather requests need the columns {WEATHER_KEY}; missing: {absent}")


def weather_requests(rows: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Distinct (Date as yyyy-MM-dd, Latitude, Longitude) to ask for, less what is held already."""
    _require(rows)
    wanted = _keyed(valid_coords(rows).filter(col("Date").isNotNull())).distinct()
    if held is not None:
        wanted = wanted.join(_keyed(held).distinct(), ["Date", "_lat", "_lon"], "left_anti")
    return wanted.filter(col("Date").isNotNull()).select(
        "Date", F.col("_lat").cast("double").alias("Latitude"), F.col("_lon").cast("double").alias("Longitude")
    )


def weather_missing(requests: DataFrame, weather: DataFrame) -> DataFrame:
    """Requests without an answer.  No answer at all is an error."""
    _require(requests)
    if weather.isEmpty():
        raise RuntimeError("the weather source returned no row")
    answered = _keyed(weather).distinct()
    left = _keyed(requests).join(answered, ["Date", "_lat", "_lon"], "left_anti")
    return left.select(
        "Date", F.col("_lat").cast("double").alias("Latitude"), F.col("_lon").cast("double").alias("Longitude")
    )
