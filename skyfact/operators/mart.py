"""The flat table behind the analysis page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.functions import is_enriched
from skyfact.operators.facts import StarSchema, attach_surrogate, band_numbers
from skyfact.operators.reshape import long_observations
from skyfact.schemas import SITE, WEATHER_MEASURES

MART_COLUMNS = [
    "Site", "Latitude", "Longitude", "Country", "Continent", "Date", "Year", "Month", "Day_of_Year",
    "Wavelength_nm", "Spectral_Band", "Particle_type", "AOD_Value", "Precipitable_Water",
    "Angstrom_Exponent", "is_enriched", *WEATHER_MEASURES,
]

# Columns of the analysis page that must be numbers.
MART_NUMERIC = [
    "Longitude", "Latitude", "AOD_Value", "Day_of_Year", "Month", "temperature_mean", "radiation_sum",
    "humidity_mean", "wind_speed_max", "evapotranspiration", "sunshine_duration_sec", "Angstrom_Exponent",
]


def dashboard_mart(star: StarSchema) -> DataFrame:
    """Every fact with the attributes of its day, wavelength, place and weather.

    Where the keyed observations of the fact are at hand, they are looked up, once each, and unpivoted after.
    """
    df = star.fact if star.keyed is None else star.keyed
    # Weather first: it is the large look-up, and rows are shuffled for it while they are narrow.
    if star.weather is None:
        df = df.withColumns({c: F.lit(None).cast("double") for c in WEATHER_MEASURES}).withColumn("is_enriched", F.lit(0))
    else:
        df = attach_surrogate(df, star.weather, "id_weather", WEATHER_MEASURES)
        df = df.withColumn("is_enriched", is_enriched(F.col("id_weather")))
    df = attach_surrogate(df, star.date, "id_date", ["Date", "Year", "Month", "Day_of_Year"])
    places = [SITE, "Latitude", "Longitude", "Country", "Continent"]
    df = attach_surrogate(df, star.site, "id_site", places).withColumnRenamed(SITE, "Site")
    if star.keyed is not None:
        df = long_observations(df, numbers=band_numbers(star.wavelength))
    return attach_surrogate(df, star.wavelength, "id_wavelength", ["Wavelength_nm", "Spectral_Band"]).select(MART_COLUMNS)
