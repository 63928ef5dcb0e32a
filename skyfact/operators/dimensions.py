"""Dimension tables with reproducible keys."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col, known, sensitive_aerosol, spectral_band
from skyfact.functions.columns import calendar_parts, fix_swapped_coords, rename, round_coords, select_present
from skyfact.operators.filters import valid_coords
from skyfact.operators.numbering import assign_ids, number_small
from skyfact.operators.spatial import locate_country
from skyfact.schemas import SITE, SITE_COLUMNS, SITE_RENAME, WEATHER_KEY, WEATHER_MEASURES, WEATHER_RENAME

SITE_KEY = [SITE, "Latitude", "Longitude", "Elevation"]


def dim_wavelength(spark: SparkSession, aod_cols: list[str]) -> DataFrame:
    """One row per AOD column of the source, measured or not; bounded by the width of the source."""
    waves = sorted(float(c[len("AOD_") : -len("nm")]) for c in aod_cols)
    rows = [F.struct(F.lit(i).alias("id_wavelength"), F.lit(w).alias("Wavelength_nm")) for i, w in enumerate(waves, 1)]
    frame = spark.range(1).select(F.inline(F.array(*rows)))
    nm = F.col("Wavelength_nm")
    return frame.withColumns({"Spectral_Band": spectral_band(nm), "Sensitive_Aerosol": sensitive_aerosol(nm)})


def dim_wavelength_from_data(long: DataFrame) -> DataFrame:
    """Only the wavelengths that have a measured value."""
    rows = long.select("Wavelength_nm", "Spectral_Band", "Sensitive_Aerosol").distinct()
    return number_small(rows, ["Wavelength_nm"], "id_wavelength")


def dim_date(df: DataFrame, date: str = "Date") -> DataFrame:
    """One row per day; rows without a date have no day."""
    days = df.select(col(date).alias("Date")).filter(F.col("Date").isNotNull()).distinct()
    return calendar_parts(number_small(days, ["Date"], "id_date"))


def site_keys(df: DataFrame) -> DataFrame:
    """Name the site columns as in the star and put swapped coordinates right; no row is dropped."""
    named = rename(df, SITE_RENAME)
    return fix_swapped_coords(
        named.withColumns({c: F.col(c).cast("double") for c in SITE_RENAME.values() if c in named.columns})
    )


def dim_site(df: DataFrame, polygons: DataFrame | None = None) -> DataFrame:
    """Distinct places, numbered by name and position, with country and continent.

    A station that moved has one row per place.
    """
    raw = select_present(df, SITE_COLUMNS).distinct()
    places = valid_coords(site_keys(raw)).distinct()
    order = [c for c in SITE_KEY if c in places.columns]
    sites = assign_ids(places, order, "id_site")
    if polygons is None:
        return sites.withColumns({"Country": F.lit(None).cast("string"), "Continent": F.lit(None).cast("string")})
    return locate_country(sites, polygons)


def normalise_weather(weather: DataFrame) -> DataFrame:
    """Star names, real dates, rounded coordinates, NaN as null."""
    df = rename(weather, WEATHER_RENAME)
    if dict(df.dtypes)["Date"] == "string":
        df = df.withColumn("Date", F.try_to_date(F.col("Date"), "yyyy-MM-dd"))
    df = round_coords(df)
    return df.select(*WEATHER_KEY, *[known(F.col(c).cast("double")).alias(c) for c in WEATHER_MEASURES])


def weather_conflicts(weather: DataFrame) -> DataFrame:
    """Keys that come with several different value rows, and how many."""
    rows = normalise_weather(weather).distinct()
    return rows.groupBy(*WEATHER_KEY).agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")


def dim_weather(weather: DataFrame, one_row_per_key: bool = True) -> tuple[DataFrame, DataFrame]:
    """(measures by ``id_weather``, key map (Date, Latitude, Longitude) -> ``id_weather``).

    With ``one_row_per_key`` a key that has several value rows keeps the lowest, so that the join
    cannot multiply facts; without it every different row gets a number.
    """
    rows = normalise_weather(weather)
    if one_row_per_key:
        lowest = F.min(F.struct(*WEATHER_MEASURES)).alias("m")
        rows = rows.groupBy(*WEATHER_KEY).agg(lowest).select(*WEATHER_KEY, "m.*")
        order = WEATHER_KEY
    else:
        rows, order = rows.distinct(), WEATHER_KEY + WEATHER_MEASURES
    numbered = assign_ids(rows, order, "id_weather")
    return numbered.select("id_weather", *WEATHER_MEASURES), numbered.select(*WEATHER_KEY, "id_weather")


