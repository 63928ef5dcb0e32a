"""Scalar rules of the observation domain as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Band borders (nm), sensitivity borders (nm), Angstrom thresholds, missing marker.
UV_BELOW = 400
VIS_UP_TO = 700
FINE_SENSITIVE_UP_TO = 500
COARSE_SENSITIVE_FROM = 800
FINE_FROM = 1.5
COARSE_UP_TO = 1.0
SENTINEL = -999


def col(name: str) -> Column:
    """Column by its exact name; names here carry brackets, colons and dots."""
    return F.col(f"`{name}`")


def known(c: Column) -> Column:
    """NaN counts as missing, like null."""
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """NaN and both infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def spectral_band(nm: Column) -> Column:
    return F.when(nm < UV_BELOW, "UV").when(nm <= VIS_UP_TO, "VIS").otherwise("NIR")


def sensitive_aerosol(nm: Column) -> Column:
    return (
        F.when(nm <= FINE_SENSITIVE_UP_TO, "fine-sensitive")
        .when(nm >= COARSE_SENSITIVE_FROM, "coarse-sensitive")
        .otherwise("balanced")
    )


def particle_type(exponent: Column) -> Column:
    """Aerosol class from the Angstrom exponent; a missing exponent has no class."""
    return F.when(
        exponent.isNotNull() & ~F.isnan(exponent),
        F.when(exponent >= FINE_FROM, "fine").when(exponent <= COARSE_UP_TO, "coarse").otherwise("mixed"),
    )


def wavelength_nm(band: Column) -> Column:
    """``AOD_500nm`` -> 500.0; anything else is null."""
    return F.regexp_extract(band, r"AOD_(\d+)nm", 1).try_cast("double")


def clip_lower(c: Column, floor: float = 0.0) -> Column:
    """Lift values below ``floor`` to it; null stays null."""
    return F.when(c < floor, F.lit(floor)).otherwise(c)


def coord_key(c: Column) -> Column:
    """A coordinate rounded to six places, in a type that is safe to join on."""
    return F.round(c.cast("double"), 6).try_cast("decimal(9,6)")


def is_enriched(id_weather: Column) -> Column:
    return id_weather.isNotNull().cast("int")


def sentinel_to_null(df: DataFrame, cols: list[str], marker: float = SENTINEL) -> DataFrame:
    """The missing marker, and NaN, become null in the named numeric columns."""
    return df.withColumns({c: F.expr(f"CASE WHEN `{c}` <> {marker} AND NOT isnan(`{c}`) THEN `{c}` END") for c in cols})


def coerce_numeric(df: DataFrame, cols: list[str], to: str = "float") -> DataFrame:
    """Cast the named columns that exist; what is not a number becomes null."""
    return df.withColumns({c: col(c).try_cast(to) for c in cols if c in df.columns})


def calendar_parts(df: DataFrame, date: str = "Date") -> DataFrame:
    d = col(date)
    return df.withColumns(
        {"Year": F.year(d), "Month": F.month(d), "Day": F.dayofmonth(d), "Day_of_Year": F.dayofyear(d)}
    )


def round_coords(df: DataFrame, places: int = 6) -> DataFrame:
    return df.withColumns(
        {c: F.round(F.col(c).cast("double"), places) for c in ("Latitude", "Longitude") if c in df.columns}
    )


def fix_swapped_coords(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """Exchange the pair where the latitude is impossible but the longitude would be one."""
    y, x = col(lat), col(lon)
    swapped = (F.abs(y) > 90) & (F.abs(x) <= 90)
    return df.withColumns({lat: F.when(swapped, x).otherwise(y), lon: F.when(swapped, y).otherwise(x)})


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns that exist, pass over the others."""
    return df.withColumnsRenamed(mapping)


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select([col(c) for c in wanted if c in df.columns])


def column_family(df: DataFrame, like: str, exclude: str | None = None) -> DataFrame:
    """Columns whose name holds ``like`` and does not hold ``exclude``."""
    return df.select([col(c) for c in df.columns if like in c and not (exclude and exclude in c)])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Clean every floating-point column before a load."""
    fields = [f.name for f in df.schema if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: finite(col(c)) for c in fields})
