"""Row filters of the analysis page and of the load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.functions import col


def valid_coords(df: DataFrame, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    return df.filter(col(lat).between(-90, 90) & col(lon).between(-180, 180))


def only_enriched(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_enriched") == 1)


def filter_members(df: DataFrame, name: str, values: list | None, include_null: bool = False) -> DataFrame:
    """Keep rows whose value is in ``values``; an empty selection keeps everything."""
    if not values:
        return df
    keep = col(name).isin(list(values))
    return df.filter(keep | col(name).isNull()) if include_null else df.filter(keep)


def member_options(df: DataFrame, name: str) -> DataFrame:
    """The values one can choose from."""
    return df.select(col(name)).filter(col(name).isNotNull()).distinct().orderBy(col(name))


def filter_range(df: DataFrame, name: str, lo: float, hi: float) -> DataFrame:
    return df.filter(col(name).between(lo, hi))


def filter_months(df: DataFrame, lo: int, hi: int, name: str = "Month") -> DataFrame:
    """Months ``lo``..``hi``, clamped to the calendar, in either order."""
    a, b = sorted(min(12, max(1, int(m))) for m in (lo, hi))
    return df.filter(col(name).between(a, b))


def site_rows(df: DataFrame, site: str, name: str = "AERONET_Site") -> DataFrame:
    return df.filter(col(name) == site)


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where every column of ``cols`` is present and not NaN."""
    return df.dropna(subset=[c for c in cols])


def bounds(df: DataFrame, name: str) -> DataFrame:
    """One row: smallest and largest value."""
    return df.agg(F.min(col(name)).alias("lo"), F.max(col(name)).alias("hi"))


@dataclass(frozen=True)
class Filters:
    """The selection of the analysis page.

    ``None`` for continents or particle types stands for the default of the page, all values that
    occur, which leaves out rows without a value; an empty list switches the filter off.  ``None`` for
    the ranges keeps every row that has a value.
    """

    enriched: bool = False
    continents: list[str] | None = None
    particle_types: list[str] | None = None
    aod: tuple[float, float] | None = None
    months: tuple[int, int] | None = None
    include_null: bool = False


def apply_filters(df: DataFrame, f: Filters) -> DataFrame:
    """All filters in one predicate chain, each only where its column exists; parquet sees them."""
    if f.enriched and "is_enriched" in df.columns:
        df = only_enriched(df)
    for name, values in (("Continent", f.continents), ("Particle_type", f.particle_types)):
        if name not in df.columns:
            continue
        if values is None:
            df = df if f.include_null else df.filter(col(name).isNotNull())
        else:
            df = filter_members(df, name, values, f.include_null)
    if "AOD_Value" in df.columns:
        df = filter_range(df, "AOD_Value", *f.aod) if f.aod else df.filter(F.col("AOD_Value").isNotNull())
    if "Month" in df.columns:
        df = filter_months(df, *(f.months or (1, 12)))
    return df


