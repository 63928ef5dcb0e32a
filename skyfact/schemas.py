"""Column names, table schemas and the constraints of the star."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Names of the input columns.
SITE = "AERONET_Site"
RAW_DATE = "Date(dd:mm:yyyy)"
RAW_TIME = "Time(hh:mm:ss)"
WATER = "Precipitable_Water(cm)"
ANGSTROM = "440-870_Angstrom_Exponent"
LAT = "Site_Latitude(Degrees)"
LON = "Site_Longitude(Degrees)"
ELEV = "Site_Elevation(m)"
AOD_PATTERN = r"AOD_\d+nm"
BASE_COLUMNS = [SITE, RAW_DATE, "Date", "Day_of_Year", WATER, ANGSTROM, LAT, LON, ELEV]
TEXT_COLUMNS = [SITE, RAW_DATE, "Date"]
SITE_COLUMNS = [SITE, LAT, LON, ELEV]
SITE_RENAME = {LAT: "Latitude", LON: "Longitude", ELEV: "Elevation"}
FACT_RENAME = {WATER: "Precipitable_Water", ANGSTROM: "Angstrom_Exponent"}

# Weather variables of the daily source and their names in the star.
WEATHER_RENAME = {
    "temperature_2m_mean": "temperature_mean",
    "shortwave_radiation_sum": "radiation_sum",
    "relative_humidity_2m_mean": "humidity_mean",
    "wind_speed_10m_max": "wind_speed_max",
    "wind_direction_10m_dominant": "wind_direction_dominant",
    "et0_fao_evapotranspiration": "evapotranspiration",
    "sunshine_duration": "sunshine_duration_sec",
}
WEATHER_MEASURES = list(WEATHER_RENAME.values())
WEATHER_KEY = ["Date", "Latitude", "Longitude"]
WEATHER_SCHEMA = T.StructType(
    [T.StructField("Date", T.StringType()), T.StructField("Latitude", T.DoubleType())]
    + [T.StructField("Longitude", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in WEATHER_RENAME]
)

_POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
POLYGON_SCHEMA = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("Continent", T.StringType()),
        T.StructField("rings", T.ArrayType(T.ArrayType(_POINT))),
    ]
)

FACT_MEASURES = ["Particle_type", "AOD_Value", "Precipitable_Water", "Angstrom_Exponent"]
FACT_KEYS = ["id_date", "id_wavelength", "id_site"]
FACT_COLUMNS = ["Fact_ID", *FACT_KEYS, *FACT_MEASURES]
LOADED_FACT_COLUMNS = ["Fact_ID", *FACT_KEYS, "id_weather", *FACT_MEASURES, "is_enriched"]
SAMPLE_COLUMNS = [
    "Fact_ID", "Date", SITE, "Country", "Continent", "Latitude", "Longitude",
    "id_wavelength", "Wavelength_nm", "Spectral_Band", *FACT_MEASURES,
]


def aod_columns(names: list[str], pattern: str = AOD_PATTERN) -> list[str]:
    return [c for c in names if re.fullmatch(pattern, c)]


def detect_columns(
    header: list[str], pattern: str = AOD_PATTERN, base: list[str] | None = None
) -> tuple[list[str], list[str]]:
    """(columns to read, AOD columns) of a file header; a header without AOD columns is refused."""
    aod = aod_columns(header, pattern)
    if not aod:
        raise ValueError(f"no column matches {pattern} among {len(header)} columns")
    wanted = BASE_COLUMNS if base is None else base
    return [c for c in wanted if c in header] + aod, aod


def csv_schema(header: list[str], floats: list[str] | None = None) -> T.StructType:
    """A type for every column of the file, in file order: CSV schemas are positional."""
    numbers = set(aod_columns(header)) | (set(BASE_COLUMNS) - set(TEXT_COLUMNS)) | set(floats or [])
    return T.StructType(
        [T.StructField(c, T.FloatType() if c in numbers else T.StringType()) for c in header]
    )


@dataclass(frozen=True)
class TableSpec:
    """Warehouse types and rules of one table."""

    name: str
    ddl: str
    primary_key: str
    unique: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    foreign: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


# Table layout of the warehouse. The keys of sites and weather are bigint, because
# both tables grow with the observations.
WAREHOUSE = {
    t.name: t
    for t in (
        TableSpec(
            "dim_wavelength",
            "id_wavelength int, Wavelength_nm double, Spectral_Band string, Sensitive_Aerosol string",
            "id_wavelength",
            unique=("Wavelength_nm",),
            required=("id_wavelength", "Wavelength_nm"),
            lengths={"Spectral_Band": 10, "Sensitive_Aerosol": 20},
        ),
        TableSpec(
            "dim_date",
            "id_date int, Date date, Year smallint, Month tinyint, Day tinyint, Day_of_Year smallint",
            "id_date",
            unique=("Date",),
            required=("id_date", "Date", "Year", "Month", "Day", "Day_of_Year"),
        ),
        TableSpec(
            "dim_site",
            "id_site bigint, AERONET_Site string, Latitude decimal(9,6), Longitude decimal(9,6), "
            "Elevation double, Country string, Continent string",
            "id_site",
            required=("id_site",),
            lengths={"AERONET_Site": 150, "Country": 120, "Continent": 60},
        ),
        TableSpec(
            "dim_weather",
            "id_weather bigint, " + ", ".join(f"{c} double" for c in WEATHER_MEASURES),
            "id_weather",
            required=("id_weather",),
        ),
        TableSpec(
            "fact_aod",
            "Fact_ID bigint, id_date int, id_wavelength int, id_site bigint, id_weather bigint, "
            "Particle_type string, AOD_Value double, Precipitable_Water double, "
            "Angstrom_Exponent double, is_enriched tinyint",
            "Fact_ID",
            required=("Fact_ID", "id_date", "id_wavelength", "id_site", "AOD_Value", "is_enriched"),
            foreign={
                "id_date": "dim_date",
                "id_wavelength": "dim_wavelength",
                "id_site": "dim_site",
                "id_weather": "dim_weather",
            },
            lengths={"Particle_type": 10},
        ),
    )
}
