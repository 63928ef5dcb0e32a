"""Facts: foreign keys, weather keys, numbering."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.functions import col, coord_key, is_enriched
from skyfact.functions.columns import rename
from skyfact.operators.dimensions import SITE_KEY, site_keys
from skyfact.operators.joins import lookup_join, surrogate_join
from skyfact.operators.numbering import assign_ids
from skyfact.operators.reshape import classify_particles, long_observations
from skyfact.schemas import FACT_KEYS, FACT_MEASURES, FACT_RENAME, LOADED_FACT_COLUMNS, SITE, aod_columns
from skyfact.session import materialize


@dataclass(frozen=True)
class StarSchema:
    """The tables of the star; dimensions are stored tables, the fact may be a plan."""

    wavelength: DataFrame
    date: DataFrame
    site: DataFrame
    fact: DataFrame
    weather: DataFrame | None = None
    weather_keys: DataFrame | None = None
    # The stored rows that the fact is unpivoted from, one per observation; None once the fact is another.
    keyed: DataFrame | None = None

    def with_fact(self, fact: DataFrame) -> StarSchema:
        return replace(self, fact=fact, keyed=None)

    def tables(self) -> dict[str, DataFrame]:
        named = {
            "dim_wavelength": self.wavelength,
            "dim_date": self.date,
            "dim_site": self.site,
            "dim_weather": self.weather,
            "fact_aod": self.fact,
        }
        return {k: v for k, v in named.items() if v is not None}


def attach_natural(df: DataFrame, dim: DataFrame, on: list[str], key: str, null_safe: bool = False) -> DataFrame:
    """Add the surrogate ``key`` of a stored dimension by natural key; no match gives null."""
    return lookup_join(df, dim.select(key, *[col(c) for c in on]), on, "left", null_safe)


def attach_surrogate(fact: DataFrame, dim: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Add columns of a stored dimension by surrogate key; no match gives nulls."""
    return surrogate_join(fact, dim.select(key, *[col(c) for c in cols]), key)


def attach_keys(wide: DataFrame, date: DataFrame, site: DataFrame, site_key: str = "place") -> DataFrame:
    """Add ``id_date`` and ``id_site`` to wide rows, before they multiply by the number of bands.

    ``site_key="place"`` compares name and position; ``"name"`` compares the name only, which
    repeats the observations of a station once per place it stood at.
    """
    df = attach_natural(wide, date, ["Date"], "id_date")
    if site_key == "name":
        return attach_natural(df, site, [SITE], "id_site")
    df = site_keys(df)
    return attach_natural(df, site, [c for c in SITE_KEY if c in df.columns], "id_site", null_safe=True)


def keyed_observations(
    wide: DataFrame,
    date: DataFrame,
    site: DataFrame,
    weather_keys: DataFrame | None = None,
    site_key: str = "place",
) -> DataFrame:
    """Wide rows reduced to their keys, the particle class and the measures.

    All look-ups, weather too if its keys are given, happen here, once per observation and not once
    per wavelength.
    """
    keyed = attach_keys(classify_particles(wide), date, site, site_key)
    if weather_keys is not None and site_key == "place":
        keyed = enrich_in_place(keyed, weather_keys)
    elif weather_keys is not None:
        keyed = enrich_weather(keyed, date, site, weather_keys)
    keyed = rename(keyed, FACT_RENAME)
    extra = [c for c in ("Precipitable_Water", "Angstrom_Exponent") if c not in keyed.columns]
    keyed = keyed.withColumns({c: F.lit(None).cast("float") for c in extra})
    weather = [c for c in ("id_weather", "is_enriched") if c in keyed.columns]
    return keyed.select(
        "id_date", "id_site", *weather, "Particle_type", "Precipitable_Water", "Angstrom_Exponent",
        *[col(c) for c in aod_columns(keyed.columns)],
    )


def band_numbers(wavelength: DataFrame) -> dict[float, int]:
    """``id_wavelength`` by wavelength; one row per column of the source."""
    return {r.Wavelength_nm: r.id_wavelength for r in wavelength.select("id_wavelength", "Wavelength_nm").collect()}


def keyed_to_fact(keyed: DataFrame, wavelength: DataFrame) -> DataFrame:
    """Unpivot keyed observations with ``id_wavelength`` as a constant of each band; no join, no shuffle."""
    weather = [c for c in ("id_weather", "is_enriched") if c in keyed.columns]
    long = long_observations(keyed, numbers=band_numbers(wavelength))
    return long.select(*FACT_KEYS, *weather[:1], *FACT_MEASURES, *weather[1:])


def build_fact(
    wide: DataFrame,
    date: DataFrame,
    wavelength: DataFrame,
    site: DataFrame,
    weather_keys: DataFrame | None = None,
    site_key: str = "place",
    store: bool = False,
) -> DataFrame:
    """Facts without a number yet: one row per measured (observation, wavelength).

    ``store`` writes the keyed rows first, for a reader that looks at the facts twice, as numbering does.
    """
    keyed = keyed_observations(wide, date, site, weather_keys, site_key)
    return keyed_to_fact(materialize(keyed, "keyed") if store else keyed, wavelength)


def number_facts(fact: DataFrame) -> DataFrame:
    """``Fact_ID`` 1..n by wavelength, day, place and value.  The table comes out sorted that way."""
    order = ["id_wavelength", "id_date", "id_site", *FACT_MEASURES]
    return assign_ids(fact, order, "Fact_ID", label="fact", lead=order[0])


def place_keys(site: DataFrame) -> DataFrame:
    """``id_site`` with joinable coordinates."""
    return site.select(
        "id_site", coord_key(F.col("Latitude")).alias("_lat"), coord_key(F.col("Longitude")).alias("_lon")
    )


def weather_key_table(keymap: DataFrame) -> DataFrame:
    """The weather key map with joinable coordinates."""
    return keymap.select(
        F.col("Date").alias("_date"),
        coord_key(F.col("Latitude")).alias("_lat"),
        coord_key(F.col("Longitude")).alias("_lon"),
        "id_weather",
    )


def enrich_weather(df: DataFrame, date: DataFrame, site: DataFrame, keymap: DataFrame) -> DataFrame:
    """Add ``id_weather`` and ``is_enriched`` to any frame that has ``id_date`` and ``id_site``."""
    located = lookup_join(df, date.select("id_date", F.col("Date").alias("_date")), ["id_date"])
    located = lookup_join(located, place_keys(site), ["id_site"])
    joined = lookup_join(located, weather_key_table(keymap), ["_date", "_lat", "_lon"])
    return joined.drop("_date", "_lat", "_lon").withColumn("is_enriched", is_enriched(F.col("id_weather")))


def enrich_in_place(keyed: DataFrame, keymap: DataFrame) -> DataFrame:
    """As ``enrich_weather`` for rows that still carry the day and the position of their keys."""
    placed = keyed.withColumns(
        {
            "_date": F.when(F.col("id_date").isNotNull() & F.col("id_site").isNotNull(), F.col("Date")),
            "_lat": coord_key(F.col("Latitude")),
            "_lon": coord_key(F.col("Longitude")),
        }
    )
    joined = lookup_join(placed, weather_key_table(keymap), ["_date", "_lat", "_lon"])
    return joined.drop("_date", "_lat", "_lon").withColumn("is_enriched", is_enriched(F.col("id_weather")))


def unenriched(fact: DataFrame) -> DataFrame:
    """A fact for which no weather is known."""
    return fact.withColumns({"id_weather": F.lit(None).cast("bigint"), "is_enriched": F.lit(0)})


def upgrade_fact(fact: DataFrame) -> DataFrame:
    """Bring a fact of an earlier layout to the present one."""
    if "id_weather" not in fact.columns:
        fact = fact.withColumn("id_weather", F.lit(None).cast("bigint"))
    if "is_enriched" not in fact.columns:
        fact = fact.withColumn("is_enriched", F.lit(0))
    else:
        fact = fact.withColumn("is_enriched", F.coalesce("is_enriched", F.lit(0)))
    return fact.select(LOADED_FACT_COLUMNS)


def split_rejects(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts the warehouse takes, facts it cannot take because a required key or value is missing)."""
    bad = F.lit(False)
    for c in [*FACT_KEYS, "AOD_Value"]:
        bad = bad | col(c).isNull()
    return fact.filter(~bad), fact.filter(bad)


def fk_misses(fact: DataFrame, star: StarSchema) -> DataFrame:
    """Facts per foreign key that find no dimension row.  Counts per key first, then the look-up."""
    parts = []
    for name, key, dim in (
        ("date", "id_date", star.date),
        ("wavelength", "id_wavelength", star.wavelength),
        ("site", "id_site", star.site),
    ):
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        missing = counts.join(dim.select(key), key, "left_anti")
        parts.append(missing.agg(F.lit(name).alias("dimension"), F.coalesce(F.sum("n"), F.lit(0)).alias("misses")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


