"""A warehouse that grows by days: keys that were given stay, new members and facts are numbered on from there.

Each load extends the dimensions by what they lack, attaches keys to its own observations only, and publishes all
tables at once.  The manifest is the ledger of the fact: for each load its first ``Fact_ID`` and its rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.operators.dimensions import SITE_KEY, dim_date, dim_site, dim_wavelength, dim_weather
from skyfact.operators.facts import StarSchema, build_fact, split_rejects, unenriched
from skyfact.operators.numbering import assign_ids
from skyfact.schemas import FACT_MEASURES, LOADED_FACT_COLUMNS, aod_columns
from skyfact.session import materialize
from skyfact.sinks.manifests import current, last_number, publish, read_table, stage

WEATHER_KEY = ["Date", "Latitude", "Longitude"]
FACT_ORDER = ["id_wavelength", "id_date", "id_site", *FACT_MEASURES]


@dataclass(frozen=True)
class Loaded:
    """What a load has published, and the facts it could not take."""

    manifest: dict
    rejects: DataFrame


def extended(held: DataFrame | None, fresh: DataFrame, natural: list[str], key: str) -> DataFrame:
    """``held`` with the members of ``fresh`` that it lacks, numbered on from its highest key."""
    if held is None:
        return fresh
    named = held.select(*[col(c).alias(f"_{c}") for c in natural])
    same = reduce(lambda a, b: a & b, [col(c).eqNullSafe(col(f"_{c}")) for c in natural])
    new = fresh.drop(key).join(named, same, "left_anti")
    top = held.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    numbered = assign_ids(new, natural, "_no", f"new-{key}").withColumn(key, (F.col("_no") + top).cast(held.schema[key].dataType))
    return held.unionByName(numbered.select(*[col(c) for c in held.columns]))


def append_load(spark: SparkSession, root: str, wide: DataFrame, polygons: DataFrame | None = None, weather: DataFrame | None = None) -> Loaded:
    """Add cleaned observations to the warehouse below ``root``; the first load founds it.

    Old rows of all tables keep their keys.  Facts that lack a key or a value are handed back and get no number, so numbers
    are dense over all loads.  Raises ``Superseded``, and publishes nothing, if another load came between.
    """
    number, before = last_number(spark, root) + 1, current(spark, root)
    held = lambda t: read_table(spark, before, t) if before else None
    wavelength = materialize(extended(held("dim_wavelength"), dim_wavelength(spark, aod_columns(wide.columns)), ["Wavelength_nm"], "id_wavelength"), "dim_wavelength")
    date = materialize(extended(held("dim_date"), dim_date(wide), ["Date"], "id_date"), "dim_date")
    site = materialize(extended(held("dim_site"), dim_site(wide, polygons), SITE_KEY, "id_site"), "dim_site")
    keys = measures = None
    if weather is not None or held("dim_weather") is not None:
        rows = held("weather")
        if weather is not None:
            values, places = dim_weather(weather)
            rows = extended(rows, places.join(values, "id_weather"), WEATHER_KEY, "id_weather")
        rows = materialize(rows, "weather")
        keys, measures = rows.select(*WEATHER_KEY, "id_weather"), rows.drop(*WEATHER_KEY)
    fact = build_fact(wide, date, wavelength, site, keys, store=True)
    taken, rejects = split_rejects(fact if keys is not None else unenriched(fact))
    first = sum(r["rows"] for r in before["runs"]) if before else 0
    numbered = assign_ids(taken, FACT_ORDER, "Fact_ID", "fact-new").withColumn("Fact_ID", F.col("Fact_ID") + first)
    part = stage(numbered.select(LOADED_FACT_COLUMNS), root, "fact_aod")
    tables = {"dim_wavelength": [stage(wavelength, root, "dim_wavelength")], "dim_date": [stage(date, root, "dim_date")], "dim_site": [stage(site, root, "dim_site")]}
    if keys is not None:
        tables |= {"dim_weather": [stage(measures, root, "dim_weather")], "weather": [stage(rows, root, "weather")]}
    tables["fact_aod"] = [*(before["tables"]["fact_aod"] if before else []), part]
    run = {"first_id": first + 1, "rows": spark.read.parquet(part).count()}
    return Loaded(publish(spark, root, number, {"tables": tables, "runs": [*(before["runs"] if before else []), run]}), rejects)


def read_warehouse(spark: SparkSession, root: str, version: int | None = None) -> StarSchema:
    """The tables of the last load, or of an earlier version, as a star."""
    found = current(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    get = lambda t: read_table(spark, found, t)
    rows = get("weather")
    keys = rows.select(*WEATHER_KEY, "id_weather") if rows is not None else None
    return StarSchema(get("dim_wavelength"), get("dim_date"), get("dim_site"), get("fact_aod"), get("dim_weather"), keys)
