"""From cleaned observations to a star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from skyfact.functions import col
from skyfact.operators.dimensions import dim_date, dim_site, dim_wavelength, dim_wavelength_from_data, dim_weather
from skyfact.operators.facts import StarSchema, keyed_observations, keyed_to_fact, number_facts, unenriched
from skyfact.operators.reshape import long_observations
from skyfact.schemas import aod_columns
from skyfact.session import materialize


def measured_rows(wide: DataFrame) -> DataFrame:
    """Wide rows with at least one measured band."""
    return wide.filter(reduce(lambda a, b: a | b, [col(c).isNotNull() for c in aod_columns(wide.columns)]))


def build_star(
    wide: DataFrame,
    polygons: DataFrame | None = None,
    weather: DataFrame | None = None,
    dims_from: str = "schema",
    site_key: str = "place",
    numbered: bool = True,
) -> StarSchema:
    """All tables of the star; dimensions are stored on the way, the fact once it is numbered.

    ``dims_from="schema"`` keeps every wavelength of the source and every day; ``"data"`` only
    those with a measured value.
    """
    if dims_from not in ("schema", "data"):
        raise ValueError("dims_from is 'schema' or 'data'")
    by_data = dims_from == "data"
    if by_data:
        wavelength = materialize(dim_wavelength_from_data(long_observations(wide)), "dim_wavelength")
    else:
        wavelength = dim_wavelength(wide.sparkSession, aod_columns(wide.columns))
    date = materialize(dim_date(measured_rows(wide) if by_data else wide), "dim_date")
    site = materialize(dim_site(wide, polygons), "dim_site")
    measures = keys = None
    if weather is not None:
        measures, keys = dim_weather(weather)
        measures, keys = materialize(measures, "dim_weather"), materialize(keys, "weather_keys")
    keyed = keyed_observations(wide, date, site, keys, site_key)
    if numbered:
        # The range shuffle looks at its input twice, to sample and to sort; let it read this.
        keyed = materialize(keyed, "keyed")
    fact = keyed_to_fact(keyed, wavelength)
    if keys is None:
        fact = unenriched(fact)
    if not numbered:
        return StarSchema(wavelength, date, site, fact, measures, keys)
    return StarSchema(wavelength, date, site, number_facts(fact), measures, keys, keyed)
