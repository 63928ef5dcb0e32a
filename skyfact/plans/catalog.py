"""Every operator as a named query over the stored tables: (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.operators import analysis as A
from skyfact.operators import profile as P
from skyfact.operators.constraints import constraint_violations
from skyfact.operators.dimensions import (
    dim_date,
    dim_site,
    dim_wavelength,
    dim_wavelength_from_data,
    dim_weather,
    site_keys,
    weather_conflicts,
)
from skyfact.operators.facts import StarSchema, build_fact, fk_misses, number_facts, split_rejects, unenriched
from skyfact.operators.filters import Filters, apply_filters, bounds, member_options, only_enriched, site_rows
from skyfact.operators.histogram import histogram
from skyfact.operators.quality import dq_checks, dq_flat, dq_report, source_doy_mismatch
from skyfact.operators.reshape import classify_particles, long_observations, metrics_long, with_labels
from skyfact.operators.sampling import sample_front, sample_geo, sample_rows
from skyfact.operators.spatial import locate_country, multiple_matches
from skyfact.operators.weather import weather_missing, weather_requests
from skyfact.plans.defects import planted
from skyfact.plans.roundtrips import ROUND_TRIPS
from skyfact.plans.warehouse import Warehouse
from skyfact.schemas import ANGSTROM, ELEV, FACT_COLUMNS, LAT, LON, RAW_TIME, SITE, WATER
from skyfact.sources import views
from skyfact.sources.observations import parse_obs_date, parse_obs_time

Query = Callable[[SparkSession, str], DataFrame]

# The page opens with everything chosen.
PAGE = Filters()


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and floats as double, for comparison with other engines."""
    kinds = dict(df.dtypes)
    casts = {c: F.date_format(col(c), "yyyy-MM-dd") for c, t in kinds.items() if t == "date"}
    casts |= {c: col(c).cast("double") for c, t in kinds.items() if t == "float"}
    return df.withColumns(casts) if casts else df


def rounded(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last bits."""
    return df.withColumns({c: F.round(col(c), places) for c in cols})


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return views.obs_wide(spark, d)


def _obs(spark: SparkSession, d: str) -> DataFrame:
    return Warehouse.of(spark, d).observations


def _star(spark: SparkSession, d: str) -> StarSchema:
    return Warehouse.of(spark, d).star


def _mart(spark: SparkSession, d: str) -> DataFrame:
    return Warehouse.of(spark, d).mart


def _page(spark: SparkSession, d: str) -> DataFrame:
    return apply_filters(_mart(spark, d), PAGE)


def _page_enriched(spark: SparkSession, d: str) -> DataFrame:
    return only_enriched(_page(spark, d))


# --- cleaning and profile -------------------------------------------------------------------------


def clean_wide(spark: SparkSession, d: str) -> DataFrame:
    names = {SITE: "site", WATER: "water", ANGSTROM: "angstrom", LAT: "lat", LON: "lon", ELEV: "elev"}
    return plain(_obs(spark, d).withColumnsRenamed(names))


def time_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.value_counts(parse_obs_time(_raw(spark, d)), RAW_TIME).withColumnRenamed(RAW_TIME, "time")


def sentinel_counts(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    return P.sentinel_counts(raw, P.numeric_columns(raw))


def negative_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.negative_counts(_obs(spark, d), views.AOD_COLUMNS)


def describe_columns(spark: SparkSession, d: str) -> DataFrame:
    table = P.describe_columns(_raw(spark, d))
    return rounded(table, ["mean", "std", "min", "q1", "median", "q3", "max"], 4)


def column_info(spark: SparkSession, d: str) -> DataFrame:
    return P.column_info(_raw(spark, d))


def box_stats(spark: SparkSession, d: str) -> DataFrame:
    table = P.box_stats(_obs(spark, d), views.AOD_COLUMNS, window=(-0.01, 0.5))
    return rounded(table, ["q1", "median", "q3", "whisker_low", "whisker_high"])


def hist_angstrom(spark: SparkSession, d: str) -> DataFrame:
    return rounded(histogram(_obs(spark, d), ANGSTROM, 40), ["lower", "upper"])


def hist_water(spark: SparkSession, d: str) -> DataFrame:
    return rounded(histogram(_obs(spark, d), WATER, 40), ["lower", "upper"])


def site_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.value_counts(_raw(spark, d), SITE).withColumnRenamed(SITE, "site")


def quality_level_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.value_counts(_raw(spark, d), "Data_Quality_Level")


def rows_per_year(spark: SparkSession, d: str) -> DataFrame:
    return P.rows_per_year(parse_obs_date(_raw(spark, d)))


def site_coordinates(spark: SparkSession, d: str) -> DataFrame:
    return plain(P.site_coordinates(_raw(spark, d), LAT, LON))


def one_site(spark: SparkSession, d: str) -> DataFrame:
    rows = site_rows(_obs(spark, d), "site_7")
    return plain(rows.select("Date", "Day_of_Year", col(WATER).alias("water"), col(ANGSTROM).alias("angstrom")))


def last_observations(spark: SparkSession, d: str) -> DataFrame:
    rows = _obs(spark, d).select("Date", col(SITE).alias("site"), col("AOD_500nm").alias("aod"), col(WATER).alias("water"))
    return plain(P.last_rows(rows, 5, ["Date", "site", "aod", "water"]))


def source_days(spark: SparkSession, d: str) -> DataFrame:
    return source_doy_mismatch(_obs(spark, d))


# --- star -----------------------------------------------------------------------------------------


def long_aod(spark: SparkSession, d: str) -> DataFrame:
    wide = classify_particles(_obs(spark, d)).withColumnsRenamed({SITE: "site"})
    long = long_observations(wide, ["site", "Date", "Particle_type"])
    return plain(long)


def dim_wavelength_schema(spark: SparkSession, d: str) -> DataFrame:
    """All bands of the source, measured or not, with their measured values."""
    wide = _obs(spark, d)
    counts = long_observations(wide, []).groupBy("Wavelength_nm").agg(F.count("AOD_Value").alias("measured"))
    bands = dim_wavelength(spark, [c for c in wide.columns if c.startswith("AOD_")])
    return bands.join(counts, "Wavelength_nm", "left").withColumn("measured", F.coalesce("measured", F.lit(0)))


def dim_wavelength_data(spark: SparkSession, d: str) -> DataFrame:
    return dim_wavelength_from_data(long_observations(_obs(spark, d), []))


def dim_date_table(spark: SparkSession, d: str) -> DataFrame:
    return plain(dim_date(_obs(spark, d)))


def dim_site_table(spark: SparkSession, d: str) -> DataFrame:
    return dim_site(_obs(spark, d), views.country_polygons(spark, d)).withColumnRenamed(SITE, "site")


def dim_weather_table(spark: SparkSession, d: str) -> DataFrame:
    return dim_weather(Warehouse.of(spark, d).weather)[0]


def weather_key_map(spark: SparkSession, d: str) -> DataFrame:
    return plain(dim_weather(Warehouse.of(spark, d).weather)[1])


def weather_all_rows(spark: SparkSession, d: str) -> DataFrame:
    return dim_weather(Warehouse.of(spark, d).weather, one_row_per_key=False)[0]


def weather_conflict_keys(spark: SparkSession, d: str) -> DataFrame:
    return plain(weather_conflicts(Warehouse.of(spark, d).weather))


def country_overlaps(spark: SparkSession, d: str) -> DataFrame:
    places = site_keys(_obs(spark, d).select(SITE, LAT, LON)).distinct().withColumnRenamed(SITE, "site")
    return multiple_matches(places, views.country_polygons(spark, d))


def country_join(spark: SparkSession, d: str) -> DataFrame:
    places = site_keys(_obs(spark, d).select(SITE, LAT, LON)).select("Latitude", "Longitude").distinct()
    return locate_country(places, views.country_polygons(spark, d))


def country_join_detailed(spark: SparkSession, d: str) -> DataFrame:
    places = site_keys(_obs(spark, d).select(SITE, LAT, LON)).select("Latitude", "Longitude").distinct()
    return locate_country(places, views.detailed_polygons(spark, d))


def fact_star(spark: SparkSession, d: str) -> DataFrame:
    return plain(_star(spark, d).fact.select(FACT_COLUMNS))


def fact_by_site_name(spark: SparkSession, d: str) -> DataFrame:
    wide, star = _obs(spark, d), _star(spark, d)
    fact = build_fact(wide, star.date, star.wavelength, star.site, site_key="name", store=True)
    return plain(number_facts(fact))


def fact_unenriched(spark: SparkSession, d: str) -> DataFrame:
    wide, star = _obs(spark, d), _star(spark, d)
    fact = unenriched(build_fact(wide, star.date, star.wavelength, star.site))
    per = fact.groupBy("id_wavelength", "is_enriched")
    return per.agg(F.count(F.lit(1)).alias("facts"), F.count("id_weather").alias("with_weather"))


def fact_enriched(spark: SparkSession, d: str) -> DataFrame:
    return _star(spark, d).fact.select("Fact_ID", "id_date", "id_wavelength", "id_site", "id_weather", "is_enriched")


def fact_rejects(spark: SparkSession, d: str) -> DataFrame:
    return split_rejects(_star(spark, d).fact)[1].select("Fact_ID", "id_date", "id_wavelength", "id_site", "AOD_Value")


def fk_miss_counts(spark: SparkSession, d: str) -> DataFrame:
    star = planted(_star(spark, d))
    return fk_misses(star.fact, star)


def requests_for_weather(spark: SparkSession, d: str) -> DataFrame:
    return weather_requests(site_keys(_obs(spark, d)))


def requests_left(spark: SparkSession, d: str) -> DataFrame:
    return weather_requests(site_keys(_obs(spark, d)), Warehouse.of(spark, d).weather)


def missing_weather(spark: SparkSession, d: str) -> DataFrame:
    return weather_missing(weather_requests(site_keys(_obs(spark, d))), Warehouse.of(spark, d).weather)


# --- mart and page --------------------------------------------------------------------------------


def dashboard_mart(spark: SparkSession, d: str) -> DataFrame:
    return plain(_mart(spark, d))


def mart_filtered(spark: SparkSession, d: str) -> DataFrame:
    chosen = Filters(True, ["ASIA", "EUROPE"], ["fine", "mixed"], (0.1, 3.0), (9, 4))
    rows = apply_filters(_mart(spark, d), chosen)
    return plain(rows.select("Site", "Date", "Wavelength_nm", "Continent", "Particle_type", "AOD_Value"))


def continent_options(spark: SparkSession, d: str) -> DataFrame:
    return member_options(_mart(spark, d), "Continent")


def aod_bounds(spark: SparkSession, d: str) -> DataFrame:
    return bounds(_mart(spark, d), "AOD_Value")


def count_continent(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(_page(spark, d), "Continent")


def count_continent_all(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(_mart(spark, d), "Continent")


def count_particle(spark: SparkSession, d: str) -> DataFrame:
    return A.count_particle(_page(spark, d))


def trend_day(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.trend_by_day(_page(spark, d)), ["AOD_Value"])


def trend_month(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.trend_by_month(_page_enriched(spark, d)), ["AOD_mean", "temp_mean"])


def map_layers(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.map_layers(_page_enriched(spark, d), list(A.LAYERS)), ["value", "size"], 5)


def map_layers_fixed(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.map_layers(_page_enriched(spark, d), ["AOD"], "fixed"), ["value"])


def month_metrics(spark: SparkSession, d: str) -> DataFrame:
    names = {"AOD_mean": "AOD", "temp_mean": "Temp"}
    table = A.trend_by_month(_page_enriched(spark, d))
    return rounded(with_labels(metrics_long(table, ["Month"], list(names)), names), ["value"])


def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.corr_matrix(_page_enriched(spark, d)), ["r"])


def ols_temperature(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.ols(_page_enriched(spark, d), "temperature_mean", "AOD_Value"), ["slope", "intercept"])


def ols_humidity(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.ols(_page_enriched(spark, d), "humidity_mean", "AOD_Value"), ["slope", "intercept"])


def ols_line(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.ols_line(_page_enriched(spark, d), "temperature_mean", "AOD_Value"), ["x", "y"])


def hist_aod(spark: SparkSession, d: str) -> DataFrame:
    return rounded(histogram(_page(spark, d), "AOD_Value", 30), ["lower", "upper"])


def scatter_temperature(spark: SparkSession, d: str) -> DataFrame:
    return A.scatter(_page_enriched(spark, d), "temperature_mean", "AOD_Value", "Particle_type")


def scatter_matrix(spark: SparkSession, d: str) -> DataFrame:
    return plain(A.scatter_matrix(_page_enriched(spark, d)))


# --- quality and samples --------------------------------------------------------------------------


def dq_checks_table(spark: SparkSession, d: str) -> DataFrame:
    return dq_checks(_star(spark, d))


def dq_score(spark: SparkSession, d: str) -> DataFrame:
    flat = dq_flat(dq_report(_star(spark, d)))
    return rounded(flat, ["overall", "completeness", "consistency", "uniqueness", "validity"])


def dq_defects(spark: SparkSession, d: str) -> DataFrame:
    return dq_checks(planted(_star(spark, d)))


def constraints(spark: SparkSession, d: str) -> DataFrame:
    return constraint_violations(planted(_star(spark, d)))


def sample(spark: SparkSession, d: str) -> DataFrame:
    return plain(sample_geo(_star(spark, d)).withColumnRenamed(SITE, "site"))


def sample_strata(spark: SparkSession, d: str) -> DataFrame:
    return plain(sample_geo(_star(spark, d), n=5, strata="id_wavelength").withColumnRenamed(SITE, "site"))


def sample_half(spark: SparkSession, d: str) -> DataFrame:
    """Half of all facts: the sample is cut off by a bound, and no task orders it."""
    fact = _star(spark, d).fact
    return sample_rows(fact, fact.count() // 2).select("Fact_ID", "id_wavelength", "AOD_Value")


def sample_from_front(spark: SparkSession, d: str) -> DataFrame:
    """A fifth of all facts, band by band: some bands whole, and one in part."""
    fact = _star(spark, d).fact
    return sample_front(fact, fact.count() // 5).select("Fact_ID", "id_wavelength", "AOD_Value")


def scatter_matrix_bins(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.scatter_matrix_bins(_page_enriched(spark, d), bins=20), ["x_low", "y_low"])


def scatter_bins(spark: SparkSession, d: str) -> DataFrame:
    return rounded(A.scatter_bins(_page_enriched(spark, d), "temperature_mean", "AOD_Value", 20), ["x", "y"])


QUERIES: dict[str, Query] = {
    "clean_wide": clean_wide,
    "time_counts": time_counts,
    "sentinel_counts": sentinel_counts,
    "negative_counts": negative_counts,
    "describe_columns": describe_columns,
    "column_info": column_info,
    "box_stats": box_stats,
    "hist_angstrom": hist_angstrom,
    "hist_water": hist_water,
    "site_value_counts": site_value_counts,
    "quality_level_counts": quality_level_counts,
    "rows_per_year": rows_per_year,
    "site_coordinates": site_coordinates,
    "site_rows": one_site,
    "last_rows": last_observations,
    "source_doy_mismatch": source_days,
    "long_aod": long_aod,
    "dim_wavelength_schema": dim_wavelength_schema,
    "dim_wavelength_data": dim_wavelength_data,
    "dim_date": dim_date_table,
    "dim_site": dim_site_table,
    "dim_weather": dim_weather_table,
    "dim_weather_all_rows": weather_all_rows,
    "weather_key_map": weather_key_map,
    "weather_conflicts": weather_conflict_keys,
    "country_overlaps": country_overlaps,
    "country_join": country_join,
    "country_join_detailed": country_join_detailed,
    "fact_star": fact_star,
    "fact_by_site_name": fact_by_site_name,
    "fact_unenriched": fact_unenriched,
    "fact_enriched": fact_enriched,
    "fact_rejects": fact_rejects,
    "fk_misses": fk_miss_counts,
    "weather_requests": requests_for_weather,
    "weather_requests_left": requests_left,
    "weather_missing": missing_weather,
    "dashboard_mart": dashboard_mart,
    "mart_filtered": mart_filtered,
    "continent_options": continent_options,
    "aod_bounds": aod_bounds,
    "count_continent": count_continent,
    "count_continent_all": count_continent_all,
    "count_particle": count_particle,
    "trend_day": trend_day,
    "trend_month": trend_month,
    "map_layers": map_layers,
    "map_layers_fixed": map_layers_fixed,
    "month_metrics": month_metrics,
    "corr_matrix": corr_matrix,
    "ols_temperature": ols_temperature,
    "ols_humidity": ols_humidity,
    "ols_line": ols_line,
    "hist_aod": hist_aod,
    "scatter_temperature": scatter_temperature,
    "scatter_matrix": scatter_matrix,
    "dq_checks": dq_checks_table,
    "dq_report": dq_score,
    "dq_defects": dq_defects,
    "constraint_violations": constraints,
    "sample_geo": sample,
    "sample_strata": sample_strata,
    "sample_half": sample_half,
    "sample_front": sample_from_front,
    "scatter_bins": scatter_bins,
    "scatter_matrix_bins": scatter_matrix_bins,
    **ROUND_TRIPS,
}
