"""Readers and writers as queries: tables derived from the order tables go through real files and back.

Each query writes to a folder of its own below the scratch folder, with the writer that production uses,
and returns what the reader makes of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.functions.columns import coerce_numeric, column_family
from skyfact.operators.facts import attach_surrogate, build_fact, number_facts, upgrade_fact
from skyfact.operators.quality import dq_report
from skyfact.operators.sampling import sample_geo
from skyfact.operators.sketches import add_days, rank_errors, sketch_quantiles
from skyfact.plans.incremental import append_load, read_warehouse
from skyfact.plans.warehouse import Warehouse
from skyfact.schemas import FACT_COLUMNS, LAT, LOADED_FACT_COLUMNS, LON, RAW_DATE, RAW_TIME, SITE, WATER, WEATHER_RENAME
from skyfact.session import materialize, scratch_dir
from skyfact.sinks.tables import (
    load_warehouse,
    parquet_sink,
    read_star,
    stage_path,
    write_bulk_csv,
    write_dq_report,
    write_sample_csv,
    write_star,
)
from skyfact.sources import views
from skyfact.sources.mart import read_mart_csv
from skyfact.sources.observations import clean_observations, parse_obs_time, preflight, read_columns, read_fact, read_mixed_fact, read_observations
from skyfact.sources.polygons import read_country_polygons
from skyfact.sources.weather import latest_weather, read_weather

# The count of a row decides which of its cells is damaged on the way to the file.
BAD_CELL, NAN_CELL, BAD_DATE, EMPTY_CELL = 3, 4, 5, 6


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text and floats as double, for comparison with other engines."""
    casts = {c: F.date_format(col(c), "yyyy-MM-dd") for c, t in df.dtypes if t == "date"}
    casts |= {c: col(c).cast("double") for c, t in df.dtypes if t == "float"}
    return df.withColumns(casts) if casts else df


def _raw_files(spark: SparkSession, d: str) -> str:
    """CSV files of the raw rows, with text where a number belongs, NaN, impossible dates and empty cells."""
    n, first = col("N[AOD_500nm]"), F.col("AOD_340nm").cast("string")
    raw = views.obs_wide(spark, d).withColumns(
        {
            "AOD_340nm": F.when(n == BAD_CELL, "abc").when(n == NAN_CELL, "NaN").when(n != EMPTY_CELL, first),
            RAW_DATE: F.when(n == BAD_DATE, "32:13:2020").otherwise(col(RAW_DATE)),
        }
    )
    path = _folder(spark, "csv")
    # as many files as the scan has partitions, but several in any case
    several = raw if raw.rdd.getNumPartitions() > 1 else raw.repartition(2)
    several.write.option("header", True).csv(path)
    return path


def csv_ingest(spark: SparkSession, d: str) -> DataFrame:
    path = _raw_files(spark, d)
    preflight(spark, path)
    df = clean_observations(coerce_numeric(read_observations(spark, path), ["AOD_340nm"], "float"))
    names = {SITE: "site", WATER: "water", LAT: "lat", LON: "lon"}
    return _plain(df.withColumnsRenamed(names)).select("site", "Date", "water", "lat", "lon", *views.AOD_COLUMNS)


def csv_times(spark: SparkSession, d: str) -> DataFrame:
    """A column that is read on request only, as text."""
    df = parse_obs_time(read_observations(spark, _raw_files(spark, d), [RAW_TIME]))
    return df.groupBy(col(RAW_TIME).alias("time")).agg(F.count(F.lit(1)).alias("count"))


def star_round_trip(spark: SparkSession, d: str) -> DataFrame:
    target = stage_path(_folder(spark, "star"), "star").removesuffix(".parquet")
    paths = write_star(Warehouse.of(spark, d).star, target, compression="zstd")
    fact, star = read_fact(spark, paths["fact_aod"]), read_star(spark, paths)
    places = read_columns(spark, paths["dim_site"], ["id_site", "Country"])
    rows = attach_surrogate(attach_surrogate(fact, places, "id_site", ["Country"]), star.date, "id_date", ["Month"])
    return _plain(rows.select(*FACT_COLUMNS, "Country", F.col("Month").cast("int").alias("Month")))


def weather_files(spark: SparkSession, d: str) -> DataFrame:
    folder, weather = _folder(spark, "weather"), views.weather_daily(spark, d)
    weather.write.parquet(f"{folder}/weather_daily_1.parquet")
    staged = latest_weather(spark, folder)
    stored = spark.read.parquet(staged)
    stored.write.option("header", True).csv(f"{folder}/w.csv")
    stored.write.json(f"{folder}/w.json")
    out = None
    for kind, path in (("parquet", staged), ("csv", f"{folder}/w.csv"), ("json", f"{folder}/w.json")):
        part = _plain(read_weather(spark, path)).withColumnsRenamed(WEATHER_RENAME).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def geojson_countries(spark: SparkSession, d: str) -> DataFrame:
    """Outlines as GeoJSON, one feature per line, and back: what is left of each."""
    ring = lambda r: F.transform(r, lambda p: F.array(p["lon"], p["lat"]))
    parts = F.transform("rings", lambda r: F.array(ring(r)))
    several = F.struct(F.lit("MultiPolygon").alias("type"), parts.alias("coordinates"))
    single = F.struct(F.lit("Polygon").alias("type"), F.transform("rings", ring).alias("coordinates"))
    base = views.country_polygons(spark, d)
    feature = lambda geometry: F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("Country").alias("ADMIN"), F.col("Continent").alias("CONTINENT")).alias("properties"), geometry.alias("geometry")))
    path = f"{_folder(spark, 'outlines')}.json"
    # every third outline as a multi-polygon: rings are rings either way
    base.select(F.when(F.length("Country") % 3 == 0, feature(several)).otherwise(feature(single)).alias("value")).write.text(path)
    points = F.flatten("rings")
    ends = {f"{f}_{k}": fn(points.getField(k)) for k in ("lon", "lat") for f, fn in (("min", F.array_min), ("max", F.array_max))}
    return read_country_polygons(spark, path).select("Country", "Continent", F.size("rings").alias("rings"), F.size(points).alias("points"), *[c.alias(n) for n, c in ends.items()])


def mart_csv(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "mart-csv")
    Warehouse.of(spark, d).mart.write.option("header", True).option("compression", "gzip").csv(path)
    keep = ["Site", "Date", "Month", "Wavelength_nm", "Country", "Particle_type", "AOD_Value", "temperature_mean", "is_enriched"]
    return _plain(read_mart_csv(spark, path)).select(*keep)


def warehouse_load(spark: SparkSession, d: str) -> DataFrame:
    """Each fact once: as it arrived in the warehouse, or among the rejects, which are a table too."""
    folder = _folder(spark, "db")
    sink = parquet_sink(folder)
    sink("rejects", load_warehouse(Warehouse.of(spark, d).star, sink), False)
    loaded = spark.read.parquet(f"{folder}/fact_aod").withColumn("status", F.lit("loaded"))
    rejects = spark.read.parquet(f"{folder}/rejects").withColumn("status", F.lit("rejected"))
    keep = ["Fact_ID", "id_date", "id_wavelength", "id_site", "id_weather", "AOD_Value", "status"]
    return loaded.select(*keep).unionByName(rejects.select(*keep))


def warehouse_dims(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark, "db")
    load_warehouse(Warehouse.of(spark, d).star, parquet_sink(folder))
    site = spark.read.parquet(f"{folder}/dim_site")
    return site.select("id_site", F.col(SITE).alias("site"), F.col("Latitude").cast("double").alias("Latitude"), F.col("Longitude").cast("double").alias("Longitude"), "Elevation", "Country", "Continent")


def fact_upgraded(spark: SparkSession, d: str) -> DataFrame:
    """A fact as an earlier load left it, without weather columns."""
    old = Warehouse.of(spark, d).star.fact.select(FACT_COLUMNS)
    return upgrade_fact(old).select("Fact_ID", "id_date", "id_site", "id_weather", "AOD_Value", "is_enriched")


def fact_mixed_folder(spark: SparkSession, d: str) -> DataFrame:
    """A folder with parts of an earlier layout and of the present one."""
    path, fact = _folder(spark, "mixed"), Warehouse.of(spark, d).star.fact
    fact.filter("Fact_ID % 2 = 0").select(FACT_COLUMNS).write.parquet(path)
    fact.filter("Fact_ID % 2 = 1").select(LOADED_FACT_COLUMNS).write.mode("append").parquet(path)
    return read_mixed_fact(spark, path).select("Fact_ID", "id_date", "id_site", "id_weather", "AOD_Value", "is_enriched")


# Fixed value: the day on which the second load begins.
SECOND_LOAD = "1995-06-01"


def warehouse_two_loads(spark: SparkSession, d: str) -> DataFrame:
    """The facts of a warehouse that was loaded twice, with days of their own, by what their keys stand for."""
    root, house = _folder(spark, "grown"), Warehouse.of(spark, d)
    outlines = views.country_polygons(spark, d)
    for days in (f"Date < '{SECOND_LOAD}'", f"Date >= '{SECOND_LOAD}' OR Date IS NULL"):
        append_load(spark, root, house.observations.filter(days), outlines, house.weather)
    star = read_warehouse(spark, root)
    rows = star.fact.join(star.date.select("id_date", "Date"), "id_date").join(star.wavelength.select("id_wavelength", "Wavelength_nm"), "id_wavelength")
    rows = rows.join(star.site.select("id_site", col(SITE).alias("site"), "Country"), "id_site")
    return _plain(rows.select("site", "Country", "Date", "Wavelength_nm", "AOD_Value", "is_enriched"))


# The days that the stored sketches are asked for.
SKETCHED_DAYS = ("1994-01-01", "1996-12-31")


def quantiles_by_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Per band: values, least, largest, and whether every tenth is within one percent of its rank, from stored sketches of days."""
    path, obs = _folder(spark, "sketches"), Warehouse.of(spark, d).observations
    first, last = SKETCHED_DAYS
    add_days(spark, path, obs.filter(F.col("Date") < SECOND_LOAD), views.AOD_COLUMNS)
    add_days(spark, path, obs, views.AOD_COLUMNS)
    found = materialize(sketch_quantiles(spark.read.parquet(path), [i / 10 for i in range(11)], first, last), "sketched")
    errors = rank_errors(obs.filter(F.col("Date").between(first, last)), found, views.AOD_COLUMNS)
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("quantile")))
    return errors.groupBy("column", "n").agg(at(0.0).alias("least"), at(1.0).alias("largest"), F.max((F.col("error") > 0.01).cast("int")).alias("off"))


def bulk_csv(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "bulk")
    fact = Warehouse.of(spark, d).star.fact.select(FACT_COLUMNS)
    write_bulk_csv(fact, path, compression="gzip")
    return _plain(spark.read.schema(fact.schema).option("header", True).option("nullValue", "\\N").option("escape", '"').csv(path))


def sample_csv(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "sample")
    write_sample_csv(sample_geo(Warehouse.of(spark, d).star), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("Fact_ID").cast("bigint").alias("Fact_ID"), col(SITE).alias("site"), "Country", F.col("AOD_Value").cast("double").alias("AOD_Value"))


def _report(spark: SparkSession, d: str) -> str:
    path = _folder(spark, "report")
    report = dq_report(Warehouse.of(spark, d).star, threshold=80.0, parts=3, artifacts={"fact_aod": "here"})
    write_dq_report(report, path)
    return path


def dq_record(spark: SparkSession, d: str) -> DataFrame:
    """The stored record: scores, counts, gate, and what it was made from."""
    r = spark.read.json(f"{_report(spark, d)}/report")
    kpi = lambda n: F.round(f"dimensions.{n}.kpi_pct", 6).alias(n)
    return r.select(
        F.round("overall_quality_kpi_pct", 6).alias("overall"), kpi("completeness"), kpi("consistency"), kpi("uniqueness"), kpi("validity"),
        F.col("row_counts.fact").alias("facts"), F.col("row_counts.parts").alias("parts"), F.col("threshold_pct").cast("double").alias("threshold"),
        F.col("artifacts_used.fact_aod").alias("artifact"), "used_weather", "passed", F.col("generated_at_utc").rlike("^[0-9]{8}T[0-9]{6}Z$").alias("stamped"),
    )


def dq_text(spark: SparkSession, d: str) -> DataFrame:
    """The numbers in the first line of the stored text, and the kinds of lines."""
    lines = spark.read.text(f"{_report(spark, d)}/summary")
    return lines.select(F.regexp_extract("value", "^([A-Za-z ]+):", 1).alias("line"), F.regexp_extract("value", ": ([0-9.]+)%", 1).cast("double").alias("pct"))


def count_columns(spark: SparkSession, d: str) -> DataFrame:
    """The columns with counts, without those of single bands that are no counts: how many rows have each value."""
    family = column_family(views.obs_wide(spark, d), "AOD_500nm", exclude="nothing")
    return column_family(family, "[").groupBy(col("N[AOD_500nm]").alias("n")).agg(F.count(F.lit(1)).alias("count"))


def fact_by_name_weather(spark: SparkSession, d: str) -> DataFrame:
    """Sites found by their name alone, and weather by day and position of the site that was found."""
    house = Warehouse.of(spark, d)
    star = house.star
    fact = build_fact(house.observations, star.date, star.wavelength, star.site, star.weather_keys, site_key="name", store=True)
    return number_facts(fact).groupBy("id_site", "is_enriched").agg(F.count(F.lit(1)).alias("facts"), F.count("id_weather").alias("with_weather"), F.countDistinct("id_weather").alias("weather_rows"))


ROUND_TRIPS = {
    "csv_ingest": csv_ingest,
    "csv_times": csv_times,
    "star_round_trip": star_round_trip,
    "weather_files": weather_files,
    "geojson_countries": geojson_countries,
    "mart_csv": mart_csv,
    "warehouse_load": warehouse_load,
    "warehouse_dims": warehouse_dims,
    "fact_upgraded": fact_upgraded,
    "fact_mixed_folder": fact_mixed_folder,
    "warehouse_two_loads": warehouse_two_loads,
    "quantiles_by_sketch": quantiles_by_sketch,
    "bulk_csv": bulk_csv,
    "sample_csv": sample_csv,
    "dq_record": dq_record,
    "dq_text": dq_text,
    "count_columns": count_columns,
    "fact_by_name_weather": fact_by_name_weather,
}
