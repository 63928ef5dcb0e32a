"""The daily load: read, clean, star, weather, quality gate, publish."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from skyfact.operators.dimensions import site_keys
from skyfact.operators.facts import StarSchema, split_rejects, upgrade_fact
from skyfact.operators.quality import DEFAULT_THRESHOLD, dq_report, require_quality
from skyfact.operators.sampling import sample_geo
from skyfact.operators.weather import weather_missing, weather_requests
from skyfact.plans.star import build_star
from skyfact.session import materialize
from skyfact.sinks.tables import load_warehouse, read_star, stage_path, write_dq_report, write_sample_csv, write_star
from skyfact.sources.observations import clean_observations, preflight, read_observations
from skyfact.sources.polygons import read_country_polygons
from skyfact.sources.weather import latest_weather, read_weather


@dataclass(frozen=True)
class DailyJob:
    """Where the load reads and writes, and how strict it is."""

    observations: str
    staging: str
    reports: str
    polygons: str | None = None
    weather: str | None = None
    threshold: float = DEFAULT_THRESHOLD
    site_key: str = "place"
    dims_from: str = "schema"
    weather_required: bool = False


@dataclass(frozen=True)
class DailyResult:
    """What a run left: ``rejects`` are the stored facts that the warehouse cannot take, ``weather_missing`` the
    stored station days without weather (None where there is no weather at all)."""

    paths: dict[str, str]
    star: StarSchema
    score: float
    rejects: DataFrame
    weather_missing: DataFrame | None = None


class NoWeather(RuntimeError):
    """The weather source has nothing for any of the station days."""


def extract(spark: SparkSession, job: DailyJob) -> DataFrame:
    """Checked, cleaned and staged as Parquet, so that later stages read columns, not text."""
    preflight(spark, job.observations)
    path = stage_path(job.staging, "observations")
    clean_observations(read_observations(spark, job.observations)).write.parquet(path)
    return spark.read.parquet(path)


def find_weather(spark: SparkSession, job: DailyJob) -> DataFrame | None:
    """The named weather table, or the newest staged one; one input for the whole run."""
    path = job.weather or latest_weather(spark, job.staging)
    return read_weather(spark, path) if path else None


def ask_weather(spark: SparkSession, job: DailyJob, wide: DataFrame) -> tuple[DataFrame | None, DataFrame | None, dict[str, str]]:
    """(weather, gap, paths): stages what is asked for, takes one input, and stores what did not come.

    A source that answers none of the requests stops the run, and so does a missing one where it is required.
    """
    paths = {"weather_requests": stage_path(job.staging, "weather_requests")}
    weather_requests(site_keys(wide)).write.parquet(paths["weather_requests"])
    requests = spark.read.parquet(paths["weather_requests"])
    weather = find_weather(spark, job)
    if weather is None:
        if job.weather_required:
            raise NoWeather(f"no weather in {job.weather or job.staging}")
        return None, None, paths
    if weather.isEmpty():
        raise NoWeather("the weather source returned no row")
    paths["weather_missing"] = f"{job.reports.rstrip('/')}/weather_missing"
    weather_missing(requests, weather).write.mode("overwrite").parquet(paths["weather_missing"])
    gap = spark.read.parquet(paths["weather_missing"])
    asked = requests.count()
    if asked and gap.count() == asked:
        raise NoWeather("the weather source has none of the station days")
    return weather, gap, paths


def run_daily(
    spark: SparkSession, job: DailyJob, sink: Callable[[str, DataFrame, bool], None] | None = None
) -> DailyResult:
    """The whole chain.  Nothing is published unless the quality gate is passed."""
    wide = extract(spark, job)
    polygons = read_country_polygons(spark, job.polygons) if job.polygons else None
    weather, gap, asked = ask_weather(spark, job, wide)
    star = build_star(wide, polygons, weather, job.dims_from, job.site_key)
    paths = write_star(star, stage_path(job.staging, "star").removesuffix(".parquet"))
    stored = read_star(spark, paths)
    write_sample_csv(sample_geo(stored), f"{paths['fact_aod'].rsplit('/', 1)[0]}/sample_csv")
    parts = len(stored.fact.inputFiles())
    report = materialize(dq_report(stored, threshold=job.threshold, parts=parts, artifacts=paths), "dq")
    write_dq_report(report, job.reports)
    score = require_quality(report)
    rejects = load_warehouse(stored, sink) if sink else split_rejects(upgrade_fact(stored.fact))[1]
    paths = paths | asked | {"rejects": stage_path(job.staging, "rejects")}
    rejects.write.parquet(paths["rejects"])
    return DailyResult(paths, stored, score, spark.read.parquet(paths["rejects"]), gap)
