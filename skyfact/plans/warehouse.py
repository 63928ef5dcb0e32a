"""The star and the mart of one source, written once per session and shared by the queries on top."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from skyfact.operators.facts import StarSchema
from skyfact.operators.mart import dashboard_mart
from skyfact.plans.star import build_star
from skyfact.schemas import LOADED_FACT_COLUMNS
from skyfact.session import clear_scratch, materialize
from skyfact.sources import views


SOURCE_TABLES = ("lineitem", "supplier", "nation", "region")


class Warehouse:
    """Lazily stored tables; every property is a scan of what was written."""

    _open: dict[tuple, Warehouse] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        key = (spark.sparkContext.applicationId, sf_dir, cls._stamp(spark, sf_dir))
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    @staticmethod
    def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
        """Names, sizes and times of the input files: other files make another warehouse."""
        context, found = spark.sparkContext, []
        for name in SOURCE_TABLES:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
            files = path.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(path)
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
        return tuple(found)

    @classmethod
    def close(cls, spark: SparkSession) -> None:
        """Forget the stored tables of this application and delete them."""
        for key in [k for k in cls._open if k[0] == spark.sparkContext.applicationId]:
            del cls._open[key]
        clear_scratch(spark)

    @cached_property
    def observations(self) -> DataFrame:
        return materialize(views.observations(self.spark, self.sf_dir), "observations")

    @cached_property
    def weather(self) -> DataFrame:
        return materialize(views.weather_of(self.observations), "weather")

    @cached_property
    def star(self) -> StarSchema:
        """The fact is stored once, as it was numbered; its numbers are put together when it is read."""
        star = build_star(self.observations, views.country_polygons(self.spark, self.sf_dir), self.weather)
        return replace(star, fact=star.fact.select(LOADED_FACT_COLUMNS))

    @cached_property
    def mart(self) -> DataFrame:
        return materialize(dashboard_mart(self.star), "mart")
