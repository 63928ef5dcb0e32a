"""Daily sun-photometer observations as Spark DataFrames: star schema, weather, quality, analysis."""

from skyfact.session import materialize, scratch_dir, spark_session

__all__ = ["materialize", "scratch_dir", "spark_session"]
