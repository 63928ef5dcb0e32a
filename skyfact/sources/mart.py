"""Flat CSV files for the analysis page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType

from skyfact.functions.columns import coerce_numeric
from skyfact.operators.mart import MART_NUMERIC


def read_mart_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with types inferred from all of its rows, the known measures forced to numbers.

    A measure is read as text and cast after, so that a stray cell costs that cell only.  Any other
    column has a type that all its cells fit; a file with another header is an error.
    """
    reader = lambda: spark.read.option("header", True).option("enforceSchema", False)
    inferred = reader().option("inferSchema", True).csv(path).schema
    for f in inferred:
        if f.name in MART_NUMERIC:
            f.dataType = StringType()
    df = reader().option("mode", "FAILFAST").schema(inferred).csv(path)
    return coerce_numeric(df, MART_NUMERIC, "double")
