"""Wide observation files and the cleaning that follows the scan."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.functions.columns import sentinel_to_null
from skyfact.operators.facts import upgrade_fact
from skyfact.schemas import RAW_DATE, RAW_TIME, TEXT_COLUMNS, csv_schema, detect_columns


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the CSV file(s); only the first line is looked at."""
    return spark.read.option("header", True).csv(path).columns


def read_observations(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The known columns of a wide CSV with explicit types; a cell that does not parse is null.

    ``columns`` names others to read as well, e.g. counts or quality levels, as text.  All files
    must have the same header: one with other columns, or in another order, is an error.
    """
    header = read_header(spark, path)
    wanted, _ = detect_columns(header)
    extra = [c for c in (columns or []) if c in header and c not in wanted]
    reader = spark.read.schema(csv_schema(header)).option("header", True).option("mode", "PERMISSIVE")
    return reader.option("enforceSchema", False).csv(path).select(*[col(c) for c in wanted + extra])


def parse_obs_date(df: DataFrame) -> DataFrame:
    """``Date`` from day:month:year text, or from ISO text; what is no date becomes null."""
    if RAW_DATE in df.columns:
        return df.withColumn("Date", F.try_to_date(col(RAW_DATE), "d:M:yyyy")).drop(RAW_DATE)
    if dict(df.dtypes).get("Date") == "string":
        return df.withColumn("Date", F.try_to_date(F.col("Date"), "yyyy-MM-dd"))
    return df


def parse_obs_time(df: DataFrame, name: str = RAW_TIME) -> DataFrame:
    """Time of day as checked HH:mm:ss text; what is no time becomes null."""
    parsed = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), col(name)), F.lit("yyyy-MM-dd H:m:s"))
    return df.withColumn(name, F.date_format(parsed, "HH:mm:ss"))


def clean_observations(df: DataFrame) -> DataFrame:
    """Markers and NaN to null in the numeric columns, text to date."""
    numbers = [n for n, t in df.dtypes if t in ("float", "double") and n not in TEXT_COLUMNS]
    return parse_obs_date(sentinel_to_null(df, numbers))


def preflight(spark: SparkSession, path: str, rows: int = 5) -> None:
    """Fail early, with the path in the message, if the source is missing or cannot be read."""
    try:
        found = read_observations(spark, path).limit(rows).count()
    except AnalysisException as e:
        raise FileNotFoundError(f"cannot read observations at {path}: {e.getCondition()}") from e
    except ValueError as e:
        raise ValueError(f"no observations at {path}: {e}") from e
    if not found:
        raise ValueError(f"no observations at {path}: the source is empty")


def read_columns(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """Some columns of a stored table; the scan reads no others."""
    return spark.read.parquet(path).select(*[col(c) for c in cols])


def read_fact(spark: SparkSession, fact_dir: str) -> DataFrame:
    """The stored fact, all parts; nothing there is an error."""
    try:
        fact = spark.read.parquet(fact_dir)
    except AnalysisException as e:
        raise FileNotFoundError(f"no fact parts in {fact_dir}") from e
    if fact.isEmpty():
        raise FileNotFoundError(f"no fact rows in {fact_dir}")
    return fact


def read_mixed_fact(spark: SparkSession, path: str) -> DataFrame:
    """A fact whose parts were written in different layouts: columns of all parts, with the defaults of the
    present layout where a part lacks them."""
    return upgrade_fact(spark.read.option("mergeSchema", True).parquet(path))
