"""Exploratory profile of the observation table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyfact.functions import col, known
from skyfact.functions.columns import SENTINEL
from skyfact.operators.quantiles import quantiles_wide


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def column_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) with all values as double."""
    return df.select(*[col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], [col(c) for c in cols], "column", "value"
    )


def per_column(df: DataFrame, cols: list[str], fields: dict[str, str]) -> DataFrame:
    """One row per column from a single aggregation; ``{c}`` in an aggregate stands for the column."""
    rows = []
    for c in cols:
        cells = ", ".join(f"'{name}', {agg.format(c=f'`{c}`')}" for name, agg in fields.items())
        rows.append(f"named_struct('column', '{c}', {cells})")
    return df.agg(F.expr(f"array({', '.join(rows)})").alias("rows")).select(F.inline("rows"))


def _count_where(df: DataFrame, cols: list[str], test: str) -> DataFrame:
    counts = per_column(df, cols, {"count": f"count_if({test})"})
    return counts.filter(F.col("count") > 0).orderBy(F.desc("count"), "column")


def sentinel_counts(df: DataFrame, cols: list[str], marker: float = SENTINEL) -> DataFrame:
    """Missing markers per column, most first, columns without any left out."""
    return _count_where(df, cols, f"{{c}} = {marker}")


def negative_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Negative values per column, most first, columns without any left out."""
    return _count_where(df, cols, "{c} < 0")


def column_info(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Non-null count and type of every column."""
    types = dict(df.dtypes)
    names = cols or df.columns
    counts = per_column(df, names, {"non_null": "count({c})"})
    kinds = F.create_map(*[F.lit(x) for c in names for x in (c, types[c])])
    return counts.withColumn("type", kinds[F.col("column")])


def describe_columns(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    names = cols or numeric_columns(df)
    real = df.select(*[known(col(c).cast("double")).alias(c) for c in names])
    moments = per_column(
        real,
        names,
        {
            "count": "count({c})",
            "mean": "avg({c})",
            "std": "stddev_samp({c})",
            "min": "min({c})",
            "max": "max({c})",
        },
    )
    quarts = quantiles_wide(column_values(real, names), [0.25, 0.5, 0.75], ["q1", "median", "q3"], exact)
    return moments.join(quarts, "column", "left").select(
        "column", "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def box_stats(
    df: DataFrame, cols: list[str], exact: bool = True, window: tuple[float, float] | None = None
) -> DataFrame:
    """Box-plot numbers per column: quartiles, whiskers inside 1.5 box lengths, outliers.

    ``window`` adds how many values lie in a zoomed view.
    """
    values = column_values(df, cols)
    boxes = quantiles_wide(values, [0.25, 0.5, 0.75], ["q1", "median", "q3"], exact)
    fenced = boxes.withColumns(
        {"fence_low": F.expr("q1 - 1.5 * (q3 - q1)"), "fence_high": F.expr("q3 + 1.5 * (q3 - q1)")}
    )
    v = F.col("value")
    inside = v.between(F.col("fence_low"), F.col("fence_high"))
    aggs = [
        F.count(F.lit(1)).alias("count"),
        F.least(F.min(F.when(inside, v)), F.first("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, v)), F.first("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    ]
    if window:
        aggs.append(F.count_if(v.between(*window)).alias("in_window"))
    # One row per column on the small side.
    joined = values.filter(v.isNotNull() & ~F.isnan(v)).join(F.broadcast(fenced), "column")
    return joined.groupBy("column", "q1", "median", "q3").agg(*aggs)


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per value, most first; rows without a value are not counted."""
    counts = df.filter(col(name).isNotNull()).groupBy(col(name)).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), col(name))


def rows_per_year(df: DataFrame, date: str = "Date") -> DataFrame:
    year: Column = F.year(col(date)).alias("year")
    rows = df.filter(col(date).isNotNull()).groupBy(year).agg(F.count(F.lit(1)).alias("count"))
    return rows.orderBy("year")


def site_coordinates(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Distinct positions and how many rows lie on each."""
    place = [col(lat).alias("Latitude"), col(lon).alias("Longitude")]
    return df.groupBy(*place).agg(F.count(F.lit(1)).alias("count"))


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def last_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The ``n`` last rows in ``order``, in that order."""
    last = df.orderBy(*[col(c).desc() for c in order]).limit(n)
    return last.orderBy(*[col(c) for c in order])
