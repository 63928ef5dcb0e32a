"""Quantiles over any span of days, from sketches that are stored once per day and column.

A sketch (KLL) holds a few hundred weighted values, and merging sketches gives that of all their rows, with the
same bound of the error.  So a question over years reads a row per day and column and none of the observations, and
a new day adds its own rows and changes no others.  ``quantiles`` stays the exact way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col, finite

# Size of a sketch: with 800, ranks are off by less than half a percent, but for one time in a hundred.
SKETCH_K = 800


def day_sketches(df: DataFrame, cols: list[str], date: str = "Date", k: int = SKETCH_K) -> DataFrame:
    """(Date, column, n, sketch) of each day and column with a value; rows without a day are a day of their own, null.

    All columns are sketched in one aggregation by day, with partial sketches before the shuffle.  Nulls, NaN
    and infinities are no values.
    """
    values = df.select(col(date).alias("Date"), *[finite(col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    per_day = values.groupBy("Date").agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(cols))], *[F.kll_sketch_agg_double(f"v{i}", F.lit(k)).alias(f"s{i}") for i in range(len(cols))]
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)]
    return per_day.select("Date", F.inline(F.array(*rows))).filter("n > 0")


def add_days(spark: SparkSession, path: str, df: DataFrame, cols: list[str], date: str = "Date", k: int = SKETCH_K) -> None:
    """Append the sketches of the days that ``path`` does not hold yet; a day that it holds stays as it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    if there:
        held = spark.read.parquet(path).select(F.col("Date").alias("_held")).distinct()
        df = df.join(held, col(date).eqNullSafe(F.col("_held")), "left_anti")
    day_sketches(df, cols, date, k).write.mode("append").parquet(path)


def sketch_quantiles(sketches: DataFrame, probs: list[float], first: str | None = None, last: str | None = None) -> DataFrame:
    """(column, n, prob, quantile) over the days from ``first`` to ``last``, both included; over all rows without bounds.

    A quantile is a value that occurs; 0 and 1 give the least and the largest exactly.
    """
    for bound, within in ((first, F.col("Date") >= F.lit(first)), (last, F.col("Date") <= F.lit(last))):
        if bound is not None:
            sketches = sketches.filter(within)
    merged = sketches.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    cells = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs]
    return merged.select("column", "n", F.inline(F.array(*cells)))


def rank_errors(df: DataFrame, found: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n, prob, quantile) and the rows they are of -> the same with ``error``: how far the share is from where the value stands.

    A value stands from the share of smaller rows up to that of rows not larger; within, the error is 0.
    """
    values = df.select(*[finite(col(c).cast("double")).alias(c) for c in cols]).unpivot([], [col(c) for c in cols], "column", "value")
    # a row per column and probability on the small side
    met = values.filter("value IS NOT NULL").join(F.broadcast(found), "column")
    counts = met.groupBy("column", "n", "prob", "quantile").agg(F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto"))
    error = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - F.col("prob"), F.col("prob") - F.col("upto") / F.col("n"))
    return counts.select("column", "n", "prob", "quantile", error.alias("error"))
