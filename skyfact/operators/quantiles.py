"""Exact quantiles of several columns, without gathering a column in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfact.session import materialize

ACCURACY = 2_000
# The sketch is off by at most 1 / ACCURACY of the rows; brackets reach four times as far.
SLACK = 4.0 / ACCURACY
# So few rows are counted value by value, without enclosures: there the slack is hardly a rank.
FEW_ROWS = 10 * ACCURACY


def _brackets(values: DataFrame, probs: list[float]) -> DataFrame:
    """Per column: the number of rows, and for each probability two values that enclose its rank."""
    low = [max(0.0, p - SLACK) for p in probs]
    high = [min(1.0, p + SLACK) for p in probs]
    ends = values.groupBy("column").agg(
        F.count("value").alias("rows"),
        F.min("value").alias("vmin"),
        F.max("value").alias("vmax"),
        F.percentile_approx("value", low + high, ACCURACY).alias("q"),
    )
    few = F.col("rows") <= FEW_ROWS
    los = [F.when(few | F.lit(p == 0.0), F.col("vmin")).otherwise(F.col("q")[i]) for i, p in enumerate(low)]
    his = [
        F.when(few | F.lit(p == 1.0), F.col("vmax")).otherwise(F.col("q")[i + len(probs)]) for i, p in enumerate(high)
    ]
    return ends.select(
        "column",
        "rows",
        *[c.alias(f"lo{i}") for i, c in enumerate(los)],
        *[c.alias(f"hi{i}") for i, c in enumerate(his)],
    )


def quantiles(values: DataFrame, probs: list[float]) -> DataFrame:
    """(column, prob, quantile) of a frame (column, value), by linear interpolation between ranks.

    A sketch encloses each wanted rank.  One aggregation then counts the rows outside of the
    enclosures stretch by stretch and those inside value by value, so equal values shrink before
    the shuffle.  The remainder, still in proportion to the rows, is range-sorted and stored; counts per
    range, and running counts inside each, find the two neighbours exactly.  A rank that its enclosure
    does not hold, which a sketch within its bounds cannot cause, raises.
    """
    present = values.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # One row per column.
    inside = present.join(F.broadcast(_brackets(present, probs)), "column")
    begun = " + ".join(f"INT(value >= lo{i})" for i in range(len(probs)))
    ended = " + ".join(f"INT(value > hi{i})" for i in range(len(probs)))
    # The stretch never falls while the value grows, so (stretch, value) sorts as the value does.
    shrunk = (
        inside.selectExpr("column", "rows", "value", f"{begun} AS begun", f"{ended} AS ended")
        .selectExpr("column", "rows", "begun + ended AS stretch", "CASE WHEN begun > ended THEN value END AS v")
        .groupBy("column", "rows", "stretch", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Ranges of (column, stretch, value) with about as many values each; equal values are one row.
    order = [F.col("column"), F.col("stretch"), F.col("v").asc_nulls_first()]
    ranged = shrunk.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    stored = materialize(ranged, "quantiles")
    sums = stored.groupBy("column", "part").agg(F.sum("n").alias("sum"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per column and range.
    offsets = sums.select("column", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    running = Window.partitionBy("column", "part").orderBy("stretch", F.col("v").asc_nulls_first())
    upto = F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = stored.withColumn("within", upto).join(offsets, ["column", "part"]).withColumn("upto", F.col("offset") + F.col("within"))
    lost = F.raise_error(F.lit("a rank lies outside of the values that enclose it")).cast("double")
    picks = []
    for p in probs:
        at = F.lit(p) * (F.col("rows") - 1)
        for rank in (F.floor(at), F.ceil(at)):
            holds = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
            picks.append(F.max(F.when(holds, F.col("v"))).alias(f"e{len(picks)}"))
    found = ranked.groupBy("column", "rows").agg(*picks)
    found = found.select("column", "rows", *[F.coalesce(f"e{i}", lost).alias(f"e{i}") for i in range(len(picks))])
    cells = []
    for i, p in enumerate(probs):
        a, b, at = F.col(f"e{2 * i}"), F.col(f"e{2 * i + 1}"), F.lit(p) * (F.col("rows") - 1)
        cells.append(F.struct(F.lit(p).alias("prob"), (a + (b - a) * (at - F.floor(at))).alias("quantile")))
    return found.select("column", F.inline(F.array(*cells)))


def quantiles_approx(values: DataFrame, probs: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """As ``quantiles`` in a single pass, with a rank error of 1 / ``accuracy``."""
    present = values.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    sketch = present.groupBy("column").agg(F.percentile_approx("value", probs, accuracy).alias("q"))
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("q").alias("quantile"))
    return sketch.select("column", F.explode(pairs).alias("z")).select("column", "z.*")


def quantiles_wide(values: DataFrame, probs: list[float], names: list[str], exact: bool = True) -> DataFrame:
    """One row per column, one named column per probability."""
    table = quantiles(values, probs) if exact else quantiles_approx(values, probs)
    picks = [F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in zip(probs, names)]
    return table.groupBy("column").agg(*picks)
