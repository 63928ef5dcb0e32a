"""Dense surrogate keys without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.session import materialize, materialize_parts

# monotonically_increasing_id keeps the partition in the bits above these.
_ROW_BITS = 33
# So many bits above them hold the partition, and what is left above those the pass.
_PART_BITS = 20
# About so many rows are sorted, and so lie in shuffle files, at a time.
PASS_ROWS = 32_000_000


def number_small(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """1..n over a table whose size is bounded by its meaning (calendar days, bands)."""
    return df.select(
        F.row_number().over(Window.orderBy(*[col(c) for c in order])).alias(name),
        *[col(c) for c in df.columns],
    )


def group_offsets(counts: DataFrame, order: list[str], n: str = "n", name: str = "offset") -> DataFrame:
    """How many rows the groups before each group hold.  One row per group comes in."""
    before = Window.orderBy(*[col(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum(n).over(before), F.lit(0)))


def lead_passes(df: DataFrame, lead: str, pass_rows: int | None = None) -> list[Column] | None:
    """Conditions that cut ``df`` by ``lead``, a column of few values (bands), into runs of values in their order, null
    first, each of about ``pass_rows`` rows or of one value; None where a single pass holds all rows."""
    limit = PASS_ROWS if pass_rows is None else pass_rows
    runs, rows = [], 0
    # One row per value.
    for value, n in df.groupBy(col(lead)).agg(F.count(F.lit(1))).orderBy(col(lead).asc_nulls_first()).collect():
        if not runs or rows + n > limit:
            runs, rows = [*runs, []], 0
        runs[-1].append(value)
        rows += n
    if len(runs) < 2:
        return None

    def among(values: list) -> Column:
        named = [v for v in values if v is not None]
        found = col(lead).isin(named) if named else F.lit(False)
        return found if len(named) == len(values) else found | col(lead).isNull()

    return [among(values) for values in runs]


def sorted_table(df: DataFrame, order: list[str], label: str, passes: list[Column] | None = None) -> DataFrame:
    """Range-sort ``df`` by ``order`` and write it, with ``_pos`` = partition and row of each line.

    ``passes`` are conditions, in the order of ``order``, each row meeting one: the rows of each are sorted and written
    on their own, so that the shuffle files never hold all rows.

    The source partition closes the sort key, so that a run of equal rows, however long, is
    still cut into several ranges.  It depends on the partition only, not on the row order in
    it, hence a task that runs again after a lost executor yields the same rows.
    """
    keys = [col(c) for c in order]

    def ranged(number: int, rows: DataFrame) -> DataFrame:
        tagged = rows.withColumn("_src", F.spark_partition_id())
        cut = tagged.repartitionByRange(*keys, F.col("_src")).sortWithinPartitions(*keys).drop("_src")
        first = number << (_ROW_BITS + _PART_BITS)
        return cut.withColumn("_pos", F.monotonically_increasing_id() + F.lit(first).cast("bigint"))

    if passes is None:
        return materialize(ranged(0, df), label)
    return materialize_parts((ranged(i, df.filter(c)) for i, c in enumerate(passes)), label)


def assign_ids(df: DataFrame, order: list[str], name: str, label: str | None = None, lead: str | None = None) -> DataFrame:
    """Number the rows 1..n in the total order ``order``, at any size.

    One range shuffle and one write; then a count per range (at most one row per partition)
    gives the offsets.  ``order`` must tell all different rows apart; equal rows may take
    each other's number, which changes nothing.  ``lead`` says that the first column of ``order`` has few values;
    then a large table is sorted in passes, a few values at a time.
    """
    table = sorted_table(df, order, label or name, lead_passes(df, lead) if lead else None)
    part = F.shiftright(F.col("_pos"), _ROW_BITS).cast("int")
    counts = table.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    # Stored, because whoever reads the numbered table again would count again.
    offsets = F.broadcast(materialize(group_offsets(counts, ["_part"]).select("_part", "offset"), "offsets"))
    row: Column = F.col("_pos").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        table.withColumn("_part", part)
        .join(offsets, "_part")
        .select((F.col("offset") + row + 1).alias(name), *[col(c) for c in df.columns])
    )
