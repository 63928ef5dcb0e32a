"""Look-ups that broadcast only what was counted, and stay even when a key is hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.session import materialize

# A look-up table is broadcast up to these bounds, both measured on the stored table.
BROADCAST_ROWS = 300_000
BROADCAST_BYTES = 64 << 20
# A table of more rows, but not of more bytes, goes in so many broadcasts at most.
MOST_PIECES = 8
# A key is hot when one task would get more rows of it than this.
HOT_ROWS = 2_000_000


def fits_broadcast(table: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Whether ``table`` is within both bounds.  Meant for stored tables, where a count is cheap; only one
    with few rows is measured."""
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    if table.limit(limit + 1).count() > limit:
        return False
    texts = [c for c, t in table.dtypes if t in ("string", "binary")]
    nested = [c for c, t in table.dtypes if t.startswith(("array", "map", "struct"))]
    width = F.lit(8 * len(table.columns))
    for c in texts:
        width = width + F.coalesce(F.octet_length(col(c)), F.lit(0))
    for c in nested:
        width = width + F.coalesce(F.octet_length(F.to_json(col(c))), F.lit(0))
    size = table.agg(F.sum(width)).first()[0] or 0
    return size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def _equi_join(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, on, how)
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    pairs = [col(c).eqNullSafe(col(f"_right_{c}")) for c in on]
    return left.join(right, reduce(lambda a, b: a & b, pairs), how).drop(*[f"_right_{c}" for c in on])


def hot_keys(df: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and in how many parts of about that size each is dealt."""
    counts = df.groupBy(*[col(c) for c in on]).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).withColumn("_parts", F.ceil(F.col("_n") / hot_rows).cast("int")).drop("_n")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """Shuffled join that deals out the rows of hot keys over as many tasks as their number asks for.

    The left rows of a hot key are split by a digest of all their columns and the partition they come from,
    which a repeated task gives again; the matching right rows are repeated once per part; all other
    keys stay as they are.  Left rows with a null key never match, so they stay out of the shuffle.
    """
    unmatched = None
    if not null_safe:
        no_key = reduce(lambda a, b: a | b, [col(c).isNull() for c in on])
        if how == "left":
            absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in on]
            unmatched = left.filter(no_key).select(*[col(c) for c in left.columns], *absent)
        left = left.filter(~no_key)
    hot = materialize(hot_keys(left, on, HOT_ROWS if hot_rows is None else hot_rows), "hot-keys")
    if hot.isEmpty():
        joined = _equi_join(left, right, on, how, null_safe)
    else:
        # At most one hot key per hot_rows rows; within the bounds the list is broadcast, else joined.
        mark = F.broadcast(hot) if fits_broadcast(hot) else hot
        marked = _equi_join(left, mark, on, "left", null_safe)
        row = F.xxhash64(F.spark_partition_id(), *[col(c) for c in left.columns])
        left_salted = marked.withColumn("_salt", F.coalesce(F.pmod(row, F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")
        parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
        right_salted = _equi_join(right, mark, on, "left", null_safe).withColumn("_salt", F.explode(parts)).drop("_parts")
        joined = _equi_join(left_salted, right_salted, [*on, "_salt"], how, null_safe).drop("_salt")
    return joined if unmatched is None else joined.unionByName(unmatched)


def surrogate_join(left: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join to a stored look-up table by a whole-number key.

    A table of more rows than one broadcast takes goes in several, each of some keys, as long as all of them together are
    within the bytes of one; the big frame is not shuffled then.
    """
    limit = BROADCAST_ROWS
    rows = table.limit(limit * MOST_PIECES + 1).count()
    if rows <= limit or not fits_broadcast(table, limit * MOST_PIECES):
        return lookup_join(left, table, [key], "left")
    pieces = -(-rows // limit)
    values = [c for c in table.columns if c != key]
    piece = F.pmod(F.xxhash64(col(key)), F.lit(pieces))
    for i in range(pieces):
        part = table.filter(piece == i).withColumnsRenamed({c: f"_{i}_{c}" for c in values})
        left = left.join(F.broadcast(part), key, "left")
    # A key is in one piece only.
    merged = [F.coalesce(*[col(f"_{i}_{c}") for i in range(pieces)]).alias(c) for c in values]
    return left.select(*[col(c) for c in left.columns[: len(left.columns) - pieces * len(values)]], *merged)


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """Join a big frame to a stored look-up table: broadcast if it is small, else salted shuffle."""
    if fits_broadcast(table, max_rows):
        return _equi_join(left, F.broadcast(table), on, how, null_safe)
    return salted_join(left, table, on, how, null_safe)
