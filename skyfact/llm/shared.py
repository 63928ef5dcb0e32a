"""Sizes and stored intermediate tables of the operators."""

from __future__ import annotations

import uuid

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, and survives the loss of executors."""
    path = f"{scratch_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch of whole texts; Spark's default of 10,000 takes ten times the memory.
BATCH_ROWS = 1000
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of the session, where it has not bounded them itself, and hand ``df`` on."""
    conf = df.sparkSession.conf
    if conf.get(_ROWS_CONF, "10000") == "10000":
        conf.set(_ROWS_CONF, str(BATCH_ROWS))
    return df


def text_size(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def slices(size: int, each: int) -> int:
    """So many parts of ``each`` bytes."""
    return max(1, -(-size // each))


def picked(docs: DataFrame, chosen: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` names by ``on`` (nulls match), with chosen's other columns.

    ``chosen`` has ``_n``, how many rows of docs have the key.  Where there are several, the least
    stands for them, so that each row of chosen gives one row; only those are grouped.
    """
    chosen = chosen.withColumnsRenamed({c: f"_{c}" for c in on})
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on])
    joined = docs.join(chosen, match).drop(*[f"_{c}" for c in on])
    rest = [c for c in docs.columns if c not in on]
    more = [c for c in chosen.columns if c != "_n" and c[1:] not in on]
    several = joined.filter("_n > 1").groupBy(*on, *more).agg(F.min(F.struct(*rest)).alias("_row")).select(*on, "_row.*", *more)
    return joined.filter("_n = 1").select(*on, *rest, *more).unionByName(several)
