"""The rules of the warehouse tables as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.operators.facts import StarSchema
from skyfact.schemas import WAREHOUSE, TableSpec
from skyfact.session import materialize


def _row(df: DataFrame, table: str, rule: str, name: str, n) -> DataFrame:
    return df.agg(
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        F.lit(name).alias("column"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("violations"),
    )


def _surplus(df: DataFrame, table: str, rule: str, name: str) -> DataFrame:
    """Rows beyond the first of each value; null is not a value."""
    counts = df.filter(col(name).isNotNull()).groupBy(col(name)).agg(F.count(F.lit(1)).alias("n"))
    return _row(counts, table, rule, name, F.sum(F.col("n") - 1))


def _row_rules(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rules that look at one row: values that must be there, and texts that must fit."""
    rules = [("not null", c, col(c).isNull()) for c in spec.required]
    rules += [("length", c, F.length(col(c)) > n) for c, n in spec.lengths.items() if c in df.columns]
    cells = [
        F.struct(
            F.lit(spec.name).alias("table"),
            F.lit(rule).alias("rule"),
            F.lit(c).alias("column"),
            F.count_if(bad).alias("violations"),
        )
        for rule, c, bad in rules
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _orphans(df: DataFrame, spec: TableSpec, name: str, target: DataFrame) -> DataFrame:
    """Rows whose key is not in ``target``; keys are counted before the look-up, so hot ones weigh nothing.

    ``df`` has ``n`` rows for each combination of keys.
    """
    counts = df.filter(col(name).isNotNull()).groupBy(col(name)).agg(F.sum("n").alias("n"))
    return _row(counts.join(target.select(col(name)), name, "left_anti"), spec.name, "foreign key", name, F.sum("n"))


def constraint_violations(star: StarSchema) -> DataFrame:
    """(table, rule, column, violations) for primary keys, unique columns, required columns, text lengths, foreign keys.

    The combinations of foreign keys are counted and stored once, so a fact is read three times in all.
    """
    tables = star.tables()
    found = []
    for name, df in tables.items():
        spec = WAREHOUSE[name]
        found.append(_surplus(df, name, "primary key", spec.primary_key))
        found += [_surplus(df, name, "unique", c) for c in spec.unique]
        found.append(_row_rules(df, spec))
        foreign = {k: t for k, t in spec.foreign.items() if t in tables and k in df.columns}
        if foreign:
            keys = materialize(df.groupBy(*[col(k) for k in foreign]).agg(F.count(F.lit(1)).alias("n")), "foreign-keys")
            found += [_orphans(keys, spec, k, tables[t]) for k, t in foreign.items()]
    return reduce(DataFrame.unionByName, found)
