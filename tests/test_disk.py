"""What queries leave on disk on their way."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF
from skyfact.operators import joins, numbering, quality
from skyfact.operators.mart import dashboard_mart
from skyfact.operators.numbering import assign_ids, lead_passes
from skyfact.operators.quality import day_passes, dq_checks, id_checks
from skyfact.plans.defects import planted
from skyfact.session import materialize, scratch_dir


def folders(spark, label: str) -> set[Path]:
    return {p for p in Path(scratch_dir(spark).removeprefix("file:")).glob(f"{label}-*") if len(p.name) == len(label) + 33}


def size(path: Path) -> int:
    return sum(f.stat().st_size for f in path.rglob("part-*"))


def shuffle_bytes(spark) -> int:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for d in dirs for f in Path(d).rglob("shuffle_*.data"))


def made(spark, name: str, label: str) -> Path:
    before = folders(spark, label)
    entry.queries()[name](spark, SF)
    (path,) = folders(spark, label) - before
    return path


def test_bulk_csv_is_packed(spark, star, tmp_path):
    path = made(spark, "bulk_csv", "bulk")
    assert {f.suffixes[-2:][0] + f.suffixes[-1] for f in path.glob("part-*")} == {".csv.gz"}
    star.fact.write.option("header", True).csv(str(tmp_path / "plain"))
    assert size(path) * 2 < size(tmp_path / "plain")


def test_mart_csv_is_packed(spark, mart, tmp_path):
    path = made(spark, "mart_csv", "mart-csv")
    mart.write.option("header", True).csv(str(tmp_path / "plain"))
    assert size(path) * 3 < size(tmp_path / "plain")


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_bytes(spark)
    materialize(spark.range(300_000).repartition(F.xxhash64("id")), "many")
    assert shuffle_bytes(spark) <= before + 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("rows", [1, 60, 150, 10_000])
def test_passes_number_as_one_pass_does(spark, monkeypatch, rows):
    """Bands in runs of any length, one of them null, ties included."""
    band = F.when(F.col("id") % 7 > 0, F.col("id") % 7).cast("int")
    df = spark.range(500).select(band.alias("b"), (F.col("id") * 37 % 101).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("w"))
    monkeypatch.setattr(numbering, "PASS_ROWS", rows)
    found = sorted(assign_ids(df, ["b", "v", "w"], "n", lead="b").collect(), key=lambda r: r.n)
    null_first = lambda v: (v is not None, v or 0)
    rows_in = sorted(map(tuple, df.collect()), key=lambda r: tuple(map(null_first, r)))
    assert [r.n for r in found] == list(range(1, 501)) and [tuple(r)[1:] for r in found] == rows_in
    runs = lead_passes(df, "b")
    assert (runs and len(runs)) == {1: 7, 60: 7, 150: 4, 10_000: None}[rows]


def test_passes_of_nothing(spark):
    assert assign_ids(spark.range(0).selectExpr("id AS b", "id AS v"), ["b", "v"], "n", lead="b").count() == 0


def test_facts_are_stored_once(spark, star):
    """Numbers are put together when the fact is read; no second copy of the table."""
    assert not folders(spark, "fact_aod")
    assert star.fact.count() == star.fact.selectExpr("max(Fact_ID)").first()[0]


def test_mart_of_observations_is_the_mart_of_facts(spark, star):
    """Looked up per observation and unpivoted after, or looked up per fact."""
    a, b = dashboard_mart(star), dashboard_mart(star.with_fact(star.fact))
    assert star.keyed is not None and a.dtypes == b.dtypes
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_another_fact_is_not_taken_from_the_observations(star):
    assert planted(star).keyed is None and star.with_fact(star.fact.limit(3)).keyed is None
    assert dashboard_mart(star.with_fact(star.fact.limit(3))).count() == 3


@pytest.mark.parametrize("faults", [False, True])
def test_checks_add_up_over_runs_of_days(spark, star, monkeypatch, faults):
    """As many passes as are allowed, facts without a day among them; the triples of a pass are not kept."""
    checked = planted(star) if faults else star
    whole = {r.check: (r.failed, r.checked) for r in dq_checks(checked).collect()}
    monkeypatch.setattr(quality, "PASS_FACTS", 1000)
    assert len(day_passes(checked.fact)) == quality.MOST_PASSES
    assert checked.fact.count() == sum(checked.fact.filter(c).count() for c in day_passes(checked.fact))
    assert {r.check: (r.failed, r.checked) for r in dq_checks(checked).collect()} == whole
    assert not folders(spark, "key-triples") and len(whole) == 23


def test_days_of_facts_without_a_day(spark, monkeypatch):
    monkeypatch.setattr(quality, "PASS_FACTS", 1)
    none = spark.range(5).selectExpr("CAST(NULL AS INT) AS id_date")
    one = none.unionByName(spark.range(3).selectExpr("7 AS id_date"))
    for df, n in ((none, 5), (one, 8), (none.limit(0), 0)):
        assert sum(df.filter(c).count() for c in day_passes(df)) == n


def test_repeated_ids(spark):
    """Numbers below zero, at the ends of the type, apart by multiples of 64, and missing."""
    ids = [0, 64, 128, 128, -1, -1, -1, -64, 63, 2**63 - 1, -(2**63), 2**63 - 1, None, None, 5]
    found = id_checks(spark.createDataFrame([(i,) for i in ids], "Fact_ID long")).first()
    assert (found.failed, found.checked) == (len(ids) - len(set(ids)), len(ids))
    assert tuple(id_checks(spark.createDataFrame([], "Fact_ID long")).first())[1:] == (0, 0)


def test_ids_are_counted_in_few_groups(star):
    """What is shuffled for the check of numbers is far less than the numbers."""
    plan = id_checks(star.fact)._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and "keys=[Fact_ID" not in plan


@pytest.mark.parametrize("bound, pieces", [(10, 5), (5, 9), (60, 1)])
def test_look_up_in_pieces(spark, monkeypatch, bound, pieces):
    """More rows than a broadcast takes: no shuffle of the big side, and the rows of a join, repeated and missing keys included."""
    table = materialize(spark.range(44).selectExpr("nullif(id, 3) AS k", "id * 2 AS v", "nullif(id % 4, 1) AS w").unionByName(spark.createDataFrame([(7, 1, None)], "k long, v long, w long")), "right")
    left = spark.range(200).selectExpr("id", "nullif(id % 60, 5) AS k")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", bound)
    found, plain = joins.surrogate_join(left, table, "k"), left.join(table, "k", "left")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert pieces > joins.MOST_PIECES or plan.count("BroadcastHashJoin") == pieces and "SortMergeJoin" not in plan
    assert found.columns == plain.columns and sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_star_round_trip_shuffles_no_fact(spark):
    """Places are looked up by broadcast, whatever Spark guesses of their files."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["star_round_trip"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
