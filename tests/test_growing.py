"""Loads that build on each other, manifests, sketches of days, and folders with parts of several layouts."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF
from skyfact.operators.sketches import add_days, day_sketches, rank_errors, sketch_quantiles
from skyfact.plans.incremental import append_load, read_warehouse
from skyfact.plans.warehouse import Warehouse
from skyfact.sinks import manifests
from skyfact.sources.observations import read_mixed_fact


def test_loads_build_on_each_other(spark, tmp_path):
    """Old keys stay, numbers are dense over both loads, a failed or late load publishes nothing."""
    house, root = Warehouse.of(spark, SF), str(tmp_path / "dw")
    early, late = (house.observations.filter(f"Date {op} '1995-06-01'").limit(400) for op in ("<", ">="))
    with pytest.raises(FileNotFoundError):
        read_warehouse(spark, root)
    first = append_load(spark, root, early, weather=house.weather)
    old = read_warehouse(spark, root)
    before = {n: sorted(map(tuple, df.collect()), key=str) for n, df in old.tables().items()}
    second = append_load(spark, root, late)
    star = read_warehouse(spark, root)
    for name, df in star.tables().items():
        now = set(map(tuple, df.collect()))
        assert set(before[name]) <= now and len(now) == df.count()
    ids = sorted(r.Fact_ID for r in star.fact.select("Fact_ID").collect())
    assert ids == list(range(1, len(ids) + 1)) and len(ids) > len(before["fact_aod"])
    assert [r["first_id"] for r in second.manifest["runs"]] == [1, len(before["fact_aod"]) + 1]
    for dim, key in ((star.date, "id_date"), (star.site, "id_site")):
        n = dim.count()
        assert dim.agg(F.max(key)).first()[0] == n == dim.select(key).distinct().count()
    assert first.rejects.filter("id_site IS NOT NULL AND id_date IS NOT NULL AND AOD_Value IS NOT NULL").isEmpty()
    # an earlier version stays readable
    assert sorted(map(tuple, read_warehouse(spark, root, first.manifest["version"]).fact.collect()), key=str) == before["fact_aod"]
    # of two loads with one base the second is refused, and readers see the first
    number = manifests.last_number(spark, root) + 1
    manifests.publish(spark, root, number, second.manifest)
    with pytest.raises(manifests.Superseded):
        manifests.publish(spark, root, number, first.manifest)
    assert manifests.current(spark, root)["version"] == number and read_warehouse(spark, root).fact.count() == len(ids)
    # a writer that died in its manifest is as if it had not been, and the next takes the next number
    (tmp_path / "dw" / "_manifest" / f"{number + 1:010d}.json").write_text(json.dumps(first.manifest)[:20])
    assert manifests.current(spark, root)["version"] == number and manifests.last_number(spark, root) == number + 1


def test_a_load_that_fails_leaves_the_last_state(spark, tmp_path, monkeypatch):
    house, root = Warehouse.of(spark, SF), str(tmp_path / "dw")
    append_load(spark, root, house.observations.limit(50))
    n = read_warehouse(spark, root).fact.count()
    from skyfact.plans import incremental

    def broken(df, root, table):
        if table == "dim_site":
            raise OSError("disk")
        return manifests.stage(df, root, table)

    monkeypatch.setattr(incremental, "stage", broken)
    with pytest.raises(OSError):
        append_load(spark, root, house.observations.filter("Date > '1995-01-01'").limit(50))
    assert read_warehouse(spark, root).fact.count() == n


def test_sketches_of_days(spark, tmp_path):
    rng = np.random.default_rng(4)
    table = pd.DataFrame({"day": rng.integers(1, 29, 40000), "a": rng.normal(size=40000), "b": rng.exponential(size=40000)})
    table.loc[:50, "a"] = np.nan
    df = spark.createDataFrame(table).select(F.to_date(F.format_string("2020-02-%02d", "day")).alias("Date"), "a", "b")
    path = str(tmp_path / "s")
    add_days(spark, path, df.filter("Date < '2020-02-11'"), ["a", "b"])
    add_days(spark, path, df, ["a", "b"])
    add_days(spark, path, df, ["a", "b"])
    stored = spark.read.parquet(path)
    assert stored.count() == 28 * 2
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    for first, last in ((None, None), ("2020-02-05", "2020-02-20"), ("2020-02-28", None)):
        rows = df if first is None else df.filter(F.col("Date") >= first)
        rows = rows if last is None else rows.filter(F.col("Date") <= last)
        errors = rank_errors(rows, sketch_quantiles(stored, probs, first, last), ["a", "b"]).collect()
        assert len(errors) == 12 and all(r.error < 0.01 for r in errors)
        for r in errors:
            if r.prob in (0.0, 1.0):
                assert r["quantile"] == rows.filter(f"NOT isnan({r.column})").agg((F.min if r.prob == 0 else F.max)(r.column)).first()[0]
    odd = spark.createDataFrame([(None, 1.0), (None, 3.0), (None, None)], "Date date, a double")
    assert [(r.n, r["quantile"]) for r in sketch_quantiles(day_sketches(odd, ["a"]), [1.0]).collect()] == [(2, 3.0)]
    assert sketch_quantiles(day_sketches(odd, ["a"]), [0.5], "2020-01-01").count() == 0
    assert day_sketches(odd.limit(0), ["a"]).count() == 0


def test_fact_of_several_layouts(spark, star, tmp_path):
    fact, path = star.fact, str(tmp_path / "f")
    fact.filter("Fact_ID <= 20").drop("id_weather", "is_enriched").write.parquet(path)
    fact.filter("Fact_ID BETWEEN 21 AND 40").drop("is_enriched").write.mode("append").parquet(path)
    fact.filter("Fact_ID BETWEEN 41 AND 60").write.mode("append").parquet(path)
    got = {r.Fact_ID: (r.id_weather, r.is_enriched) for r in read_mixed_fact(spark, path).collect()}
    want = {r.Fact_ID: (r.id_weather if r.Fact_ID > 20 else None, r.is_enriched if r.Fact_ID > 40 else 0) for r in fact.filter("Fact_ID <= 60").collect()}
    assert got == want
