from __future__ import annotations

import json
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyfact.operators.constraints import constraint_violations
from skyfact.operators.facts import fk_misses
from skyfact.operators.quality import QualityError, dq_checks, dq_flat, dq_report, dq_summary, require_quality
from skyfact.operators.sampling import sample_geo, sample_rows
from skyfact.plans.daily import DailyJob, NoWeather, extract, run_daily
from skyfact.plans.defects import ORPHAN, planted
from skyfact.schemas import LOADED_FACT_COLUMNS, RAW_DATE, WAREHOUSE
from skyfact.sinks.tables import (
    LOAD_ORDER,
    jdbc_options,
    load_warehouse,
    parquet_sink,
    read_star,
    stage_path,
    warehouse_types,
    write_bulk_csv,
    write_dq_report,
    write_sample_csv,
    write_star,
)
from skyfact.sources import views

from conftest import SF


def failed(checks):
    return {r.check: r.failed for r in checks.collect()}


def test_planted_faults_are_counted(star):
    n = star.fact.count()
    hits = lambda step, at: len(range(at, n + 1, step)) if at else n // step
    clean, bad = failed(dq_checks(star)), failed(dq_checks(planted(star)))
    copies = hits(1000, 1) + hits(1013, 2)
    assert clean["duplicate_ids"] == 0 and bad["duplicate_ids"] == hits(1000, 1)
    frame = planted(star).fact.toPandas()
    assert len(frame) == n + copies
    keys = frame[["id_date", "id_wavelength", "id_site"]]
    assert bad["duplicate_keys"] == int(keys.duplicated().sum())
    assert bad["null_id_date"] == int(frame.id_date.isna().sum()) == bad["fk_miss_date"]
    assert bad["fk_miss_site"] == int((frame.id_site.isna() | (frame.id_site == ORPHAN)).sum())
    assert bad["aod_negative"] == int((frame.AOD_Value < 0).sum()) > 0
    assert bad["aod_extreme"] == int((frame.AOD_Value > 3).sum())
    assert bad["water_negative"] == int((frame.Precipitable_Water < 0).sum()) > 0
    assert bad["particle_mismatch"] == int(((frame.Particle_type == "dust") & frame.Angstrom_Exponent.notna()).sum()) > 0
    assert bad["band_mismatch"] == int((frame.id_wavelength == 2).sum()) > 0 == clean["band_mismatch"]
    assert {r.dimension: r.misses for r in fk_misses(planted(star).fact, planted(star)).collect()} == {
        "date": bad["fk_miss_date"], "wavelength": 0, "site": bad["fk_miss_site"],
    }


def test_report_and_gate(star):
    report = dq_report(star, parts=3, artifacts={"fact": "somewhere"})
    row = report.first()
    d, flat = row["dimensions"], dq_flat(report).first()
    four = [d[k]["kpi_pct"] for k in ("completeness", "consistency", "uniqueness", "validity")]
    assert row["overall_quality_kpi_pct"] == pytest.approx(sum(four) / 4) == pytest.approx(flat["overall"])
    assert row["row_counts"].asDict() == {"fact": star.fact.count(), "parts": 3}
    assert row["artifacts_used"] == {"fact": "somewhere"} and row["used_weather"] is True
    assert d["completeness"]["kpi_pct"] == pytest.approx(sum(d["completeness"]["by_col_pct"]) / 6)
    assert d["uniqueness"]["kpi_pct"] == (80.0 if d["uniqueness"]["combo_dups"] else 100.0)
    assert len(d["uniqueness"]["issues"]) == (1 if d["uniqueness"]["combo_dups"] else 0)
    assert d["consistency"]["weather_coverage"]["coverage_pct"] == 100.0
    assert require_quality(report) == row["overall_quality_kpi_pct"]
    with pytest.raises(QualityError):
        require_quality(dq_report(star, threshold=99.9))
    text = dq_summary(report).first()["summary"].split("\n")
    assert len(text) == 5 and f"{row['overall_quality_kpi_pct']:.2f}%" in text[0]
    assert dq_flat(dq_report(planted(star))).first()["uniqueness"] == 60.0


def test_empty_fact_does_not_pass(star):
    empty = star.with_fact(star.fact.limit(0))
    row = dq_report(empty).first()
    assert math.isnan(row["overall_quality_kpi_pct"]) and row["passed"] is False
    assert row["dimensions"]["completeness"]["kpi_pct"] == 100.0
    with pytest.raises(QualityError):
        require_quality(dq_report(empty))


def test_constraints(star):
    broken = planted(star)
    got = {(r.table, r.rule, r.column): r.violations for r in constraint_violations(broken).collect()}
    frame = broken.fact.toPandas()
    assert got["fact_aod", "primary key", "Fact_ID"] == int(frame.Fact_ID.duplicated().sum())
    assert got["fact_aod", "not null", "id_date"] == int(frame.id_date.isna().sum())
    assert got["fact_aod", "foreign key", "id_site"] == int((frame.id_site == ORPHAN).sum())
    assert got["fact_aod", "foreign key", "id_weather"] == got["dim_date", "unique", "Date"] == 0


def test_samples_of_any_size(spark, star):
    """A sample cut off by a bound is the one that ordering gives; no task orders more than it may."""
    from skyfact.operators.sampling import draw, front_quotas, lowest_lots, sample_front

    fact = star.fact.select("Fact_ID", "id_wavelength")
    total = fact.count()
    in_order = [r.Fact_ID for r in fact.orderBy(draw("Fact_ID", 42), "Fact_ID").collect()]
    for n in (60, total // 2, total - 1):
        assert sorted(r.Fact_ID for r in lowest_lots(fact, n, 42, "Fact_ID", one_task=50).collect()) == sorted(in_order[:n])
    assert lowest_lots(fact, total + 5, 42, "Fact_ID", one_task=50).count() == total
    plan = lowest_lots(fact, total // 2, 42, "Fact_ID", one_task=50)._jdf.queryExecution().executedPlan().toString()
    assert f"limit={total // 2}" not in plan
    same = spark.range(500).select(F.lit(7).alias("Fact_ID"), "id")
    assert lowest_lots(same, 300, 42, "Fact_ID", one_task=10).count() == 300
    # by parts from the front
    sizes = {r.id_wavelength: r["count"] for r in fact.groupBy("id_wavelength").count().collect()}
    n = sizes[1] + sizes[2] // 3
    got = sample_front(fact, n)
    assert {r.id_wavelength: r["count"] for r in got.groupBy("id_wavelength").count().collect()} == {1: sizes[1], 2: n - sizes[1]}
    assert sorted(r.Fact_ID for r in sample_front(fact, 50).collect()) == sorted(r.Fact_ID for r in lowest_lots(fact.filter("id_wavelength = 1"), 50, 42, "Fact_ID").collect())
    assert sample_front(fact, 0).count() == 0 and sample_front(fact, total * 2).count() == total
    odd = spark.createDataFrame([(1, None), (2, None), (3, "b"), (4, "a"), (5, "a")], "Fact_ID long, part string")
    assert [tuple(r) for r in front_quotas(odd, 3, "part").orderBy("part").collect()] == [(None, 2, 2), ("a", 2, 1), ("b", 1, 0)]
    assert {r.Fact_ID for r in sample_front(odd, 2, part="part").collect()} == {1, 2}
    assert sample_front(odd.limit(0), 5, part="part").count() == 0


def test_samples(star):
    a, b = (sample_rows(f, 50).select("Fact_ID") for f in (star.fact, star.fact.repartition(13)))
    assert a.count() == 50 and sorted(a.collect()) == sorted(b.collect())
    assert sorted(sample_rows(star.fact, 50, seed=1).select("Fact_ID").collect()) != sorted(a.collect())
    assert sample_rows(star.fact.limit(7), 50).count() == 7
    strata = sample_rows(star.fact, 3, strata="id_wavelength").groupBy("id_wavelength").count().collect()
    assert [r["count"] for r in strata] == [3] * 8
    geo = sample_geo(star)
    ids = {r.Fact_ID for r in geo.collect()}
    assert ids == {r.Fact_ID for r in a.collect()} and {r.Fact_ID for r in geo.limit(5).collect()} <= ids


def test_star_round_trip(spark, star, tmp_path):
    paths = write_star(star, str(tmp_path / "star"))
    back = read_star(spark, paths)
    assert back.fact.count() == star.fact.count() and back.weather_keys.count() == star.weather_keys.count()
    assert len(list((tmp_path / "star" / "fact_aod").glob("id_wavelength=*"))) == 8
    plan = back.fact.filter("id_wavelength = 3").select("AOD_Value")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(id_wavelength" in plan
    write_star(star.with_fact(star.fact.limit(5)), str(tmp_path / "star"))
    assert spark.read.parquet(paths["fact_aod"]).count() == 5
    assert stage_path("/x/", "star", "7") == "/x/star_7.parquet" and stage_path("/x", "a") != stage_path("/x", "a")


def test_warehouse_load(spark, star, tmp_path):
    order = []
    sink = parquet_sink(str(tmp_path))

    def spy(table, df, truncate):
        order.append((table, truncate))
        sink(table, df, truncate)

    rejects = load_warehouse(star, spy)
    assert order == [(t, True) for t in reversed(LOAD_ORDER)] + [(t, False) for t in LOAD_ORDER]
    fact = spark.read.parquet(str(tmp_path / "fact_aod"))
    assert fact.count() + rejects.count() == star.fact.count() and rejects.count() > 0
    assert fact.columns == LOADED_FACT_COLUMNS and dict(fact.dtypes)["is_enriched"] == "tinyint"
    for name, spec in WAREHOUSE.items():
        assert spark.read.parquet(str(tmp_path / name)).columns == spec.schema.fieldNames()
    site = warehouse_types(star.site, "dim_site")
    assert dict(site.dtypes)["Latitude"] == "decimal(9,6)"


def test_jdbc_options():
    """No database is started here; the options are what Spark's writer gets."""
    got = jdbc_options("jdbc:mysql://h/db", "fact_aod", user="u")
    assert got["batchsize"] == "20000" and got["dbtable"] == "fact_aod" and got["truncate"] == "true" and got["user"] == "u"


def test_exports(spark, star, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), "a,b"), (2, 1.5, None)], "k int, v double, t string")
    write_bulk_csv(df, str(tmp_path / "bulk"))
    lines = sorted(line for f in Path(tmp_path / "bulk").glob("*.csv") for line in f.read_text().splitlines())
    assert '1,\\N,"a,b"' in lines and "2,1.5,\\N" in lines and "k,v,t" in lines
    write_sample_csv(sample_geo(star), str(tmp_path / "sample"))
    files = list((tmp_path / "sample").glob("*.csv"))
    assert len(files) == 1 and len(files[0].read_text().splitlines()) == 51
    write_dq_report(dq_report(star), str(tmp_path / "dq"))
    (report,) = (tmp_path / "dq" / "report").glob("*.json")
    assert json.loads(report.read_text())["dimensions"]["uniqueness"]["fact_id_dups"] == 0
    (text,) = (tmp_path / "dq" / "summary").glob("*.txt")
    assert "Completeness" in text.read_text()


@pytest.fixture
def job(spark, tmp_path):
    raw = views.obs_wide(spark, SF).filter(F.col("AERONET_Site").isin("site_1", "site_2", "site_4", "site_6"))
    raw.write.option("header", True).csv(str(tmp_path / "obs"))
    views.country_polygons(spark, SF).write.parquet(str(tmp_path / "polygons"))
    views.weather_daily(spark, SF).write.parquet(str(tmp_path / "staging" / "weather_daily_1.parquet"))
    return DailyJob(str(tmp_path / "obs"), str(tmp_path / "staging"), str(tmp_path / "dq"), str(tmp_path / "polygons"), threshold=85.0)


def test_daily_load(spark, job, tmp_path):
    result = run_daily(spark, job, parquet_sink(str(tmp_path / "db")))
    assert 85.0 <= result.score <= 100.0
    stored = spark.read.parquet(str(tmp_path / "db" / "fact_aod"))
    assert stored.count() == result.star.fact.count() - result.rejects.count() > 0
    assert stored.filter("is_enriched = 1").count() > 0
    assert result.star.site.filter("Country IS NOT NULL").count() > 0
    wide = extract(spark, job)
    assert RAW_DATE not in wide.columns
    asked = spark.read.parquet(result.paths["weather_requests"]).count()
    assert 0 < result.weather_missing.count() < asked
    assert spark.read.parquet(result.paths["rejects"]).count() == result.rejects.count()


def test_daily_load_without_weather(spark, job, tmp_path):
    from dataclasses import replace

    bare = replace(job, staging=str(tmp_path / "bare"))
    result = run_daily(spark, bare)
    assert result.weather_missing is None and result.star.fact.filter("is_enriched = 1").isEmpty()
    # without a sink the rejects are those that a load would have left
    assert result.rejects.count() == result.star.fact.filter("id_site IS NULL OR id_date IS NULL").count()
    with pytest.raises(NoWeather):
        run_daily(spark, replace(bare, weather_required=True))
    elsewhere = views.weather_daily(spark, SF).limit(3).withColumn("Latitude", F.lit(-89.0))
    for name, rows in (("none", elsewhere.limit(0)), ("other", elsewhere)):
        rows.write.parquet(str(tmp_path / name))
        with pytest.raises(NoWeather):
            run_daily(spark, replace(bare, weather=str(tmp_path / name)))


def test_gate_stops_the_load(spark, job, tmp_path):
    from dataclasses import replace

    with pytest.raises(QualityError):
        run_daily(spark, replace(job, threshold=99.99), parquet_sink(str(tmp_path / "db")))
    assert not (tmp_path / "db").exists()


def test_texts_that_do_not_fit_the_warehouse(spark, star):
    from dataclasses import replace

    long_name = F.when(F.col("id_site") == 1, F.repeat(F.lit("x"), 151)).otherwise(F.col("AERONET_Site"))
    broken = replace(star, site=star.site.withColumn("AERONET_Site", long_name))
    got = {(r.table, r.column): r.violations for r in constraint_violations(broken).filter("rule = 'length'").collect()}
    assert got.pop(("dim_site", "AERONET_Site")) == 1 and set(got.values()) == {0} and ("fact_aod", "Particle_type") in got


def test_fact_is_read_three_times(spark, star, monkeypatch):
    """Quality: values, ids, and the stored key triples; every other look at the fact is a look at those."""
    plan = dq_report(star)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Relation" in line and "AOD_Value#" in line or "Relation" in line and "Fact_ID#" in line]
    assert len(scans) <= 2
