from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyfact.operators import joins as J
from skyfact.operators.dimensions import dim_date, dim_site, dim_weather, dim_wavelength, weather_conflicts
from skyfact.operators.facts import build_fact, enrich_weather, number_facts, split_rejects, unenriched, upgrade_fact
from skyfact.operators.numbering import assign_ids, group_offsets, sorted_table
from skyfact.plans.star import build_star
from skyfact.schemas import ELEV, LAT, LON, SITE, WEATHER_RENAME
from skyfact.session import materialize
from skyfact.sources import views

from conftest import SF


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_ids_are_dense_and_independent_of_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 5).alias("v"))
    few = assign_ids(df.coalesce(2), ["v", "k"], "n")
    many = assign_ids(df.repartition(11), ["v", "k"], "n")
    assert rows(few) == rows(many)
    expected = {k: i for i, k in enumerate(sorted((r.v, r.k) for r in df.collect()), start=1)}
    assert {(r.v, r.k): r.n for r in few.collect()} == expected


def test_copies_are_cut_into_several_ranges(spark):
    """A third of all rows is the same row; no task may get all of it."""
    df = spark.range(0, 30000, 1, 12).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = sorted_table(df, ["k"], "copies")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = table.filter("k = -1").groupBy(F.shiftright("_pos", 33).alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 10000 and len(parts) > 1
    ids = assign_ids(df, ["k"], "n")
    assert ids.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 30000, 30000)
    assert ids.filter("k = -1").agg(F.max("n")).first()[0] == 10000


def test_ids_of_nothing(spark):
    assert assign_ids(spark.range(0), ["id"], "n").count() == 0


def test_offsets(spark):
    df = spark.createDataFrame([(3, 10), (1, 4), (2, 6)], "g int, n long")
    assert {(r.g, r.offset) for r in group_offsets(df, ["g"]).collect()} == {(1, 0), (2, 4), (3, 10)}


@pytest.fixture
def sides(spark):
    left = spark.range(0, 9000, 1, 6).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50).alias("k"),
    )
    right = spark.range(0, 45).select(F.col("id").alias("k"), (F.col("id") * 100).alias("v"))
    return left, materialize(right, "right")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [100, 1_000_000])
def test_salted_join_is_a_join(sides, how, hot_rows):
    left, right = sides
    got = J.salted_join(left, right, ["k"], how, hot_rows=hot_rows)
    assert rows(got.select("id", "k", "v")) == rows(left.join(right, "k", how).select("id", "k", "v"))


def test_salted_join_deals_out_hot_and_null_keys(sides, spark):
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = J.salted_join(left, right, ["k"], hot_rows=900)
        where = got.select("k", F.spark_partition_id().alias("t")).groupBy("k")
        tasks = {r.k: r.tasks for r in where.agg(F.countDistinct("t").alias("tasks")).collect()}
        assert tasks[7] > 1 and tasks[None] > 1 and tasks[8] == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_safe_salted_join(sides, spark):
    left, right = sides
    more = materialize(right.unionByName(spark.createDataFrame([(None, -5)], "k long, v long")), "right")
    got = J.salted_join(left, more, ["k"], null_safe=True, hot_rows=100)
    small = J.lookup_join(left, more, ["k"], null_safe=True)
    assert rows(got.select("id", "k", "v")) == rows(small.select("id", "k", "v"))
    assert got.filter("k IS NULL AND v = -5").count() == left.filter("k IS NULL").count() > 0


def test_look_up_without_broadcast_gives_the_same_facts(spark, star, monkeypatch):
    wide, keys = views.observations(spark, SF), star.weather_keys
    plain = build_fact(wide, star.date, star.wavelength, star.site, keys)
    monkeypatch.setattr(J, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(J, "HOT_ROWS", 50)
    # One hot key only is dealt out then, because the list of hot keys is bounded too.
    salted = build_fact(wide, star.date, star.wavelength, star.site, keys)
    assert rows(plain) == rows(salted)


def test_date_dimension(spark):
    df = spark.createDataFrame([("2021-03-01",), ("2020-02-29",), (None,), ("2021-03-01",)], "d string")
    table = dim_date(df.select(F.to_date("d").alias("Date")))
    assert [(r.id_date, str(r.Date), r.Day_of_Year) for r in table.orderBy("id_date").collect()] == [
        (1, "2020-02-29", 60),
        (2, "2021-03-01", 60),
    ]


def test_wavelength_dimension_keeps_unmeasured_bands(spark):
    table = dim_wavelength(spark, ["AOD_870nm", "AOD_340nm", "AOD_1020nm"]).collect()
    assert [(r.id_wavelength, r.Wavelength_nm, r.Spectral_Band) for r in table] == [
        (1, 340.0, "UV"),
        (2, 870.0, "NIR"),
        (3, 1020.0, "NIR"),
    ]


def test_moved_station(spark):
    data = [("A", 1.0, 2.0, 3.0, 0.5), ("A", 1.0, 2.0, 8.0, 0.6), ("B", 99.0, -200.0, 0.0, 0.7)]
    df = spark.createDataFrame(data, f"`{SITE}` string, `{LAT}` float, `{LON}` float, `{ELEV}` float, AOD_500nm float")
    df = df.withColumn("Date", F.to_date(F.lit("2020-01-01")))
    site = materialize(dim_site(df), "site")
    assert site.count() == 2
    date, wave = materialize(dim_date(df), "date"), dim_wavelength(spark, ["AOD_500nm"])
    fact = number_facts(build_fact(df, date, wave, site))
    assert fact.count() == 3 and fact.filter("id_site IS NULL").count() == 1
    by_name = build_fact(df, date, wave, site, site_key="name")
    assert by_name.count() == 5
    good, bad = split_rejects(fact)
    assert (good.count(), bad.count()) == (2, 1)


WEATHER = ", ".join(["Date string", "Latitude double", "Longitude double", *[f"{c} double" for c in WEATHER_RENAME]])


def test_weather_dimension(spark):
    base = ("2020-01-01", 1.0000001, 2.0)
    data = [base + (5.0,) * 7, base + (5.0,) * 7, base + (4.0,) + (9.0,) * 6, ("2020-01-02", 1.0, 2.0) + (float("nan"),) * 7]
    df = spark.createDataFrame(data, WEATHER)
    dim, keys = dim_weather(df)
    assert dim.count() == keys.count() == 2
    first = keys.orderBy("id_weather").first()
    assert (str(first.Date), first.Latitude, first.id_weather) == ("2020-01-01", 1.0, 1)
    table = {r.id_weather: r for r in dim.collect()}
    assert table[1].temperature_mean == 4.0 and table[2].temperature_mean is None
    assert dim_weather(df, one_row_per_key=False)[0].count() == 3
    assert [r.variants for r in weather_conflicts(df).collect()] == [2]


def test_enrich_and_upgrade(spark, star):
    fact = star.fact.drop("id_weather", "is_enriched")
    again = enrich_weather(fact, star.date, star.site, star.weather_keys)
    assert rows(again.select("Fact_ID", "id_weather", "is_enriched")) == rows(star.fact.select("Fact_ID", "id_weather", "is_enriched"))
    assert 0 < star.fact.filter("is_enriched = 1").count() < star.fact.count()
    assert unenriched(fact).filter("id_weather IS NOT NULL OR is_enriched <> 0").isEmpty()
    assert upgrade_fact(fact).filter("is_enriched <> 0").isEmpty()
    assert rows(upgrade_fact(star.fact)) == rows(star.fact)


def test_long_rows_are_the_measured_cells(spark, star):
    wide = views.observations(spark, SF)
    cells = wide.agg(*[F.count(c).alias(c) for c in views.AOD_COLUMNS]).first()
    assert star.fact.count() == sum(cells)
    ids = star.fact.agg(F.min("Fact_ID"), F.max("Fact_ID"), F.countDistinct("Fact_ID")).first()
    assert ids == (1, sum(cells), sum(cells))


def test_dims_from_data(spark):
    wide = views.observations(spark, SF).withColumn("AOD_340nm", F.lit(None).cast("float"))
    star = build_star(wide, dims_from="data", numbered=False)
    assert star.wavelength.count() == 7
    assert build_star(wide, numbered=False).wavelength.count() == 8
    assert star.fact.filter("id_wavelength IS NULL OR id_date IS NULL").isEmpty()
    with pytest.raises(ValueError):
        build_star(wide, dims_from="x")
