from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from skyfact import functions as X
from skyfact.functions import columns as C
from skyfact.operators.filters import Filters, apply_filters, complete_cases, filter_members, filter_months, filter_range, valid_coords
from skyfact.operators.reshape import drop_null_measures, long_observations, metrics_long, wide_to_long, with_labels
from skyfact.schemas import ANGSTROM

NAN = float("nan")


def one(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_spectral_band_borders(spark):
    nm = [(399.0,), (400.0,), (500.0,), (501.0,), (700.0,), (701.0,), (799.0,), (800.0,)]
    assert one(spark, nm, "w double", X.spectral_band(F.col("w"))) == ["UV", "VIS", "VIS", "VIS", "VIS", "NIR", "NIR", "NIR"]
    fine, mid, coarse = "fine-sensitive", "balanced", "coarse-sensitive"
    expected = [fine, fine, fine, mid, mid, mid, mid, coarse]
    assert one(spark, nm, "w double", X.sensitive_aerosol(F.col("w"))) == expected


def test_particle_type_borders(spark):
    rows = [(1.5,), (1.4999,), (1.0,), (1.0001,), (-3.0,), (None,), (NAN,)]
    expected = ["fine", "mixed", "coarse", "mixed", "coarse", None, None]
    assert one(spark, rows, "a double", X.particle_type(F.col("a"))) == expected


def test_wavelength_from_name(spark):
    rows = [("AOD_340nm",), ("AOD_1020nm",), ("Water",), (None,)]
    assert one(spark, rows, "b string", X.wavelength_nm(F.col("b"))) == [340.0, 1020.0, None, None]


def test_clip_keeps_null(spark):
    assert one(spark, [(-0.5,), (0.25,), (None,)], "v double", X.clip_lower(F.col("v"))) == [0.0, 0.25, None]


def test_sentinel_and_nan_become_null(spark):
    df = spark.createDataFrame([(-999.0, 1.0), (NAN, -999.0), (2.5, -998.0)], "a float, b float")
    assert [tuple(r) for r in C.sentinel_to_null(df, ["a", "b"]).collect()] == [(None, 1.0), (None, None), (2.5, -998.0)]


def test_coordinates(spark):
    df = spark.createDataFrame(
        [(35.332001, 2.0), (120.0, 45.0), (95.0, -200.0), (NAN, 1.0), (90.0, 180.0), (None, 3.0)],
        "Latitude double, Longitude double",
    )
    fixed = C.fix_swapped_coords(df)
    assert tuple(fixed.collect()[1]) == (45.0, 120.0)
    assert [tuple(r) for r in valid_coords(fixed).collect()] == [(35.332001, 2.0), (45.0, 120.0), (90.0, 180.0)]
    keys = [r[0] for r in df.select(X.coord_key(F.col("Latitude"))).collect()]
    assert str(keys[0]) == "35.332001" and keys[3] is None
    assert C.round_coords(df.withColumn("Latitude", F.col("Latitude") + 1e-8)).first()["Latitude"] == 35.332001


def test_coercion_and_small_helpers(spark):
    df = spark.createDataFrame([("1.5", "x"), ("abc", "y"), (None, "z")], "v string, t string")
    assert [r[0] for r in C.coerce_numeric(df, ["v", "absent"]).collect()] == [1.5, None, None]
    assert C.rename(df, {"v": "w", "nope": "n"}).columns == ["w", "t"]
    assert C.select_present(df, ["t", "q"]).columns == ["t"]
    wide = spark.range(1).selectExpr("1 AS `AOD_500nm`", "2 AS `N[AOD_500nm]`", "3 AS other")
    assert C.column_family(wide, "AOD", exclude="N[").columns == ["AOD_500nm"]
    nans = spark.createDataFrame([(NAN, 1), (math.inf, 2), (3.0, 3)], "v double, k int")
    assert [r["v"] for r in C.nan_to_null(nans).collect()] == [None, None, 3.0]
    day = spark.createDataFrame([(dt.date(2020, 2, 29),)], "Date date")
    assert tuple(C.calendar_parts(day).first())[1:] == (2020, 2, 29, 60)


def test_unpivot_keeps_every_cell_until_filtered(spark):
    rows = [("a", 1.0, None, 1.2), ("b", -0.25, 0.5, None)]
    wide = spark.createDataFrame(rows, f"site string, AOD_340nm float, AOD_870nm float, `{ANGSTROM}` float")
    assert wide_to_long(wide, ["site"], ["AOD_340nm", "AOD_870nm"]).count() == 4
    long = long_observations(wide, ["site", "Particle_type"])
    found = {(r.site, r.Wavelength_nm): (r.AOD_Value, r.Spectral_Band, r.Particle_type) for r in long.collect()}
    assert found == {
        ("a", 340.0): (1.0, "UV", "mixed"),
        ("b", 340.0): (0.0, "UV", None),
        ("b", 870.0): (0.5, "NIR", None),
    }
    nans = spark.createDataFrame([(NAN, 1.0), (None, 1.0)], "AOD_Value double, Wavelength_nm double")
    assert drop_null_measures(nans).count() == 1
    with pytest.raises(ValueError):
        long_observations(wide.select("site"))


def test_labels(spark):
    df = spark.createDataFrame([("s", 1.0, 2.0)], "site string, AOD_Value double, other double")
    long = with_labels(metrics_long(df, ["site"], ["AOD_Value", "other"]), {"other": "Other"})
    assert {(r.metric, r.value, r.label) for r in long.collect()} == {("AOD_Value", 1.0, "AOD"), ("other", 2.0, "Other")}


def test_filters(spark):
    rows = [("ASIA", "fine", 0.1, 1, 1), ("EUROPE", None, 0.5, 6, 0), (None, "mixed", 3.0, 12, 1), ("ASIA", "fine", None, 7, 1)]
    df = spark.createDataFrame(rows, "Continent string, Particle_type string, AOD_Value double, Month int, is_enriched int")
    assert filter_members(df, "Continent", []).count() == 4
    assert filter_members(df, "Continent", ["ASIA"], include_null=True).count() == 3
    assert filter_range(df, "AOD_Value", 0.1, 0.5).count() == 2
    assert filter_months(df, 20, 6).count() == 3
    assert filter_months(df, 6, 20).collect() == filter_months(df, 20, 6).collect()
    assert apply_filters(df, Filters()).count() == 1
    assert apply_filters(df, Filters(continents=[], particle_types=[])).count() == 3
    assert apply_filters(df, Filters(include_null=True)).count() == 3
    assert apply_filters(df, Filters(enriched=True, continents=[], particle_types=[], aod=(1, 5))).count() == 1
    assert apply_filters(df.select("Month"), Filters(months=(1, 6))).count() == 2
    nans = spark.createDataFrame([(NAN, 1.0), (None, 1.0), (1.0, 1.0)], "a double, b double")
    assert complete_cases(nans, ["a", "b"]).count() == 1
