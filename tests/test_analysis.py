from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyfact.operators import analysis as A
from skyfact.operators import profile as P
from skyfact.operators.histogram import histogram
from skyfact.operators.quantiles import quantiles, quantiles_wide
from skyfact.operators.spatial import locate_country, multiple_matches, polygon_matches
from skyfact.plans.page import figures
from skyfact.schemas import POLYGON_SCHEMA

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
FLOATS = st.lists(st.floats(-1e6, 1e6, allow_nan=False, width=32), min_size=1, max_size=60)


def frame(spark, values, name="v"):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], f"{name} double")


@QUICK
@given(FLOATS)
def test_quantiles_of_anything(spark, values):
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles_wide(P.column_values(frame(spark, values), ["v"]), probs, list("abcde")).first()
    assert np.allclose([got[c] for c in "abcde"], np.quantile(np.array(values, dtype=float), probs), rtol=1e-12, atol=1e-9)


def test_quantiles_with_a_hot_value(spark):
    """A third of all values is the same, and the table is far longer than the sketch is exact."""
    df = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 7919 % 100_003) / 1000.0).alias("v"),
        ((F.col("id") * 31) % 1009).cast("double").alias("w"),
    )
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = {(r.column, r.prob): r.quantile for r in quantiles(P.column_values(df, ["v", "w"]), probs).collect()}
    table = df.toPandas()
    for c in ("v", "w"):
        assert np.allclose([got[c, p] for p in probs], np.quantile(table[c], probs), rtol=1e-12)


def test_quantiles_skip_missing(spark):
    df = frame(spark, [None, float("nan"), 1.0, 2.0])
    assert quantiles(P.column_values(df, ["v"]), [0.5]).first()["quantile"] == 1.5
    assert quantiles(P.column_values(frame(spark, [None]), ["v"]), [0.5]).count() == 0


def test_describe_and_box_against_pandas(spark, mart):
    cols = ["AOD_Value", "Angstrom_Exponent"]
    table = mart.select(cols).toPandas().astype(float)
    ref = table.describe()
    for r in P.describe_columns(mart, cols).collect():
        mine = [r["count"], r["mean"], r["std"], r["min"], r["q1"], r["median"], r["q3"], r["max"]]
        assert np.allclose(mine, ref[r["column"]].to_numpy(), rtol=1e-9)
    for r in P.box_stats(mart, cols).collect():
        v = table[r["column"]].dropna()
        lo, hi = r["q1"] - 1.5 * (r["q3"] - r["q1"]), r["q3"] + 1.5 * (r["q3"] - r["q1"])
        inside = v[(v >= lo) & (v <= hi)]
        assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (inside.min(), inside.max(), len(v) - len(inside))
    near = P.describe_columns(mart, cols, exact=False).collect()
    assert all(abs(r["median"] - ref.loc["50%", r["column"]]) < 0.02 for r in near)


@QUICK
@given(FLOATS, st.integers(1, 40))
def test_histogram_against_numpy(spark, values, bins):
    counts = {r["bin"]: r["count"] for r in histogram(frame(spark, values), "v", bins).collect()}
    assert sum(counts.values()) == len(values) and all(0 <= b < bins for b in counts)
    if len(set(values)) == 1:
        assert counts == {0: len(values)}


def test_histogram_bins(spark):
    df = frame(spark, [0.0, 0.1, 0.95, 1.0, None, float("nan"), float("inf")])
    got = {r["bin"]: (round(r.lower, 6), round(r.upper, 6), r["count"]) for r in histogram(df, "v", 10).collect()}
    assert got == {0: (0.0, 0.1, 1), 1: (0.1, 0.2, 1), 9: (0.9, 1.0, 2)}
    assert histogram(frame(spark, [None]), "v").count() == 0


def test_counts(spark):
    df = spark.createDataFrame([("a", -999.0, -1.0), ("b", 1.0, -2.0), ("a", -999.0, float("nan")), (None, 2.0, 0.0)], "s string, x float, y float")
    assert [(r.s, r["count"]) for r in A.count_by(df, "s").collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert [(r.s, r["count"]) for r in P.value_counts(df, "s").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in P.sentinel_counts(df, ["x", "y"]).collect()] == [("x", 2)]
    assert [tuple(r) for r in P.negative_counts(df, ["x", "y"]).collect()] == [("x", 2), ("y", 2)]
    assert [tuple(r) for r in P.column_info(df).collect()] == [("s", 3, "string"), ("x", 4, "float"), ("y", 4, "float")]
    assert [r.s for r in P.last_rows(df, 2, ["s"]).collect()] == ["a", "b"]
    assert P.first_rows(df, 3).count() == 3


def test_correlation_and_line_against_pandas(spark, mart):
    rows = mart.filter("is_enriched = 1")
    table = rows.select(A.CORR_COLUMNS).toPandas().astype(float).dropna()
    ref = table.corr()
    got = A.corr_matrix(rows).collect()
    assert len(got) == 49
    assert all(abs(r.r - ref.loc[r.x, r.y]) < 1e-9 for r in got)
    fit = A.ols(rows, "temperature_mean", "AOD_Value").first()
    m, b = np.polyfit(table["temperature_mean"], table["AOD_Value"], 1)
    assert fit.slope == pytest.approx(m, abs=1e-9) and fit.intercept == pytest.approx(b, abs=1e-9)
    line = A.ols_line(rows, "temperature_mean", "AOD_Value").toPandas()
    assert np.allclose(line.x, np.linspace(table.temperature_mean.min(), table.temperature_mean.max(), 100))


def test_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "x double, y double")
    assert A.ols(df, "x", "y").first()["slope"] is None and A.ols_line(df, "x", "y").count() == 0
    assert {(r.x, r.y): r.r for r in A.corr_matrix(df, ["x", "y"]).collect()}["x", "y"] is None
    assert A.ols(df.limit(1), "x", "y").first()["slope"] is None
    with pytest.raises(A.MissingColumns):
        A.corr_matrix(df, ["x", "z"])


def test_marker_sizes(spark):
    df = frame(spark, [1.0, 2.0, 3.0, None])
    assert [r["size"] for r in A.marker_size(df, "v").orderBy("v").collect()] == [None, 6.0, 14.0, 22.0]
    assert {r["size"] for r in A.marker_size(frame(spark, [2.0, 2.0]), "v").collect()} == {14.0}
    assert {r["size"] for r in A.marker_size(frame(spark, [None]), "v").collect()} == {14.0}


def test_map_layers(spark):
    rows = [("A", 1.0, 2.0, 0.2, 10.0), ("A", 1.0, 2.0, 0.4, 20.0), ("B", 5.0, 6.0, 0.9, None), ("C", None, 6.0, 9.0, 1.0)]
    df = spark.createDataFrame(rows, "Site string, Latitude double, Longitude double, AOD_Value double, temperature_mean double")
    got = {(r.Site, r.layer): (r.value and round(r.value, 6), r["size"]) for r in A.map_layers(df, list(A.LAYERS)).collect()}
    assert got == {
        ("A", "AOD"): (0.3, 6.0), ("B", "AOD"): (0.9, 22.0),
        ("A", "Temperatura"): (15.0, 14.0), ("B", "Temperatura"): (None, 14.0),
    }
    assert {r["size"] for r in A.map_layers(df, ["AOD"], "fixed").collect()} == {10.0}
    with pytest.raises(A.MissingColumns):
        A.map_layers(df, ["Humedad"])


def test_page(spark, mart):
    plans = figures(mart)
    assert len(plans) == 12
    total = mart.filter("Continent IS NOT NULL AND Particle_type IS NOT NULL").count()
    for name in ("count_continent", "count_particle", "hist_aod"):
        assert plans[name].agg(F.sum("count")).first()[0] == total
    assert set(figures(mart.select("Continent", "AOD_Value"))) == {"count_continent", "hist_aod"}


SQUARE = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0)]
HOLE = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]
TRIANGLE = [(20.0, 0.0), (30.0, 0.0), (25.0, 9.5)]
ISLE = [(40.0, 40.0), (41.0, 40.0), (41.0, 41.0), (40.0, 41.0)]
OTHER = [(9.0, 0.0), (15.0, 0.0), (15.0, 10.0), (9.0, 10.0), (9.0, 0.0)]
CASES = [
    (1, 2.0, 2.0, "Square"), (2, 5.0, 5.0, None), (3, 5.0, 4.0, "Square"), (4, 0.0, 0.0, "Square"), (5, 0.0, 5.5, "Square"),
    (6, 25.0, 3.0, "Triangle"), (7, 20.5, 3.0, None), (8, 40.5, 40.5, "Triangle"), (9, 9.5, 5.0, "Other"), (10, 10.0, 5.0, "Other"),
    (11, 12.0, 10.0, "Other"), (12, -5.0, -5.0, None), (13, 25.0, 9.5, "Triangle"), (14, 9.0, 5.0, "Square"), (15, 25.0, 0.0, "Triangle"),
]


def polygons(spark):
    data = [("Square", "P", [SQUARE, HOLE]), ("Triangle", "Q", [TRIANGLE, ISLE]), ("Other", "R", [OTHER])]
    return spark.createDataFrame(data, POLYGON_SCHEMA)


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_points_in_polygons(spark, monkeypatch, broadcast_rows):
    """Inside, hole, edge, corner, open ring, several parts, overlap: within beats touching, then the name."""
    from skyfact.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", broadcast_rows)
    points = spark.createDataFrame([c[:3] for c in CASES], "id int, Longitude double, Latitude double")
    got = {r.id: r.Country for r in locate_country(points, polygons(spark)).collect()}
    assert got == {c[0]: c[3] for c in CASES}
    wide = {r.id: r.Country for r in locate_country(points, polygons(spark), cell=7.0).collect()}
    assert wide == got
    assert {r.id: r["polygons"] for r in multiple_matches(points, polygons(spark)).collect()} == {9: 2, 10: 2, 14: 2}


def test_even_odd_against_brute_force(spark):
    rng = np.random.default_rng(7)
    ring = [(float(a), float(b)) for a, b in zip(np.cos(np.linspace(0, 6.2, 40)) * rng.uniform(3, 20, 40), np.sin(np.linspace(0, 6.2, 40)) * rng.uniform(3, 20, 40))]
    pts = pd.DataFrame({"id": range(400), "Longitude": rng.uniform(-21, 21, 400), "Latitude": rng.uniform(-21, 21, 400)})

    def inside(x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * ((y - y1) / (y2 - y1)) + x1:
                odd = not odd
        return odd

    star = spark.createDataFrame([("S", "T", [ring])], POLYGON_SCHEMA)
    got = {r.id: r.Country is not None for r in locate_country(spark.createDataFrame(pts), star).collect()}
    assert got == {r.id: inside(r.Longitude, r.Latitude) for r in pts.itertuples()}


def even_odd(ring, x, y):
    """Whether points are inside, by all sides of the ring."""
    odd = np.zeros(len(x), bool)
    for (x1, y1), (x2, y2) in zip(ring, np.roll(ring, -1, axis=0)):
        if y1 != y2:
            odd ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * ((y - y1) / (y2 - y1)) + x1)
    return odd


@pytest.mark.parametrize("most", [2, 24])
def test_cells_of_any_size_give_the_same(spark, most):
    """A star, a comb of long and short sides, and a fan of sides that all meet in one point; points on cell borders too."""
    from skyfact.operators import spatial

    rng = np.random.default_rng(11)
    turn = np.linspace(0, 2 * np.pi, 60, endpoint=False)
    star = np.stack([np.cos(turn), np.sin(turn)], 1) * rng.uniform(2, 30, (60, 1))
    comb = np.array([(float(i // 2), 20.0 * (i % 2)) for i in range(40)] + [(20.0, -3.0), (0.0, -3.0)])
    fan = np.array([p for i in range(30) for p in ((1.0, 1.0), (10.0, i / 4.0), (10.0, i / 4.0 + 0.1))])
    gate = np.array([(-12.0, -30.0), (-2.0, -30.0), (-2.0, -20.0), (6.0, -20.0), (6.0, -30.0), (18.0, -30.0), (18.0, -15.0), (-12.0, -15.0)])
    shapes = {"star": star, "comb": comb, "fan": fan, "gate": gate, "etag": gate[::-1]}
    frame = spark.createDataFrame([(n, "K", [[(float(a), float(b)) for a, b in r]]) for n, r in shapes.items()], POLYGON_SCHEMA)
    x, y = rng.uniform(-31, 31, 1500), rng.uniform(-31, 31, 1500)
    border = spatial.SHIFT + spatial.ROOT_DEGREES / 2 ** rng.integers(0, 6, 300) * rng.integers(-8, 8, 300)
    x[:300], y[200:500] = border, border
    x[500:700], y[500:700] = rng.integers(-14, 20, 200) + 0.5, rng.choice([-30.0, -20.0, -15.0], 200)  # level with sides
    points = spark.createDataFrame(pd.DataFrame({"id": range(1500), "Longitude": x, "Latitude": y}))
    found = polygon_matches(points, frame, most=most, deepest=9).filter("within").select("id", "_country").collect()
    for name, ring in shapes.items():
        on = np.zeros(len(x), bool)
        for (x1, y1), (x2, y2) in zip(ring, np.roll(ring, -1, axis=0)):
            on |= (y1 == y2) & (y == y1) & (x >= min(x1, x2)) & (x <= max(x1, x2))
        assert {r.id for r in found if r["_country"] == name} == set(np.flatnonzero(even_odd(ring, x, y) & ~on).tolist())


def test_outline_of_very_many_sides(spark):
    """200,000 sides: a point meets few of them, no row of the index holds many, and the answer is right."""
    from skyfact.operators import spatial

    n = 200_000
    rng = np.random.default_rng(5)
    turn = np.linspace(0, 2 * np.pi, n, endpoint=False)
    ring = np.stack([np.cos(turn), np.sin(turn)], 1) * (40 + 3 * np.sin(97 * turn) + 1e-3 * rng.standard_normal(n))[:, None]
    corners = spark.createDataFrame(pd.DataFrame({"i": range(n), "lon": ring[:, 0], "lat": ring[:, 1]}))
    rings = corners.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "lon", "lat"))), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("ring"))
    outline = rings.select(F.lit("Round").alias("Country"), F.lit("K").alias("Continent"), F.array("ring").alias("rings"))
    index = spatial.polygon_cells(outline)
    most, cells = index.agg(F.max(F.size("edges")), F.count("*")).first()
    assert most <= spatial.MAX_SIDES and cells < n
    x, y = rng.uniform(-45, 45, 4000), rng.uniform(-45, 45, 4000)
    x[:2000] = ring[:: n // 2000, 0] + rng.normal(0, 0.01, 2000)
    y[:2000] = ring[:: n // 2000, 1] + rng.normal(0, 0.01, 2000)
    points = spark.createDataFrame(pd.DataFrame({"id": range(4000), "Longitude": x, "Latitude": y}))
    got = {r.id for r in locate_country(points, outline).filter("Country IS NOT NULL").select("id").collect()}
    assert got == set(np.flatnonzero(even_odd(ring, x, y)).tolist())


def test_points_without_a_place(spark):
    rows = [(1, None, 2.0), (2, 2.0, None), (3, float("nan"), 2.0), (4, float("inf"), 2.0), (5, 2.0, 2.0), (5, 2.0, 2.0)]
    frame = spark.createDataFrame(rows, "id int, Longitude double, Latitude double")
    got = sorted((r.id, r.Country) for r in locate_country(frame, polygons(spark)).collect())
    assert got == [(1, None), (2, None), (3, None), (4, None), (5, "Square")]
    assert polygon_matches(frame, polygons(spark)).filter("within").count() == 2
    none = locate_country(frame, polygons(spark).limit(0)).collect()
    assert len(none) == 5 and all(r.Country is None for r in none)


def test_points_on_slanted_sides(spark):
    """Points computed on slanted sides are on them, whatever the rounding; others are not."""
    rng = np.random.default_rng(3)
    ring = [(float(a), float(b)) for a, b in rng.uniform(-60, 60, (7, 2))]
    rows = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        for t in (0.25, 0.5, 0.75, 0.1, 1 / 3):
            rows.append((len(rows), x1 + (x2 - x1) * t, y1 + (y2 - y1) * t))
    shape = spark.createDataFrame([("S", "T", [ring])], POLYGON_SCHEMA)
    frame = spark.createDataFrame(rows, "id int, Longitude double, Latitude double")
    got = polygon_matches(frame, shape).collect()
    assert len(got) == len(rows) and all(r.touches and not r.within for r in got)
    away = spark.createDataFrame([(i, x + 1e-3, y + 1.7e-3) for i, x, y in rows], "id int, Longitude double, Latitude double")
    assert sum(bool(r.touches) == bool(r.within) for r in polygon_matches(away, shape).collect()) == len(rows)


def test_few_candidates_for_a_point(spark):
    """900 polygons in four root cells: a point meets those of its small cell, and one that lies under all of them."""
    box = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    at = [(0.5 * i, 0.5 * j) for i in range(30) for j in range(30)]
    boxes = [(f"c{n}", "K", [box(x, y, 0.4)]) for n, (x, y) in enumerate(at)] + [("under", "K", [box(-20.0, -20.0, 60.0)])]
    points = spark.createDataFrame([(n, x + 0.2, y + 0.2) for n, (x, y) in enumerate(at)], "id int, Longitude double, Latitude double")
    pairs = polygon_matches(points, spark.createDataFrame(boxes, POLYGON_SCHEMA)).collect()
    met = pd.Series([r.id for r in pairs]).value_counts()
    assert met.max() <= 25
    assert {(r.id, r["_country"]) for r in pairs if r.within} == {(n, c) for n in range(900) for c in (f"c{n}", "under")}


def test_quantiles_of_very_many_values(spark):
    """Millions of distinct values: exact, and no window over a whole column."""
    from skyfact.operators.quantiles import quantiles

    n = 2_000_000
    frame = spark.range(0, n, 1, 8).select(F.lit("a").alias("column"), ((F.col("id") * 7919) % n / 16.0).alias("value"))
    df = quantiles(frame, [0.0, 0.25, 0.5, 0.999, 1.0])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(column" not in plan or "part" in plan
    for line in plan.splitlines():
        if "windowspecdefinition(column" in line:
            assert "part#" in line
    got = {r.prob: r["quantile"] for r in df.collect()}
    assert got == {p: pytest.approx(p * (n - 1) / 16.0) for p in got}


def test_quantiles_raise_where_the_sketch_misses(spark, monkeypatch):
    from skyfact.operators import quantiles as Q

    monkeypatch.setattr(Q, "FEW_ROWS", 0)
    monkeypatch.setattr(Q, "SLACK", -0.2)
    frame = spark.range(1000).select(F.lit("a").alias("column"), F.col("id").cast("double").alias("value"))
    with pytest.raises(Exception, match="encloses? it|enclose"):
        Q.quantiles(frame, [0.5]).collect()


def test_scatter_matrix_bins(spark, mart):
    rows = mart.filter("is_enriched = 1")
    table = rows.select(A.SCATTER_COLUMNS).toPandas().astype(float).dropna()
    got = A.scatter_matrix_bins(rows, bins=7).collect()
    assert len({(r.x, r.y) for r in got}) == 10 and len(got) <= 10 * 49
    for pair in {(r.x, r.y) for r in got}:
        assert sum(r["count"] for r in got if (r.x, r.y) == pair) == len(table)
        ref = np.histogram2d(table[pair[0]], table[pair[1]], 7)[0]
        assert sum(r["count"] for r in got if (r.x, r.y) == pair and r.x_bin == 0) == pytest.approx(ref[0].sum(), abs=2)
    flat = spark.createDataFrame([(1.0, 2.0, 0.0), (1.0, 3.0, 1.0), (None, 4.0, 1.0), (float("nan"), 4.0, 1.0)], "a double, b double, c double")
    got = {(r.x, r.y, r.x_bin, r.y_bin): (r.x_low, r.y_low, r["count"]) for r in A.scatter_matrix_bins(flat, ["a", "b", "c"], 2).collect()}
    assert got == {
        ("a", "b", 0, 0): (1.0, 2.0, 1), ("a", "b", 0, 1): (1.0, 2.5, 1), ("a", "c", 0, 0): (1.0, 0.0, 1),
        ("a", "c", 0, 1): (1.0, 0.5, 1), ("b", "c", 0, 0): (2.0, 0.0, 1), ("b", "c", 1, 1): (2.5, 0.5, 1),
    }
    assert A.scatter_matrix_bins(flat.limit(0), ["a", "b"]).count() == 0
    with pytest.raises(A.MissingColumns):
        A.scatter_matrix_bins(flat, ["a", "z"])
