from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest

from skyfact.schemas import ANGSTROM, LAT, LON, RAW_DATE, RAW_TIME, SITE, WATER, detect_columns
from skyfact.sources.mart import read_mart_csv
from skyfact.sources.observations import (
    clean_observations,
    parse_obs_time,
    preflight,
    read_columns,
    read_fact,
    read_observations,
)
from skyfact.sources.polygons import read_country_polygons
from skyfact.sources.weather import latest_weather, read_weather

HEADER = f"{SITE},{RAW_DATE},{RAW_TIME},Day_of_Year,AOD_340nm,AOD_500nm,N[AOD_500nm],{WATER},{ANGSTROM},{LAT},{LON},Site_Elevation(m),Data_Quality_Level"
LINES = [
    "Good,09:02:2020,12:00:00,40,0.1,0.2,5,1.5,1.2,10.5,20.5,100,lev20",
    "BadDate,32:13:2020,12:00:00,40,0.1,0.2,5,1.5,1.2,10.5,20.5,100,lev20",
    "BadCell,9:2:2020,25:00:00,40,abc,0.2,5,1.5,1.2,10.5,20.5,100,lev20",
    "Empty,10:02:2020,12:00:00,41,,0.2,5,1.5,1.2,10.5,20.5,100,lev20",
    "Nan,11:02:2020,12:00:00,42,NaN,0.2,5,1.5,1.2,10.5,20.5,100,lev20",
    "Missing,12:02:2020,12:00:00,43,-999,-999.000000,5,-999.,1.2,10.5,20.5,100,lev15",
]


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "obs.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_detect_columns():
    use, aod = detect_columns(HEADER.split(","))
    assert aod == ["AOD_340nm", "AOD_500nm"] and use[0] == SITE and "N[AOD_500nm]" not in use and RAW_TIME not in use
    with pytest.raises(ValueError):
        detect_columns(["a", "AOD_nm", "N[AOD_500nm]"])


def test_csv_ingest(spark, csv_file):
    df = clean_observations(read_observations(spark, csv_file))
    rows = {r[SITE]: r for r in df.collect()}
    assert len(rows) == 6
    assert rows["Good"]["Date"] == dt.date(2020, 2, 9) and rows["BadCell"]["Date"] == dt.date(2020, 2, 9)
    assert rows["BadDate"]["Date"] is None and rows["BadDate"]["AOD_500nm"] == pytest.approx(0.2)
    for name in ("BadCell", "Empty", "Nan", "Missing"):
        assert rows[name]["AOD_340nm"] is None
    assert rows["BadCell"]["AOD_500nm"] == pytest.approx(0.2)
    assert rows["Missing"]["AOD_500nm"] is None and rows["Missing"][WATER] is None
    assert dict(df.dtypes)["AOD_340nm"] == "float" and RAW_DATE not in df.columns


def test_extra_columns_and_time(spark, csv_file):
    df = parse_obs_time(read_observations(spark, csv_file, [RAW_TIME, "Data_Quality_Level"]))
    got = {r[SITE]: (r[RAW_TIME], r["Data_Quality_Level"]) for r in df.collect()}
    assert got["Good"] == ("12:00:00", "lev20") and got["BadCell"] == (None, "lev20")


def test_iso_dates(spark, tmp_path):
    path = tmp_path / "iso.csv"
    path.write_text(f"{SITE},Date,AOD_500nm\nA,2020-02-09,0.1\nB,2020-13-40,0.1\n")
    rows = {r[SITE]: r["Date"] for r in clean_observations(read_observations(spark, str(path))).collect()}
    assert rows == {"A": dt.date(2020, 2, 9), "B": None}


def test_scan_reads_only_what_is_selected(spark, csv_file):
    plan = read_observations(spark, csv_file).select("AOD_500nm")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<AOD_500nm:float>" in plan


def test_preflight(spark, csv_file, tmp_path):
    preflight(spark, csv_file)
    with pytest.raises(FileNotFoundError, match="nowhere"):
        preflight(spark, str(tmp_path / "nowhere.csv"))
    empty = tmp_path / "empty.csv"
    empty.write_text(HEADER + "\n")
    with pytest.raises(ValueError, match="empty"):
        preflight(spark, str(empty))
    other = tmp_path / "other.csv"
    other.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="other.csv"):
        preflight(spark, str(other))


def test_stored_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id AS a", "id * 2 AS `b(c)`", "id AS d").write.parquet(path)
    df = read_columns(spark, path, ["b(c)"])
    assert df.columns == ["b(c)"] and df.count() == 3
    assert read_fact(spark, path).count() == 3
    with pytest.raises(FileNotFoundError):
        read_fact(spark, str(tmp_path / "none"))
    empty = str(tmp_path / "empty")
    spark.range(0).write.parquet(empty)
    with pytest.raises(FileNotFoundError):
        read_fact(spark, empty)


WEATHER = {
    "Date": "2020-02-09", "Latitude": 1.5, "Longitude": 2.5, "temperature_2m_mean": 10.0, "sunshine_duration": 100.0,
    "wind_speed_10m_max": 5.0, "wind_direction_10m_dominant": 90.0, "shortwave_radiation_sum": 7.0,
    "et0_fao_evapotranspiration": 1.0, "relative_humidity_2m_mean": 60.0,
}


def test_weather_formats(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps(WEATHER) + "\n")
    ref = read_weather(spark, str(tmp_path / "w.json"))
    assert ref.first().asDict() == {**WEATHER, **{k: v for k, v in ref.first().asDict().items() if k in WEATHER}}
    ref.write.option("header", True).csv(str(tmp_path / "w.csv"))
    ref.write.parquet(str(tmp_path / "w.parquet"))
    for name in ("w.csv", "w.parquet"):
        assert read_weather(spark, str(tmp_path / name)).collect() == ref.collect()


def test_latest_weather(spark, tmp_path):
    assert latest_weather(spark, str(tmp_path)) is None
    df = spark.createDataFrame([WEATHER])
    for i, name in enumerate(("weather_daily_b.parquet", "weather_daily_a.parquet", "other_c.parquet")):
        df.write.parquet(str(tmp_path / name))
        stamp = time.time() + 10 * i
        for part in (tmp_path / name).iterdir():
            os.utime(part, (stamp, stamp))
    df.toPandas().to_parquet(tmp_path / "weather_daily_0.parquet")
    os.utime(tmp_path / "weather_daily_0.parquet", (1, 1))
    assert latest_weather(spark, str(tmp_path)) == f"{tmp_path}/weather_daily_a.parquet"


def test_geojson(spark, tmp_path):
    box = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"ADMIN": "A", "CONTINENT": "X", "pop": 5}, "geometry": {"type": "Polygon", "coordinates": box}},
        {"type": "Feature", "properties": {"ADMIN": "B", "CONTINENT": "Y", "pop": 6}, "geometry": {"type": "MultiPolygon", "coordinates": [box, box]}},
    ]
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "c.geojsonl").write_text("\n".join(map(json.dumps, features)))
    for name in ("c.geojson", "c.geojsonl"):
        rows = {r.Country: r for r in read_country_polygons(spark, str(tmp_path / name)).collect()}
        assert rows["A"].Continent == "X" and len(rows["A"].rings) == 1 and len(rows["B"].rings) == 2
        assert rows["A"].rings[0][2] == (1.0, 1.0)
    stored = read_country_polygons(spark, str(tmp_path / "c.geojson"))
    stored.write.parquet(str(tmp_path / "c.parquet"))
    assert read_country_polygons(spark, str(tmp_path / "c.parquet")).count() == 2
    for f in features:
        del f["properties"]["CONTINENT"]
    (tmp_path / "d.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    with pytest.raises(ValueError, match="Continent"):
        read_country_polygons(spark, str(tmp_path / "d.geojson"))


def test_mart_csv(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("Site,AOD_Value,Month,count\nA,0.5,3,7\nB,oops,4,8\n")
    df = read_mart_csv(spark, str(path))
    assert dict(df.dtypes) == {"Site": "string", "AOD_Value": "double", "Month": "double", "count": "int"}
    assert [r["AOD_Value"] for r in df.orderBy("Site").collect()] == [0.5, None]


def test_mart_csv_reads_all_rows_before_it_types(spark, tmp_path):
    lines = [f"{i},0.5" for i in range(5200)] + ["ab,0.25", "9999999999,bad"]
    (tmp_path / "m.csv").write_text("Code,AOD_Value\n" + "\n".join(lines))
    df = read_mart_csv(spark, str(tmp_path / "m.csv"))
    assert dict(df.dtypes) == {"Code": "string", "AOD_Value": "double"}
    assert {r.Code for r in df.filter("Code > '9999'").collect()} >= {"ab", "9999999999"} and df.filter("Code IS NULL").isEmpty()
    assert df.filter("AOD_Value IS NULL").count() == 1


def _feature(name, continent="EUROPE"):
    box = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    props = {"ADMIN": name} | ({"CONTINENT": continent} if continent else {})
    return {"type": "Feature", "properties": props, "geometry": {"type": "Polygon", "coordinates": box}}


def test_geojson_lines_in_any_name(spark, tmp_path):
    """One feature per line under .json, a collection on one line, and a first feature that lacks a property."""
    features = [_feature("A", None), _feature("B"), _feature("C")]
    (tmp_path / "lines.json").write_text("\n" + "\n".join(map(json.dumps, features)))
    (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (tmp_path / "laid.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    for name in ("lines.json", "one.json", "laid.json"):
        got = read_country_polygons(spark, str(tmp_path / name)).collect()
        assert sorted((r.Country, r.Continent) for r in got) == [("A", None), ("B", "EUROPE"), ("C", "EUROPE")]
    (tmp_path / "none.json").write_text(json.dumps(_feature("A", None)))
    with pytest.raises(ValueError):
        read_country_polygons(spark, str(tmp_path / "none.json"))


def test_geojson_folder_of_several_layouts(spark, tmp_path):
    """Every file of a folder is read in its own layout; what the text names and reading doesn't give is an error."""
    folder = tmp_path / "mixed.json"
    folder.mkdir()
    feature = lambda n: json.dumps(_feature(n))
    (folder / "a lines.json").write_text(feature("L0") + "\n" + feature("L1") + "\n\n" + feature("L2") + "\n")
    (folder / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": [_feature("F0"), _feature("F1")]}, indent=1))
    (folder / "c.json").write_text('{"type":"FeatureCollection","features":[\n' + feature("G0") + ",\n" + feature("G1") + "\n]}")
    (folder / "d.json").write_text(json.dumps({"type": "FeatureCollection", "features": [_feature("H0")]}) + "\n" + feature("H1"))
    assert sorted(r.Country for r in read_country_polygons(spark, str(folder)).collect()) == ["F0", "F1", "G0", "G1", "H0", "H1", "L0", "L1", "L2"]
    (folder / "e.json").write_text(feature("X0") + "\n" + feature("X1")[:-5] + "\n")
    with pytest.raises(ValueError, match="e.json: 2 features in the text"):
        read_country_polygons(spark, str(folder))


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "obs").mkdir()
    names = ["AERONET_Site", "Date(dd:mm:yyyy)", "Day_of_Year", "Precipitable_Water(cm)", "440-870_Angstrom_Exponent", "Site_Latitude(Degrees)", "Site_Longitude(Degrees)", "Site_Elevation(m)"]
    row = "a,1:1:2020,1,1,1,1,1,1"
    (tmp_path / "obs" / "1.csv").write_text(",".join([*names, "AOD_340nm", "AOD_500nm"]) + f"\n{row},0.1,0.5\n")
    (tmp_path / "obs" / "2.csv").write_text(",".join([*names, "AOD_500nm", "AOD_340nm"]) + f"\n{row},0.5,0.1\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_observations(spark, str(tmp_path / "obs")).collect()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from skyfact import session

    conf = SimpleNamespace(get=lambda key, default=None: {"spark.sql.warehouse.dir": "/wh"}.get(key, default))
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077", applicationId="app-1")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(SimpleNamespace(conf=conf, sparkContext=context))
    context.master = "local[2]"
    assert session.scratch_dir(SimpleNamespace(conf=conf, sparkContext=context)) == "/wh/scratch/skyfact-app-1"


def test_other_files_make_another_warehouse(spark, tmp_path):
    """Stored tables are kept for the files they were made from, not for their path."""
    import shutil

    from skyfact.plans.warehouse import SOURCE_TABLES, Warehouse

    for name in SOURCE_TABLES:
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    first = Warehouse.of(spark, str(tmp_path))
    assert Warehouse.of(spark, str(tmp_path)) is first
    os.utime(tmp_path / "supplier.parquet", (1, 1))
    assert Warehouse.of(spark, str(tmp_path)) is not first
