"""The registered queries once more, as plain SQL for another engine over the same tables.

Written from the definition of each result, not from the Spark plans: countries, for instance, come
from box arithmetic here and from ray casting there.
"""

from __future__ import annotations

from skyfact.operators.analysis import CORR_COLUMNS as CORR
from skyfact.operators.analysis import SCATTER_COLUMNS as SCATTER
from skyfact.plans.roundtrips import BAD_CELL, BAD_DATE, EMPTY_CELL, NAN_CELL, SKETCHED_DAYS
from skyfact.schemas import WEATHER_MEASURES as MEASURES
from skyfact.sources.views import AOD_COLUMNS as AOD
from skyfact.sources.views import BANDS, TEETH



def _csv(items) -> str:
    return ", ".join(items)


def _raw_aod(w: int) -> str:
    return (
        f"CAST(CASE WHEN (h + {w}) % 11 = 0 THEN -999.0 WHEN (h + {w}) % 17 = 0 THEN -0.01 "
        f"ELSE CAST((h * 7 + {w}) % 3500 AS DOUBLE) / 1000 END AS FLOAT) AS AOD_{w}nm"
    )


_SWAPPED = "(abs(lat) > 90 AND abs(lon) <= 90)"
_CLASS = "CASE WHEN {0} IS NULL THEN NULL WHEN {0} >= 1.5 THEN 'fine' WHEN {0} <= 1.0 THEN 'coarse' ELSE 'mixed' END"
_BAND = "CASE WHEN {0} < 400 THEN 'UV' WHEN {0} <= 700 THEN 'VIS' ELSE 'NIR' END"
_SENS = "CASE WHEN {0} <= 500 THEN 'fine-sensitive' WHEN {0} >= 800 THEN 'coarse-sensitive' ELSE 'balanced' END"
_TRUE_BOX = "lon > x0 AND lon < x1 AND lat > y0 AND lat < y1"
_FACT_ORDER = _csv(
    f"{c} NULLS FIRST"
    for c in (
        "id_wavelength", "id_date", "id_site", "Particle_type", "AOD_Value", "Precipitable_Water", "Angstrom_Exponent",
    )
)

CTES = {
    "base": """SELECT s_suppkey AS s, s_nationkey AS k, l_quantity, CAST(l_shipdate AS DATE) AS d,
        (l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 1000 AS h
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "xy": """SELECT *, -100 + 40 * (k % 5) + CASE WHEN s % 10 = 7 THEN 35 ELSE s % 31 END AS x,
        -50 + 20 * (k // 5) + (s * 3) % 16 AS y FROM base""",
    "raw": f"""SELECT 'site_' || s AS site, d,
        CAST(dayofyear(d) + CASE WHEN h % 101 = 0 THEN 1 ELSE 0 END AS INTEGER) AS source_doy,
        CASE WHEN h % 97 = 0 THEN '25:00:00' ELSE printf('%02d:%02d:00', h % 24, h % 60) END AS raw_time,
        CAST(CASE WHEN h % 13 = 0 THEN -999.0 ELSE l_quantity / 10 END AS FLOAT) AS water,
        CAST(CASE WHEN h % 19 = 0 THEN -999.0 ELSE CAST(h % 700 - 120 AS DOUBLE) / 100 END AS FLOAT) AS angstrom,
        CAST(CASE WHEN s % 29 = 3 THEN 95 WHEN s % 2 = 1 AND abs(x) > 90 THEN x ELSE y END AS DOUBLE) AS lat,
        CAST(CASE WHEN s % 29 = 3 THEN -200 WHEN s % 2 = 1 AND abs(x) > 90 THEN y ELSE x END AS DOUBLE) AS lon,
        CAST(s * 10 + CASE WHEN s % 6 = 0 AND year(d) >= 1999 THEN 5 ELSE 0 END AS DOUBLE) AS elev,
        CASE WHEN h % 10 = 0 THEN 'lev15' ELSE 'lev20' END AS level, CAST(h % 25 AS INTEGER) AS n500,
        {_csv(_raw_aod(w) for w in BANDS)} FROM xy""",
    "obs": f"""SELECT site, d, source_doy, n500, CAST(nullif(water, -999) AS DOUBLE) AS water,
        CAST(nullif(angstrom, -999) AS DOUBLE) AS angstrom,
        lat AS lat0, lon AS lon0, elev,
        CASE WHEN {_SWAPPED} THEN lon ELSE lat END AS lat, CASE WHEN {_SWAPPED} THEN lat ELSE lon END AS lon,
        {_csv(f"CAST(nullif({c}, -999) AS DOUBLE) AS {c}" for c in AOD)} FROM raw""",
    "longs": f"""SELECT site, d, lat, lon, elev, water, angstrom, {_CLASS.format("angstrom")} AS particle,
        unnest([{_csv(map(str, BANDS))}]) AS w, unnest([{_csv(AOD)}]) AS v FROM obs""",
    "measured": "SELECT * EXCLUDE (v), CASE WHEN v < 0 THEN 0 ELSE v END AS v FROM longs WHERE v IS NOT NULL",
    "dw": f"""SELECT CAST(row_number() OVER (ORDER BY w) AS INTEGER) AS id_wavelength, CAST(w AS DOUBLE) AS Wavelength_nm,
        {_BAND.format("w")} AS Spectral_Band, {_SENS.format("w")} AS Sensitive_Aerosol
        FROM (SELECT unnest([{_csv(map(str, BANDS))}]) AS w) AS t""",
    "dd": """SELECT CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS id_date, d, CAST(year(d) AS INTEGER) AS "Year",
        CAST(month(d) AS INTEGER) AS "Month", CAST(day(d) AS INTEGER) AS "Day",
        CAST(dayofyear(d) AS INTEGER) AS Day_of_Year FROM (SELECT DISTINCT d FROM obs WHERE d IS NOT NULL) AS t""",
    "outline": """SELECT n_nationkey AS k, n_name, r_name, -100 + 40 * (n_nationkey % 5) AS x,
        -50 + 20 * (n_nationkey // 5) AS y FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "boxes": """SELECT k, n_name, r_name, x AS x0, y AS y0, x + CASE WHEN k % 5 = 2 THEN 45 ELSE 30 END AS x1,
        y + 15 AS y1 FROM outline WHERE k % 5 <> 3
        UNION ALL SELECT k, n_name, r_name, x, y, x + 12, y + 15 FROM outline WHERE k % 5 = 3
        UNION ALL SELECT k, n_name, r_name, x + 18, y, x + 30, y + 15 FROM outline WHERE k % 5 = 3""",
    "points": "SELECT DISTINCT lat, lon FROM obs",
    "corners": f"""SELECT k, n_name, r_name, x, y, i AS no, x + i / 32.0 AS px, y + (i % 2) / 4.0 AS py FROM outline, range({TEETH + 1}) AS t(i)
        UNION ALL SELECT k, n_name, r_name, x, y, {2 * TEETH + 1} - i, x + 8 + i / 32.0, y + 15 + (i % 2) / 4.0 FROM outline, range({TEETH + 1}) AS t(i)""",
    "sides": """SELECT *, coalesce(lead(px) OVER w, first_value(px) OVER w) AS qx, coalesce(lead(py) OVER w, first_value(py) OVER w) AS qy
        FROM corners WINDOW w AS (PARTITION BY k ORDER BY no)""",
    "detailed": """SELECT lat, lon, n_name, r_name, CASE WHEN edge THEN 1 ELSE 0 END AS grade FROM (SELECT lat, lon, n_name, r_name,
        count(*) FILTER (WHERE (py > lat) <> (qy > lat) AND lon < px + (qx - px) * (lat - py) / (qy - py)) % 2 = 1 AS odd,
        bool_or((qx - px) * (lat - py) = (qy - py) * (lon - px) AND lon BETWEEN least(px, qx) AND greatest(px, qx)
            AND lat BETWEEN least(py, qy) AND greatest(py, qy)) AS edge
        FROM points JOIN sides ON lon BETWEEN x AND x + 38 AND lat BETWEEN y AND y + 15.25 GROUP BY ALL) AS t WHERE odd OR edge""",
    "hits": f"""SELECT lat, lon, n_name, r_name, CASE WHEN {_TRUE_BOX} AND NOT (k % 5 = 1 AND
        lon BETWEEN x0 + 10 AND x0 + 16 AND lat BETWEEN y0 + 4 AND y0 + 9) THEN 0 ELSE 1 END AS grade
        FROM points JOIN boxes ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1
        WHERE NOT (k % 5 = 1 AND lon > x0 + 10 AND lon < x0 + 16 AND lat > y0 + 4 AND lat < y0 + 9)""",
    "located": """SELECT lat, lon, n_name, r_name FROM (SELECT *, row_number() OVER
        (PARTITION BY lat, lon ORDER BY grade, n_name) AS rn FROM hits) AS t WHERE rn = 1""",
    "places": """SELECT DISTINCT site, lat, lon, elev FROM obs
        WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180""",
    "ds": """SELECT row_number() OVER (ORDER BY site, p.lat, p.lon, elev) AS id_site, site, p.lat, p.lon, elev,
        n_name, r_name FROM places AS p LEFT JOIN located AS l ON p.lat = l.lat AND p.lon = l.lon""",
    "days": """SELECT *, CAST(lat * 7 + lon * 3 + 2000 AS INTEGER) AS q, CAST(dayofyear(d) AS INTEGER) AS n
        FROM (SELECT DISTINCT d, lat, lon FROM obs) AS t""",
    "held": """SELECT *, unnest(CASE WHEN (n + q) % 30 = 0 THEN [0, 0] WHEN (n + q) % 33 = 0 THEN [0, 1] ELSE [0] END)
        AS v FROM days WHERE (n + q) % 3 = 0""",
    "weather": """SELECT d, lat, lon,
        CAST((n * 3 + q) % 400 - 100 + v AS DOUBLE) / 10 AS temperature_mean,
        CAST((n * 17 + q * 3) % 3000 AS DOUBLE) / 100 AS radiation_sum,
        CAST((n * 7 + q * 11) % 1000 AS DOUBLE) / 10 AS humidity_mean,
        CAST((n * 11 + q * 5) % 900 AS DOUBLE) / 10 AS wind_speed_max,
        CAST((n * 13 + q) % 360 AS DOUBLE) AS wind_direction_dominant,
        CAST((n * 5 + q * 2) % 900 AS DOUBLE) / 100 AS evapotranspiration,
        CAST((n * 101 + q * 7) % 43200 AS DOUBLE) AS sunshine_duration_sec FROM held""",
    "wkey": f"""SELECT *, row_number() OVER (ORDER BY d, lat, lon) AS id_weather FROM (SELECT *, row_number() OVER
        (PARTITION BY d, lat, lon ORDER BY {_csv(MEASURES)}) AS rn FROM weather) AS t WHERE rn = 1""",
    "keyed": """SELECT id_date, id_wavelength, id_site, particle AS Particle_type, v AS AOD_Value,
        water AS Precipitable_Water, angstrom AS Angstrom_Exponent, m.d, ds.lat, ds.lon
        FROM measured AS m LEFT JOIN dd ON m.d = dd.d LEFT JOIN dw ON m.w = dw.Wavelength_nm
        LEFT JOIN ds ON m.site = ds.site AND m.lat = ds.lat AND m.lon = ds.lon AND m.elev = ds.elev""",
    "fact": f"""SELECT row_number() OVER (ORDER BY {_FACT_ORDER}) AS Fact_ID, keyed.* EXCLUDE (d, lat, lon), id_weather,
        CASE WHEN id_weather IS NULL THEN 0 ELSE 1 END AS is_enriched
        FROM keyed LEFT JOIN wkey ON keyed.d = wkey.d AND keyed.lat = wkey.lat AND keyed.lon = wkey.lon""",
    "mart": f"""SELECT ds.site AS "Site", ds.lat AS Latitude, ds.lon AS Longitude, n_name AS Country, r_name AS Continent,
        strftime(dd.d, '%Y-%m-%d') AS "Date", "Year", "Month", Day_of_Year, Wavelength_nm, Spectral_Band,
        Particle_type, AOD_Value, Precipitable_Water, Angstrom_Exponent, is_enriched, {_csv(MEASURES)}
        FROM fact LEFT JOIN dd ON fact.id_date = dd.id_date LEFT JOIN dw ON fact.id_wavelength = dw.id_wavelength
        LEFT JOIN ds ON fact.id_site = ds.id_site LEFT JOIN wkey ON fact.id_weather = wkey.id_weather""",
    "page": """SELECT * FROM mart WHERE Continent IS NOT NULL AND Particle_type IS NOT NULL
        AND AOD_Value IS NOT NULL AND "Month" BETWEEN 1 AND 12""",
    "rich": "SELECT * FROM page WHERE is_enriched = 1",
    "bad": """SELECT CASE WHEN c = 1 THEN -Fact_ID ELSE Fact_ID END AS Fact_ID,
        CASE WHEN Fact_ID % 991 = 4 THEN NULL ELSE id_date END AS id_date, id_wavelength,
        CASE WHEN Fact_ID % 997 = 3 THEN 1000000007 ELSE id_site END AS id_site,
        CASE WHEN Fact_ID % 983 = 5 THEN 'dust' ELSE Particle_type END AS Particle_type,
        CASE WHEN Fact_ID % 977 = 6 THEN -1.0 WHEN Fact_ID % 971 = 7 THEN 3.75 ELSE AOD_Value END AS AOD_Value,
        CASE WHEN Fact_ID % 967 = 8 THEN -1.0 ELSE Precipitable_Water END AS Precipitable_Water,
        Angstrom_Exponent, id_weather, is_enriched
        FROM (SELECT *, unnest(CASE WHEN Fact_ID % 1000 = 1 THEN [0, 0] WHEN Fact_ID % 1013 = 2 THEN [0, 1]
        ELSE [0] END) AS c FROM fact) AS t""",
    "bad_dw": """SELECT * REPLACE (CASE WHEN id_wavelength = 2 THEN 'NIR' ELSE Spectral_Band END AS Spectral_Band)
        FROM dw""",
}


def _q(body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in CTES.items()) + "\n" + body


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _hist(source: str, name: str, bins: int) -> str:
    return _q(f"""SELECT bin, round(lo + bin * width, 6) AS lower, round(lo + (bin + 1) * width, 6) AS upper, count(*) AS count
        FROM (SELECT CAST(least(floor((v - lo) / width), {bins - 1}) AS INTEGER) AS bin, lo, width
        FROM (SELECT {name} AS v FROM {source} WHERE {name} IS NOT NULL) AS a,
        (SELECT min({name}) AS lo, (max({name}) - min({name})) / {bins} AS width FROM {source}) AS b) AS t
        GROUP BY bin, lo, width""")


def _describe(c: str, source: str = "raw") -> str:
    v = f"CAST({c[1]} AS DOUBLE)"
    parts = [f"round(avg({v}), 4) AS mean", f"round(stddev_samp({v}), 4) AS std"]
    parts += [f"round(min({v}), 4) AS min"]
    for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
        parts.append(f"round(quantile_cont({v}, {p}), 4) AS {n}")
    return f"SELECT '{c[0]}' AS \"column\", count({v}) AS count, {_csv(parts)}, round(max({v}), 4) AS max FROM {source}"


def _box(c: str) -> str:
    return f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(*) AS count,
        round(min(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS whisker_low,
        round(max(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS whisker_high,
        count(*) FILTER (WHERE NOT v BETWEEN lo AND hi) AS outliers,
        count(*) FILTER (WHERE v BETWEEN -0.01 AND 0.5) AS in_window
        FROM (SELECT {c} AS v FROM obs WHERE {c} IS NOT NULL) AS a,
        (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT quantile_cont({c}, 0.25) AS q1,
        quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM obs) AS x) AS b GROUP BY q1, median, q3"""


def _counts(cols: dict[str, str], source: str, test: str) -> str:
    rows = (f"SELECT '{n}' AS \"column\", count(*) FILTER (WHERE {c} {test}) AS count FROM {source}" for n, c in cols.items())
    return _q(f"SELECT * FROM ({_union(rows)}) AS t WHERE count > 0")


def _checks(fact: str, dw: str) -> str:
    """All quality checks as (check, failed, checked)."""
    joined = f"""(SELECT f.*, dd.d, dd.Day_of_Year, w.Wavelength_nm, w.Spectral_Band, w.Sensitive_Aerosol, ds.lat, ds.lon,
        wkey.id_weather AS found FROM {fact} AS f LEFT JOIN dd ON f.id_date = dd.id_date
        LEFT JOIN {dw} AS w ON f.id_wavelength = w.id_wavelength LEFT JOIN ds ON f.id_site = ds.id_site
        LEFT JOIN wkey ON dd.d = wkey.d AND ds.lat = wkey.lat AND ds.lon = wkey.lon) AS j"""
    rules = {
        **{
            f"null_{c}": f"{c} IS NULL"
            for c in ("id_date", "id_wavelength", "id_site", "AOD_Value", "Precipitable_Water", "Angstrom_Exponent")
        },
        "particle_mismatch": f"Particle_type <> {_CLASS.format('Angstrom_Exponent')}",
        "aod_negative": "AOD_Value < 0",
        "aod_extreme": "AOD_Value > 3",
        "water_negative": "Precipitable_Water < 0",
        "angstrom_out_of_range": "Angstrom_Exponent < -1 OR Angstrom_Exponent > 5",
        "fk_miss_date": "d IS NULL",
        "fk_miss_wavelength": "Wavelength_nm IS NULL",
        "fk_miss_site": "lat IS NULL",
        "doy_mismatch": "Day_of_Year <> dayofyear(d)",
        "band_mismatch": f"Wavelength_nm IS NOT NULL AND Spectral_Band IS DISTINCT FROM {_BAND.format('Wavelength_nm')}",
        "sensitivity_mismatch": f"Wavelength_nm IS NOT NULL AND Sensitive_Aerosol IS DISTINCT FROM {_SENS.format('Wavelength_nm')}",
        "lat_out_of_range": "lat NOT BETWEEN -90 AND 90",
        "lon_out_of_range": "lon NOT BETWEEN -180 AND 180",
        "weather_unmatched": "found IS NULL",
    }
    cells = [f"struct_pack(a := '{n}', b := count(*) FILTER (WHERE {r}), c := count(*))" for n, r in rules.items()]
    cells.append("struct_pack(a := 'weather_missing', b := 0, c := count(found))")
    cells.append("struct_pack(a := 'duplicate_ids', b := count(*) - count(DISTINCT Fact_ID), c := count(*))")
    triple = f"SELECT count(*) AS n FROM {fact} GROUP BY id_date, id_wavelength, id_site"
    return f"""SELECT r.a AS "check", CAST(r.b AS BIGINT) AS failed, CAST(r.c AS BIGINT) AS checked
        FROM (SELECT unnest([{_csv(cells)}]) AS r FROM {joined}) AS t
        UNION ALL SELECT 'duplicate_keys', CAST(sum(n - 1) AS BIGINT), CAST(sum(n) AS BIGINT) FROM ({triple}) AS g"""


def _score() -> str:
    pct = lambda name: f"(100.0 * (1.0 - {name} / facts))"
    nulls = [
        f"round({pct('null_' + c)}, 4)"
        for c in ("id_date", "id_wavelength", "id_site", "AOD_Value", "Precipitable_Water", "Angstrom_Exponent")
    ]
    cons = [pct(c) for c in ("fk_miss_date", "fk_miss_wavelength", "fk_miss_site", "doy_mismatch", "particle_mismatch", "band_mismatch")]
    cons.append("100.0 * (1.0 - weather_missing / eligible)")
    valid = [pct(c) for c in ("aod_negative", "water_negative", "angstrom_out_of_range", "lat_out_of_range", "lon_out_of_range")]
    names = [
        "null_id_date", "null_id_wavelength", "null_id_site", "null_AOD_Value", "null_Precipitable_Water",
        "null_Angstrom_Exponent", "fk_miss_date", "fk_miss_wavelength", "fk_miss_site", "doy_mismatch", "particle_mismatch",
        "band_mismatch", "weather_missing", "weather_unmatched", "aod_negative", "water_negative",
        "angstrom_out_of_range", "lat_out_of_range", "lon_out_of_range", "duplicate_ids", "duplicate_keys",
    ]
    picks = [f"CAST(max(CASE WHEN \"check\" = '{n}' THEN failed END) AS DOUBLE) AS {n}" for n in names]
    picks.append("max(CASE WHEN \"check\" = 'duplicate_ids' THEN checked END) AS facts")
    picks.append("max(CASE WHEN \"check\" = 'weather_missing' THEN checked END) AS eligible")
    mean = lambda parts: f"(({' + '.join(parts)}) / {len(parts)})"
    return _q(f"""SELECT round((a + b + c + e) / 4, 6) AS overall, round(a, 6) AS completeness, round(b, 6) AS consistency,
        round(c, 6) AS uniqueness, round(e, 6) AS validity, round(100.0 * (1.0 - weather_missing / eligible), 2) AS coverage,
        round({pct("weather_unmatched")}, 2) AS true_coverage, facts, (a + b + c + e) / 4 >= 90 AS passed
        FROM (SELECT *, {mean(nulls)} AS a, {mean(cons)} AS b,
        CAST(100 - CASE WHEN duplicate_ids > 0 THEN 20 ELSE 0 END - CASE WHEN duplicate_keys > 0 THEN 20 ELSE 0 END AS DOUBLE)
        AS c, {mean(valid)} AS e FROM (SELECT {_csv(picks)} FROM ({_checks("fact", "dw")}) AS k) AS p) AS s""")


def _violations() -> str:
    tables = {"dim_wavelength": "bad_dw", "dim_date": "dd", "dim_site": "ds", "dim_weather": "wkey", "fact_aod": "bad"}
    required = {
        "dim_wavelength": ["id_wavelength", "Wavelength_nm"],
        "dim_date": ["id_date", "Date", "Year", "Month", "Day", "Day_of_Year"],
        "dim_site": ["id_site"],
        "dim_weather": ["id_weather"],
        "fact_aod": ["Fact_ID", "id_date", "id_wavelength", "id_site", "AOD_Value", "is_enriched"],
    }
    unique = [
        ("dim_wavelength", "id_wavelength", "primary key"), ("dim_wavelength", "Wavelength_nm", "unique"),
        ("dim_date", "id_date", "primary key"), ("dim_date", "Date", "unique"), ("dim_site", "id_site", "primary key"),
        ("dim_weather", "id_weather", "primary key"), ("fact_aod", "Fact_ID", "primary key"),
    ]
    foreign = {"id_date": "dd", "id_wavelength": "bad_dw", "id_site": "ds", "id_weather": "wkey"}
    name = lambda c: "d" if c == "Date" else f'"{c}"'
    row = lambda t, r, c, n, rest: (
        f"SELECT '{t}' AS \"table\", '{r}' AS rule, '{c}' AS \"column\", {n} AS violations FROM {rest}"
    )
    rows = [row(t, r, c, f"count({name(c)}) - count(DISTINCT {name(c)})", tables[t]) for t, c, r in unique]
    for t, cols in required.items():
        rows += [row(t, "not null", c, f"count(*) - count({name(c)})", tables[t]) for c in cols]
    limits = [
        ("dim_wavelength", "Spectral_Band", "Spectral_Band", 10), ("dim_wavelength", "Sensitive_Aerosol", "Sensitive_Aerosol", 20),
        ("dim_site", "AERONET_Site", "site", 150), ("dim_site", "Country", "n_name", 120), ("dim_site", "Continent", "r_name", 60),
        ("fact_aod", "Particle_type", "Particle_type", 10),
    ]
    rows += [row(t, "length", c, f"count(*) FILTER (WHERE length({e}) > {n})", tables[t]) for t, c, e, n in limits]
    for c, target in foreign.items():
        rows.append(
            row("fact_aod", "foreign key", c, "count(*)", f"bad WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {target})")
        )
    return _q(_union(rows))


def _layers() -> str:
    layers = {"AOD": "AOD_Value", "Temperatura": "temperature_mean", "Humedad": "humidity_mean"}
    means = _union(
        f'SELECT "Site", Latitude, Longitude, Continent, \'{n}\' AS layer, avg({c}) AS value FROM rich '
        'WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL GROUP BY "Site", Latitude, Longitude, Continent'
        for n, c in layers.items()
    )
    return _q(f"""SELECT "Site", Latitude, Longitude, Continent, layer, round(value, 5) AS value,
        round((value - lo) / (hi - lo) * 16 + 6, 5) AS size FROM (SELECT *, min(value) OVER (PARTITION BY layer) AS lo,
        max(value) OVER (PARTITION BY layer) AS hi FROM ({means}) AS m) AS t""")


def _corr() -> str:
    full = " AND ".join(f"{c} IS NOT NULL" for c in CORR)
    return _q(
        _union(
            f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM rich WHERE {full}" for a in CORR for b in CORR
        )
    )


def _ols(x: str) -> str:
    return _q(f"""SELECT count(*) AS n, round(regr_slope(AOD_Value, {x}), 6) AS slope,
        round(regr_intercept(AOD_Value, {x}), 6) AS intercept, min({x}) AS x_min, max({x}) AS x_max FROM rich
        WHERE {x} IS NOT NULL AND AOD_Value IS NOT NULL""")


def _sample(source: str) -> str:
    return _q(f"""SELECT Fact_ID, strftime(dd.d, '%Y-%m-%d') AS "Date", ds.site, n_name AS Country, r_name AS Continent,
        ds.lat AS Latitude, ds.lon AS Longitude, f.id_wavelength, Wavelength_nm, Spectral_Band, Particle_type, AOD_Value,
        Precipitable_Water, Angstrom_Exponent FROM ({source}) AS f LEFT JOIN dd ON f.id_date = dd.id_date
        LEFT JOIN dw ON f.id_wavelength = dw.id_wavelength LEFT JOIN ds ON f.id_site = ds.id_site""")


_LOT = "md5('42:' || CAST(Fact_ID AS VARCHAR)), Fact_ID"
_DAY = "strftime(d, '%Y-%m-%d') AS \"Date\""
_PROFILED = {
    "Day_of_Year": "source_doy",
    "N[AOD_500nm]": "n500",
    "Precipitable_Water(cm)": "water",
    "440-870_Angstrom_Exponent": "angstrom",
    "Site_Latitude(Degrees)": "lat",
    "Site_Longitude(Degrees)": "lon",
    "Site_Elevation(m)": "elev",
    **{c: c for c in AOD},
}
_INFO = {
    "AERONET_Site": ("site", "string"), "Date(dd:mm:yyyy)": ("d", "string"), "Time(hh:mm:ss)": ("raw_time", "string"),
    "Data_Quality_Level": ("level", "string"), **{k: (v, "int" if v == "n500" else "float") for k, v in _PROFILED.items()},
}
_FACT = ["id_date", "id_wavelength", "id_site", "Particle_type", "AOD_Value", "Precipitable_Water", "Angstrom_Exponent"]
_DATED = ["d", "lat", "lon"]
_REQUEST = f"SELECT DISTINCT {_DAY}, lat AS Latitude, lon AS Longitude FROM obs AS o WHERE d IS NOT NULL " \
    "AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"
_NOT_HELD = " AND NOT EXISTS (SELECT 1 FROM weather AS w WHERE w.d = o.d AND w.lat = o.lat AND w.lon = o.lon)"


def oracle_sql() -> dict[str, str]:
    sql = {
        "clean_wide": _q(f"""SELECT site, {_DAY}, CAST(source_doy AS DOUBLE) AS Day_of_Year, water, angstrom, lat0 AS lat,
            lon0 AS lon, elev, {_csv(AOD)} FROM obs"""),
        "time_counts": _q("SELECT raw_time AS time, count(*) AS count FROM raw WHERE raw_time < '24' GROUP BY raw_time"),
        "sentinel_counts": _counts(_PROFILED, "raw", "= -999"),
        "negative_counts": _counts({c: c for c in AOD}, "obs", "< 0"),
        "describe_columns": _q(_union(_describe(c) for c in _PROFILED.items())),
        "column_info": _q(
            _union(
                f"SELECT '{n}' AS \"column\", count({c}) AS non_null, '{t}' AS type FROM raw" for n, (c, t) in _INFO.items()
            )
        ),
        "box_stats": _q(_union(_box(c) for c in AOD)),
        "hist_angstrom": _hist("obs", "angstrom", 40),
        "hist_water": _hist("obs", "water", 40),
        "site_value_counts": _q("SELECT site, count(*) AS count FROM raw GROUP BY site"),
        "quality_level_counts": _q("SELECT level AS Data_Quality_Level, count(*) AS count FROM raw GROUP BY level"),
        "rows_per_year": _q("SELECT CAST(year(d) AS INTEGER) AS year, count(*) AS count FROM raw GROUP BY year(d)"),
        "site_coordinates": _q("SELECT lat AS Latitude, lon AS Longitude, count(*) AS count FROM raw GROUP BY lat, lon"),
        "site_rows": _q(f"""SELECT {_DAY}, CAST(source_doy AS DOUBLE) AS Day_of_Year, water, angstrom FROM obs
            WHERE site = 'site_7'"""),
        "last_rows": _q(f"""SELECT {_DAY}, site, AOD_500nm AS aod, water FROM obs ORDER BY d DESC, site DESC,
            AOD_500nm DESC NULLS LAST, water DESC NULLS LAST LIMIT 5"""),
        "source_doy_mismatch": _q("""SELECT count(*) FILTER (WHERE source_doy <> dayofyear(d)) AS failed,
            count(*) AS checked FROM obs"""),
        "long_aod": _q(f"""SELECT site, {_DAY}, particle AS Particle_type, 'AOD_' || w || 'nm' AS AOD_band, v AS AOD_Value,
            CAST(w AS DOUBLE) AS Wavelength_nm, {_BAND.format("w")} AS Spectral_Band, {_SENS.format("w")} AS Sensitive_Aerosol
            FROM measured"""),
        "dim_wavelength_schema": _q("""SELECT dw.*, coalesce(n, 0) AS measured FROM dw
            LEFT JOIN (SELECT w, count(v) AS n FROM measured GROUP BY w) AS m ON m.w = dw.Wavelength_nm"""),
        "dim_wavelength_data": _q(f"""SELECT CAST(row_number() OVER (ORDER BY w) AS INTEGER) AS id_wavelength,
            CAST(w AS DOUBLE) AS Wavelength_nm, {_BAND.format("w")} AS Spectral_Band, {_SENS.format("w")} AS Sensitive_Aerosol
            FROM (SELECT DISTINCT w FROM measured) AS t"""),
        "dim_date": _q(f'SELECT id_date, {_DAY}, "Year", "Month", "Day", Day_of_Year FROM dd'),
        "dim_site": _q("""SELECT id_site, site, lat AS Latitude, lon AS Longitude, elev AS Elevation, n_name AS Country,
            r_name AS Continent FROM ds"""),
        "dim_weather": _q(f"SELECT id_weather, {_csv(MEASURES)} FROM wkey"),
        "dim_weather_all_rows": _q(f"""SELECT row_number() OVER (ORDER BY {_csv(_DATED + MEASURES)}) AS id_weather,
            {_csv(MEASURES)} FROM (SELECT DISTINCT * FROM weather) AS t"""),
        "weather_key_map": _q(f"SELECT {_DAY}, lat AS Latitude, lon AS Longitude, id_weather FROM wkey"),
        "weather_conflicts": _q(f"""SELECT {_DAY}, lat AS Latitude, lon AS Longitude, count(*) AS variants
            FROM (SELECT DISTINCT * FROM weather) AS t GROUP BY d, lat, lon HAVING count(*) > 1"""),
        "country_overlaps": _q("""SELECT site, o.lat AS Latitude, o.lon AS Longitude, count(DISTINCT n_name) AS polygons
            FROM (SELECT DISTINCT site, lat, lon FROM obs) AS o JOIN hits ON o.lat = hits.lat AND o.lon = hits.lon
            GROUP BY site, o.lat, o.lon HAVING count(DISTINCT n_name) > 1"""),
        "country_join": _q("""SELECT p.lat AS Latitude, p.lon AS Longitude, n_name AS Country, r_name AS Continent
            FROM points AS p LEFT JOIN located AS l ON p.lat = l.lat AND p.lon = l.lon"""),
        "country_join_detailed": _q("""SELECT p.lat AS Latitude, p.lon AS Longitude, n_name AS Country, r_name AS Continent FROM points AS p
            LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY lat, lon ORDER BY grade, n_name) AS rn FROM detailed) AS l
            ON p.lat = l.lat AND p.lon = l.lon AND rn = 1"""),
        "fact_star": _q(f"SELECT Fact_ID, {_csv(_FACT)} FROM fact"),
        "fact_by_site_name": _q(f"""SELECT row_number() OVER (ORDER BY {_FACT_ORDER}) AS Fact_ID, {_csv(_FACT)} FROM
            (SELECT id_date, id_wavelength, id_site, particle AS Particle_type, v AS AOD_Value, water AS Precipitable_Water,
            angstrom AS Angstrom_Exponent FROM measured AS m LEFT JOIN dd ON m.d = dd.d
            LEFT JOIN dw ON m.w = dw.Wavelength_nm LEFT JOIN ds ON m.site = ds.site) AS t"""),
        "fact_unenriched": _q("""SELECT id_wavelength, 0 AS is_enriched, count(*) AS facts, CAST(0 AS BIGINT) AS with_weather
            FROM keyed GROUP BY id_wavelength"""),
        "fact_enriched": _q("SELECT Fact_ID, id_date, id_wavelength, id_site, id_weather, is_enriched FROM fact"),
        "fact_rejects": _q("""SELECT Fact_ID, id_date, id_wavelength, id_site, AOD_Value FROM fact
            WHERE id_date IS NULL OR id_wavelength IS NULL OR id_site IS NULL OR AOD_Value IS NULL"""),
        "fk_misses": _q(
            _union(
                f"SELECT '{n}' AS dimension, count(*) FILTER (WHERE t.{k} IS NULL) AS misses FROM bad "
                f"LEFT JOIN {t} AS t ON bad.{k} = t.{k}"
                for n, k, t in (("date", "id_date", "dd"), ("wavelength", "id_wavelength", "bad_dw"), ("site", "id_site", "ds"))
            )
        ),
        "weather_requests": _q(_REQUEST),
        "weather_requests_left": _q(_REQUEST + _NOT_HELD),
        "weather_missing": _q(_REQUEST + _NOT_HELD),
        "dashboard_mart": _q("SELECT * FROM mart"),
        "mart_filtered": _q("""SELECT "Site", "Date", Wavelength_nm, Continent, Particle_type, AOD_Value FROM mart
            WHERE is_enriched = 1 AND Continent IN ('ASIA', 'EUROPE') AND Particle_type IN ('fine', 'mixed')
            AND AOD_Value BETWEEN 0.1 AND 3.0 AND "Month" BETWEEN 4 AND 9"""),
        "continent_options": _q("SELECT DISTINCT Continent FROM mart WHERE Continent IS NOT NULL"),
        "aod_bounds": _q("SELECT min(AOD_Value) AS lo, max(AOD_Value) AS hi FROM mart"),
        "count_continent": _q("SELECT Continent, count(*) AS count FROM page GROUP BY Continent"),
        "count_continent_all": _q("SELECT Continent, count(*) AS count FROM mart GROUP BY Continent"),
        "count_particle": _q("SELECT Particle_type, count(*) AS count FROM page GROUP BY Particle_type"),
        "trend_day": _q("SELECT Day_of_Year, round(avg(AOD_Value), 6) AS AOD_Value FROM page GROUP BY Day_of_Year"),
        "trend_month": _q("""SELECT "Month", round(avg(AOD_Value), 6) AS AOD_mean,
            round(avg(temperature_mean), 6) AS temp_mean FROM rich GROUP BY "Month" """),
        "map_layers": _layers(),
        "map_layers_fixed": _q("""SELECT "Site", Latitude, Longitude, Continent, 'AOD' AS layer,
            round(avg(AOD_Value), 6) AS value, CAST(10 AS DOUBLE) AS size FROM rich
            WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL GROUP BY "Site", Latitude, Longitude, Continent"""),
        "month_metrics": _q(
            _union(
                f"SELECT \"Month\", '{m}' AS metric, round(avg({c}), 6) AS value, '{n}' AS label FROM rich GROUP BY \"Month\""
                for m, c, n in (("AOD_mean", "AOD_Value", "AOD"), ("temp_mean", "temperature_mean", "Temp"))
            )
        ),
        "corr_matrix": _corr(),
        "ols_temperature": _ols("temperature_mean"),
        "ols_humidity": _ols("humidity_mean"),
        "ols_line": _q("""SELECT CAST(i AS INTEGER) AS i, round(lo + i * (hi - lo) / 99, 6) AS x,
            round(m * (lo + i * (hi - lo) / 99) + b, 6) AS y FROM (SELECT regr_slope(AOD_Value, temperature_mean) AS m,
            regr_intercept(AOD_Value, temperature_mean) AS b, min(temperature_mean) AS lo, max(temperature_mean) AS hi
            FROM rich) AS f, range(100) AS r(i)"""),
        "hist_aod": _hist("page", "AOD_Value", 30),
        "scatter_temperature": _q("""SELECT temperature_mean, AOD_Value, Particle_type FROM rich
            WHERE temperature_mean IS NOT NULL AND AOD_Value IS NOT NULL AND Particle_type IS NOT NULL"""),
        "scatter_matrix": _q(f"SELECT {_csv(SCATTER)} FROM rich WHERE {' AND '.join(f'{c} IS NOT NULL' for c in SCATTER)}"),
        "dq_checks": _q(_checks("fact", "dw")),
        "dq_report": _score(),
        "dq_defects": _q(_checks("bad", "bad_dw")),
        "constraint_violations": _violations(),
        "sample_geo": _sample(f"SELECT * FROM fact ORDER BY {_LOT} LIMIT 50"),
        "sample_strata": _sample(f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_wavelength ORDER BY {_LOT})
            AS rn FROM fact) AS t WHERE rn <= 5"""),
        "sample_half": _q(f"""SELECT Fact_ID, id_wavelength, AOD_Value FROM (SELECT *, row_number() OVER (ORDER BY {_LOT}) AS rn,
            count(*) OVER () AS n FROM fact) AS t WHERE rn <= n // 2"""),
        "sample_front": _q(f"""SELECT Fact_ID, id_wavelength, AOD_Value FROM (SELECT *, row_number() OVER (ORDER BY id_wavelength, {_LOT}) AS rn,
            count(*) OVER () AS n FROM fact) AS t WHERE rn <= n // 5"""),
        "scatter_matrix_bins": _pair_bins(20),
        **_round_trips(),
    }
    return sql


def _pair_bins(bins: int) -> str:
    full = " AND ".join(f"{c} IS NOT NULL" for c in SCATTER)
    ends = _csv(f"min({c}) AS lo{i}, (max({c}) - min({c})) / {bins} AS w{i}" for i, c in enumerate(SCATTER))
    place = lambda i: f"CAST(least(floor(({SCATTER[i]} - lo{i}) / w{i}), {bins - 1}) AS INTEGER)"
    rows = [
        f"""SELECT '{SCATTER[i]}' AS x, '{SCATTER[j]}' AS y, {place(i)} AS x_bin, {place(j)} AS y_bin, round(any_value(lo{i}) + {place(i)} * any_value(w{i}), 6) AS x_low,
        round(any_value(lo{j}) + {place(j)} * any_value(w{j}), 6) AS y_low, count(*) AS count FROM chosen, ends GROUP BY {place(i)}, {place(j)}"""
        for i in range(len(SCATTER)) for j in range(i + 1, len(SCATTER))
    ]
    chosen = f"chosen AS (SELECT {_csv(SCATTER)} FROM rich WHERE {full}), ends AS (SELECT {ends} FROM chosen)"
    return _q("").rstrip() + ",\n" + chosen + "\n" + _union(rows)


def _round_trips() -> dict[str, str]:
    aod = _csv([f"CASE WHEN n500 IN ({BAD_CELL}, {NAN_CELL}, {EMPTY_CELL}) THEN NULL ELSE AOD_340nm END AS AOD_340nm", *AOD[1:]])
    sides = {"x0": "min(x0)", "x1": "max(x1)", "y0": "min(y0)", "y1": "max(y1)"}
    return {
        "csv_ingest": _q(f"""SELECT obs.site, CASE WHEN n500 <> {BAD_DATE} THEN strftime(obs.d, '%Y-%m-%d') END AS "Date", obs.water,
            lat0 AS lat, lon0 AS lon, {aod} FROM obs"""),
        "csv_times": _q("""SELECT CASE WHEN raw_time < '24' THEN raw_time END AS time, count(*) AS count FROM raw GROUP BY 1"""),
        "star_round_trip": _q(f"""SELECT Fact_ID, {_csv("fact." + c for c in _FACT)}, n_name AS Country, "Month" FROM fact
            LEFT JOIN ds ON fact.id_site = ds.id_site LEFT JOIN dd ON fact.id_date = dd.id_date"""),
        "weather_files": _q(
            _union(
                f"SELECT {_DAY}, lat AS Latitude, lon AS Longitude, {_csv(MEASURES)}, '{k}' AS kind FROM weather" for k in ("parquet", "csv", "json")
            )
        ),
        "geojson_countries": _q(f"""SELECT n_name AS Country, r_name AS Continent, CAST(n AS INTEGER) AS rings, CAST(5 * n AS INTEGER) AS points,
            {_csv(f"CAST({e} AS DOUBLE) AS {n}" for e, n in zip(sides, ("min_lon", "max_lon", "min_lat", "max_lat")))} FROM
            (SELECT n_name, r_name, {_csv(f"{v} AS {k}" for k, v in sides.items())}, max(CASE WHEN k % 5 IN (1, 3) THEN 2 ELSE 1 END) AS n
            FROM boxes GROUP BY n_name, r_name) AS t"""),
        "mart_csv": _q("""SELECT "Site", "Date", CAST("Month" AS DOUBLE) AS "Month", Wavelength_nm, Country, Particle_type, AOD_Value, temperature_mean, is_enriched FROM mart"""),
        "warehouse_load": _q("""SELECT Fact_ID, id_date, id_wavelength, id_site, id_weather, AOD_Value, CASE WHEN id_date IS NULL OR
            id_wavelength IS NULL OR id_site IS NULL OR AOD_Value IS NULL THEN 'rejected' ELSE 'loaded' END AS status FROM fact"""),
        "warehouse_dims": _q("""SELECT id_site, site, lat AS Latitude, lon AS Longitude, elev AS Elevation, n_name AS Country, r_name AS Continent FROM ds"""),
        "fact_upgraded": _q("""SELECT Fact_ID, id_date, id_site, CAST(NULL AS BIGINT) AS id_weather, AOD_Value, 0 AS is_enriched FROM fact"""),
        "fact_mixed_folder": _q("""SELECT Fact_ID, id_date, id_site, CASE WHEN Fact_ID % 2 = 1 THEN id_weather END AS id_weather, AOD_Value,
            CASE WHEN Fact_ID % 2 = 1 THEN is_enriched ELSE 0 END AS is_enriched FROM fact"""),
        "warehouse_two_loads": _q(f"""SELECT ds.site, n_name AS Country, {_DAY}, Wavelength_nm, AOD_Value, is_enriched FROM fact
            JOIN dd ON fact.id_date = dd.id_date JOIN dw ON fact.id_wavelength = dw.id_wavelength JOIN ds ON fact.id_site = ds.id_site"""),
        "quantiles_by_sketch": _q(_union(f"""SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS least, max({c}) AS largest, 0 AS off FROM obs
            WHERE d BETWEEN '{SKETCHED_DAYS[0]}' AND '{SKETCHED_DAYS[1]}'""" for c in AOD)),
        "bulk_csv": _q(f"SELECT Fact_ID, {_csv(_FACT)} FROM fact"),
        "sample_csv": _q(f"""SELECT Fact_ID, ds.site, n_name AS Country, AOD_Value FROM (SELECT * FROM fact ORDER BY {_LOT} LIMIT 50) AS f
            LEFT JOIN ds ON f.id_site = ds.id_site"""),
        "dq_record": f"""SELECT overall, completeness, consistency, uniqueness, validity, facts, CAST(3 AS BIGINT) AS parts, CAST(80 AS DOUBLE) AS threshold,
            'here' AS artifact, true AS used_weather, overall >= 80 AS passed, true AS stamped FROM ({_score()}) AS s""",
        "dq_text": f"""SELECT line, round(pct, 2) AS pct FROM (SELECT unnest(['Quality of the transformed data', 'Completeness', 'Consistency',
            'Uniqueness', 'Validity']) AS line, unnest([overall, completeness, consistency, uniqueness, validity]) AS pct FROM ({_score()}) AS s) AS t""",
        "count_columns": _q("SELECT n500 AS n, count(*) AS count FROM raw GROUP BY n500"),
        "fact_by_name_weather": _q("""SELECT id_site, CASE WHEN id_weather IS NULL THEN 0 ELSE 1 END AS is_enriched, count(*) AS facts,
            count(id_weather) AS with_weather, count(DISTINCT id_weather) AS weather_rows FROM measured AS m LEFT JOIN dd ON m.d = dd.d
            LEFT JOIN ds ON m.site = ds.site LEFT JOIN wkey ON m.d = wkey.d AND ds.lat = wkey.lat AND ds.lon = wkey.lon GROUP BY 1, 2"""),
        "scatter_bins": _q("""SELECT CAST(bx AS INTEGER) AS x_bin, CAST(by_ AS INTEGER) AS y_bin, round(x0 + bx * wx, 6) AS x, round(y0 + by_ * wy, 6) AS y, count(*) AS count
            FROM (SELECT least(floor((temperature_mean - x0) / wx), 19) AS bx, least(floor((AOD_Value - y0) / wy), 19) AS by_, x0, wx, y0, wy FROM rich,
            (SELECT min(temperature_mean) AS x0, (max(temperature_mean) - min(temperature_mean)) / 20 AS wx, min(AOD_Value) AS y0,
            (max(AOD_Value) - min(AOD_Value)) / 20 AS wy FROM rich) AS e WHERE temperature_mean IS NOT NULL AND AOD_Value IS NOT NULL) AS t
            GROUP BY bx, by_, x0, wx, y0, wy"""),
    }
