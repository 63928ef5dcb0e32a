"""Observations, weather and country outlines derived from the order tables.

Stand-ins for the files of a network of stations: supplier = station, nation = country, region =
continent, line item = one observation, ship date = day.  Integer arithmetic up to one last
division, so that other engines come to the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.functions import col
from skyfact.functions.columns import fix_swapped_coords, round_coords
from skyfact.schemas import ANGSTROM, ELEV, LAT, LON, RAW_DATE, RAW_TIME, SITE, WATER, WEATHER_RENAME
from skyfact.sources.observations import clean_observations

BANDS = [340, 380, 400, 440, 500, 675, 870, 1020]
AOD_COLUMNS = [f"AOD_{w}nm" for w in BANDS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _aod(w: int) -> str:
    value = f"CAST((h * 7 + {w}) % 3500 AS DOUBLE) / 1000"
    case = f"CASE WHEN (h + {w}) % 11 = 0 THEN -999.0D WHEN (h + {w}) % 17 = 0 THEN -0.01D ELSE {value} END"
    return f"CAST({case} AS FLOAT) AS AOD_{w}nm"


def obs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw wide row per line item, with markers, text dates, swapped and impossible positions."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    stations = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS s", "s_nationkey AS k")
    # No hint: the stored size of the station table decides how it is joined.
    df = items.join(stations, items.l_suppkey == stations.s).selectExpr(
        "s",
        "l_quantity",
        "l_shipdate AS d",
        "(l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 1000 AS h",
        "-100 + 40 * (k % 5) + CASE WHEN s % 10 = 7 THEN 35 ELSE s % 31 END AS x",
        "-50 + 20 * FLOOR(k / 5) + (s * 3) % 16 AS y",
    )
    lost, swapped = "s % 29 = 3", "s % 2 = 1 AND abs(x) > 90"
    return df.selectExpr(
        f"concat('site_', s) AS `{SITE}`",
        f"date_format(d, 'dd:MM:yyyy') AS `{RAW_DATE}`",
        f"CASE WHEN h % 97 = 0 THEN '25:00:00' ELSE format_string('%02d:%02d:00', h % 24, h % 60) END AS `{RAW_TIME}`",
        "CAST(dayofyear(d) + CASE WHEN h % 101 = 0 THEN 1 ELSE 0 END AS FLOAT) AS Day_of_Year",
        f"CAST(CASE WHEN h % 13 = 0 THEN -999.0D ELSE l_quantity / 10 END AS FLOAT) AS `{WATER}`",
        f"CAST(CASE WHEN h % 19 = 0 THEN -999.0D ELSE CAST(h % 700 - 120 AS DOUBLE) / 100 END AS FLOAT) AS `{ANGSTROM}`",
        f"CAST(CASE WHEN {lost} THEN 95 WHEN {swapped} THEN x ELSE y END AS FLOAT) AS `{LAT}`",
        f"CAST(CASE WHEN {lost} THEN -200 WHEN {swapped} THEN y ELSE x END AS FLOAT) AS `{LON}`",
        f"CAST(s * 10 + CASE WHEN s % 6 = 0 AND year(d) >= 1999 THEN 5 ELSE 0 END AS FLOAT) AS `{ELEV}`",
        "CASE WHEN h % 10 = 0 THEN 'lev15' ELSE 'lev20' END AS Data_Quality_Level",
        "CAST(h % 25 AS INT) AS `N[AOD_500nm]`",
        *[_aod(w) for w in BANDS],
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned wide table, without the columns that only the profile looks at."""
    return clean_observations(obs_wide(spark, sf_dir).drop(RAW_TIME, "Data_Quality_Level", "N[AOD_500nm]"))


def country_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outline per nation: a box, a box with a hole, two boxes, or a box that reaches into the next."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")

    def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return F.array(
            *[F.struct(a.cast("double").alias("lon"), b.cast("double").alias("lat")) for a, b in corners]
        )

    x, y = -100 + 40 * (k % 5), -50 + 20 * F.floor(k / 5)
    wide = F.when(k % 5 == 2, 45).otherwise(30)
    whole = box(x, y, x + wide, y + 15)
    hole = box(x + 10, y + 4, x + 16, y + 9)
    west, east = box(x, y, x + 12, y + 15), box(x + 18, y, x + 30, y + 15)
    rings = F.when(k % 5 == 1, F.array(whole, hole)).when(k % 5 == 3, F.array(west, east)).otherwise(F.array(whole))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("Country"), F.col("r_name").alias("Continent"), rings.alias("rings")
    )


TEETH = 960


def detailed_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outline of about two thousand sides per nation: a slanted box whose level sides are toothed."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    x, y = -100 + 40 * (F.col("n_nationkey") % 5), -50 + 20 * F.floor(F.col("n_nationkey") / 5)

    def row(first: int, last: int, step: int, dx: int, dy: int) -> Column:
        corner = lambda i: F.struct((x + dx + i / 32).alias("lon"), (y + dy + (i % 2) / 4).alias("lat"))
        return F.transform(F.sequence(F.lit(first), F.lit(last), F.lit(step)), corner)

    ring = F.concat(row(0, TEETH, 1, 0, 0), row(TEETH, 0, -1, 8, 15))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("Country"), F.col("r_name").alias("Continent"), F.array(ring).alias("rings")
    )


def station_days(wide: DataFrame) -> DataFrame:
    """Distinct (Date, Latitude, Longitude) of the cleaned observations."""
    df = wide.select(
        "Date", col(LAT).cast("double").alias("Latitude"), col(LON).cast("double").alias("Longitude")
    )
    return round_coords(fix_swapped_coords(df)).distinct()


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_of(observations(spark, sf_dir))


def weather_of(wide: DataFrame) -> DataFrame:
    """Daily weather for a third of the station days; some rows come twice, some with a second value."""
    d, q = F.dayofyear("Date"), (F.col("Latitude") * 7 + F.col("Longitude") * 3 + 2000).cast("int")
    days = station_days(wide).withColumns({"d": d, "q": q}).filter("(d + q) % 3 = 0")
    copies = F.when((F.col("d") + F.col("q")) % 30 == 0, F.array(F.lit(0), F.lit(0))).when(
        (F.col("d") + F.col("q")) % 33 == 0, F.array(F.lit(0), F.lit(1))
    )
    rows = days.withColumn("v", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    d, q, v = F.col("d"), F.col("q"), F.col("v")
    # Small integer formulas, divided once.
    measures = {
        "temperature_2m_mean": ((d * 3 + q) % 400 - 100 + v).cast("double") / 10,
        "sunshine_duration": ((d * 101 + q * 7) % 43200).cast("double"),
        "wind_speed_10m_max": ((d * 11 + q * 5) % 900).cast("double") / 10,
        "wind_direction_10m_dominant": ((d * 13 + q) % 360).cast("double"),
        "shortwave_radiation_sum": ((d * 17 + q * 3) % 3000).cast("double") / 100,
        "et0_fao_evapotranspiration": ((d * 5 + q * 2) % 900).cast("double") / 100,
        "relative_humidity_2m_mean": ((d * 7 + q * 11) % 1000).cast("double") / 10,
    }
    return rows.select(
        F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        "Latitude",
        "Longitude",
        *[measures[c].alias(c) for c in WEATHER_RENAME],
    )
