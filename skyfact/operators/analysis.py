"""The queries behind the figures of the analysis page; each returns a small aggregate."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfact.functions import col, finite
from skyfact.operators.filters import complete_cases
from skyfact.operators.reshape import metrics_long

# Names of the map layers, marker sizes, and the variables of the correlation and scatter matrix.
LAYERS = {"AOD": "AOD_Value", "Temperatura": "temperature_mean", "Humedad": "humidity_mean"}
SIZE_MIN, SIZE_MAX, SIZE_FIXED = 6.0, 22.0, 10.0
CORR_COLUMNS = [
    "AOD_Value", "temperature_mean", "radiation_sum", "humidity_mean",
    "wind_speed_max", "evapotranspiration", "sunshine_duration_sec",
]
SCATTER_COLUMNS = ["AOD_Value", "Angstrom_Exponent", "temperature_mean", "humidity_mean", "radiation_sum"]


class MissingColumns(ValueError):
    """A figure asks for columns that the frame does not have."""


def _need(df: DataFrame, cols: list[str]) -> None:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise MissingColumns(f"missing columns: {absent}")


def count_by(df: DataFrame, name: str) -> DataFrame:
    """Rows per value, most first; rows without a value are a group."""
    _need(df, [name])
    counts = df.groupBy(col(name)).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), col(name))


def count_particle(df: DataFrame) -> DataFrame:
    return count_by(df, "Particle_type")


def trend_by_day(df: DataFrame) -> DataFrame:
    """Mean AOD per day of the year."""
    _need(df, ["Day_of_Year", "AOD_Value"])
    return df.groupBy("Day_of_Year").agg(F.avg("AOD_Value").alias("AOD_Value")).orderBy("Day_of_Year")


def trend_by_month(df: DataFrame) -> DataFrame:
    """Mean AOD and temperature per month."""
    _need(df, ["Month", "AOD_Value", "temperature_mean"])
    means = df.groupBy("Month").agg(
        F.avg("AOD_Value").alias("AOD_mean"), F.avg("temperature_mean").alias("temp_mean")
    )
    return means.orderBy("Month")


def marker_size(df: DataFrame, name: str, by: str | None = None, lo: float = SIZE_MIN, hi: float = SIZE_MAX) -> DataFrame:
    """Scale a measure to marker sizes ``lo``..``hi``, within each value of ``by``.

    Where all values are (nearly) equal or none is finite every marker gets the middle size.
    """
    v = finite(col(name).cast("double"))
    ends = (df.groupBy(by) if by else df).agg(F.min(v).alias("_min"), F.max(v).alias("_max"))
    if by:
        # ``by`` names the map layers, of which there are a handful.
        joined = df.join(F.broadcast(ends), by, "left")
        low, high = F.col("_min"), F.col("_max")
    else:
        pair = ends.select(F.struct("_min", "_max").alias("ends")).scalar()
        joined, low, high = df, pair.getField("_min"), pair.getField("_max")
    flat = low.isNull() | (F.abs(low - high) <= 1e-8 + 1e-5 * F.abs(high))
    scaled = F.try_divide(col(name) - low, high - low) * (hi - lo) + lo
    return joined.withColumn("size", F.when(flat, F.lit((lo + hi) / 2)).otherwise(scaled)).drop("_min", "_max")


def site_columns(df: DataFrame) -> list[str]:
    """What identifies a place on the map, as far as the frame has it."""
    name = ["Site"] if "Site" in df.columns else ["Site_Name"]
    return [c for c in [*name, "Latitude", "Longitude", "Continent"] if c in df.columns]


def map_layers(df: DataFrame, layers: list[str], size_mode: str = "value") -> DataFrame:
    """(place, layer, value, size): means per place for each layer, places without a position left out."""
    _need(df, ["Latitude", "Longitude"])
    chosen = {k: LAYERS[k] for k in layers if k in LAYERS and LAYERS[k] in df.columns}
    if not chosen:
        raise MissingColumns(f"no data for the layers {layers}")
    place = site_columns(df)
    means = df.groupBy(*place).agg(*[F.avg(c).alias(k) for k, c in chosen.items()])
    means = complete_cases(means, ["Latitude", "Longitude"])
    long = metrics_long(means, place, list(chosen)).withColumnRenamed("metric", "layer")
    if size_mode == "fixed":
        return long.withColumn("size", F.lit(SIZE_FIXED))
    return marker_size(long, "value", by="layer")


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(x, y, r) for all pairs of columns over the complete rows.

    Means first, then plain sums of centred products; null where a column is constant.
    """
    keep = [c for c in (cols or CORR_COLUMNS) if c in df.columns]
    if len(keep) < 2:
        raise MissingColumns(f"a correlation needs two columns, found {keep}")
    rows = complete_cases(df.select(*[col(c).cast("double").alias(c) for c in keep]), keep)
    means = rows.agg(F.struct(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(keep)]).alias("means")).scalar()
    centred = rows.select(*[(col(c) - means.getField(f"m{i}")).alias(f"d{i}") for i, c in enumerate(keep)])
    pairs = list(combinations_with_replacement(range(len(keep)), 2))
    sums = centred.agg(*[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"s{i}_{j}") for i, j in pairs])
    cells = []
    for i, j in pairs:
        r = F.try_divide(F.col(f"s{i}_{j}"), F.sqrt(F.col(f"s{i}_{i}")) * F.sqrt(F.col(f"s{j}_{j}")))
        for x, y in {(i, j), (j, i)}:
            cells.append(F.struct(F.lit(keep[x]).alias("x"), F.lit(keep[y]).alias("y"), r.alias("r")))
    return sums.select(F.inline(F.array(*cells)))


def _xy(df: DataFrame, x: str, y: str) -> DataFrame:
    _need(df, [x, y])
    return complete_cases(df.select(col(x).cast("double").alias("x"), col(y).cast("double").alias("y")), ["x", "y"])


def ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row (n, slope, intercept, x_min, x_max) of the least-squares line; null below two points."""
    fit = _xy(df, x, y).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.covar_pop("x", "y"), F.var_pop("x")).alias("m"),
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
    )
    slope = F.when(F.col("n") >= 2, F.col("m"))
    return fit.select(
        "n", slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"), "x_min", "x_max"
    )


def ols_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """``points`` evenly spaced (x, y) on the line; none where there is no line."""
    fit = ols(df, x, y).filter("slope IS NOT NULL")
    step = (F.col("x_max") - F.col("x_min")) / F.lit(points - 1)
    at = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    at = at.withColumn("x", F.col("x_min") + F.col("i") * step)
    return at.select("i", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")).orderBy("i")


def scatter(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """The complete (x, y[, colour]) rows."""
    cols = [x, y] + ([color] if color else [])
    _need(df, cols)
    return complete_cases(df.select(*[col(c) for c in cols]), cols)


def scatter_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The complete rows of the chosen measures."""
    keep = [c for c in (cols or SCATTER_COLUMNS) if c in df.columns]
    if len(keep) < 2:
        raise MissingColumns(f"a scatter matrix needs two columns, found {keep}")
    return complete_cases(df.select(*[col(c) for c in keep]), keep)


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """The scatter of complete rows in bins x bins fields over min..max: lower corner and count of each that has rows.

    At most bins * bins rows whatever the size; the last field of each axis holds its upper end.
    """
    _need(df, [x, y])
    rows = complete_cases(df.select(col(x).cast("double").alias("x"), col(y).cast("double").alias("y")), ["x", "y"])
    ends = rows.agg(F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).alias("e")).scalar()
    place, corner = {}, {}
    for c in ("x", "y"):
        low, width = ends.getField(f"{c}0"), (ends.getField(f"{c}1") - ends.getField(f"{c}0")) / F.lit(bins)
        step = F.coalesce(F.floor(F.try_divide(F.col(c) - low, width)), F.lit(0))
        place[c] = F.least(step, F.lit(bins - 1)).cast("int").alias(f"{c}_bin")
        corner[c] = (low + F.col(f"{c}_bin") * width).alias(c)
    counts = rows.select(place["x"], place["y"]).groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("x_bin", "y_bin", corner["x"], corner["y"], "count")


def _bin(c: str, ends: Column, bins: int) -> tuple[Column, Column]:
    """The bin of a value between the column's ends, and a function of the bin's lower end."""
    low, high = ends.getField(f"lo_{c}"), ends.getField(f"hi_{c}")
    width = (high - low) / F.lit(bins)
    step = F.coalesce(F.floor(F.try_divide(F.col(c) - low, width)), F.lit(0))
    return F.least(step, F.lit(bins - 1)).cast("int"), lambda n: low + n * width


def scatter_matrix_bins(df: DataFrame, cols: list[str] | None = None, bins: int = 20) -> DataFrame:
    """(x, y, x_bin, y_bin, x_low, y_low, count) for all pairs of columns over the complete rows.

    Two scans whatever the number of pairs: one for all bounds, one for all counts.  Rows are counted by their bins in
    all columns first, so that what is spread over the pairs, and shuffled once more, are those counts; at most
    pairs * bins * bins rows come out.  The last bin of a column holds its upper end; a constant column
    has one bin.
    """
    keep = [c for c in (cols or SCATTER_COLUMNS) if c in df.columns]
    if len(keep) < 2:
        raise MissingColumns(f"a scatter matrix needs two columns, found {keep}")
    number = {c: f"v{i}" for i, c in enumerate(keep)}
    rows = complete_cases(df.select(*[finite(col(c).cast("double")).alias(v) for c, v in number.items()]), list(number.values()))
    ends = rows.agg(F.struct(*[f(v).alias(f"{n}_{v}") for v in number.values() for n, f in (("lo", F.min), ("hi", F.max))]).alias("e")).scalar()
    bin_of = {v: _bin(v, ends, bins) for v in number.values()}
    counts = rows.select(*[b.alias(v) for v, (b, _) in bin_of.items()]).groupBy(*bin_of).agg(F.count(F.lit(1)).alias("n"))
    pair = lambda x, y: F.struct(
        F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(number[x]).alias("x_bin"), F.col(number[y]).alias("y_bin"),
    )
    spread = counts.select("n", F.inline(F.array(*[pair(x, y) for x, y in combinations(keep, 2)])))
    sums = spread.groupBy("x", "y", "x_bin", "y_bin").agg(F.sum("n").alias("count"))

    def low(name: str) -> Column:
        out = F.lit(None).cast("double")
        for c, v in number.items():
            out = F.when(F.col(name) == c, bin_of[v][1](F.col(f"{name}_bin"))).otherwise(out)
        return out.alias(f"{name}_low")

    return sums.select("x", "y", "x_bin", "y_bin", low("x"), low("y"), "count")
