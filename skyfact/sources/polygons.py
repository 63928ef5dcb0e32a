"""Country outlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfact.schemas import POLYGON_SCHEMA
from skyfact.session import materialize

# Property names of the country data set.
PROPERTY_NAMES = {"ADMIN": "Country", "CONTINENT": "Continent"}

_FEATURE = (
    "struct<type:string, properties:map<string,string>, geometry:struct<type:string, coordinates:string>>"
)


def _ring(points: Column) -> Column:
    return F.transform(points, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))


def _rings() -> Column:
    """All rings of a polygon or of the parts of a multi-polygon, in one list."""
    text, kind = F.col("geometry.coordinates"), F.col("geometry.type")
    single = F.from_json(text, "array<array<array<double>>>")
    several = F.flatten(F.from_json(text, "array<array<array<array<double>>>>"))
    return F.transform(F.when(kind == "MultiPolygon", several).otherwise(single), _ring)


def named_polygons(df: DataFrame) -> DataFrame:
    """Give the columns their names in the star; a source without them is refused."""
    df = df.withColumnsRenamed(PROPERTY_NAMES)
    absent = [c for c in POLYGON_SCHEMA.fieldNames() if c not in df.columns]
    if absent:
        raise ValueError(f"the outlines lack the columns {absent}")
    return df.select([F.col(f.name).cast(f.dataType) for f in POLYGON_SCHEMA])


_COLLECTION = f"type string, features array<{_FEATURE}>, properties map<string,string>, geometry struct<type:string, coordinates:string>"


def _layouts(spark: SparkSession, path: str) -> DataFrame:
    """Per file: whether each of its lines is a JSON value of its own, and how many features its text names."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))
    named = F.regexp_count("value", F.lit(r'"type"\s*:\s*"Feature"'))
    return lines.groupBy("file").agg(F.bool_and(F.try_parse_json("value").isNotNull()).alias("by_line"), F.sum(named).alias("named"))


def _features(text: DataFrame) -> DataFrame:
    """(file, value) -> file and the features of each JSON text: of a collection, or itself."""
    raw = text.select("file", F.from_json("value", _COLLECTION).alias("j")).select("file", "j.*")
    one = F.struct("type", "properties", "geometry")
    return raw.select("file", F.explode(F.coalesce("features", F.array(one))).alias("f")).select("file", "f.*")


def read_country_polygons(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """(Country, Continent, rings) from GeoJSON or Parquet, in degrees.

    Each GeoJSON file has a layout of its own: a value per line (features or collections), which may
    be split, or one value over all lines, which is read whole.  ``lines`` says so for all files; without it,
    each file's text decides.  A file that names more features than were read is refused, and so is a source in which
    no feature has a property that is needed; a single feature that lacks one has null there.
    """
    if not path.rstrip("/").endswith(("json", "geojsonl")):
        return named_polygons(spark.read.parquet(path))
    layouts = materialize(_layouts(spark, path), "outline-files")
    by_line = F.col("by_line") if lines is None else F.lit(lines)
    split = layouts.filter(by_line).select("file")
    text = lambda whole: spark.read.text(path, wholetext=whole).select(F.col("_metadata.file_path").alias("file"), "value").filter(F.trim("value") != "")
    # one row per file on the small side
    features = _features(text(False).join(split, "file", "left_semi").unionByName(text(True).join(split, "file", "left_anti")))
    features = materialize(features.filter("type IS NOT NULL OR properties IS NOT NULL OR geometry IS NOT NULL"), "outline-features")
    read = features.groupBy("file").agg(F.count(F.lit(1)).alias("read"))
    lost = layouts.join(read, "file", "left").filter("named > coalesce(read, 0)").select("file", "named", F.coalesce("read", F.lit(0)).alias("read"))
    faults = [f"{r['file']}: {r['named']} features in the text, {r['read']} read" for r in lost.limit(5).collect()]
    if faults:
        raise ValueError("; ".join(faults))
    known = [*PROPERTY_NAMES, *PROPERTY_NAMES.values()]
    has = features.agg(*[F.bool_or(F.map_contains_key("properties", c)).alias(c) for c in known]).first()
    names = [c for c in known if has[c]]
    return named_polygons(features.select(*[F.col("properties")[c].alias(c) for c in names], _rings().alias("rings")))
