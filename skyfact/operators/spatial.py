"""Points in polygons as an equi-join on the cells of a quadtree over the polygons' sides.

Outlines are taken apart into sides at once.  Squares of ``ROOT_DEGREES`` are cut in four, and these again, where more
than ``MAX_SIDES`` sides of all polygons reach them: by a join of those sides with the cells to be cut, two levels
at a time.  A polygon is cut along only where it has sides itself.  So a point meets few sides, however detailed
an outline is and however many polygons there are, and what covers a wide area stays in a few cells.  A cell knows whether its south-east corner is inside; a point is inside if the way
from there along the cell's east edge to the point's latitude, and then west to the point, crosses an
odd number of sides, all of which reach the cell.  Cells without sides are inside or don't exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfact.operators.joins import lookup_join
from skyfact.session import materialize

ROOT_DEGREES = 16.0
# A cell that more sides reach is cut in four, down to this level (two metres at the equator).
MAX_SIDES = 24
MAX_LEVEL = 20
# Cell borders are off round numbers, on which vertices and stations tend to lie.
SHIFT = 0.000731
# A point this near to a side lies on it: more than rounding, about a tenth of a millimetre.
ON_SIDE_DEGREES = 1e-9
_CELL = ["level", "cx", "cy"]
_KEY = ["pid", *_CELL]
_STEP = 2


def polygon_sides(polygons: DataFrame, key: str = "pid") -> DataFrame:
    """(key, rings) -> key, x1, y1, x2, y2: a row for each side; a ring that is not closed is closed."""

    def sides(ring: Column) -> Column:
        following = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(
                a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
            ),
        )

    rings = polygons.select(key, F.explode("rings").alias("ring"))
    known = "x1 IS NOT NULL AND y1 IS NOT NULL AND x2 IS NOT NULL AND y2 IS NOT NULL AND NOT (x1 = x2 AND y1 = y2)"
    return rings.select(key, F.inline(sides(F.col("ring")))).filter(known)


def _size(level: Column, root: float) -> Column:
    return F.lit(root) / F.pow(F.lit(2.0), level)


def _cell(x: Column, size: Column) -> Column:
    return F.floor((x - SHIFT) / size).cast("long")


def _reaches(size: Column) -> Column:
    """Whether a side comes into the cell (cx, cy), or next to it by rounding."""
    half = size / 2 + 2 * ON_SIDE_DEGREES
    mx, my = (F.col("cx") + 0.5) * size + SHIFT, (F.col("cy") + 0.5) * size + SHIFT
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    across = F.abs(dx * (my - F.col("y1")) - dy * (mx - F.col("x1")))
    overlaps = lambda a, b, m: (F.least(a, b) <= m + half) & (F.greatest(a, b) >= m - half)
    in_box = overlaps(F.col("x1"), F.col("x2"), mx) & overlaps(F.col("y1"), F.col("y2"), my)
    # slack for the rounding of the products
    return in_box & (across <= (F.abs(dx) + F.abs(dy)) * half * (1 + 1e-9))


def _span(a: Column, b: Column, size: Column) -> Column:
    margin = 2 * ON_SIDE_DEGREES
    return F.sequence(_cell(F.least(a, b) - margin, size), _cell(F.greatest(a, b) + margin, size))


def _cut(sides: DataFrame, root: float, most: int, deepest: int) -> tuple[DataFrame, DataFrame]:
    """(sides by the leaf cells that they reach, all leaf cells: with or without sides)."""
    size = F.lit(root)
    box = sides.groupBy("pid").agg(F.min(F.least("x1", "x2")).alias("w"), F.max(F.greatest("x1", "x2")).alias("e"), F.min(F.least("y1", "y2")).alias("s"), F.max(F.greatest("y1", "y2")).alias("n"))
    cells = box.select("pid", F.explode(_span(F.col("w"), F.col("e"), size)).alias("cx"), "s", "n").select("pid", F.lit(0).alias("level"), "cx", F.explode(_span(F.col("s"), F.col("n"), size)).alias("cy"))
    placed = sides.withColumn("level", F.lit(0)).withColumn("cx", F.explode(_span(F.col("x1"), F.col("x2"), size))).withColumn("cy", F.explode(_span(F.col("y1"), F.col("y2"), size)))
    placed = materialize(placed.filter(_reaches(size)), "outline-sides-0")
    done_sides, done_cells = [], []
    for level in range(0, deepest + 1, _STEP):
        many = placed.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("sides")).filter(F.col("sides") > most).drop("sides")
        if level + _STEP > deepest:
            break
        # the cells of each polygon that has sides there; both joins are as large as the heavy cells
        own = materialize(placed.join(many, _CELL, "left_semi").select(*_KEY).distinct(), f"outline-cut-{level}")
        if own.isEmpty():
            break
        done_sides.append(placed.join(own, _KEY, "left_anti"))
        done_cells.append(cells.join(own, _KEY, "left_anti"))
        parts = lambda c: F.explode(F.array(*[F.col(c) * 2**_STEP + i for i in range(2**_STEP)])).alias(c)
        finer = lambda df, rest: df.select("pid", (F.col("level") + _STEP).alias("level"), parts("cx"), "cy", *rest).select("pid", "level", "cx", parts("cy"), *rest)
        cells = finer(own, [])
        smaller = F.lit(root / 2 ** (level + _STEP))
        placed = materialize(finer(placed.join(own, _KEY, "left_semi"), ["x1", "y1", "x2", "y2"]).filter(_reaches(smaller)), f"outline-sides-{level}")
    return _all([*done_sides, placed]), _all([*done_cells, cells])


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _left(e: Column, x: Column, y: Column) -> Column:
    """Whether the point is left of the side's direction.  This alone decides all crossings, so that they agree.

    A point on the side counts as moved north by a trifle, and east by much less, as comparing ends by ``>`` does.
    """
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    turn = dx * (y - e["y1"]) - dy * (x - e["x1"])
    return (turn > 0) | ((turn == 0) & ((dx > 0) | ((dx == 0) & (dy < 0))))


def _corners(sides: DataFrame, cells: DataFrame, root: float) -> DataFrame:
    """Cells with ``inside``: whether the south-east corner is, by the sides of the polygon that cross its latitude to the east.

    Corners and crossings of a latitude line are ordered by longitude together, and crossings counted from the east.
    """
    size = _size(F.col("level"), root)
    corner = cells.select(*_KEY, ((F.col("cx") + 1) * size + SHIFT).alias("x"), (F.col("cy") * size + SHIFT).alias("y"))
    rows = corner.select("pid", "level", "cy", "y").distinct()
    # A side is looked up at the level whose rows are as high as the side, where it is in two or three; a line at
    # all levels that its polygon's sides have.  Level sides cross no line.
    height = F.abs(F.col("y2") - F.col("y1"))
    fit = F.greatest(F.lit(0), F.least(F.lit(MAX_LEVEL), F.floor(F.log2(F.lit(root) / height)))).cast("int")
    tall = sides.filter("y1 <> y2").withColumn("fit", fit)
    fits = tall.groupBy("pid").agg(F.collect_set("fit").alias("fits"))
    at_fit = _size(F.col("fit"), root)
    lines = rows.join(fits, "pid").withColumn("fit", F.explode("fits")).withColumn("row", _cell(F.col("y"), at_fit)).drop("fits")
    spread = tall.withColumn("row", F.explode(_span(F.col("y1"), F.col("y2"), at_fit)))
    met = spread.join(lines, ["pid", "fit", "row"]).filter((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y")))
    at = F.col("x1") + (F.col("x2") - F.col("x1")) * ((F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")))
    events = met.select("pid", "level", "cy", at.alias("x"), F.lit(1).alias("one"), F.lit(None).cast("long").alias("cx"))
    marks = corner.select("pid", "level", "cy", "x", F.lit(0).alias("one"), "cx")
    line = Window.partitionBy("pid", "level", "cy").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = events.unionByName(marks).withColumn("passed", F.sum("one").over(line))
    return passed.filter("cx IS NOT NULL").select(*_KEY, (F.col("passed") % 2 == 1).alias("inside"))


def polygon_cells(polygons: DataFrame, cell: float = ROOT_DEGREES, most: int = MAX_SIDES, deepest: int = MAX_LEVEL) -> DataFrame:
    """(Country, Continent, rings) -> Country, Continent, level, cx, cy, inside (the south-east corner), edges.

    ``edges`` are the polygon's sides that reach the cell: ``most`` at most, but for cells of the last level.  Cells that
    none of them reaches are there if they are inside.
    """
    named = materialize(polygons.select("Country", "Continent", "rings").withColumn("pid", F.monotonically_increasing_id()), "outlines")
    sides = materialize(polygon_sides(named), "outline-sides")
    placed, cells = _cut(sides, cell, most, deepest)
    edges = placed.groupBy(*_KEY).agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    index = _corners(sides, cells, cell).join(edges, _KEY, "left").filter("inside OR edges IS NOT NULL")
    none = F.array().cast(edges.schema["edges"].dataType)
    # one row per polygon on the small side
    return index.join(named.select("pid", "Country", "Continent"), "pid").select("Country", "Continent", "level", "cx", "cy", "inside", F.coalesce("edges", none).alias("edges"))


def _inside(x: Column, y: Column, root: float) -> Column:
    """Even-odd by the way from the cell's south-east corner."""
    size = _size(F.col("level"), root)
    xe, ys = (F.col("cx") + 1) * size + SHIFT, F.col("cy") * size + SHIFT

    def crosses(e: Column) -> Column:
        up, right = e["y2"] > e["y1"], e["x2"] > e["x1"]
        spans_y, spans_x = (e["y1"] > y) != (e["y2"] > y), (e["x1"] > xe) != (e["x2"] > xe)
        east = lambda x_: _left(e, x_, y) == up  # the side is east of the point
        above = lambda y_: _left(e, xe, y_) != right  # the side is north of the point
        west_way = spans_y & (east(x) != east(xe))
        edge_way = spans_x & (above(y) != above(ys))
        return west_way != edge_way

    return F.col("inside") != (F.size(F.filter("edges", crosses)) % 2 == 1)


def _on_edge(edges: Column, x: Column, y: Column) -> Column:
    """Whether the point lies on a side, as far as rounding can tell."""
    eps = ON_SIDE_DEGREES

    def touches(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        area = dx * (y - e["y1"]) - dy * (x - e["x1"])
        in_x = x.between(F.least(e["x1"], e["x2"]) - eps, F.greatest(e["x1"], e["x2"]) + eps)
        in_y = y.between(F.least(e["y1"], e["y2"]) - eps, F.greatest(e["y1"], e["y2"]) + eps)
        return (F.abs(area) <= eps * (F.abs(dx) + F.abs(dy))) & in_x & in_y

    return F.exists(edges, touches)


def polygon_matches(
    points: DataFrame, polygons: DataFrame, cell: float = ROOT_DEGREES, most: int = MAX_SIDES, deepest: int = MAX_LEVEL
) -> DataFrame:
    """Each point with each polygon that reaches into its cell: ``within``, ``touches`` (null where there is none).

    Even-odd over all rings of a polygon, so holes and several parts need no special case.
    """
    index = polygon_cells(polygons, cell, most, deepest).withColumnsRenamed({"Country": "_country", "Continent": "_continent"})
    index = materialize(index, "polygon-cells")
    # which levels there are below each root cell: a point is looked up in those
    roots = index.select("level", F.expr("shiftright(cx, level)").alias("rx"), F.expr("shiftright(cy, level)").alias("ry")).groupBy("rx", "ry").agg(F.collect_set("level").alias("levels"))
    x, y = F.col("Longitude"), F.col("Latitude")
    known = lambda c: F.when(~F.isnan(c.cast("double")) & (F.abs(c) < 1e9), c.cast("double"))
    placed = points.withColumns({"rx": _cell(known(x), F.lit(cell)), "ry": _cell(known(y), F.lit(cell))})
    placed = lookup_join(placed, materialize(roots, "polygon-roots"), ["rx", "ry"]).withColumn("level", F.explode_outer("levels")).drop("levels", "rx", "ry")
    size = _size(F.col("level"), cell)
    placed = placed.withColumns({"cx": _cell(known(x), size), "cy": _cell(known(y), size)})
    pairs = lookup_join(placed, index, ["level", "cx", "cy"])
    return (
        pairs.withColumns({"_odd": _inside(x, y, cell), "_edge": _on_edge(F.col("edges"), x, y)})
        .withColumns({"within": F.expr("_odd AND NOT _edge"), "touches": F.expr("_odd OR _edge")})
        .drop("_odd", "_edge", "edges", "inside", "level", "cx", "cy")
    )


def locate_country(points: DataFrame, polygons: DataFrame, cell: float = ROOT_DEGREES) -> DataFrame:
    """Add Country and Continent; every point stays, once.

    A polygon that holds the point comes first, then one that merely touches it, and the lowest country
    name among several.
    """
    ids = points.columns
    best = F.min(
        F.when(
            F.col("touches"),
            F.struct(
                (~F.col("within")).alias("rank"), F.col("_country").alias("Country"), F.col("_continent").alias("Continent")
            ),
        )
    )
    hits = polygon_matches(points, polygons, cell).groupBy(*ids).agg(best.alias("hit"))
    return hits.select(*ids, "hit.Country", "hit.Continent")


def multiple_matches(points: DataFrame, polygons: DataFrame, cell: float = ROOT_DEGREES) -> DataFrame:
    """Points that several polygons hold or touch, and how many do."""
    hits = polygon_matches(points, polygons, cell).filter("touches")
    return hits.groupBy(*points.columns).agg(F.count(F.lit(1)).alias("polygons")).filter("polygons > 1")
