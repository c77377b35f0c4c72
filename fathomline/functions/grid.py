"""A hierarchical longitude/latitude grid made of Column arithmetic.

Level r parts the world into 2^(r+8) by 2^(r+7) cells, so that a parent holds its children exactly and levels 4 to 10 are
of the size of common hexagonal grids (level 9: about a quarter of a kilometre). A cell is one long: level, column, row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

X_BITS, Y_BITS, FIELD = 8, 7, 28
EARTH_KM = 6371.0072


def _n(res: int, bits: int) -> int:
    return 1 << (res + bits)


def valid(lat: Column, lon: Column) -> Column:
    return lat.between(-90, 90) & lon.between(-180, 180)


def _bin(value: Column, low: float, width: float, n: int) -> Column:
    return F.least(F.floor((value - low) / width * n), F.lit(n - 1))


def cell(lat: Column, lon: Column, res: int) -> Column:
    """The cell of a position; null if the position is missing or out of range."""
    x, y = _bin(lon, -180.0, 360.0, _n(res, X_BITS)), _bin(lat, -90.0, 180.0, _n(res, Y_BITS))
    return F.when(valid(lat, lon), F.lit(res << 2 * FIELD).cast("long") + x * F.lit(1 << FIELD) + y)


def level(c: Column) -> Column:
    return F.shiftright(c, 2 * FIELD)


def column(c: Column) -> Column:
    return F.shiftright(c, FIELD).bitwiseAND(F.lit((1 << FIELD) - 1))


def row(c: Column) -> Column:
    return c.bitwiseAND(F.lit((1 << FIELD) - 1))


def parent(c: Column, res: int) -> Column:
    by = (level(c) - F.lit(res)).cast("int")
    power = F.pow(F.lit(2.0), by).cast("long")
    return F.lit(res << 2 * FIELD).cast("long") + F.floor(column(c) / power) * F.lit(1 << FIELD) + F.floor(row(c) / power)


def center_lon(c: Column) -> Column:
    return (column(c) + 0.5) * 360.0 / F.pow(F.lit(2.0), level(c) + X_BITS) - 180.0


def center_lat(c: Column) -> Column:
    return (row(c) + 0.5) * 180.0 / F.pow(F.lit(2.0), level(c) + Y_BITS) - 90.0


def area_km2(c: Column) -> Column:
    """Exact area of a cell on the sphere."""
    n = F.pow(F.lit(2.0), level(c) + Y_BITS)
    edge = lambda k: F.sin(F.radians((row(c) + k) * 180.0 / n - 90.0))
    width = F.lit(2 * math.pi) / F.pow(F.lit(2.0), level(c) + X_BITS)
    return F.lit(EARTH_KM**2) * width * (edge(1) - edge(0))


def to_string(c: Column) -> Column:
    return F.lower(F.hex(c))


def from_string(s: Column) -> Column:
    return F.conv(s, 16, 10).cast("long")


Ring = list[list[float]]


def polygon_stretches(spark: SparkSession, polygons: list[list[Ring]], res: int) -> DataFrame:
    """(y, first, last): the stretches of each grid row whose cells' centres lie inside a polygon (even-odd over its rings).

    Every edge is exploded into the grid rows whose centre line it crosses; a row's crossings, in order, pair up into
    stretches of columns. No pair of cells and edges is ever formed.
    """
    edges = [
        (p, float(x0), float(y0), float(x1), float(y1))
        for p, rings in enumerate(polygons)
        for ring in rings
        for (x0, y0, *_), (x1, y1, *_) in zip(ring, [*ring[1:], ring[0]], strict=True)
        if y0 != y1
    ]
    nx, ny = _n(res, X_BITS), _n(res, Y_BITS)
    df = spark.createDataFrame(edges, "polygon int, x0 double, y0 double, x1 double, y1 double")
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    # Rows whose centre c holds low <= c < high.
    at = lambda y: F.ceil((y + 90.0) / 180.0 * ny - 0.5)
    span = df.withColumns({"first": F.greatest(at(low), F.lit(0)), "last": F.least(at(high) - 1, F.lit(ny - 1))}).where("first <= last")
    rows = span.select("*", F.explode(F.sequence("first", "last")).alias("y"))
    lat = (F.col("y") + 0.5) * 180.0 / ny - 90.0
    crossing = F.col("x0") + (lat - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    lines = rows.groupBy("polygon", "y").agg(F.sort_array(F.collect_list(crossing)).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(1), F.floor(F.size("xs") / 2).cast("int")), lambda k: F.struct(F.col("xs")[2 * k - 2].alias("a"), F.col("xs")[2 * k - 1].alias("b")))
    stretch = lines.where(F.size("xs") >= 2).select("y", F.explode(pairs).alias("p"))
    first = F.greatest(F.ceil((F.col("p.a") + 180.0) / 360.0 * nx - 0.5), F.lit(0))
    last = F.least(F.ceil((F.col("p.b") + 180.0) / 360.0 * nx - 0.5) - 1, F.lit(nx - 1))
    found = stretch.select("y", first.alias("first"), last.alias("last")).where("first <= last")
    # Polygons may overlap: stretches of a row that touch become one, so that no cell is in two.
    line = Window.partitionBy("y").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    begins = found.withColumn("new", F.coalesce(F.col("first") > F.max("last").over(line) + 1, F.lit(True)).cast("int"))
    numbered = begins.withColumn("k", F.sum("new").over(Window.partitionBy("y").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("y", "k").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("k")


def of_row(y: Column, res: int) -> Column:
    """The first cell of a grid row."""
    return F.lit(res << 2 * FIELD).cast("long") + y


def stretch_cells(stretches: DataFrame, res: int) -> DataFrame:
    """(cell): every cell of (y, first, last)."""
    cells = stretches.select("y", F.explode(F.sequence("first", "last")).alias("x"))
    return cells.select((of_row(F.col("y"), res) + F.col("x") * F.lit(1 << FIELD)).alias("cell"))


def polygon_cells(spark: SparkSession, polygons: list[list[Ring]], res: int) -> DataFrame:
    """(cell): cells whose centre lies inside a polygon."""
    return stretch_cells(polygon_stretches(spark, polygons, res), res)
