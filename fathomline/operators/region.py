"""Coverage of polygon regions, and their readings.

A region is held as stretches of grid cells, one or a few for each row of the grid, not as cells: a few thousand rows for
a country, whatever its area. Whether a cell lies inside is a join on its row and a comparison with the stretch's ends.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.functions import grid
from fathomline.functions.scalars import round_at, safe_double, share_of_duplicates
from fathomline.sources.files import Files

#: Stretches of a region that are broadcast at most; more are joined by shuffling.
BROADCAST_STRETCHES = 500_000
#: Margin of the box that is tested before the cells, in degrees, and the thresholds of coverage.
MARGIN, THRESHOLDS = 0.01, (1, 100)

Polygon = list[grid.Ring]


def polygons(doc: dict[str, Any]) -> Iterator[Polygon]:
    """The polygons, as lists of rings, of any GeoJSON object."""
    match doc:
        case {"type": "Polygon", "coordinates": rings}:
            yield rings
        case {"type": "MultiPolygon", "coordinates": several}:
            yield from several
        case {"type": "Feature", "geometry": dict(geometry)}:
            yield from polygons(geometry)
        case {"type": "FeatureCollection", "features": list(parts)} | {"type": "GeometryCollection", "geometries": list(parts)}:
            for part in parts:
                yield from polygons(part)
        case _:
            raise ValueError(f"no area can be made of a GeoJSON {doc.get('type')!r}")


def read_polygons(files: Files, path: str) -> list[Polygon]:
    found = list(polygons(json.loads(files.read(path))))
    if not found:
        raise ValueError(f"{path} holds no polygon")
    return found


class Region:
    """Polygons at a resolution."""

    def __init__(self, spark: SparkSession, shapes: list[Polygon], res: int) -> None:
        self.res, self.shapes = res, shapes
        self.stretches = grid.polygon_stretches(spark, shapes, res).persist()
        self.size = self.stretches.count()

    def close(self) -> None:
        self.stretches.unpersist()

    def cells(self) -> DataFrame:
        return grid.stretch_cells(self.stretches, self.res).withColumnRenamed("cell", "h3")

    def area(self) -> DataFrame:
        """Cells and square kilometres: all cells of a row are of one size, so none is made."""
        n = F.col("last") - F.col("first") + 1
        each = grid.area_km2(grid.of_row(F.col("y"), self.res))
        return self.stretches.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("region_cells"), round_at(F.coalesce(F.sum(n * each), F.lit(0.0)), 2).alias("region_km2"))

    def within(self, rows: DataFrame) -> DataFrame:
        """Rows whose cell `h3` lies inside."""
        held = self.stretches.select(F.col("y").alias("_y"), F.col("first").alias("_first"), F.col("last").alias("_last"))
        held = F.broadcast(held) if self.size <= BROADCAST_STRETCHES else held
        hit = (grid.row(F.col("h3")) == F.col("_y")) & grid.column(F.col("h3")).between(F.col("_first"), F.col("_last"))
        return rows.join(held, hit, "left_semi")

    def inside(self, readings: DataFrame) -> DataFrame:
        """Readings inside: a box on the typed positions first, which storage can prune by, then the cells."""
        corners = [point for rings in self.shapes for ring in rings for point in ring]
        if not self.size:
            raise ValueError("the polygon holds no cell")
        margin = max(MARGIN, 360.0 / (1 << (self.res + grid.X_BITS)))  # a cell, so that the box covers whole cells
        lon, lat = ([float(p[k]) for p in corners] for k in (0, 1))
        box = F.col("lon_d").between(min(lon) - margin, max(lon) + margin) & F.col("lat_d").between(min(lat) - margin, max(lat) + margin)
        return self.within(readings.where(box).withColumn("h3", grid.cell(F.col("lat_d"), F.col("lon_d"), self.res)))


def coverage_cells(cells: DataFrame) -> DataFrame:
    year = F.left("coll_month", F.lit(4))
    made = cells.groupBy("h3").agg(
        F.sum("n_unique").cast("long").alias("n_unique"), F.sum("n_rows").cast("long").alias("n_published"), F.count_distinct("provider").cast("int").alias("n_providers"),
        F.min(year).cast("int").alias("first_year"), F.max(year).cast("int").alias("last_year"),
    )
    return made.select("h3", "n_unique", "n_published", share_of_duplicates(F.col("n_unique"), F.col("n_published")).alias("dup_share"), "n_providers", "first_year", "last_year")


def coverage(cells: DataFrame, region_size: int, by_year: bool = False) -> DataFrame:
    """Totals, cells at or above each threshold, area and shares of a region's cells; for all time or for each year."""
    keys = [F.left("coll_month", F.lit(4)).alias("year")] if by_year else [F.lit("all").alias("year")]
    rows = cells.select(*keys, "h3", "provider", "n_unique", "n_rows")
    each = rows.groupBy("year", "h3").agg(F.sum("n_unique").alias("u"), F.sum("n_rows").alias("p"))
    providers = rows.groupBy("year").agg(F.count_distinct("provider").alias("providers"))
    at_least = [F.count_if(F.col("u") >= t).alias(f"cells_ge{t}") for t in THRESHOLDS]
    area = round_at(F.coalesce(F.sum(F.when(F.col("u") >= 1, grid.area_km2(F.col("h3")))), F.lit(0.0)), 2).alias("km2_covered")
    made = each.groupBy("year").agg(F.sum("u").cast("long").alias("unique"), F.sum("p").cast("long").alias("published"), *at_least, area).join(providers, "year")
    shares = {f"share_ge{t}": round_at(F.col(f"cells_ge{t}") / float(region_size), 4) if region_size else F.lit(0.0) for t in THRESHOLDS}
    return made.withColumns(shares)


def extract(rows: DataFrame, res: int) -> DataFrame:
    """Originals with the number of their copies."""
    counts = rows.groupBy("key").agg(F.count("*").alias("n_copies"), F.min(F.struct(F.col("ingested").isNull().alias("n"), "ingested", "file", "unique_id")).alias("o")).withColumnRenamed("key", "k")
    same = (F.col("key") == F.col("k")) & F.col("ingested").eqNullSafe(F.col("o.ingested")) & F.col("file").eqNullSafe(F.col("o.file")) & F.col("unique_id").eqNullSafe(F.col("o.unique_id"))
    first = rows.join(counts, same)
    one = Window.partitionBy("key", "file").orderBy("unique_id", "provider")
    kept = first.withColumn("rn", F.row_number().over(one)).where("rn = 1")
    return kept.select("key", "provider", "unique_id", "time", F.col("lon_d").alias("lon"), F.col("lat_d").alias("lat"), safe_double(F.col("depth").cast("string")).alias("depth"), grid.to_string(F.col("h3")).alias(f"h3_r{res}"), "n_copies", F.col("file").alias("first_file"))


def extract_cells(rows: DataFrame) -> DataFrame:
    """Readings of a region by cell, from the rows themselves."""
    year = F.left("time", F.lit(4)).try_cast("int")
    made = rows.groupBy("h3").agg(F.count_distinct("key").alias("n_unique"), F.count("*").alias("n_published"), F.count_distinct("provider").cast("int").alias("n_providers"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    return made.withColumn("dup_share", share_of_duplicates(F.col("n_unique"), F.col("n_published")))
