"""City grids: lattices, cell counts, nearest roads, street densities and sample circles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import from_local
from ..sources.scratch import met
from .neighbourhood import GREEN_LANDUSE, NIGHTLIFE, tag
from .spatial import nearest_segment, planar_cell

# Tag keys counted per cell, and road classes whose length and distance a cell has.
POI_KEYS = ("amenity", "shop", "healthcare", "tourism")
CELL_ROADS = ("motorway", "trunk", "primary", "secondary", "tertiary")


def cell_flags() -> dict[str, Column]:
    """Counted categories of a cell by an element's ``tags``; an element counts in each that holds."""
    has = {k: F.coalesce(F.map_contains_key("tags", F.lit(k)), F.lit(False)) for k in POI_KEYS}
    transit = (tag("public_transport") == "platform") | (tag("highway") == "bus_stop") | tag("railway").isin("station", "tram_stop") | (tag("amenity") == "bus_station")
    green = tag("leisure").isin("park", "playground") | (tag("natural") == "wood") | tag("landuse").isin(*GREEN_LANDUSE)
    return has | {"nightlife": tag("amenity").isin(*NIGHTLIFE), "transit": transit, "green": green}


def cell_side(*, side: float | None = None, area: float | None = None) -> float:
    """Side of a cell in metres, from its area in square metres if that is given and positive."""
    out = math.sqrt(area) if area and area > 0 else side
    if not out or out <= 0:
        raise ValueError("a cell needs a positive side or area")
    return out


def area_mode(*, radius_km: float | None = None, half_km: float = 10.0) -> tuple[float, bool]:
    """Half extent in metres and whether cells are cut to the circle: by radius if one is given, else by box."""
    if radius_km and radius_km > 0:
        return radius_km * 1000.0, True
    if half_km <= 0:
        raise ValueError("the half size of the box must be positive")
    return half_km * 1000.0, False


def cell_degrees(cells: DataFrame, lat0: Column, lon0: Column, *, half: float, cell: float) -> DataFrame:
    """Add the centre ``lat, lon`` and the bounds ``south, west, north, east`` of cells in degrees."""
    x0, y0 = F.col("ix") * cell - half, F.col("iy") * cell - half
    lat, lon = from_local(x0 + cell / 2, y0 + cell / 2, lat0, lon0)
    south, west = from_local(x0, y0, lat0, lon0)
    north, east = from_local(x0 + cell, y0 + cell, lat0, lon0)
    return cells.select("*", *[c.alias(n) for n, c in (("lat", lat), ("lon", lon), ("south", south), ("west", west), ("north", north), ("east", east))])


def lattice(cities: DataFrame, *, half: float, cell: float, circle: bool = True) -> DataFrame:
    """Cells ``city, ix, iy, cx, cy`` (centres in metres) of every city; with ``circle`` those whose centre is inside."""
    n = math.ceil(2 * half / cell)
    numbers = cities.select("city", F.explode(F.sequence(F.lit(0), F.lit(n * n - 1))).alias("i"))
    cells = numbers.select("city", (F.col("i") % n).cast("int").alias("ix"), F.expr(f"cast(i div {n} as int)").alias("iy"))
    cells = cells.select("*", (F.lit(-half) + F.col("ix") * cell + cell / 2).alias("cx"), (F.lit(-half) + F.col("iy") * cell + cell / 2).alias("cy"))
    return cells.where(F.col("cx") * F.col("cx") + F.col("cy") * F.col("cy") <= half * half) if circle else cells


def sample_lattice(cities: DataFrame, *, half: float, step: float) -> DataFrame:
    """Square lattice of sample points with both ends and an odd count: ``city, point_id, x, y``."""
    n = int(round(2 * half / step)) + 1
    n += 1 - n % 2
    wide = 2 * half / (n - 1)
    return cities.select("city", F.explode(F.sequence(F.lit(0), F.lit(n * n - 1))).alias("point_id")).select("city", F.col("point_id").cast("int").alias("point_id"), (F.lit(-half) + (F.col("point_id") % n) * wide).alias("x"), (F.lit(-half) + F.expr(f"point_id div {n}") * wide).alias("y"))


def cell_counts(elements: DataFrame, flags: dict[str, Column], *, half: float, cell: float) -> DataFrame:
    """Counts per cell of ``elements(city, x, y, ...)``; an element counts in every flag that holds."""
    ix, iy, inside = planar_cell(F.col("x"), F.col("y"), half, cell)
    return elements.where(inside).groupBy("city", ix.alias("ix"), iy.alias("iy")).agg(*[F.count_if(c).alias(f"{k}_count") for k, c in flags.items()])


def road_lengths(segments: DataFrame, *, half: float, cell: float) -> DataFrame:
    """Length of the segments whose midpoint lies in a cell, and their mean speed and count of speeds."""
    ix, iy, inside = planar_cell((F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2, half, cell)
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    return segments.where(inside).groupBy("city", ix.alias("ix"), iy.alias("iy")).agg(F.sum(length).alias("road_m"), F.coalesce(F.avg("maxspeed"), F.lit(0.0)).alias("speed_mean"), F.count("maxspeed").alias("speed_n"))


def grid_cells(cities: DataFrame, elements: DataFrame, roads: DataFrame, flags: dict[str, Column] | None = None, *, half: float = 5000.0, cell: float = 300.0, circle: bool = True) -> DataFrame:
    """One row per cell inside the circle: counts, densities per km2, major-road length and the nearest major road.

    ``roads`` with a column ``highway`` count by their class (``CELL_ROADS``); without one all count.  Cells
    without elements keep zeros; the nearest distance is null without a road near the cell.
    """
    flags = flags or cell_flags()
    roads = roads.where(F.col("highway").isin(*CELL_ROADS)) if "highway" in roads.columns else roads
    cells = lattice(cities, half=half, cell=cell, circle=circle)
    counts = cell_counts(elements, flags, half=half, cell=cell)
    lengths = road_lengths(roads, half=half, cell=cell)
    buffer, index = max(2 * cell, 500.0), max(4 * cell, 1000.0)
    at = cells.select("city", (F.col("iy") * F.lit(1_000_000) + F.col("ix")).alias("point_id"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    near = nearest_segment(at, roads, half=half, index_cell=index, buffer=buffer).select("city", F.expr("cast(point_id % 1000000 as int)").alias("ix"), F.expr("cast(point_id div 1000000 as int)").alias("iy"), F.col("dist").alias("road_nearest_m"))
    key = ["city", "ix", "iy"]
    out = cells.join(counts, key, "left").join(lengths, key, "left").join(near, key, "left")
    area = (cell / 1000.0) ** 2
    names = [f"{k}_count" for k in flags]
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in names]
    dense = [(F.coalesce(c, F.lit(0)) / area).alias(f"{c.removesuffix('_count')}_per_km2") for c in names]
    return out.select(*key, "cx", "cy", *zero, *dense, F.coalesce("road_m", F.lit(0.0)).alias("road_m"), F.coalesce("speed_mean", F.lit(0.0)).alias("speed_mean"), F.coalesce("speed_n", F.lit(0)).alias("speed_n"), "road_nearest_m")


def grid_summary(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Per city: cells, and for each column the total, non-zero cells, mean, median and maximum of the non-zero."""
    aggs = []
    for c in columns:
        some = F.when(F.col(c) > 0, F.col(c))
        aggs += [F.sum(c).alias(f"{c}_total"), F.count(some).alias(f"{c}_cells"), F.avg(some).alias(f"{c}_mean"), F.median(some).alias(f"{c}_median"), F.max(some).alias(f"{c}_max")]
    return cells.groupBy("city").agg(F.count("*").alias("cells"), *aggs)


def street_density(elements: DataFrame, streets: DataFrame, *, half: float = 5000.0, cell: float = 300.0, buffer: float = 200.0, max_distance: float | None = 50.0) -> DataFrame:
    """Per city and street name: length, amenities assigned to their nearest street, amenities per km.

    Amenities without a street near them are counted under a null name.
    """
    index = max(cell, 2 * buffer, 200.0)
    near = nearest_segment(elements.select("city", F.col("element_id").alias("point_id"), "x", "y"), streets, half=half, index_cell=index, buffer=buffer)
    if max_distance is not None:
        near = near.where(F.col("dist") <= max_distance)
    named = met(near, streets.select("city", "seg_id", "street"), ["city", "seg_id"]).select("city", "point_id", "street")
    own = met(elements.select("city", F.col("element_id").alias("point_id")), named, ["city", "point_id"], "left").groupBy("city", "street").agg(F.count("*").alias("amenities"))
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    lengths = streets.groupBy("city", "street").agg(F.sum(length).alias("length_m"))
    both = lengths.join(own, ["city", "street"], "left").select("city", "street", "length_m", F.coalesce("amenities", F.lit(0)).alias("amenities"))
    lost = own.where("street is null").select("city", "street", F.lit(0.0).alias("length_m"), "amenities")
    per = F.when(F.col("length_m") > 0, F.col("amenities") / (F.col("length_m") / 1000.0)).otherwise(0.0)
    return both.unionByName(lost).withColumn("amenities_per_km", per)


def street_cells(cities: DataFrame, streets: DataFrame, *, half: float = 5000.0, cell: float = 300.0, buffer: float = 200.0, max_distance: float = 0.0) -> DataFrame:
    """Cells with the name of the nearest street, null beyond ``max_distance`` (0: always named)."""
    cells = lattice(cities, half=half, cell=cell)
    at = cells.select("city", (F.col("iy") * F.lit(1_000_000) + F.col("ix")).alias("point_id"), F.col("cx").alias("x"), F.col("cy").alias("y"))
    near = nearest_segment(at, streets, half=half, index_cell=max(cell, 2 * buffer, 200.0), buffer=buffer).join(streets.select("city", "seg_id", "street"), ["city", "seg_id"])
    close = F.lit(True) if max_distance <= 0 else F.col("dist") <= max_distance
    named = near.select("city", F.expr("cast(point_id % 1000000 as int)").alias("ix"), F.expr("cast(point_id div 1000000 as int)").alias("iy"), F.when(close, F.col("street")).alias("street"), F.col("dist").alias("street_m"))
    return cells.join(named, ["city", "ix", "iy"], "left").select("city", "ix", "iy", "street", "street_m")


def circle_counts(samples: DataFrame, elements: DataFrame, *, radius: float) -> DataFrame:
    """Elements within ``radius`` metres of each sample point, by type: ``city, point_id, total, nodes, ways, relations``."""
    key = lambda c: F.floor(F.col(c) / radius).cast("int")
    side = lambda c: F.explode(F.sequence(key(c) - 1, key(c) + 1))
    here = samples.select("city", "point_id", F.col("x").alias("px"), F.col("y").alias("py"), side("x").alias("_cx"), F.col("y").alias("_y")).select("city", "point_id", "px", "py", "_cx", side("_y").alias("_cy"))
    there = elements.select("city", "osm_type", "x", "y", key("x").alias("_cx"), key("y").alias("_cy"))
    inside = F.pow(F.col("x") - F.col("px"), 2) + F.pow(F.col("y") - F.col("py"), 2) <= radius * radius
    inner = here.join(there, ["city", "_cx", "_cy"]).where(inside).groupBy("city", "point_id").agg(F.count("*").alias("total"), *[F.count_if(F.col("osm_type") == t).alias(f"{t}s") for t in ("node", "way", "relation")])
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "nodes", "ways", "relations")]
    return samples.select("city", "point_id").join(inner, ["city", "point_id"], "left").select("city", "point_id", *zero)


def circle_summary(counts: DataFrame, *, radius: float) -> DataFrame:
    """Per city over the sample circles: mean, median, p10, p90, min, max and mean density per km2."""
    area = math.pi * (radius / 1000.0) ** 2
    return counts.groupBy("city").agg(F.avg("total").alias("mean"), F.median("total").alias("median"), F.percentile("total", F.lit(0.1)).alias("p10"), F.percentile("total", F.lit(0.9)).alias("p90"), F.min("total").alias("least"), F.max("total").alias("most"), (F.avg("total") / area).alias("density_mean"))


def way_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Geometry and box centre of ``ways(way_id, pos, node_id)`` from ``nodes(node_id, lat, lon)``; unknown nodes drop out."""
    met = ways.join(nodes, "node_id")
    line = F.transform(F.array_sort(F.collect_list(F.struct("pos", "lat", "lon"))), lambda p: F.struct(p.lat.alias("lat"), p.lon.alias("lon")))
    return met.groupBy("way_id").agg(line.alias("geometry"), ((F.min("lat") + F.max("lat")) / 2).alias("lat"), ((F.min("lon") + F.max("lon")) / 2).alias("lon"))
