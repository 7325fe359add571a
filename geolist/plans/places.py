"""Registered queries on places: grids, streets, neighbourhoods, transit, stations, geocodes, rasters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, scores
from ..operators import around, grid, neighbourhood, spatial
from ..sources import readers
from ..sources.scratch import shared_dir
from . import base
from .base import SQL, haversine_sql, near_sql, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
HALF, CELL = 5000.0, 300.0


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def r6(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


_CELLS = "ce AS (SELECT c::BIGINT AS city, a::INT AS ix, b::INT AS iy, -5000.0::DOUBLE + a * 300.0::DOUBLE + 150 AS x, -5000.0::DOUBLE + b * 300.0::DOUBLE + 150 AS y, b * 1000000 + a AS point_id FROM range(5) r(c), range(34) s(a), range(34) t(b) WHERE x * x + y * y <= 25000000)"
_INSIDE = "x >= -5000 AND y >= -5000 AND floor((x + 5000) / 300) < 34 AND floor((y + 5000) / 300) < 34"
_FLAGS = {"amenity": "amenity IS NOT NULL", "shop": "shop IS NOT NULL", "healthcare": "healthcare IS NOT NULL", "tourism": "tourism IS NOT NULL", "nightlife": "amenity IN ('bar', 'pub', 'nightclub')", "transit": "public_transport = 'platform' OR highway = 'bus_stop' OR railway IN ('station', 'tram_stop') OR amenity = 'bus_station'", "green": f"leisure IN ('park', 'playground') OR nature = 'wood' OR landuse IN {grid.GREEN_LANDUSE}"}
_COUNTS = "co AS (SELECT city, floor((x + 5000) / 300)::INT AS ix, floor((y + 5000) / 300)::INT AS iy, " + ", ".join(f"count(*) FILTER (WHERE {p}) AS {k}_count" for k, p in _FLAGS.items()) + f" FROM el WHERE {_INSIDE} GROUP BY ALL)"
_MAJOR = f"st.highway IN {grid.CELL_ROADS}"
_MID = f"SELECT *, (x1 + x2) / 2 AS x, (y1 + y2) / 2 AS y FROM st WHERE {_MAJOR}"
_ROADS = f"ro AS (SELECT city, floor((x + 5000) / 300)::INT AS ix, floor((y + 5000) / 300)::INT AS iy, sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))) AS road_m, coalesce(avg(maxspeed), 0) AS speed_mean, count(maxspeed) AS speed_n FROM ({_MID}) WHERE {_INSIDE} GROUP BY ALL)"
_GRID = f"WITH {SQL['el']}, {SQL['st']}, {_CELLS}, {_COUNTS}, {_ROADS}, ne AS ({near_sql('ce', HALF, 1200.0, 600.0, _MAJOR)}), gr AS (SELECT ce.city, ce.ix, ce.iy, " + ", ".join(f"coalesce({k}_count, 0) AS {k}_count, round(coalesce({k}_count, 0) / 0.09, 6) AS {k}_per_km2" for k in _FLAGS) + ", round(coalesce(road_m, 0), 6) AS road_m, round(coalesce(speed_mean, 0), 6) AS speed_mean, coalesce(speed_n, 0) AS speed_n, round(dist, 6) AS road_nearest_m, round(48.0 + ce.city + ce.y / 111320, 6) AS lat, round(9.0 + ce.x / (111320 * cos(radians(48.0 + ce.city))), 6) AS lon, round(48.0 + ce.city + (ce.y - 150) / 111320, 6) AS south, round(9.0 + (ce.x + 150) / (111320 * cos(radians(48.0 + ce.city))), 6) AS east FROM ce LEFT JOIN co USING (city, ix, iy) LEFT JOIN ro USING (city, ix, iy) LEFT JOIN ne ON ne.city = ce.city AND ne.point_id = ce.point_id)"


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.grid_cells(base.cities(spark), base.elements(spark, sf_dir), base.streets(spark, sf_dir), half=HALF, cell=CELL)


@query(f"{_GRID} SELECT * FROM gr")
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [k for k in _FLAGS]
    dense = [c for k in names for c in (F.col(f"{k}_count"), F.round(f"{k}_per_km2", 6).alias(f"{k}_per_km2"))]
    placed = grid.cell_degrees(_grid(spark, sf_dir), 48.0 + F.col("city"), F.lit(9.0), half=HALF, cell=CELL)
    return placed.select("city", "ix", "iy", *dense, *r6("road_m", "speed_mean"), "speed_n", *r6("road_nearest_m", "lat", "lon", "south", "east"))


@query(f"WITH {SQL['el']}, {_COUNTS} SELECT city, ix, iy, amenity_count, shop_count, nightlife_count, transit_count, green_count FROM co")
def grid_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with any element, without the lattice."""
    return grid.cell_counts(base.elements(spark, sf_dir), grid.cell_flags(), half=HALF, cell=CELL).select("city", "ix", "iy", "amenity_count", "shop_count", "nightlife_count", "transit_count", "green_count")


_SUM = ", ".join(f"sum({c})::{'BIGINT' if t == 'l' else 'DOUBLE'} AS {c}_total, count(CASE WHEN {c} > 0 THEN 1 END) AS {c}_cells, round(avg(CASE WHEN {c} > 0 THEN {c} END), 6) AS {c}_mean, round(median(CASE WHEN {c} > 0 THEN {c} END)::DOUBLE, 6) AS {c}_median, max(CASE WHEN {c} > 0 THEN {c} END) AS {c}_max" for c, t in (("amenity_count", "l"), ("transit_count", "l")))


@query(f"{_GRID} SELECT city, count(*) AS cells, {_SUM} FROM gr GROUP BY city")
def city_grid_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grid.grid_summary(_grid(spark, sf_dir), ["amenity_count", "transit_count"])
    return out.select("city", "cells", *[c for k in ("amenity_count", "transit_count") for c in (f"{k}_total", f"{k}_cells", *r6(f"{k}_mean", f"{k}_median"), f"{k}_max")])


@query(f"WITH {SQL['st']}, {SQL['li']} {near_sql('li', HALF, 1200.0, 600.0).replace('SELECT city, point_id, seg_id, dist', 'SELECT city, point_id, seg_id, round(dist, 6) AS dist', 1)}")
def nearest_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearest_segment(base.listings(spark, sf_dir), base.streets(spark, sf_dir), half=HALF, index_cell=1200.0, buffer=600.0).select("city", "point_id", "seg_id", *r6("dist"))


@query(f"WITH {SQL['el']}, {SQL['st']}, am AS (SELECT city, element_id AS point_id, x, y FROM el WHERE amenity IS NOT NULL), ne AS ({near_sql('am', HALF, 400.0, 200.0)}), ow AS (SELECT am.city, st.street, count(*) AS amenities FROM am LEFT JOIN (SELECT * FROM ne WHERE dist <= 50) n ON n.city = am.city AND n.point_id = am.point_id LEFT JOIN st ON st.seg_id = n.seg_id AND st.city = n.city GROUP BY ALL), le AS (SELECT city, street, sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))) AS length_m FROM st GROUP BY ALL) SELECT city, street, round(length_m, 6) AS length_m, coalesce(amenities, 0) AS amenities, round(CASE WHEN length_m > 0 THEN coalesce(amenities, 0) / (length_m / 1000) ELSE 0 END, 6) AS amenities_per_km FROM le LEFT JOIN ow USING (city, street) UNION ALL SELECT city, NULL, 0.0, amenities, 0.0 FROM ow WHERE street IS NULL")
def street_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = base.elements(spark, sf_dir).where(F.map_contains_key("tags", F.lit("amenity")))
    out = grid.street_density(own, base.streets(spark, sf_dir), half=HALF, cell=CELL)
    return out.select("city", "street", *r6("length_m"), "amenities", *r6("amenities_per_km"))


@query(f"WITH {SQL['st']}, {_CELLS}, ne AS ({near_sql('ce', HALF, 400.0, 200.0)}) SELECT ce.city, ce.ix, ce.iy, CASE WHEN dist <= 200 THEN st.street END AS street, round(dist, 6) AS street_m FROM ce LEFT JOIN ne ON ne.city = ce.city AND ne.point_id = ce.point_id LEFT JOIN st ON st.seg_id = ne.seg_id")
def street_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.street_cells(base.cities(spark), base.streets(spark, sf_dir), half=HALF, cell=CELL, max_distance=200.0).select("city", "ix", "iy", "street", *r6("street_m"))


_SAMPLES = "sa AS (SELECT c::BIGINT AS city, i::INT AS point_id, -3000.0::DOUBLE + (i % 5) * 1500.0::DOUBLE AS x, -3000.0::DOUBLE + (i // 5) * 1500.0::DOUBLE AS y FROM range(5) r(c), range(25) s(i))"
_CIRCLES = f"WITH {SQL['el']}, {_SAMPLES}, ci AS (SELECT sa.city, point_id, count(element_id) AS total, count(*) FILTER (WHERE osm_type = 'node') AS nodes, count(*) FILTER (WHERE osm_type = 'way') AS ways, count(*) FILTER (WHERE osm_type = 'relation') AS relations FROM sa LEFT JOIN el ON sa.city = el.city AND pow(el.x - sa.x, 2) + pow(el.y - sa.y, 2) <= 640000 GROUP BY ALL)"


def _circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = grid.sample_lattice(base.cities(spark), half=3000.0, step=1500.0)
    return grid.circle_counts(samples, base.elements(spark, sf_dir), radius=800.0)


@query(f"{_CIRCLES} SELECT ci.*, round(x, 6) AS x, round(y, 6) AS y FROM ci JOIN sa USING (city, point_id)")
def sample_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = grid.sample_lattice(base.cities(spark), half=3000.0, step=1500.0)
    return _circles(spark, sf_dir).join(samples, ["city", "point_id"]).select("city", "point_id", "total", "nodes", "ways", "relations", *r6("x", "y"))


@query(f"{_CIRCLES} SELECT city, round(avg(total), 6) AS mean, round(median(total)::DOUBLE, 6) AS median, round(quantile_cont(total, 0.1)::DOUBLE, 6) AS p10, round(quantile_cont(total, 0.9)::DOUBLE, 6) AS p90, min(total) AS least, max(total) AS most, round(avg(total) / (pi() * 0.64), 6) AS density_mean FROM ci GROUP BY city")
def circle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grid.circle_summary(_circles(spark, sf_dir), radius=800.0)
    return out.select("city", *r6("mean", "median", "p10", "p90"), "least", "most", *r6("density_mean"))


@query(f"WITH {SQL['li']} SELECT point_id, round(48.0 + city + y / 111320, 6) AS lat, round(9.0 + x / (111320 * cos(radians(48.0 + city))), 6) AS lon, round((lon - 9.0) * 111320 * cos(radians(48.0 + city)), 6) AS back_x, round((lat - (48.0 + city)) * 111320, 6) AS back_y FROM li")
def local_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = base.listings(spark, sf_dir)
    lat, lon = geo.from_local(F.col("x"), F.col("y"), 48.0 + F.col("city"), 9.0)
    back_x, back_y = geo.to_local(F.col("lat"), F.col("lon"), 48.0 + F.col("city"), 9.0)
    return li.select("point_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"), F.round(back_x, 6).alias("back_x"), F.round(back_y, 6).alias("back_y"))


_D = haversine_sql("li", "el")
_AROUND = {"amenity_any": ("amenity IS NOT NULL", 800), "shop_any": ("shop IS NOT NULL", 800), "healthcare_any": ("healthcare IS NOT NULL", 800), "tourism_any": ("tourism IS NOT NULL", 800), "nightlife": ("amenity IN ('bar', 'pub', 'nightclub')", 800), "platform": ("public_transport = 'platform'", 800), "bus_stop": ("highway = 'bus_stop'", 800), "rail_stop": ("railway IN ('station', 'tram_stop')", 800), "bus_station": ("amenity = 'bus_station'", 800), "park": ("leisure IN ('park', 'playground')", 1000), "wood": ("nature = 'wood'", 1000), "green_landuse": (f"landuse IN {neighbourhood.GREEN_LANDUSE}", 1000), "major_road_ways": ("osm_type = 'way' AND highway IN ('motorway', 'trunk', 'primary', 'secondary')", 300)}
_POI = {**{k: f"shop = '{k}'" for k in ("supermarket", "convenience", "bakery")}, **{k: f"amenity = '{k}'" for k in ("pharmacy", "doctors", "hospital", "school", "kindergarten", "police", "university")}, **{k: f"leisure = '{k}'" for k in ("park", "playground")}, "rail_station": "railway IN ('station', 'tram_stop')"}
_NEAREST = ("supermarket", "pharmacy", "doctors", "hospital", "school", "kindergarten", "police", "park", "playground", "rail_station")
_PAIRS = f"WITH {SQL['el']}, {SQL['li']}, pa AS (SELECT li.point_id, el.*, {_D} AS dist FROM li JOIN el ON li.city = el.city WHERE {_D} <= 2000)"


def _around_counts(prefix: str = "") -> str:
    return ", ".join(f"count(*) FILTER (WHERE ({p}) AND dist <= {r}) AS {k}" for k, (p, r) in _AROUND.items())


def _way_flags() -> tuple[dict, dict]:
    """Counts and nearest distances of ways: lit and other highways, rails, major roads."""
    way, t = F.col("osm_type") == "way", neighbourhood.tag
    counts = {"highway_total": (way & t("highway").isNotNull(), 250.0), "highway_lit": (way & (t("lit") == "yes"), 250.0), "rail_ways": (way & (t("railway") == "rail"), 1500.0)}
    nearest = {"nearest_rail_m": (way & (t("railway") == "rail"), 1500.0), "nearest_major_road_m": (way & t("highway").isin(*neighbourhood.MAJOR_ROADS), 300.0)}
    return counts, nearest


def _poi_flags() -> tuple[dict, dict]:
    """Counts and nearest distances of points of interest."""
    poi = neighbourhood.poi_flags()
    return {f"{k}_count": (p, 2000.0) for k, (p, _, _) in poi.items()}, {f"nearest_{k}_m": (p, 2000.0) for k, (p, _, near) in poi.items() if near}


def _metrics(spark: SparkSession, sf_dir: str, counts: dict, nearest: dict) -> DataFrame:
    li, el = base.listings(spark, sf_dir).select("point_id", "lat", "lon"), base.elements(spark, sf_dir).select("osm_type", "tags", "lat", "lon")
    return neighbourhood.counts_around(li, el, counts, nearest=nearest)


@query(f"{_PAIRS} SELECT point_id, {', '.join(f'coalesce({k}, 0) AS {k}' for k in _AROUND)} FROM li LEFT JOIN (SELECT point_id, {_around_counts()} FROM pa GROUP BY 1) USING (point_id)")
def radius_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, el = base.listings(spark, sf_dir).select("point_id", "lat", "lon"), base.elements(spark, sf_dir).select("osm_type", "tags", "lat", "lon")
    return neighbourhood.counts_around(li, el, neighbourhood.neighbourhood_flags())


_POI_AGG = ", ".join(f"count(*) FILTER (WHERE {p}) AS {k}_count, min(CASE WHEN {p} THEN dist END) AS nearest_{k}_m" for k, p in _POI.items())


@query(f"{_PAIRS} SELECT point_id, {', '.join(f'coalesce({k}_count, 0) AS {k}_count' for k in _POI)}, {', '.join(f'round(nearest_{k}_m, 3) AS nearest_{k}_m' for k in _NEAREST)} FROM li LEFT JOIN (SELECT point_id, {_POI_AGG} FROM pa GROUP BY 1) USING (point_id)")
def poi_counts_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics(spark, sf_dir, *_poi_flags()).select("point_id", *[f"{k}_count" for k in _POI], *[F.round(f"nearest_{k}_m", 3).alias(f"nearest_{k}_m") for k in _NEAREST])


_MAJOR_WAY = f"osm_type = 'way' AND highway IN {neighbourhood.MAJOR_ROADS}"


@query(f"{_PAIRS} SELECT point_id, coalesce(highway_total, 0) AS highway_total, coalesce(highway_lit, 0) AS highway_lit, coalesce(rail_ways, 0) AS rail_ways, round(rail_m, 3) AS nearest_rail_m, round(major_m, 3) AS nearest_major_road_m FROM li LEFT JOIN (SELECT point_id, count(*) FILTER (WHERE osm_type = 'way' AND highway IS NOT NULL AND dist <= 250) AS highway_total, count(*) FILTER (WHERE osm_type = 'way' AND lit = 'yes' AND dist <= 250) AS highway_lit, count(*) FILTER (WHERE osm_type = 'way' AND railway = 'rail' AND dist <= 1500) AS rail_ways, min(CASE WHEN osm_type = 'way' AND railway = 'rail' AND dist <= 1500 THEN dist END) AS rail_m, min(CASE WHEN {_MAJOR_WAY} AND dist <= 300 THEN dist END) AS major_m FROM pa GROUP BY 1) USING (point_id)")
def lighting_rail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lit and other highways, rail ways and the nearest rail and major road."""
    return _metrics(spark, sf_dir, *_way_flags()).select("point_id", "highway_total", "highway_lit", "rail_ways", F.round("nearest_rail_m", 3).alias("nearest_rail_m"), F.round("nearest_major_road_m", 3).alias("nearest_major_road_m"))


@query(f"{_PAIRS} SELECT point_id, coalesce(n, 0) AS major_road_ways, round(v, 6) AS speed_mean FROM li LEFT JOIN (SELECT point_id, count(*) FILTER (WHERE osm_type = 'way' AND highway IN ('primary', 'secondary') AND dist <= 300) AS n, avg(CASE WHEN osm_type = 'way' AND highway IN ('primary', 'secondary') AND dist <= 300 THEN value END) AS v FROM pa GROUP BY 1) USING (point_id)")
def traffic_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, reach = neighbourhood.neighbourhood_flags()["major_road_ways"]
    li, el = base.listings(spark, sf_dir).select("point_id", "lat", "lon"), base.elements(spark, sf_dir).select("osm_type", "tags", "value", "lat", "lon")
    return neighbourhood.counts_around(li, el, {"major_road_ways": (flag, reach)}, means={"speed_mean": (flag, F.col("value"), reach)}).select("point_id", "major_road_ways", *r6("speed_mean"))


def _sat(x: str, k: float) -> str:
    return f"(CASE WHEN {x} > 0 THEN 1 - exp(-({x})::DOUBLE / {k}) ELSE 0 END)"


_M = f"mm AS (SELECT point_id, {', '.join(f'coalesce({k}, 0) AS {k}' for k in _AROUND)} FROM li LEFT JOIN (SELECT point_id, {_around_counts()} FROM pa GROUP BY 1) USING (point_id)), tt AS (SELECT *, {_sat('amenity_any + shop_any + healthcare_any + tourism_any', 250)} AS a, {_sat('platform + bus_stop + rail_stop + bus_station', 60)} AS t, {_sat('park + wood + green_landuse', 40)} AS g, {_sat('nightlife', 10)} AS n, 1 / (1 + major_road_ways / 6) AS r FROM mm)"


@query(f"{_PAIRS}, {_M} SELECT point_id, round(a, 6) AS amenities_score, round(t, 6) AS transit_score, round(g, 6) AS green_score, round(n, 6) AS nightlife_score, round(r, 6) AS traffic_score, round(least(100.0, greatest(0.0, (0.35 * a + 0.25 * t + 0.25 * g + 0.05 * n + 0.10 * r) * 100)), 6) AS living_standard FROM tt")
def living_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = radius_counts(spark, sf_dir)
    c = F.col
    parts = scores.living_standard(c("amenity_any") + c("shop_any") + c("healthcare_any") + c("tourism_any"), c("platform") + c("bus_stop") + c("rail_stop") + c("bus_station"), c("park") + c("wood") + c("green_landuse"), c("nightlife"), c("major_road_ways"))
    return m.select("point_id", *[F.round(v, 6).alias(k) for k, v in parts.items()])


def _dis(d: str, d0: float) -> str:
    return f"coalesce(exp(-{d} / {d0}), 0.0)"


_EXTRA = f"pp AS (SELECT li.point_id, {', '.join(f'coalesce({k}_count, 0) AS {k}_count, nearest_{k}_m' for k in _POI)}, coalesce(ways, 0) AS ways, major_m, rail_m, coalesce(hw, 0) AS hw, coalesce(hl, 0) AS hl FROM li LEFT JOIN (SELECT point_id, {_POI_AGG}, count(*) FILTER (WHERE {_MAJOR_WAY} AND dist <= 300) AS ways, min(CASE WHEN {_MAJOR_WAY} AND dist <= 300 THEN dist END) AS major_m, min(CASE WHEN osm_type = 'way' AND railway = 'rail' AND dist <= 1500 THEN dist END) AS rail_m, count(*) FILTER (WHERE osm_type = 'way' AND highway IS NOT NULL AND dist <= 250) AS hw, count(*) FILTER (WHERE osm_type = 'way' AND lit = 'yes' AND dist <= 250) AS hl FROM pa GROUP BY 1) q USING (point_id)), ss AS (SELECT point_id, 0.35 * {_sat('supermarket_count', 6)} + 0.20 * {_sat('bakery_count', 8)} + 0.25 * {_sat('pharmacy_count', 6)} + 0.20 * {_sat('doctors_count', 6)} AS w, greatest(0.55 * {_sat('school_count', 6)} + 0.45 * {_sat('kindergarten_count', 6)}, 0.6 * {_dis('nearest_school_m', 1200)}) AS e, greatest(0.35 * {_sat('pharmacy_count', 6)} + 0.35 * {_sat('doctors_count', 8)} + 0.30 * {_sat('hospital_count', 2)}, 0.7 * {_dis('nearest_hospital_m', 5000)}) AS h, greatest(0.55 * {_sat('park_count', 8)} + 0.45 * {_sat('playground_count', 8)}, {_dis('nearest_park_m', 1200)}) AS g, 0.65 * (CASE WHEN hw > 0 THEN hl / hw ELSE 0 END) + 0.35 * {_dis('nearest_police_m', 4000)} AS s, 0.5 / (1 + ways / 6) + 0.3 * {_dis('major_m', 1500)} + 0.2 * {_dis('rail_m', 1500)} AS q FROM pp)"


@query(f"{_PAIRS}, {_EXTRA} SELECT point_id, round(w, 6) AS walkability, round(e, 6) AS education, round(h, 6) AS healthcare, round(g, 6) AS green_quality, round(s, 6) AS safety, round(q, 6) AS quiet, round(0.40 * e + 0.35 * g + 0.25 * q, 6) AS family FROM ss")
def extra_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, nearest = (a | b for a, b in zip(_poi_flags(), _way_flags()))
    counts["major_road_ways"] = neighbourhood.neighbourhood_flags()["major_road_ways"]
    m = _metrics(spark, sf_dir, counts, nearest)
    return m.select("point_id", *[F.round(v, 6).alias(k) for k, v in scores.extra_scores({c: F.col(c) for c in m.columns}).items()])


_STOPS = "dp AS (SELECT l_suppkey AS stop_id, count(*) AS total, count(*) FILTER (WHERE t BETWEEN 25200 AND 32399) AS peak_am, count(*) FILTER (WHERE t BETWEEN 57600 AND 68399) AS peak_pm FROM (SELECT l_suppkey, (l_orderkey * 37 % 100000) % 86400 AS t FROM lineitem) GROUP BY 1)"


def _way_sql() -> str:
    """``wd``: elements with their distance to each listing of the city: ways by their line of two vertices, others by their place."""
    end = {"lat": f"el.lat + ((element_id::BIGINT) * 17 % 401 - 200)::DOUBLE / 60000.0::DOUBLE", "lon": f"el.lon + ((element_id::BIGINT) * 31 % 401 - 200)::DOUBLE / 60000.0::DOUBLE"}
    local = f"(SELECT point_id, el.*, {haversine_sql('li', 'el')} AS straight, (el.lon - li.lon) * 111320 * cos(radians(li.lat)) AS x1, (el.lat - li.lat) * 111320 AS y1, ({end['lon']} - li.lon) * 111320 * cos(radians(li.lat)) AS x2, ({end['lat']} - li.lat) * 111320 AS y2 FROM li JOIN el ON li.city = el.city)"
    return f"wd AS (SELECT s.*, CASE WHEN osm_type = 'way' THEN {base.segment_sql('0.0::DOUBLE', '0.0::DOUBLE', 's')} ELSE straight END AS dist FROM {local} s)"


_ROAD = f"osm_type = 'way' AND highway IN {neighbourhood.MAJOR_ROADS}"


@query(f"WITH {SQL['el']}, {SQL['li']}, {_way_sql()}, ag AS (SELECT point_id, count(*) FILTER (WHERE amenity IS NOT NULL AND dist <= 800) AS amenity_any, count(*) FILTER (WHERE landuse IN {neighbourhood.GREEN_LANDUSE} AND dist <= 1000) AS green_landuse, count(*) FILTER (WHERE {_ROAD} AND dist <= 300) AS major_road_ways, count(*) FILTER (WHERE osm_type = 'way' AND railway = 'rail' AND dist <= 1500) AS rail_ways, min(CASE WHEN osm_type = 'way' AND railway = 'rail' AND dist <= 1500 THEN dist END) AS rail, min(CASE WHEN {_ROAD} AND dist <= 300 THEN dist END) AS road, avg(CASE WHEN {_ROAD} AND dist <= 300 THEN value END) AS speed FROM wd WHERE dist <= 1500 GROUP BY 1) SELECT point_id, coalesce(amenity_any, 0) AS amenity_any, coalesce(green_landuse, 0) AS green_landuse, coalesce(major_road_ways, 0) AS major_road_ways, coalesce(rail_ways, 0) AS rail_ways, round(rail, 3) AS nearest_rail_m, round(road, 3) AS nearest_major_road_m, round(speed, 6) AS speed_mean FROM li LEFT JOIN ag USING (point_id)")
def geometry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, nearest distances and a mean where ways are lines: one counts wherever any part of it is in the circle."""
    i = F.col("element_id")
    end = F.struct((F.col("lat") + (i * 17 % 401 - 200).cast("double") / 60000.0).alias("lat"), (F.col("lon") + (i * 31 % 401 - 200).cast("double") / 60000.0).alias("lon"))
    line = F.when(F.col("osm_type") == "way", F.array(F.struct("lat", "lon"), end))
    el = base.elements(spark, sf_dir).select("osm_type", "tags", "value", "lat", "lon", line.alias("geometry"))
    flags, (ways, nearest) = neighbourhood.neighbourhood_flags(), _way_flags()
    road, reach = flags["major_road_ways"]
    counts = {k: flags[k] for k in ("amenity_any", "green_landuse", "major_road_ways")} | {"rail_ways": ways["rail_ways"]}
    li = base.listings(spark, sf_dir).select("point_id", "lat", "lon")
    got = neighbourhood.counts_around(li, el, counts, nearest=nearest, means={"speed_mean": (road, F.col("value"), reach)})
    return got.select("point_id", *counts, F.round("nearest_rail_m", 3).alias("nearest_rail_m"), F.round("nearest_major_road_m", 3).alias("nearest_major_road_m"), *r6("speed_mean"))


_END = "CASE WHEN p_partkey % 4 > 0 THEN ({0} * {1} % 401 - 200)::DOUBLE / 60000.0::DOUBLE ELSE 0.0::DOUBLE END"
_GEOM = f"gm AS (SELECT {base._P} AS line_id, {base._slat(base._P)} AS la, {base._slon(base._P)} AS lo, {base._slat(base._P)} + {_END.format(base._P, 17)} AS lb, {base._slon(base._P)} + {_END.format(base._P, 31)} AS lp FROM part)"
_LOCAL = "(SELECT point_id, line_id, (lo - lon) * 111320 * cos(radians(lat)) AS x1, (la - lat) * 111320 AS y1, (lp - lon) * 111320 * cos(radians(lat)) AS x2, (lb - lat) * 111320 AS y2 FROM li JOIN gm ON abs(la - lat) < 1 AND abs(lo - lon) < 1)"


@query(f"WITH {SQL['li']}, {_GEOM}, pr AS (SELECT point_id, {base.segment_sql('0.0::DOUBLE', '0.0::DOUBLE', 's')} AS d FROM {_LOCAL} s) SELECT point_id, count(*) AS lines, round(min(d), 3) AS nearest_m FROM pr WHERE d <= 900 GROUP BY 1")
def radius_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with any part within 900 m of a listing, by distance to their geometry; a quarter are single points."""
    i = F.col("p_partkey")
    end = F.struct((base._lat(i) + (i * 17 % 401 - 200).cast("double") / 60000.0).alias("lat"), (base._lon(i) + (i * 31 % 401 - 200).cast("double") / 60000.0).alias("lon"))
    start = F.struct(base._lat(i).alias("lat"), base._lon(i).alias("lon"))
    lines = table(spark, sf_dir, "part").select(i.alias("line_id"), F.when(i % 4 > 0, F.array(start, end)).otherwise(F.array(start)).alias("geometry"))
    met = spatial.geometry_pairs(base.listings(spark, sf_dir).select("point_id", "lat", "lon"), lines, 900.0)
    return met.groupBy("point_id").agg(F.count("*").alias("lines"), F.round(F.min("dist"), 3).alias("nearest_m"))


@query(f"WITH {SQL['li']}, {SQL['sp']}, {_STOPS}, ss AS (SELECT sp.lat, sp.lon, coalesce(total, 0) AS total, coalesce(peak_am, 0) AS peak_am, coalesce(peak_pm, 0) AS peak_pm FROM sp LEFT JOIN dp USING (stop_id)), bx AS (SELECT *, 800.0::DOUBLE / 111000 AS a, 800.0::DOUBLE / greatest(1.0, 111000 * cos(radians(lat))) AS b FROM li), mt AS (SELECT bx.point_id, total, peak_am, peak_pm, {haversine_sql('bx', 'ss')} AS d FROM bx JOIN ss ON floor(ss.lat / 0.01) BETWEEN floor((bx.lat - a) / 0.01) AND floor((bx.lat + a) / 0.01) AND floor(ss.lon / 0.01) BETWEEN floor((bx.lon - b) / 0.01) AND floor((bx.lon + b) / 0.01)) SELECT point_id, round(min(d), 3) AS nearest_stop_m, count(*) FILTER (WHERE d <= 800) AS stops_in_radius, coalesce(sum(total) FILTER (WHERE d <= 800), 0)::BIGINT AS total, coalesce(sum(peak_am) FILTER (WHERE d <= 800), 0)::BIGINT AS peak_am, coalesce(sum(peak_pm) FILTER (WHERE d <= 800), 0)::BIGINT AS peak_pm FROM li LEFT JOIN mt USING (point_id) GROUP BY 1")
def transit_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops = neighbourhood.stop_departures(base.stops(spark, sf_dir), base.stop_times(spark, sf_dir), keys=["stop_id"])
    out = spatial.transit_access(base.listings(spark, sf_dir).select("point_id", "lat", "lon"), stops, radius=800.0)
    return out.select("point_id", F.round("nearest_stop_m", 3).alias("nearest_stop_m"), "stops_in_radius", "total", "peak_am", "peak_pm")


@query(f"WITH {_STOPS} SELECT s_suppkey AS stop_id, coalesce(total, 0) AS total, coalesce(peak_am, 0) AS peak_am, coalesce(peak_pm, 0) AS peak_pm FROM supplier LEFT JOIN dp ON stop_id = s_suppkey")
def stop_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbourhood.stop_departures(base.stops(spark, sf_dir), base.stop_times(spark, sf_dir), keys=["stop_id"]).select("stop_id", "total", "peak_am", "peak_pm")


@query(f"WITH {SQL['li']}, {SQL['sn']}, mt AS (SELECT li.point_id, station_id, {haversine_sql('li', 'sn')} AS d FROM li CROSS JOIN sn) SELECT point_id, station_id, round(d, 3) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d, station_id) AS rn FROM mt) WHERE rn = 1")
def nearest_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing's true nearest station, however far."""
    out = around.nearest(base.listings(spark, sf_dir), base.stations(spark, sf_dir).withColumnRenamed("station_id", "target_id"))
    return out.select("point_id", F.col("target_id").alias("station_id"), F.round("dist", 3).alias("dist"))


@query(f"WITH {SQL['li']}, {SQL['sn']}, mt AS (SELECT li.point_id, station_id, greatest(abs(floor(sn.lat / 0.2) - floor(li.lat / 0.2)), abs(floor(sn.lon / 0.2) - floor(li.lon / 0.2))) AS ring, {haversine_sql('li', 'sn')} AS d FROM li JOIN sn ON abs(floor(sn.lat / 0.2) - floor(li.lat / 0.2)) <= 6 AND abs(floor(sn.lon / 0.2) - floor(li.lon / 0.2)) <= 6), rr AS (SELECT *, min(ring) OVER (PARTITION BY point_id) AS f FROM mt) SELECT point_id, station_id FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d, station_id) AS rn FROM rr WHERE ring <= greatest(2, f)) WHERE rn = 1")
def nearest_station_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearest_station(base.listings(spark, sf_dir), base.stations(spark, sf_dir), ring_rule=True).select("point_id", "station_id")


@query("SELECT event_id % 25 AS station_id, event_type AS component, count(value) AS n, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most FROM events GROUP BY ALL")
def station_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "events").select((F.col("event_id") % 25).alias("station_id"), F.col("event_type").alias("component"), "value")
    return neighbourhood.measure_stats(m, ["station_id", "component"]).select("station_id", "component", "n", *r6("mean"), "least", "most")


_GEO_ROWS = "ge AS (SELECT o_orderkey AS id, [NULL, 'overpass_address', 'overpass_postcode', 'nominatim'][o_orderkey % 4 + 1] AS method, CASE WHEN o_orderkey % 9 = 0 THEN 'postcode' WHEN o_orderkey % 11 = 0 THEN 'address' END AS precision, (o_custkey % 3)::INT AS matched, (o_custkey % 200)::INT AS sampled, ['house', 'apartments', 'road', 'city', 'other'][o_custkey % 5 + 1] AS address_type, CASE WHEN o_orderkey % 2 = 0 THEN (o_custkey % 120)::DOUBLE / 100 END AS importance, o_orderkey % 3 = 0 AS known FROM orders)"
_CONF = "CASE WHEN method IS NOT DISTINCT FROM 'overpass_address' OR precision IS NOT DISTINCT FROM 'address' THEN 1 WHEN method IS NOT DISTINCT FROM 'overpass_postcode' OR precision IS NOT DISTINCT FROM 'postcode' THEN 2 WHEN method IS NOT DISTINCT FROM 'nominatim' THEN 3 ELSE 4 END AS r, (CASE address_type WHEN 'house' THEN 0.92 WHEN 'apartments' THEN 0.85 WHEN 'road' THEN 0.75 WHEN 'city' THEN 0.5 ELSE 0.65 END)::DOUBLE * CASE WHEN importance IS NULL THEN 1.0 ELSE 0.8 + 0.2 * least(1.0, importance) END AS c"


@query(f"WITH {_GEO_ROWS}, rr AS (SELECT *, {_CONF} FROM ge) SELECT id, round(CASE r WHEN 1 THEN CASE WHEN matched > 0 THEN least(0.99, 0.95 + 0.01 * least(5, matched)) ELSE 0.95 END WHEN 2 THEN (0.45 + 0.30 * (1 - exp(-sampled / 60.0::DOUBLE))) * CASE WHEN known THEN 0.75 ELSE 1 END WHEN 3 THEN c * CASE WHEN known AND c < 0.75 THEN 0.9 ELSE 1 END ELSE CASE WHEN known THEN 0.32 ELSE 0.4 END END::DOUBLE, 6) AS confidence, ['address_match', 'postcode_centroid', 'nominatim', 'unknown'][r] AS rule FROM rr")
def geocode_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k, c = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    pick = lambda names, i: F.element_at(F.array(*[F.lit(n).cast("string") for n in names]), (i % len(names) + 1).cast("int"))
    rows = o.select(k.alias("id"), pick([None, "overpass_address", "overpass_postcode", "nominatim"], k).alias("method"), F.when(k % 9 == 0, "postcode").when(k % 11 == 0, "address").alias("precision"), (c % 3).cast("int").alias("matched"), (c % 200).cast("int").alias("sampled"), pick(["house", "apartments", "road", "city", "other"], c).alias("kind"), F.when(k % 2 == 0, (c % 120).cast("double") / 100).alias("importance"), (k % 3 == 0).alias("known"))
    made = scores.geocode_confidence(*[F.col(n) for n in ("method", "precision", "matched", "sampled", "kind", "importance", "known")])
    return rows.select("id", made.alias("g")).select("id", F.round("g.confidence", 6).alias("confidence"), "g.rule")


_WANT = "wa AS (SELECT o_orderkey AS id, 'Brand#' || (o_orderkey % 5 + 1) || (o_custkey % 5 + 1) AS street, (o_custkey % 45)::VARCHAR AS housenumber, (10000 + o_orderkey % 60)::VARCHAR AS postcode, CASE WHEN o_orderkey % 3 > 0 THEN 'town ' || (o_custkey % 6) END AS city FROM orders)"


@query(f"WITH {SQL['ad']}, {_WANT}, a AS (SELECT postcode, lower(street) AS s, housenumber AS h, first(lat ORDER BY osm_type, osm_id) AS lat, first(lon ORDER BY osm_type, osm_id) AS lon FROM ad GROUP BY 1, 2, 3), nd AS (SELECT *, lower(city) AS c FROM ad WHERE osm_type = 'node'), b AS (SELECT postcode, c, avg(lat) AS lat, avg(lon) AS lon, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY postcode, c ORDER BY osm_id) AS k FROM nd) WHERE k <= 20 GROUP BY 1, 2), b0 AS (SELECT postcode, avg(lat) AS lat, avg(lon) AS lon, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY postcode ORDER BY osm_id) AS k FROM nd) WHERE k <= 20 GROUP BY 1) SELECT wa.id, round(coalesce(a.lat, b.lat, b0.lat, CASE WHEN wa.id % 2 = 0 THEN 50.0 END)::DOUBLE, 6) AS lat, round(coalesce(a.lon, b.lon, b0.lon, CASE WHEN wa.id % 2 = 0 THEN 10.0 END)::DOUBLE, 6) AS lon, CASE WHEN a.lat IS NOT NULL THEN 'overpass_address' WHEN coalesce(b.lat, b0.lat) IS NOT NULL THEN 'overpass_postcode' WHEN wa.id % 2 = 0 THEN 'nominatim' END AS method, CASE WHEN coalesce(a.lat, b.lat, b0.lat) IS NULL AND wa.id % 2 = 1 THEN 'geocode_failed' ELSE 'ok' END AS status FROM wa LEFT JOIN a ON a.postcode = wa.postcode AND a.s = lower(wa.street) AND a.h = wa.housenumber LEFT JOIN b ON b.postcode = wa.postcode AND b.c = wa.city LEFT JOIN b0 ON b0.postcode = wa.postcode AND wa.city IS NULL")
def geocode_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    want = table(spark, sf_dir, "orders").select(k.alias("id"), F.concat(F.lit("Brand#"), (k % 5 + 1).cast("string"), (c % 5 + 1).cast("string")).alias("street"), (c % 45).cast("string").alias("housenumber"), (10000 + k % 60).cast("string").alias("postcode"), F.when(k % 3 > 0, F.concat(F.lit("town "), (c % 6).cast("string"))).alias("city"))
    fallback = want.where("id % 2 = 0").select("id", F.lit(50.0).alias("lat"), F.lit(10.0).alias("lon"))
    return neighbourhood.geocode_cascade(want, base.addresses(spark, sf_dir), fallback, sample=20).select("id", *r6("lat", "lon"), "method", "status")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'geocode_failed' WHEN o_orderkey % 6 = 1 THEN 'overpass_failed' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 4 > 0 AND o_orderkey % 6 = 1 THEN 'timeout' END AS error FROM orders")
def enrichment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of records: no position, no map data (with the error), or ok."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    placed = o.select(k.alias("id"), F.when(k % 4 > 0, 50.0).alias("lat"), F.lit("ok").alias("status"))
    lost = o.where("o_orderkey % 6 = 1").select(k.alias("id"), F.explode(F.array(F.lit("timeout"), F.lit("unreachable"))).alias("error"))
    return neighbourhood.enrichment_status(placed, lost).select("id", "status", "error")


@query(f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'way' ELSE 'node' END AS osm_type, round({base._slat(base._E)}, 6) AS lat, round({base._slon(base._E)}, 6) AS lon, event_type AS tag, event_id % 4 AS vertices FROM events")
def map_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements out of query answers: own position or centre, tags and geometry."""
    i = F.col("event_id")
    point = F.struct(base._lat(i).alias("lat"), base._lon(i).alias("lon"))
    own = i % 3 > 0
    line = F.transform(F.filter(F.sequence(F.lit(1), F.lit(3)), lambda j: j <= i % 4), lambda j: F.struct((j * 1.0).alias("lat"), (j * 2.0).alias("lon")))
    element = F.struct(F.when(own, "node").otherwise("way").alias("type"), i.alias("id"), F.when(own, point["lat"]).alias("lat"), F.when(own, point["lon"]).alias("lon"), F.when(~own, point).alias("center"), F.create_map(F.lit("kind"), F.col("event_type")).alias("tags"), line.alias("geometry"))
    answers = table(spark, sf_dir, "events").groupBy((i % 997).alias("answer")).agg(F.collect_list(element).alias("elements"))
    out = readers.elements(answers)
    return out.select(F.col("osm_id").alias("event_id"), "osm_type", *r6("lat", "lon"), F.col("tags.kind").alias("tag"), F.size("geometry").cast("long").alias("vertices"))


@query(f"SELECT n_nationkey::BIGINT AS station_id, 'DE' || n_nationkey AS code, n_name AS name, round({base._slat(base._N)}, 6) AS lat FROM nation WHERE n_nationkey % 4 > 0")
def station_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active stations out of a columnar payload."""
    i, s = F.col("n_nationkey").cast("long"), lambda c: c.cast("string")
    names = ["station code", "station active to", "station id", "station name", "station city", "station latitude", "station longitude"]
    row = F.array(F.concat(F.lit("DE"), s(i)), F.when(i % 4 == 0, "2001-01-01").when(i % 4 == 1, ""), s(i), F.col("n_name"), F.lit("x"), s(base._lat(i)), s(base._lon(i)))
    payload = table(spark, sf_dir, "nation").select(F.array(*map(F.lit, names)).alias("indices"), F.create_map(s(i), row).alias("data"))
    return readers.stations(payload).select("station_id", "code", "name", *r6("lat"))


#: A reference of a way or relation; some lead nowhere.
_MEMBER = "CASE WHEN l_linenumber % 4 = 3 THEN -l_partkey ELSE l_partkey END"


def _member() -> Column:
    return F.when(F.col("l_linenumber") % 4 == 3, -F.col("l_partkey")).otherwise(F.col("l_partkey"))


@query(f"WITH nd AS (SELECT p_partkey AS member_id, {base._slat('p_partkey')} AS lat, {base._slon('p_partkey')} AS lon FROM part) SELECT l_suppkey AS relation_id, round((min(lat) + max(lat)) / 2, 6) AS lat, round((min(lon) + max(lon)) / 2, 6) AS lon FROM lineitem JOIN nd ON {_MEMBER} = member_id GROUP BY 1")
def relation_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre of the box of a relation's members."""
    p = F.col("p_partkey")
    at = table(spark, sf_dir, "part").select(p.alias("member_id"), base._lat(p).alias("lat"), base._lon(p).alias("lon"))
    members = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("relation_id"), _member().alias("member_id"))
    return readers.relation_centres(members, at).select("relation_id", *r6("lat", "lon"))


@query(f"WITH e AS (SELECT 'node' AS kind, p_partkey AS id, round({base._slat('p_partkey')}, 6) AS lat, 'Brand <' || p_brand || '> & Co' AS name, 0 AS refs, 0::HUGEINT AS total FROM part UNION ALL SELECT 'way', l_orderkey, NULL, NULL, count(*), sum(l_partkey) FROM lineitem GROUP BY 2 UNION ALL SELECT 'relation', n_nationkey, NULL, any_value(n_name), count(s_suppkey), sum(s_suppkey) FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 2) SELECT kind, id::BIGINT AS id, lat, name, refs::INT AS refs, coalesce(total, 0)::BIGINT AS total FROM e")
def map_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map extract written from parts, orders and suppliers as XML and read back in one pass: nodes, ways, relations with members."""
    t = lambda name: table(spark, sf_dir, name)
    s, e = lambda c: F.col(c).cast("string"), lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    named = lambda c: F.concat(F.lit("  <tag k='name' v=\""), e(c), F.lit("\"/>\n"))
    nodes = t("part").select(F.concat(F.lit('<node id="'), s("p_partkey"), F.lit('" lat="'), base._lat(F.col("p_partkey")).cast("string"), F.lit("\" lon='9.5'>\n"), named(F.concat(F.lit("Brand <"), "p_brand", F.lit("> & Co"))), F.lit("</node>")).alias("value"))
    joined = lambda parts: F.array_join(F.collect_list(parts), "")
    ways = t("lineitem").groupBy("l_orderkey").agg(joined(F.concat(F.lit('<nd ref="'), s("l_partkey"), F.lit('"/>'))).alias("nd")).select(F.concat(F.lit('<way id="'), s("l_orderkey"), F.lit('">'), "nd", F.lit("</way>")).alias("value"))
    member = F.when(F.col("s_suppkey").isNotNull(), F.concat(F.lit('<member type="node" ref="'), s("s_suppkey"), F.lit('" role=""/>')))
    relations = t("nation").join(t("supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_nationkey", "n_name").agg(joined(member).alias("m")).select(F.concat(F.lit('<relation id="'), s("n_nationkey"), F.lit('">'), "m", named(F.col("n_name")), F.lit("</relation>")).alias("value"))
    path = shared_dir(spark)
    nodes.unionByName(ways).unionByName(relations).write.text(path)
    got = readers.read_osm(spark, path)
    refs = F.coalesce(F.when(F.size("nodes") > 0, F.col("nodes")), F.transform("members", lambda m: m.ref))
    return got.select("kind", "id", F.round("lat", 6).alias("lat"), F.try_element_at("tags", F.lit("name")).alias("name"), F.size(refs).alias("refs"), F.aggregate(refs, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query(f"WITH {SQL['li']} SELECT point_id, round(CASE WHEN point_id % 3 > 0 THEN lat ELSE 48.0 + city END, 6) AS lat FROM li")
def own_or_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing's own latitude, else its city's."""
    li = base.listings(spark, sf_dir)
    return li.select("point_id", F.round(geo.own_or_centre(F.when(F.col("point_id") % 3 > 0, F.col("lat")), 48.0 + F.col("city")), 6).alias("lat"))


@query(f"WITH {SQL['li']}, ce AS (SELECT ['den', 'night'][p_partkey % 2 + 1] AS band, (p_partkey // 2 % 50)::INT AS row, (p_partkey // 100 % 20)::INT AS col, avg(CASE WHEN p_size <> 7 THEN p_retailprice END) AS v FROM part GROUP BY ALL) SELECT point_id, band, round(v, 6) AS value FROM li JOIN ce ON ce.row = floor((5000 - y) / 200)::INT AND ce.col = floor((x + 5000) / 500)::INT")
def raster_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    cells = table(spark, sf_dir, "part").groupBy(F.when(p % 2 == 0, "den").otherwise("night").alias("band"), F.expr("cast(p_partkey div 2 % 50 as int)").alias("row"), F.expr("cast(p_partkey div 100 % 20 as int)").alias("col")).agg(F.coalesce(F.avg(F.when(F.col("p_size") != 7, F.col("p_retailprice"))), F.lit(-1.0)).alias("value"))
    return spatial.raster_sample(base.listings(spark, sf_dir), cells, x0=-5000.0, y0=5000.0, width=500.0, height=200.0, no_data=-1.0).select("point_id", "band", *r6("value"))


@query(f"WITH nd AS (SELECT p_partkey AS node_id, {base._slat('p_partkey')} AS lat, {base._slon('p_partkey')} AS lon FROM part) SELECT l_orderkey AS way_id, count(*) AS vertices, round(first(lat ORDER BY l_linenumber, lat, lon), 6) AS first_lat, round(last(lon ORDER BY l_linenumber, lat, lon), 6) AS last_lon, round((min(lat) + max(lat)) / 2, 6) AS lat, round((min(lon) + max(lon)) / 2, 6) AS lon FROM lineitem JOIN nd ON {_MEMBER} = node_id GROUP BY 1")
def way_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    nodes = table(spark, sf_dir, "part").select(p.alias("node_id"), base._lat(p).alias("lat"), base._lon(p).alias("lon"))
    ways = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("way_id"), F.col("l_linenumber").alias("pos"), _member().alias("node_id"))
    out = grid.way_lines(ways, nodes)
    return out.select("way_id", F.size("geometry").cast("long").alias("vertices"), F.round(F.element_at("geometry", 1)["lat"], 6).alias("first_lat"), F.round(F.element_at("geometry", -1)["lon"], 6).alias("last_lon"), *r6("lat", "lon"))


@query("WITH v AS (SELECT o_orderkey AS way_id, o_custkey % 4 + 1 AS n FROM orders) SELECT way_id, i::INT AS pos, i * 2.0::DOUBLE AS from_x, (i + 1) * 2.0::DOUBLE AS to_x FROM v, range(1, 5) r(i) WHERE i < n")
def way_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.transform(F.sequence(F.lit(1).cast("long"), F.col("o_custkey") % 4 + 1), lambda i: i * 2.0)
    parts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("way_id"), F.posexplode(geo.segments_of(line)).alias("pos", "s"))
    return parts.select("way_id", (F.col("pos") + 1).alias("pos"), F.col("s.a").alias("from_x"), F.col("s.b").alias("to_x"))


@query(f"WITH {SQL['li']} SELECT point_id, round(round(lat, 2) * 2 + round(lon, 2), 6) AS value FROM li")
def location_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An operator evaluated once per rounded coordinate."""
    once = lambda places: places.select("point_id", F.round(F.col("lat") * 2 + F.col("lon"), 6).alias("value"))
    return spatial.per_location(base.listings(spark, sf_dir).select("point_id", "lat", "lon"), once, digits=2).select("point_id", "value")
