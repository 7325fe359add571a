"""Roles of the given tables for the registered queries: listings, map elements, streets, stops, stations.

Positions come from ids by integer arithmetic, so Spark and SQL agree on them.  ``SQL`` has the same roles as
common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AMENITIES = ["bar", "pharmacy", "doctors", "school", "bus_station", "police", "hospital", "kindergarten", "university", "pub"]
SHOPS = ["supermarket", "bakery", "convenience"]
HIGHWAYS = ["bus_stop", "primary", "residential", "secondary"]
LEISURE = ["park", "playground", "pitch", "garden"]
LANDUSE = ["forest", "retail", "grass", "meadow", "industrial", "recreation_ground", "village_green"]
NATURAL = ["wood", "water"]
RAILWAYS = ["rail", "station", "tram_stop", "disused"]
PLATFORMS = ["platform", "stop_position"]
LIT = ["yes", "no", "limited", "yes", "24/7"]
ROADS = ["primary", "residential", "motorway", "tertiary", "service", "secondary", "trunk"]
OSM_TYPES = ["node", "way", "relation"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _x(i: Column) -> Column:
    return (i * 7919 % 10007).cast("double") / 10007.0 * 10000.0 - 5000.0


def _y(i: Column) -> Column:
    return (i * 104729 % 10009).cast("double") / 10009.0 * 10000.0 - 5000.0


def _lat(i: Column) -> Column:
    return 48.0 + (i % 5) + _y(i) / 111320.0


def _lon(i: Column) -> Column:
    return 9.0 + _x(i) / (F.lit(111320.0) * F.cos(F.radians(48.0 + (i % 5))))


def cities(spark: SparkSession) -> DataFrame:
    return spark.range(5).withColumnRenamed("id", "city")


def _pick(names: list[str], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (i % len(names) + 1).cast("int"))


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map elements from ``events``: city, local and geographic position, type and tags; some lie where listings do."""
    i, kind = F.col("event_id"), F.col("event_type")
    at = i + 12345
    tags = {"amenity": ("view", _pick(AMENITIES, i)), "shop": ("click", _pick(SHOPS, i)), "landuse": ("click", _pick(LANDUSE, i)), "healthcare": ("purchase", F.lit("yes")), "leisure": ("purchase", _pick(LEISURE, i)), "tourism": ("signup", F.lit("hotel")), "natural": ("signup", _pick(NATURAL, i)), "railway": ("signup", _pick(RAILWAYS, i)), "highway": ("error", _pick(HIGHWAYS, i)), "lit": ("error", _pick(LIT, i)), "public_transport": ("error", _pick(PLATFORMS, i))}
    given = F.map_filter(F.create_map(*[c for k, (own, v) in tags.items() for c in (F.lit(k), F.when(kind == own, v))]), lambda _, v: v.isNotNull())
    return table(spark, sf_dir, "events").select(i.alias("element_id"), (i % 5).alias("city"), _x(at).alias("x"), _y(at).alias("y"), _lat(at).alias("lat"), _lon(at).alias("lon"), _pick(OSM_TYPES, i).alias("osm_type"), kind.alias("kind"), "value", given.alias("tags"))


def streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street segments from ``part``."""
    i = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(i.alias("seg_id"), (i % 5).alias("city"), _x(i).alias("x1"), _y(i).alias("y1"), (_x(i) + (i * 31 % 401) - 200).alias("x2"), (_y(i) + (i * 17 % 401) - 200).alias("y2"), F.col("p_brand").alias("street"), _pick(ROADS, i).alias("highway"), F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("double")).alias("maxspeed"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings from ``customer``, at other places than the streets."""
    i = F.col("c_custkey") + 12345
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("point_id"), (i % 5).alias("city"), _x(i).alias("x"), _y(i).alias("y"), _lat(i).alias("lat"), _lon(i).alias("lon"), F.col("c_acctbal").alias("balance"))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops from ``supplier``, where listings are."""
    i = F.col("s_suppkey") + 12345
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("stop_id"), _lat(i).alias("lat"), _lon(i).alias("lon"))


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures from ``lineitem``, as ``H:MM:SS`` texts that pass 24 hours."""
    t = F.col("l_orderkey") * 37 % 100000
    text = F.format_string("%d:%02d:%02d", F.floor(t / 3600), F.floor(t % 3600 / 60), t % 60)
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("stop_id"), text.alias("departure_time"), F.lit(None).cast("string").alias("arrival_time"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("n_nationkey").cast("long")
    return table(spark, sf_dir, "nation").select(i.alias("station_id"), _lat(i).alias("lat"), _lon(i).alias("lon"))


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addressed elements from ``part``: street, number, postcode and city with a position."""
    i = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(_pick(OSM_TYPES, i).alias("osm_type"), i.alias("osm_id"), F.col("p_brand").alias("street"), (i % 40).cast("string").alias("housenumber"), F.format_string("%05d", 10000 + i % 50).alias("postcode"), F.concat(F.lit("Town "), (i % 5).cast("string")).alias("city"), _lat(i).alias("lat"), _lon(i).alias("lon"))


def _sx(i: str) -> str:
    return f"((({i}) * 7919 % 10007)::DOUBLE / 10007.0::DOUBLE * 10000.0::DOUBLE - 5000.0::DOUBLE)"


def _sy(i: str) -> str:
    return f"((({i}) * 104729 % 10009)::DOUBLE / 10009.0::DOUBLE * 10000.0::DOUBLE - 5000.0::DOUBLE)"


def _slat(i: str) -> str:
    return f"(48.0::DOUBLE + ({i}) % 5 + {_sy(i)} / 111320.0::DOUBLE)"


def _slon(i: str) -> str:
    return f"(9.0::DOUBLE + {_sx(i)} / (111320.0::DOUBLE * cos(radians(48.0::DOUBLE + ({i}) % 5))))"


def _spick(names: list[str], i: str) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][({i}) % {len(names)} + 1]"


def _case(kind: str, value: str) -> str:
    return f"CASE WHEN event_type = '{kind}' THEN {value} END"


_E, _P, _C, _S = "event_id::BIGINT", "p_partkey::BIGINT", "(c_custkey::BIGINT + 12345)", "(s_suppkey::BIGINT + 12345)"
_EP = "(event_id::BIGINT + 12345)"
_N = "n_nationkey::BIGINT"
SQL = {
    "el": f"el AS (SELECT event_id AS element_id, event_id % 5 AS city, {_sx(_EP)} AS x, {_sy(_EP)} AS y, {_slat(_EP)} AS lat, {_slon(_EP)} AS lon, {_spick(OSM_TYPES, _E)} AS osm_type, event_type AS kind, value, {_case('view', _spick(AMENITIES, _E))} AS amenity, {_case('click', _spick(SHOPS, _E))} AS shop, {_case('purchase', repr('yes'))} AS healthcare, {_case('signup', repr('hotel'))} AS tourism, {_case('error', _spick(HIGHWAYS, _E))} AS highway, {_case('purchase', _spick(LEISURE, _E))} AS leisure, {_case('click', _spick(LANDUSE, _E))} AS landuse, {_case('signup', _spick(NATURAL, _E))} AS nature, {_case('signup', _spick(RAILWAYS, _E))} AS railway, {_case('error', _spick(LIT, _E))} AS lit, {_case('error', _spick(PLATFORMS, _E))} AS public_transport FROM events)",
    "st": f"st AS (SELECT p_partkey AS seg_id, p_partkey % 5 AS city, {_sx(_P)} AS x1, {_sy(_P)} AS y1, {_sx(_P)} + (p_partkey * 31 % 401) - 200 AS x2, {_sy(_P)} + (p_partkey * 17 % 401) - 200 AS y2, p_brand AS street, {_spick(ROADS, _P)} AS highway, CASE WHEN p_size % 3 <> 0 THEN p_size::DOUBLE END AS maxspeed FROM part)",
    "li": f"li AS (SELECT c_custkey AS point_id, c_custkey % 5 AS city, {_sx(_C)} AS x, {_sy(_C)} AS y, {_slat(_C)} AS lat, {_slon(_C)} AS lon, c_acctbal AS balance FROM customer)",
    "sp": f"sp AS (SELECT s_suppkey AS stop_id, {_slat(_S)} AS lat, {_slon(_S)} AS lon FROM supplier)",
    "sn": f"sn AS (SELECT {_N} AS station_id, {_slat(_N)} AS lat, {_slon(_N)} AS lon FROM nation)",
    "ad": f"ad AS (SELECT {_spick(OSM_TYPES, _P)} AS osm_type, p_partkey AS osm_id, p_brand AS street, (p_partkey % 40)::VARCHAR AS housenumber, lpad((10000 + p_partkey % 50)::VARCHAR, 5, '0') AS postcode, 'Town ' || (p_partkey % 5) AS city, {_slat(_P)} AS lat, {_slon(_P)} AS lon FROM part)",
}


def haversine_sql(a: str, b: str) -> str:
    return f"(12742000.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))))"


def segment_sql(px: str, py: str, s: str) -> str:
    """Distance of a point to segment alias ``s``."""
    dx, dy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    square = f"({dx} * {dx} + {dy} * {dy})"
    t = f"(CASE WHEN {square} > 0 THEN least(1.0, greatest(0.0, (({px} - {s}.x1) * {dx} + ({py} - {s}.y1) * {dy}) / {square})) ELSE 0.0 END)"
    ex, ey = f"({px} - ({s}.x1 + {t} * {dx}))", f"({py} - ({s}.y1 + {t} * {dy}))"
    return f"sqrt({ex} * {ex} + {ey} * {ey})"


def near_sql(points: str, half: float, index: float, buffer: float, where: str = "true") -> str:
    """Nearest segment of ``st`` (with a condition) for ``points(city, point_id, x, y)`` by the 3 x 3 rule: ``city, point_id, seg_id, dist``."""
    n = int(-(-2 * half // index))

    def clamp(e: str) -> str:
        return f"greatest(0, least({n - 1}, floor(({e} + {half}) / {index})))"

    q = lambda a: f"floor(({points}.{a} + {half}) / {index})"
    touch = " AND ".join(f"{clamp(f'least(st.{a}1, st.{a}2) - {buffer}')} <= least({q(a)} + 1, {n - 1}) AND {clamp(f'greatest(st.{a}1, st.{a}2) + {buffer}')} >= greatest({q(a)} - 1, 0)" for a in "xy")
    return f"SELECT city, point_id, seg_id, dist FROM (SELECT {points}.city, point_id, seg_id, {segment_sql(f'{points}.x', f'{points}.y', 'st')} AS dist, row_number() OVER (PARTITION BY {points}.city, point_id ORDER BY {segment_sql(f'{points}.x', f'{points}.y', 'st')}, seg_id) AS rn FROM {points} JOIN st ON {points}.city = st.city AND {touch} AND {where}) WHERE rn = 1"
