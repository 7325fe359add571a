"""Readers for listings, map extracts, timetables, stations, labels and link dumps."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import staged

CITY_SCHEMA = "name string, lat double, lon double"


def read_jsonl(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines as ``record`` (VARIANT) with their file; blank, undecodable and non-object lines are left out.

    ``.gz``, ``.bz2`` and ``.zst`` files are read as they are.
    """
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("record"))
    return lines.where(F.col("record").isNotNull() & F.schema_of_variant("record").startswith("OBJECT"))


def read_json_batches(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON array files of a folder, without ``failed.json``, with ``file_name``."""
    reader = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json").option("allowUnquotedControlChars", True)
    df = (reader.schema(schema) if schema else reader).json(path)
    return df.withColumn("file_name", F.col("_metadata.file_name")).where("file_name <> 'failed.json'")


def parse_repaired(text: Column) -> Column:
    """JSON with raw control characters, each read as a blank."""
    return F.try_parse_json(F.regexp_replace(text, "[\\x00-\\x1F]", " "))


def _items(text: str) -> Iterator[str]:
    """The objects of an ``{"items": [...]}`` text that can be decoded; after a broken one it goes on at the next brace."""
    decoder = json.JSONDecoder()
    start = text.find("[")
    at = text.find("{", start + 1) if start >= 0 else -1
    while at >= 0:
        try:
            item, end = decoder.raw_decode(text, at)
        except ValueError:
            end, item = at + 1, None
        if isinstance(item, dict):
            yield json.dumps(item, ensure_ascii=False)
        at = text.find("{", end)


def read_broken_items(spark: SparkSession, path: str) -> DataFrame:
    """``{items: [...]}`` files that may be cut off or broken: ``file, pos, record`` of every object that can be decoded.

    One file is one task's work; a record that is broken is skipped, and reading goes on at the next brace.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, text in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                found = list(_items(text or ""))
                yield pa.record_batch([pa.array([file] * len(found), pa.string()), pa.array(range(len(found)), pa.int32()), pa.array(found, pa.string())], ["file", "pos", "text"])

    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.mapInArrow(parse, "file string, pos int, text string").select("file", "pos", F.try_parse_json("text").alias("record"))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """Cities from a three-column TSV; comments are skipped, malformed lines fail the job."""
    return spark.read.csv(path, sep="\t", comment="#", schema=CITY_SCHEMA, mode="FAILFAST")


def read_gtfs(spark: SparkSession, path: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """A timetable table of all unpacked feeds below ``path``: the named columns as text, and ``feed``.

    Every file's values are read by its own header, whose order and columns may differ; a column that a feed lacks
    is null, a feed that lacks the table is an error.  Without ``columns`` all that any feed has come, by name.  A
    byte-order mark, blanks around names and blank lines are dropped, so are lines that repeat their file's header;
    values may be quoted but hold no line breaks.
    """
    feed = lambda c: F.element_at(F.split(c, "/"), -2)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/*").select("path")
    lacking = files.groupBy(feed(F.col("path")).alias("feed")).agg(F.max(F.col("path").endswith(f"/{table}.txt")).alias("has")).where("NOT has").orderBy("feed").limit(5).collect()
    if lacking:
        raise ValueError(f"no {table}.txt in " + ", ".join(r.feed for r in lacking))
    lines = spark.read.text(f"{path}/*/{table}.txt").select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), "value")
    first = lines.where("_at = 0").withColumn("_row", F.monotonically_increasing_id()).groupBy("_file").agg(F.min_by("value", "_row").alias("_head"))
    first = staged(first)
    width = first.agg(F.max(F.size(F.split("_head", ",")))).first()[0] or 1
    cells = "STRUCT<" + ", ".join(f"c{i}: STRING" for i in range(width)) + ">"
    split = lambda c: F.from_csv(c, cells, {"escape": '"'})
    listed = lambda c: F.array(*[split(c)[f"c{i}"] for i in range(width)])
    names = F.transform(listed(F.regexp_replace("_head", "^\ufeff", "")), lambda n: F.trim(n))
    heads = staged(first.select(F.col("_file").alias("_f"), "_head", names.alias("_names")))
    if columns is None:
        columns = [r.n for r in heads.select(F.explode("_names").alias("n")).where("n <> ''").distinct().orderBy("n").collect()]
    rows = lines.join(heads, F.col("_file") == F.col("_f")).where((F.col("value") != F.col("_head")) & (F.trim("value") != ""))
    rows = rows.select("_file", "_names", listed(F.col("value")).alias("_cells"))
    value = lambda n: F.get("_cells", F.array_position("_names", F.lit(n)).cast("int") - 1)
    known = lambda n: F.when(F.array_contains("_names", n), value(n))
    return rows.select(*[known(n).alias(n) for n in columns], feed(F.col("_file")).alias("feed"))


def elements(documents: DataFrame, column: str = "elements") -> DataFrame:
    """Map elements of query answers: own or centre coordinates, tags and geometry."""
    e = documents.select(F.explode(column).alias("e"))
    return e.select(F.col("e.type").alias("osm_type"), F.col("e.id").alias("osm_id"), F.coalesce("e.lat", "e.center.lat").alias("lat"), F.coalesce("e.lon", "e.center.lon").alias("lon"), F.col("e.tags").alias("tags"), F.col("e.geometry").alias("geometry"))


# Records of a map extract, their parts, and how an attribute is written.
_RECORDS, _PARTS = ("node", "way", "relation"), ("tag", "nd", "member")
_ATTRIBUTE = re.compile(r"""([\w:.-]+)\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_MEMBERS = pa.list_(pa.struct([("type", pa.string()), ("ref", pa.int64()), ("role", pa.string())]))
_OSM = [("file", pa.string()), ("block", pa.int64()), ("place", pa.int64()), ("last", pa.bool_()), ("kind", pa.string()), ("id", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("tags", pa.list_(pa.struct([("k", pa.string()), ("v", pa.string())]))), ("nodes", pa.list_(pa.int64())), ("members", _MEMBERS)]


def _attributes(text: str) -> dict[str, str]:
    return {k: unescape(v or w) for k, v, w in _ATTRIBUTE.findall(text)}


def _osm_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the tags that come one after another; parts before a block's first record are a record 0 of their own."""
    now: dict | None = None

    def flush(rows: list[dict], last: bool) -> None:
        if now is not None:
            rows.append(now | {"last": last})

    for batch in batches:
        rows: list[dict] = []
        for file, block, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
            if now is None or (now["file"], now["block"]) != (file, block):
                flush(rows, True)
                now = {"file": file, "block": block, "place": 0, "kind": None, "id": None, "lat": None, "lon": None, "tags": [], "nodes": [], "members": []}
            name = value[:9].split(maxsplit=1)[0] if value and not value[0].isspace() else ""
            if name in _RECORDS:
                flush(rows, False)
                a = _attributes(value)
                number = lambda k, kind: kind(a[k]) if a.get(k) else None
                now = {"file": file, "block": block, "place": now["place"] + 1, "kind": name, "id": number("id", int), "lat": number("lat", float), "lon": number("lon", float), "tags": [], "nodes": [], "members": []}
            elif name in _PARTS:
                a = _attributes(value)
                if name == "tag":
                    now["tags"].append({"k": a.get("k", ""), "v": a.get("v", "")})
                elif name == "nd":
                    now["nodes"].append(int(a["ref"]))
                else:
                    now["members"].append({"type": a.get("type"), "ref": int(a["ref"]), "role": a.get("role")})
        yield pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in _OSM], [n for n, _ in _OSM])
    if now is not None:
        rows = []
        flush(rows, True)
        yield pa.record_batch([pa.array([r[n] for r in rows], t) for n, t in _OSM], [n for n, _ in _OSM])


def read_osm(spark: SparkSession, path: str) -> DataFrame:
    """All records of (compressed) map extracts in one pass: ``kind`` (node, way, relation), ``id, lat, lon, tags, nodes, members``.

    The text is cut at every ``<``, so Spark reads it by byte ranges of any size from any file system, and a range
    begins at its first tag.  A record that goes on in the next range is completed from there: only the last
    record of each range and the parts before the first one of the next meet, told by the number of records before.
    The last of equal keys of a record wins.  The result is a written table.
    """
    tags = spark.read.option("lineSep", "<").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    parts = "kind string, id long, lat double, lon double, tags array<struct<k:string,v:string>>, nodes array<long>, members array<struct<type:string,ref:long,role:string>>"
    found = staged(tags.mapInArrow(_osm_records, f"file string, block long, place long, last boolean, {parts}"))
    blocks = found.groupBy("file", "block").agg(F.max("place").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "block", before.alias("before"))
    edges = found.where("last OR place = 0").join(blocks, ["file", "block"]).withColumn("number", F.col("before") + F.col("place"))
    one = lambda c: F.flatten(F.transform("e", lambda x: x[c])).alias(c)
    pieces = edges.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("block", "place", "kind", "id", "lat", "lon", "tags", "nodes", "members"))).alias("e"))
    head = lambda c: F.get("e", F.lit(0))[c].alias(c)
    joined = pieces.select(*[head(c) for c in ("kind", "id", "lat", "lon")], *[one(c) for c in ("tags", "nodes", "members")])
    every = found.where("NOT last AND place > 0").select(*joined.columns).unionByName(joined).where("kind IS NOT NULL")
    empty = F.expr("cast(map() as map<string,string>)")
    tag_map = F.aggregate("tags", empty, lambda m, t: F.map_concat(F.map_filter(m, lambda k, _: k != t.k), F.create_map(t.k, t.v)))
    return staged(every.withColumn("tags", tag_map))


def osm_nodes(records: DataFrame) -> DataFrame:
    return records.where("kind = 'node'").select(F.col("id").alias("node_id"), "lat", "lon", "tags")


def osm_ways(records: DataFrame) -> DataFrame:
    return records.where("kind = 'way'").select(F.col("id").alias("way_id"), "nodes", "tags")


def osm_relations(records: DataFrame) -> DataFrame:
    return records.where("kind = 'relation'").select(F.col("id").alias("relation_id"), "members", "tags")


def read_osm_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and ways of a (compressed) map extract: ``node_id, lat, lon, tags`` and ``way_id, nodes, tags``, from one pass."""
    records = read_osm(spark, path)
    return osm_nodes(records), osm_ways(records)


def relation_centres(members: DataFrame, positions: DataFrame) -> DataFrame:
    """Centre of the members' box: ``members(relation_id, member_id)`` with ``positions(member_id, lat, lon)``."""
    met = members.join(positions, "member_id")
    return met.groupBy("relation_id").agg(((F.min("lat") + F.max("lat")) / 2).alias("lat"), ((F.min("lon") + F.max("lon")) / 2).alias("lon"))


def stations(payload: DataFrame, *, indices: str = "indices", data: str = "data") -> DataFrame:
    """Active stations of a columnar payload: ``indices`` names the positions of the value lists in ``data``."""
    rows = payload.select(indices, F.explode(data).alias("key", "row"))
    value = lambda name: F.get(F.col("row"), F.array_position(indices, F.lit(name)).cast("int") - 1)
    out = rows.select(value("station id").try_cast("int").alias("station_id"), value("station code").alias("code"), value("station name").alias("name"), value("station city").alias("city"), value("station latitude").try_cast("double").alias("lat"), value("station longitude").try_cast("double").alias("lon"), value("station active to").alias("active_to"))
    return out.where("(active_to is null or active_to = '') and lat is not null and lon is not null").drop("active_to")


def label_records(lines: DataFrame, personas: list[str], *, key: str = "expose_id", order: str = "line_no") -> DataFrame:
    """Labels in either encoding as a 0/1 map per id; the last record of an id wins."""
    listed = F.map_from_arrays(F.array(*map(F.lit, personas)), F.array(*[F.array_contains("positive_personas", p).cast("int") for p in personas]))
    both = lines.withColumn("labels", F.coalesce("labels", F.when(F.col("positive_personas").isNotNull(), listed)))
    return both.where("labels is not null").groupBy(key).agg(F.max_by("labels", order).alias("labels"))


def link_pairs(groups: DataFrame, *, group: str, urls: str, wanted: list[str] | None = None) -> DataFrame:
    """(group, url) pairs of nested dumps with their place, the first appearance of a url over all groups only."""
    df = groups.where(F.col(group).isin(*wanted)) if wanted else groups
    pairs = df.select(group, F.posexplode(urls).alias("pos", "url"))
    return pairs.groupBy("url").agg(F.min(F.struct(group, "pos")).alias("f")).select(f"f.{group}", "f.pos", "url")


def find_files(spark: SparkSession, glob: str) -> DataFrame:
    """``path, file_name, modified, bytes`` of the files of a glob; contents are not read."""
    files = spark.read.format("binaryFile").load(glob)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def newest_run(spark: SparkSession, glob: str) -> str | None:
    """Folder of the most recently modified file below a glob."""
    row = find_files(spark, glob).agg(F.max(F.struct("modified", "path")).alias("m")).select(F.col("m.path").alias("p")).first()
    return row.p.rsplit("/", 1)[0] if row and row.p else None
