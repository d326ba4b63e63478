"""Whole extracts of a dump that is made of analytic tables.

The tables are written as a dump in COPY form and staged from it as any dump is; the products
are then made by the engine's own plans. Users are customers, edit sessions orders with line
items as comments, nodes the versions that a user's events make (some with negative ids), ways
orders with the parts of their line items, relations conversations with their turns.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import copy_text
from ..functions import text as X
from ..operators import changesets as C
from ..sinks import blocks, copy_dump, fixed
from ..sources import blocks as block_source
from ..streaming.newest import newest_stream
from . import products, staging


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="geoloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    if base.startswith("file:"):
        base = "/" + base.removeprefix("file:").lstrip("/")
    return f"{base.rstrip('/')}/extract-{uuid.uuid4().hex}"


def dump_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The twelve tables under the names and columns of a dump."""
    table = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    later = F.expr("interval 20 years")
    orders, lines, events, turns = table("orders"), table("lineitem"), table("events"), table("conversations")
    key, made = F.col("o_orderkey"), (F.col("o_orderdate") + later).alias("created_at")
    side = lambda k, f, name: F.when(key % k != 0, key * f).cast("int").alias(name)
    changesets = orders.select(
        key.alias("id"), F.col("o_custkey").alias("user_id"), made, side(5, 11, "min_lat"), side(7, 17, "max_lat"), side(11, -13, "min_lon"), side(13, 19, "max_lon"),
        F.when(key % 50 == 0, F.col("o_orderdate") + F.expr("interval 40 years")).otherwise(F.col("o_orderdate") + F.expr("interval 7310 days")).alias("closed_at"), (key % 7).cast("int").alias("num_changes"),
    )
    session_tags = orders.select(key.alias("changeset_id"), F.lit("priority").alias("k"), F.col("o_orderpriority").alias("v"))
    odd = orders.filter(key % 3 == 0).select(key, F.lit("Note"), F.concat(F.col("o_orderstatus"), F.lit('\t<&"\\\n\\N')))
    comments = lines.select(F.col("l_orderkey").alias("changeset_id"), (F.col("l_shipdate") + later).alias("created_at"), F.col("l_suppkey").alias("author_id"), F.concat_ws("/", "l_partkey", "l_linenumber", "l_linestatus").alias("body"), (F.col("l_returnflag") != "R").alias("visible"))
    node_id = F.when(F.col("user_id") % 17 == 3, -F.col("user_id")).otherwise(F.col("user_id"))
    version = F.row_number().over(Window.partitionBy("user_id").orderBy("ts")).cast("long")
    versions = events.select(
        (F.col("event_id") * 1237 % 1_800_000_000 - 900_000_000).cast("int").alias("latitude"), (F.col("event_id") * 977 % 3_600_000_000 - 1_800_000_000).cast("int").alias("longitude"), (F.col("event_id") % 1500).alias("changeset_id"),
        (F.col("event_type") != "error").alias("visible"), F.col("ts").alias("timestamp"), version.alias("version"), F.when(F.col("event_type") == "signup", 1).cast("long").alias("redaction_id"), node_id.alias("node_id"), "event_type", "props",
    )
    tag = lambda name, value: versions.select("node_id", "version", F.lit(name).alias("k"), F.col(value).alias("v"))
    ways = orders.filter(key % 2 == 0).select(key.alias("way_id"), key.alias("changeset_id"), (F.col("o_orderdate") + later).alias("timestamp"), F.lit(1).cast("long").alias("version"), F.lit(True).alias("visible"), F.lit(None).cast("long").alias("redaction_id"))
    gone = ways.filter("way_id % 10 = 0").withColumns({"version": F.lit(2).cast("long"), "visible": F.lit(False)})
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")).cast("long")
    refs = lines.filter("l_orderkey % 2 = 0").select(F.col("l_orderkey").alias("way_id"), F.col("l_partkey").alias("node_id"), F.lit(1).cast("long").alias("version"), place.alias("sequence_id"))
    heads = turns.select(F.col("conv_id").alias("relation_id")).distinct()
    kind = F.element_at(F.array(*map(F.lit, ("Node", "Way", "Relation"))), (F.col("turn") % 3 + 1).cast("int"))
    return {
        "users": table("customer").select("c_nationkey", F.col("c_name").alias("display_name"), F.col("c_custkey").alias("id"), (F.col("c_acctbal") >= 0).alias("data_public")),
        "changesets": changesets,
        "changeset_tags": session_tags.union(odd),
        "changeset_comments": comments,
        "nodes": versions.drop("event_type", "props"),
        "ways": ways.unionByName(gone),
        "relations": heads.select("relation_id", F.col("relation_id").alias("changeset_id"), F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("timestamp"), F.lit(1).cast("long").alias("version"), F.lit(True).alias("visible"), F.lit(None).cast("long").alias("redaction_id")),
        "node_tags": tag("type", "event_type").unionByName(tag("props", "props")),
        "way_tags": orders.filter(key % 4 == 0).select(key.alias("way_id"), F.lit(1).cast("long").alias("version"), F.lit("priority").alias("k"), F.col("o_orderpriority").alias("v")),
        "relation_tags": heads.select("relation_id", F.lit(1).cast("long").alias("version"), F.lit("type").alias("k"), F.lit("chat").alias("v")),
        "way_nodes": refs.unionByName(refs.filter("way_id % 10 = 0").withColumn("version", F.lit(2).cast("long"))),
        "relation_members": turns.select(F.col("conv_id").alias("relation_id"), kind.alias("member_type"), (F.col("conv_id") * 100 + F.col("turn")).alias("member_id"), F.col("role").alias("member_role"), F.lit(1).cast("long").alias("version"), F.col("turn").alias("sequence_id")),
    }


@dataclass
class Extract:
    folder: str
    tables: dict[str, DataFrame]
    joined: dict[str, DataFrame]
    time: datetime

    def seconds(self) -> int:
        return int((self.time - datetime(1970, 1, 1)).total_seconds())


_made: dict[tuple[str, str], Extract] = {}


def extract(spark: SparkSession, sf_dir: str) -> Extract:
    """Dump, stage and join once for each application and folder of tables."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _made:
        folder = scratch(spark)
        copy_dump.write(dump_tables(spark, sf_dir), f"{folder}/dump.sql")
        staging.stage(spark, f"{folder}/dump.sql", f"{folder}/staged")
        tables, joined = staging.staged(spark, f"{folder}/staged"), {}
        for kind in ("node", "way", "relation"):
            products.nested(tables, kind).write.parquet(f"{folder}/joined_{kind}")
            joined[kind] = spark.read.parquet(f"{folder}/joined_{kind}")
        _made[key] = Extract(folder, tables, joined, staging.staged_time(spark, f"{folder}/staged"))
    return _made[key]


# --- staged tables ----------------------------------------------------------------------


_TIMES = ("created_at", "closed_at", "timestamp", "max_time")
_PARENT = ("id", "version", "changeset_id", "visible", "timestamp", "redaction_id")


def _shown(*columns: str) -> list:
    """The columns, times in their document form."""
    return [X.iso_time(F.col(c)).alias(c) if c in _TIMES else F.col(c) for c in columns]


def _staged(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: extract(spark, sf_dir).tables[name].select(*_shown(*columns))


def dump_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.max_time([(rows, staging.TABLES[name].time_column) for name, rows in extract(spark, sf_dir).tables.items() if staging.TABLES[name].time_column]).select(*_shown("max_time"))


def dump_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escapes of every form: octal and hexadecimal bytes, letters, and a NUL that ends the text."""
    form = F.concat(F.replace(F.col("event_type"), F.lit("e"), F.lit("\\145")), F.lit("\\x2D\\303\\251\\b\\v\\q\\\\"), F.col("event_id").cast("string"), F.lit("\\000not this"))
    decoded = copy_text.decode(form, "string", False)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.hex(F.encode(decoded, "utf-8")).alias("bytes"))


def checked_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times cut to the second; that none is out of range is part of the result."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", X.iso_time(X.checked_time(F.col("ts"))).alias("checked"))


# --- documents --------------------------------------------------------------------------


def _document(spark: SparkSession, sf_dir: str, product: str, order: int) -> DataFrame:
    made = extract(spark, sf_dir)
    meta = {"author": fixed.COPYRIGHT, "source": fixed.ORIGIN, "copyleft": fixed.LICENSE, "attribution": fixed.ATTRIBUTION}
    return products.document(spark, made.tables, made.joined, products.PRODUCTS[product], made.time, "geoloom", meta).filter(F.col("kind_order") == order)


def _xml(product: str, order: int, version: bool = True) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _document(spark, sf_dir, product, order).select("id", *["version"] * version, "xml")


def xml_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document(spark, sf_dir, "xml", -1).unionByName(_document(spark, sf_dir, "xml", 4)).select("kind_order", "xml")


def withheld_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = extract(spark, sf_dir).tables
    return C.withheld_comments(tables["changeset_comments"], tables["users"]).groupBy("changeset_id").agg(F.count(F.lit(1)).alias("n"))


# --- blocks, written and read back ------------------------------------------------------


def _blocks(spark: SparkSession, sf_dir: str, product: str, dense: bool = True) -> str:
    made = extract(spark, sf_dir)
    out = f"{made.folder}/{product}-{dense}-{uuid.uuid4().hex}.blocks"
    p = products.PRODUCTS[product]
    head = blocks.header_block(made.seconds(), "geoloom", fixed.ORIGIN, p.history, dense)
    blocks.write([blocks.encode(kind, products.of_product(rows, p), p.history, p.full, dense) for kind, rows in made.joined.items()], head, out)
    return out


_COMMON = ("id", "version", "seconds", "changeset_id", "visible", "uid", "user")


def _of_blocks(product: str, kind: str, dense: bool = True) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = block_source.read(spark, _blocks(spark, sf_dir, product, dense)).filter(F.col("kind") == kind)
        tags = F.array_join(F.transform("tags", lambda t: F.concat(t["k"], F.lit("="), t["v"])), ";").alias("tags")
        if kind == "node":
            return rows.select(*_COMMON, "latitude", "longitude", tags)
        if kind == "way":
            return rows.select(*_COMMON, tags, F.array_join(F.col("refs").cast("array<string>"), ",").alias("refs"))
        return rows.select(*_COMMON, tags, F.array_join(F.transform("members", lambda m: F.concat_ws(":", m["code"], m["member_id"], m["member_role"])), ",").alias("members"))

    return query


def block_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements by kind: edit sessions have no block."""
    return block_source.read(spark, _blocks(spark, sf_dir, "history-blocks")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def block_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = block_source.header(_blocks(spark, sf_dir, "history-blocks"))
    row = (",".join(map(str, head["box"])), ",".join(head["required"]), ",".join(head["optional"]), head["generator"], head["source"], head["seconds"])
    return spark.createDataFrame([row], "box string, required string, optional string, generator string, source string, seconds long")


def streamed_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest eligible versions, from a stream of the staged versions of nodes."""
    made, name = extract(spark, sf_dir), f"newest_{uuid.uuid4().hex}"
    source = spark.readStream.schema(made.tables["nodes"].schema).option("maxFilesPerTrigger", 1).parquet(f"{made.folder}/staged/nodes")
    query = newest_stream(source).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).option("checkpointLocation", f"{made.folder}/{name}").start()
    query.awaitTermination()
    return spark.table(name).select("id", "version", "visible")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dump_users": _staged("users", "id", "display_name", "data_public"),
    "dump_changesets": _staged("changesets", "id", "uid", "created_at", "min_lat", "max_lat", "min_lon", "max_lon", "closed_at", "num_changes"),
    "dump_changeset_tags": _staged("changeset_tags", "id", "k", "v"),
    "dump_comments": _staged("changeset_comments", "changeset_id", "created_at", "author_id", "body", "visible"),
    "dump_nodes": _staged("nodes", *_PARENT, "latitude", "longitude"),
    "dump_ways": _staged("ways", *_PARENT),
    "dump_relations": _staged("relations", *_PARENT),
    "dump_node_tags": _staged("node_tags", "id", "version", "k", "v"),
    "dump_way_nodes": _staged("way_nodes", "id", "version", "sequence_id", "node_id"),
    "dump_members": _staged("relation_members", "id", "version", "sequence_id", "member_type", "member_id", "member_role"),
    "dump_time": dump_time, "dump_fields": dump_fields, "checked_times": checked_times,
    "xml_edges": xml_edges, "xml_changesets": _xml("changesets", 0, False), "xml_discussions": _xml("changeset-discussions", 0, False), "xml_anonymous_discussions": _xml("changeset-discussions-no-userinfo", 0, False),
    "xml_nodes": _xml("xml", 1), "xml_history_nodes": _xml("history-xml", 1), "xml_history_ways": _xml("history-xml", 2), "xml_relations": _xml("xml-no-userinfo", 3),
    "withheld_comments": withheld_comments,
    "block_header": block_header, "block_kinds": block_kinds, "block_nodes": _of_blocks("history-blocks", "node"), "block_current_nodes": _of_blocks("blocks-no-userinfo", "node"), "block_plain_nodes": _of_blocks("history-blocks", "node", False),
    "block_ways": _of_blocks("history-blocks", "way"), "block_relations": _of_blocks("blocks", "relation"), "streamed_newest": streamed_newest,
}

_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_ATTRIBUTE = "replace(replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(10), '&#10;'), chr(9), '&#9;')"
_BASE = """users AS (SELECT c_custkey AS uid, c_name AS "user" FROM customer WHERE c_acctbal >= 0
), sessions AS (
    SELECT o_orderkey AS id, o_custkey AS uid, o_orderdate + INTERVAL 20 YEAR AS created_at, o_orderdate + CASE WHEN o_orderkey % 50 = 0 THEN INTERVAL 40 YEAR ELSE INTERVAL 7310 DAY END AS closed_at, o_orderkey % 7 AS num_changes,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey * 11 END AS min_lat, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey * 17 END AS max_lat,
           CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey * -13 END AS min_lon, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey * 19 END AS max_lon FROM orders
), session_tags AS (
    SELECT o_orderkey AS id, 'priority' AS k, o_orderpriority AS v FROM orders
    UNION ALL SELECT o_orderkey, 'Note', o_orderstatus || chr(9) || '<&"' || chr(92) || chr(10) || chr(92) || 'N' FROM orders WHERE o_orderkey % 3 = 0
), comments AS (
    SELECT l_orderkey AS id, l_shipdate + INTERVAL 20 YEAR AS created_at, l_suppkey AS author_id, concat_ws('/', l_partkey, l_linenumber, l_linestatus) AS body, l_returnflag <> 'R' AS visible FROM lineitem
), versions AS (
    SELECT CASE WHEN user_id % 17 = 3 THEN -user_id ELSE user_id END AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS version, event_id % 1500 AS changeset_id, event_type <> 'error' AS visible, ts,
           CASE WHEN event_type = 'signup' THEN 1 END AS redaction_id, event_id * 1237 % 1800000000 - 900000000 AS latitude, event_id * 977 % 3600000000 - 1800000000 AS longitude, event_type, props FROM events
), eligible AS (SELECT * FROM versions WHERE redaction_id IS NULL AND id >= 0
), newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS place FROM eligible) WHERE place = 1
), ways AS (
    SELECT o_orderkey AS id, 1 AS version, o_orderkey AS changeset_id, true AS visible, o_orderdate + INTERVAL 20 YEAR AS ts FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, 2, o_orderkey, false, o_orderdate + INTERVAL 20 YEAR FROM orders WHERE o_orderkey % 10 = 0
), refs AS (SELECT l_orderkey AS id, l_partkey AS ref, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS place FROM lineitem WHERE l_orderkey % 2 = 0
), owners AS (SELECT id AS changeset_id, uid, "user" FROM sessions JOIN users USING (uid)
), latest AS (SELECT greatest((SELECT max(created_at) FROM sessions), (SELECT max(created_at) FROM comments), (SELECT max(ts) FROM versions), (SELECT max(ts) FROM ways)) AS t)"""
_USER = """coalesce(' user="' || "user" || '" uid="' || uid || '"', '')"""
_TAG = "'  <tag k=\"' || k || '\" v=\"' || " + _ATTRIBUTE.format("v") + " || '\"/>' || chr(10)"
_DEGREES = "printf('%.7f', {} / 1e7)"


def _sessions_sql(discussion: str, full: bool = True) -> str:
    user = _USER if full else "''"
    return f"""WITH {_BASE}, tagged AS (SELECT id, string_agg({_TAG}, '' ORDER BY k) AS body FROM session_tags GROUP BY id),
        counted AS (SELECT id, count(*) AS n FROM comments WHERE visible GROUP BY id),
        said AS (SELECT id, string_agg('   <comment' || {"' uid=\"' || author_id || '\" user=\"' || \"user\" || '\"' ||" if full else ""} ' date="' || {_ISO.format('created_at')} || '">' || chr(10) || '    <text>' || body || '</text>' || chr(10) || '   </comment>' || chr(10), '' ORDER BY created_at, author_id, body) AS talk
                 FROM comments JOIN users u ON u.uid = author_id WHERE visible GROUP BY id),
        cut AS (SELECT s.*, closed_at > date_trunc('second', (SELECT t FROM latest)) AS "open", min_lat IS NOT NULL AND max_lat IS NOT NULL AND min_lon IS NOT NULL AND max_lon IS NOT NULL AS boxed FROM sessions s)
        SELECT c.id, ' <changeset id="' || c.id || '" created_at="' || {_ISO.format('created_at')} || '"' || CASE WHEN "open" THEN '' ELSE ' closed_at="' || {_ISO.format('closed_at')} || '"' END || ' open="' || "open" || '"'
            || {user} || CASE WHEN boxed THEN ' min_lat="' || {_DEGREES.format('min_lat')} || '" min_lon="' || {_DEGREES.format('min_lon')} || '" max_lat="' || {_DEGREES.format('max_lat')} || '" max_lon="' || {_DEGREES.format('max_lon')} || '"' ELSE '' END
            || ' num_changes="' || num_changes || '" comments_count="' || coalesce(n, 0) || '">' || chr(10) || body || {discussion} || ' </changeset>' AS xml
        FROM cut c LEFT JOIN users u USING (uid) JOIN tagged USING (id) LEFT JOIN counted ON counted.id = c.id LEFT JOIN said ON said.id = c.id"""


_DISCUSSION = "CASE WHEN n IS NULL THEN '' WHEN talk IS NULL THEN '  <discussion/>' || chr(10) ELSE '  <discussion>' || chr(10) || talk || '  </discussion>' || chr(10) END"


def _nodes_sql(rows: str, visible: str) -> str:
    return f"""WITH {_BASE} SELECT id, version, ' <node id="' || id || '"' || CASE WHEN visible THEN ' lat="' || {_DEGREES.format('latitude')} || '" lon="' || {_DEGREES.format('longitude')} || '"' ELSE '' END
        || ' timestamp="' || {_ISO.format('ts')} || '" version="' || version || '" changeset="' || changeset_id || '"' || {visible} || {_USER}
        || CASE WHEN visible THEN '>' || chr(10) || '  <tag k="props" v="' || {_ATTRIBUTE.format('props')} || '"/>' || chr(10) || '  <tag k="type" v="' || event_type || '"/>' || chr(10) || ' </node>' ELSE '/>' END AS xml
        FROM {rows} LEFT JOIN owners USING (changeset_id)"""


_SECONDS = "CAST(floor(epoch({})) AS BIGINT) AS seconds"
_BLOCK_NODES = f"""WITH {_BASE} SELECT id, version, {_SECONDS.format('ts')}, changeset_id, visible, uid, "user", CASE WHEN visible THEN latitude ELSE 0 END AS latitude, CASE WHEN visible THEN longitude ELSE 0 END AS longitude,
    CASE WHEN visible THEN 'props=' || props || ';type=' || event_type ELSE '' END AS tags FROM eligible LEFT JOIN owners USING (changeset_id)"""

ORACLE_SQL: dict[str, str] = {
    "dump_users": "SELECT c_custkey AS id, c_name AS display_name, c_acctbal >= 0 AS data_public FROM customer",
    "dump_changesets": f"""WITH {_BASE} SELECT id, CAST(uid AS INTEGER) AS uid, {_ISO.format('created_at')} AS created_at, CAST(min_lat AS INTEGER) AS min_lat, CAST(max_lat AS INTEGER) AS max_lat, CAST(min_lon AS INTEGER) AS min_lon, CAST(max_lon AS INTEGER) AS max_lon,
        {_ISO.format('closed_at')} AS closed_at, CAST(num_changes AS INTEGER) AS num_changes FROM sessions""",
    "dump_changeset_tags": f"WITH {_BASE} SELECT id, k, v FROM session_tags",
    "dump_comments": f"WITH {_BASE} SELECT id AS changeset_id, {_ISO.format('created_at')} AS created_at, author_id, body, visible FROM comments",
    "dump_nodes": f'WITH {_BASE} SELECT id, version, changeset_id, visible, {_ISO.format("ts")} AS "timestamp", CAST(redaction_id AS BIGINT) AS redaction_id, CAST(latitude AS INTEGER) AS latitude, CAST(longitude AS INTEGER) AS longitude FROM versions',
    "dump_ways": f'WITH {_BASE} SELECT id, CAST(version AS BIGINT) AS version, changeset_id, visible, {_ISO.format("ts")} AS "timestamp", CAST(NULL AS BIGINT) AS redaction_id FROM ways',
    "dump_relations": "SELECT DISTINCT conv_id AS id, CAST(1 AS BIGINT) AS version, conv_id AS changeset_id, true AS visible, '2020-01-01T00:00:00Z' AS \"timestamp\", CAST(NULL AS BIGINT) AS redaction_id FROM conversations",
    "dump_node_tags": f"WITH {_BASE} SELECT id, version, 'type' AS k, event_type AS v FROM versions UNION ALL SELECT id, version, 'props', props FROM versions",
    "dump_way_nodes": f"WITH {_BASE} SELECT id, CAST(1 AS BIGINT) AS version, place AS sequence_id, ref AS node_id FROM refs UNION ALL SELECT id, 2, place, ref FROM refs WHERE id % 10 = 0",
    "dump_members": "SELECT conv_id AS id, CAST(1 AS BIGINT) AS version, turn AS sequence_id, CASE turn % 3 WHEN 0 THEN 'Node' WHEN 1 THEN 'Way' ELSE 'Relation' END AS member_type, conv_id * 100 + turn AS member_id, role AS member_role FROM conversations",
    "dump_time": f"WITH {_BASE} SELECT {_ISO.format('t')} AS max_time FROM latest",
    "dump_fields": "SELECT event_id, hex(encode(event_type || '-é' || chr(8) || chr(11) || 'q' || chr(92) || event_id)) AS bytes FROM events",
    "checked_times": f"SELECT event_id, {_ISO.format('ts')} AS checked FROM events",
    "xml_edges": f"""WITH {_BASE} SELECT -1 AS kind_order, '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<{fixed.ROOT} license="{fixed.LICENSE}" copyright="{fixed.COPYRIGHT}" version="{fixed.VERSION}" generator="geoloom" attribution="{fixed.ATTRIBUTION}" timestamp="'
        || {_ISO.format('t')} || '">' || chr(10) || ' <bound box="{fixed.BOX}" origin="{fixed.ORIGIN}"/>' AS xml FROM latest UNION ALL SELECT 4, '</{fixed.ROOT}>'""",
    "xml_changesets": _sessions_sql("''"),
    "xml_discussions": _sessions_sql(_DISCUSSION),
    "xml_anonymous_discussions": _sessions_sql(_DISCUSSION, False),
    "xml_nodes": _nodes_sql("(SELECT * FROM newest WHERE visible)", "''"),
    "xml_history_nodes": _nodes_sql("eligible", "' visible=\"' || visible || '\"'"),
    "xml_history_ways": f"""WITH {_BASE}, listed AS (SELECT id, string_agg('  <nd ref="' || ref || '"/>' || chr(10), '' ORDER BY place) AS body FROM refs GROUP BY id),
        whole AS (SELECT w.*, CASE WHEN visible THEN coalesce(body, '') || CASE WHEN w.id % 4 = 0 THEN '  <tag k="priority" v="' || o_orderpriority || '"/>' || chr(10) ELSE '' END ELSE '' END AS inside FROM ways w JOIN orders ON o_orderkey = w.id LEFT JOIN listed ON listed.id = w.id)
        SELECT id, CAST(version AS BIGINT) AS version, ' <way id="' || id || '" timestamp="' || {_ISO.format('ts')} || '" version="' || version || '" changeset="' || changeset_id || '" visible="' || visible || '"' || {_USER}
            || CASE WHEN inside = '' THEN '/>' ELSE '>' || chr(10) || inside || ' </way>' END AS xml FROM whole LEFT JOIN owners USING (changeset_id)""",
    "xml_relations": """SELECT conv_id AS id, CAST(1 AS BIGINT) AS version, ' <relation id="' || conv_id || '" timestamp="2020-01-01T00:00:00Z" version="1" changeset="' || conv_id || '">' || chr(10)
        || string_agg('  <member type="' || CASE turn % 3 WHEN 0 THEN 'node' WHEN 1 THEN 'way' ELSE 'relation' END || '" ref="' || (conv_id * 100 + turn) || '" role="' || role || '"/>' || chr(10), '' ORDER BY turn)
        || '  <tag k="type" v="chat"/>' || chr(10) || ' </relation>' AS xml FROM conversations GROUP BY conv_id""",
    "withheld_comments": f"WITH {_BASE} SELECT id AS changeset_id, count(*) AS n FROM comments WHERE visible AND author_id NOT IN (SELECT uid FROM users) GROUP BY id",
    "block_header": f"""WITH {_BASE} SELECT '-180,180,90,-90' AS box, '{fixed.SCHEMA_FEATURE},{fixed.HISTORY_FEATURE},{fixed.DENSE_FEATURE}' AS required, '{",".join(fixed.OPTIONAL_FEATURES)}' AS optional, 'geoloom' AS generator, '{fixed.ORIGIN}' AS source, {_SECONDS.format('t')} FROM latest""",
    "block_kinds": f"WITH {_BASE} SELECT 'node' AS kind, count(*) AS n FROM eligible UNION ALL SELECT 'way', count(*) FROM ways UNION ALL SELECT 'relation', count(DISTINCT conv_id) FROM conversations",
    "block_nodes": _BLOCK_NODES,
    "block_plain_nodes": _BLOCK_NODES,
    "block_current_nodes": f"""WITH {_BASE} SELECT id, version, {_SECONDS.format('ts')}, changeset_id, visible, CAST(NULL AS BIGINT) AS uid, CAST(NULL AS VARCHAR) AS "user", latitude, longitude, 'props=' || props || ';type=' || event_type AS tags FROM newest WHERE visible""",
    "block_ways": f"""WITH {_BASE}, listed AS (SELECT id, string_agg(CAST(ref AS VARCHAR), ',' ORDER BY place) AS refs FROM refs GROUP BY id)
        SELECT w.id, CAST(version AS BIGINT) AS version, {_SECONDS.format('ts')}, changeset_id, visible, uid, "user", CASE WHEN visible AND w.id % 4 = 0 THEN 'priority=' || o_orderpriority ELSE '' END AS tags, CASE WHEN visible THEN coalesce(refs, '') ELSE '' END AS refs
        FROM ways w JOIN orders ON o_orderkey = w.id LEFT JOIN listed ON listed.id = w.id LEFT JOIN owners USING (changeset_id)""",
    "block_relations": f"""WITH {_BASE} SELECT c.conv_id AS id, CAST(1 AS BIGINT) AS version, CAST(1577836800 AS BIGINT) AS seconds, c.conv_id AS changeset_id, true AS visible, any_value(uid) AS uid, any_value("user") AS "user", 'type=chat' AS tags,
        string_agg((turn % 3) || ':' || (conv_id * 100 + turn) || ':' || role, ',' ORDER BY turn) AS members FROM conversations c LEFT JOIN owners ON changeset_id = conv_id GROUP BY conv_id""",
    "streamed_newest": f"WITH {_BASE} SELECT id, version, visible FROM newest",
}
