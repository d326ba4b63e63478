"""The engine's operators over analytic tables that stand in for a dump.

Versions of elements are the events of a user in order of time; edit sessions are orders,
their owners customers, their comments line items by suppliers; members are the turns of
conversations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import copy_text
from ..functions import text as X
from ..operators import changesets as C
from ..operators import elements as E
from ..sinks import blocks, xml
from . import extract_queries, staging


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.row_number().over(Window.partitionBy("user_id").orderBy("ts")).cast("long")
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), version.alias("version"), (F.col("event_id") % 1500).alias("changeset_id"), (F.col("event_type") != "error").alias("visible"),
        F.col("ts").alias("timestamp"), F.when(F.col("event_type") == "signup", 1).cast("long").alias("redaction_id"), "value", "event_type",
    )


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("uid"), F.col("o_orderdate").alias("created_at"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("display_name"), (F.col("c_acctbal") >= 0).alias("data_public"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("display_name"), (F.col("s_acctbal") >= 0).alias("data_public"))


def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.concat_ws("/", "l_partkey", "l_linenumber", "l_linestatus")
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("changeset_id"), F.col("l_shipdate").alias("created_at"), F.col("l_suppkey").alias("author_id"), body.alias("body"), (F.col("l_returnflag") != "R").alias("visible"))


def current_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.current(_versions(spark, sf_dir)).select("id", "version", "changeset_id", X.iso_time(F.col("timestamp")).alias("timestamp"), "value")


def history_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.history(_versions(spark, sf_dir)).select("id", "version", "visible", F.when(F.col("visible"), F.col("value")).alias("value"))


def _with_user(spark: SparkSession, sf_dir: str, full: bool) -> DataFrame:
    return E.shown_owner(E.with_owner(E.history(_versions(spark, sf_dir)), _sessions(spark, sf_dir), _customers(spark, sf_dir)), full)


def element_user_public(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_user(spark, sf_dir, True).select("id", "version", F.coalesce("user", F.lit("")).alias("user"), F.coalesce(F.col("uid").cast("string"), F.lit("")).alias("uid"))


def element_user_anonymous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_user(spark, sf_dir, False).select("id", "version", F.coalesce("user", F.lit("")).alias("user"))


def missing_changeset_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = _table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("uid"))
    owned = E.with_owner(E.eligible(_versions(spark, sf_dir)), closed, _customers(spark, sf_dir))
    return owned.filter("owned is null").select("id", "version", "changeset_id")


def _dump_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.max_time([(_sessions(spark, sf_dir), "created_at"), (_table(spark, sf_dir, "events"), "ts")])


def max_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dump_time(spark, sf_dir).select(X.iso_time(F.col("max_time")).alias("max_time"))


def changeset_open_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = _comments(spark, sf_dir).groupBy(F.col("changeset_id").alias("id")).agg(F.max("created_at").alias("closed_at"))
    ended = _sessions(spark, sf_dir).join(ends, "id", "left")
    latest = _sessions(spark, sf_dir).agg(F.max("created_at")).first()[0]
    return C.with_open(ended, F.lit(latest).cast("timestamp_ntz")).select("id", "open", X.iso_time(F.col("closed_at")).alias("closed_at"))


def comments_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_comment_count(_sessions(spark, sf_dir), _comments(spark, sf_dir)).select("id", "comments_count")


def discussions(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = _comments(spark, sf_dir)
    counted = C.with_comment_count(_sessions(spark, sf_dir), comments)
    talked = C.with_discussion(counted, comments, _suppliers(spark, sf_dir))
    line = F.transform("discussion", lambda x: F.concat_ws(" ", X.iso_time(x["created_at"]), x["author"], x["body"]))
    return talked.select("id", "comments_count", F.array_join(line, ";").alias("discussion"))


def ordered_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    nested = E.nest(turns, ["conv_id"], ["turn"], ["turn", "role"], "members")
    return nested.select("conv_id", F.size("members").cast("long").alias("n"), F.array_join("members.role", ",").alias("roles"))


def bbox_all_or_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    side = lambda k, f: F.when(key % k != 0, key * f)
    boxes = _table(spark, sf_dir, "orders").select(key.alias("id"), side(5, 11).alias("min_lat"), side(7, -13).alias("min_lon"), side(11, 17).alias("max_lat"), side(13, 19).alias("max_lon"))
    return C.whole_box(boxes).select("id", *[X.degrees(F.col(c)).alias(c) for c in C.BOX])


def xml_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = F.concat(F.lit("\x01\t"), F.col("text"), F.lit("\x0b\x0c\x1f\r\n"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(X.sanitize(dirty)).alias("digest"))


def xml_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", F.md5(X.escape_attribute(F.col("html"))).alias("attribute"), F.md5(X.escape_text(F.col("html"))).alias("text"))


def iso_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", X.iso_time(F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("iso"), X.epoch_seconds(F.col("ts")).alias("seconds"))


def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", X.degrees(F.col("o_orderkey") * 1237 - 900_000_000).alias("degrees"))


def copy_unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts put into COPY's form and read back."""
    form = F.replace(F.concat(F.col("text"), F.lit("\\\t")), F.lit("\\"), F.lit("\\\\"))
    for char, letter in (("\n", "n"), ("\t", "t"), ("\r", "r")):
        form = F.replace(form, F.lit(char), F.lit(f"\\{letter}"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(copy_text.unescape(form)).alias("digest"))


def delta_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of columns within groups of rows, as dense nodes have them."""

    def encoded(group: pa.Table) -> pa.Table:
        group = group.sort_by("event_id")
        deltas = [pa.array(blocks.group_deltas(group[c].to_numpy(), np.zeros(1, np.int64))) for c in ("event_id", "user_id")]
        return pa.table([group["event_id"], *deltas], ["event_id", "event_id_delta", "user_id_delta"])

    rows = _table(spark, sf_dir, "events").select("event_id", "user_id", F.floor(F.col("event_id") / 16000).cast("long").alias("group"))
    return rows.groupBy("group").applyInArrow(encoded, "event_id long, event_id_delta long, user_id_delta long")


def ref_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences within each row's list, as the references of ways have them."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
            deltas = blocks.group_deltas(lists.flatten().to_numpy(), starts)
            offsets = pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(deltas))], ["l_orderkey", "deltas"])

    refs = E.nest(_table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], ["l_partkey"], "refs")
    made = refs.select("l_orderkey", "refs.l_partkey").mapInArrow(encoded, "l_orderkey long, deltas array<bigint>")
    return made.select("l_orderkey", F.array_join(F.col("deltas").cast("array<string>"), ",").alias("deltas"))


def string_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers that a block gives to strings."""

    def numbered(group: pa.Table) -> pa.Table:
        strings = blocks.StringTable()
        strings.numbers(group.sort_by("event_id")["event_type"].combine_chunks())
        return pa.table([[group["block"][0].as_py()] * len(strings.ids), list(strings.ids), list(strings.ids.values())], ["block", "string", "string_id"])

    rows = _table(spark, sf_dir, "events").select("event_id", "event_type", F.floor(F.col("event_id") / 500).cast("long").alias("block"))
    return rows.groupBy("block").applyInArrow(numbered, "block long, string string, string_id long")


def union_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = _sessions(spark, sf_dir).select(F.lit(0).alias("kind_order"), "id", F.lit(0).cast("long").alias("version"))
    versions = E.history(_versions(spark, sf_dir)).select(F.lit(1).alias("kind_order"), "id", "version")
    return sessions.unionByName(versions).orderBy("kind_order", "id", "version")


def element_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_user(spark, sf_dir, True)
    rows = rows.withColumn("latitude", F.col("id") * 12345).withColumn("longitude", F.col("id") * -54321)
    rows = rows.withColumn("timestamp", F.date_trunc("second", "timestamp").cast("timestamp_ntz")).withColumn("tags", F.array(F.struct(F.lit("type").alias("k"), F.col("event_type").alias("v"))))
    return rows.select("id", "version", xml.node(True).alias("xml"))


def member_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations whose members are the turns of conversations."""
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), F.lit(1).cast("long").alias("version"), F.col("turn").alias("sequence_id"), F.when(F.col("turn") % 2 == 0, "Node").otherwise("Way").alias("member_type"), (F.col("conv_id") * 100 + F.col("turn")).alias("member_id"), F.col("role").alias("member_role"))
    heads = turns.select("id", "version").distinct()
    rows = E.with_members(heads, turns).select("*", F.lit(True).alias("visible"), F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("timestamp"), F.lit(7).alias("changeset_id"), F.lit(None).cast("string").alias("user"), F.lit(None).cast("long").alias("uid"), F.array().cast("array<struct<k:string,v:string>>").alias("tags"))
    return rows.select("id", xml.relation(False).alias("xml"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        current_elements, history_elements, element_user_public, element_user_anonymous, missing_changeset_check, max_time, changeset_open_flag, comments_count, discussions, ordered_children,
        bbox_all_or_nothing, xml_sanitize, xml_escape, iso_time, degrees, copy_unescape, delta_encode, ref_deltas, string_dictionary, union_document, element_xml, member_xml,
    )
} | extract_queries.QUERIES

_VERSIONS = """versions AS (
    SELECT user_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS version, event_id % 1500 AS changeset_id,
           event_type <> 'error' AS visible, ts, event_type, CASE WHEN event_type = 'signup' THEN 1 END AS redaction_id, value
    FROM events
), eligible AS (SELECT * FROM versions WHERE redaction_id IS NULL AND id >= 0)"""
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_OWNERS = """owners AS (
    SELECT o_orderkey AS changeset_id, c_name AS "user", c_custkey AS uid FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0
)"""
_ESCAPED = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"

ORACLE_SQL: dict[str, str] = {
    "current_elements": f"""WITH {_VERSIONS}, newest AS (SELECT * FROM eligible QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1)
        SELECT id, version, changeset_id, {_ISO.format('ts')} AS "timestamp", value FROM newest WHERE visible""",
    "history_elements": f"WITH {_VERSIONS} SELECT id, version, visible, CASE WHEN visible THEN value END AS value FROM eligible",
    "element_user_public": f"""WITH {_VERSIONS}, {_OWNERS} SELECT id, version, coalesce("user", '') AS "user", coalesce(CAST(uid AS VARCHAR), '') AS uid FROM eligible LEFT JOIN owners USING (changeset_id)""",
    "element_user_anonymous": f"""WITH {_VERSIONS} SELECT id, version, '' AS "user" FROM eligible""",
    "missing_changeset_check": f"WITH {_VERSIONS} SELECT id, version, changeset_id FROM eligible WHERE changeset_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')",
    "max_time": f"SELECT {_ISO.format('greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events))')} AS max_time",
    "changeset_open_flag": f"""WITH ends AS (SELECT l_orderkey AS id, max(l_shipdate) AS closed_at FROM lineitem GROUP BY 1),
        flagged AS (SELECT o_orderkey AS id, closed_at, coalesce(closed_at > (SELECT max(o_orderdate) FROM orders), false) AS "open" FROM orders LEFT JOIN ends ON id = o_orderkey)
        SELECT id, "open", CASE WHEN "open" OR closed_at IS NULL THEN '' ELSE {_ISO.format('closed_at')} END AS closed_at FROM flagged""",
    "comments_count": "SELECT o_orderkey AS id, count(l_orderkey) FILTER (WHERE l_returnflag <> 'R') AS comments_count FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
    "discussions": f"""WITH comments AS (
            SELECT l_orderkey AS id, l_shipdate AS created_at, l_suppkey AS author_id, concat_ws('/', l_partkey, l_linenumber, l_linestatus) AS body FROM lineitem WHERE l_returnflag <> 'R'
        ), counted AS (SELECT id, count(*) AS n FROM comments GROUP BY 1), said AS (
            SELECT id, string_agg(concat_ws(' ', {_ISO.format('created_at')}, s_name, body), ';' ORDER BY created_at, author_id, body) AS discussion
            FROM comments JOIN supplier ON s_suppkey = author_id WHERE s_acctbal >= 0 GROUP BY 1
        )
        SELECT o_orderkey AS id, coalesce(n, 0) AS comments_count, CASE WHEN n > 0 THEN coalesce(discussion, '') END AS discussion
        FROM orders LEFT JOIN counted c ON c.id = o_orderkey LEFT JOIN said s ON s.id = o_orderkey""",
    "ordered_children": "SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY 1",
    "bbox_all_or_nothing": """WITH boxes AS (
            SELECT o_orderkey AS id, o_orderkey * 11 AS a, o_orderkey * -13 AS b, o_orderkey * 17 AS c, o_orderkey * 19 AS d,
                   o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AS whole FROM orders
        )
        SELECT id, CASE WHEN whole THEN printf('%.7f', a / 1e7) END AS min_lat, CASE WHEN whole THEN printf('%.7f', b / 1e7) END AS min_lon,
               CASE WHEN whole THEN printf('%.7f', c / 1e7) END AS max_lat, CASE WHEN whole THEN printf('%.7f', d / 1e7) END AS max_lon FROM boxes""",
    "xml_sanitize": r"SELECT doc_id, md5(regexp_replace(chr(1) || chr(9) || text || chr(11) || chr(12) || chr(31) || chr(13) || chr(10), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '?', 'g')) AS digest FROM documents",
    "xml_escape": f"""SELECT page_id, md5(replace(replace(replace({_ESCAPED.format('html')}, chr(10), '&#10;'), chr(13), '&#13;'), chr(9), '&#9;')) AS attribute,
        md5(replace({_ESCAPED.format('html')}, chr(13), '&#13;')) AS "text" FROM pages""",
    "iso_time": f"SELECT event_id, {_ISO.format('ts')} AS iso, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events",
    "degrees": "SELECT o_orderkey, printf('%.7f', (o_orderkey * 1237 - 900000000) / 1e7) AS degrees FROM orders",
    "copy_unescape": r"SELECT doc_id, md5(text || '\' || chr(9)) AS digest FROM documents",
    "delta_encode": """SELECT event_id, event_id - coalesce(lag(event_id) OVER w, 0) AS event_id_delta, user_id - coalesce(lag(user_id) OVER w, 0) AS user_id_delta
        FROM events WINDOW w AS (PARTITION BY event_id // 16000 ORDER BY event_id)""",
    "ref_deltas": """WITH placed AS (
            SELECT l_orderkey, l_partkey - coalesce(lag(l_partkey) OVER w, 0) AS delta, row_number() OVER w AS place
            FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate)
        )
        SELECT l_orderkey, string_agg(CAST(delta AS VARCHAR), ',' ORDER BY place) AS deltas FROM placed GROUP BY 1""",
    "string_dictionary": """WITH firsts AS (SELECT event_id // 500 AS block, event_type AS string, min(event_id) AS place FROM events GROUP BY 1, 2)
        SELECT block, string, row_number() OVER (PARTITION BY block ORDER BY place) AS string_id FROM firsts""",
    "union_document": f"""WITH {_VERSIONS} SELECT 0 AS kind_order, o_orderkey AS id, CAST(0 AS BIGINT) AS version FROM orders
        UNION ALL SELECT 1, id, version FROM eligible""",
    "element_xml": f"""WITH {_VERSIONS}, {_OWNERS}
        SELECT id, version, ' <node id="' || id || '"'
            || CASE WHEN visible THEN ' lat="' || printf('%.7f', id * 12345 / 1e7) || '" lon="' || printf('%.7f', id * -54321 / 1e7) || '"' ELSE '' END
            || ' timestamp="' || {_ISO.format('ts')} || '" version="' || version || '" changeset="' || changeset_id || '" visible="' || visible || '"'
            || coalesce(' user="' || "user" || '" uid="' || uid || '"', '')
            || CASE WHEN visible THEN '>' || chr(10) || '  <tag k="type" v="' || event_type || '"/>' || chr(10) || ' </node>' ELSE '/>' END AS xml
        FROM eligible LEFT JOIN owners USING (changeset_id)""",
    "member_xml": """SELECT conv_id AS id, ' <relation id="' || conv_id || '" timestamp="2020-01-01T00:00:00Z" version="1" changeset="7">' || chr(10)
            || string_agg('  <member type="' || CASE WHEN turn % 2 = 0 THEN 'node' ELSE 'way' END || '" ref="' || (conv_id * 100 + turn) || '" role="' || role || '"/>' || chr(10), '' ORDER BY turn)
            || ' </relation>' AS xml FROM conversations GROUP BY conv_id""",
} | extract_queries.ORACLE_SQL
