"""Versioned elements: filters, newest versions, children, contributors.

All inputs of a family are keyed by ``id``; children are nested per (id, version) before they
join, so that each side is exchanged once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def eligible(elements: DataFrame) -> DataFrame:
    """Without redacted versions and negative ids (id 0 stays). Redacted versions go before
    the newest is looked for, so that an older version can take their place."""
    kept = elements.filter("redaction_id is null") if "redaction_id" in elements.columns else elements
    return kept.filter("id >= 0")


def with_newest(elements: DataFrame) -> DataFrame:
    """Add ``newest``: whether the version is the newest of its id."""
    w = Window.partitionBy("id")
    return elements.withColumn("newest", F.col("version") == F.max("version").over(w))


def newest(elements: DataFrame) -> DataFrame:
    """The newest version of each id. Ranks are limited before the exchange."""
    w = Window.partitionBy("id").orderBy(F.col("version").desc())
    return elements.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def current(elements: DataFrame) -> DataFrame:
    """Newest eligible versions that are visible: an element whose newest version is deleted
    is absent, older versions do not come back."""
    return newest(eligible(elements)).filter("visible")


def history(elements: DataFrame) -> DataFrame:
    """All eligible versions."""
    return eligible(elements)


def nest(children: DataFrame, keys: list[str], order: list[str], fields: list[str], name: str) -> DataFrame:
    """Children as an ordered array of structs per key. Strings order by their bytes."""
    items = F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
    return children.groupBy(*keys).agg(F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias(name))


def with_tags(elements: DataFrame, tags: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``tags``, ordered by key; tags of versions that do not exist are dropped."""
    nested = nest(tags, keys, ["k", "v"], ["k", "v"], "tags")
    return _filled(elements.join(nested, keys, "left"), "tags")


def with_way_nodes(ways: DataFrame, way_nodes: DataFrame) -> DataFrame:
    """Add ``refs``, the node ids in sequence."""
    nested = nest(way_nodes, ["id", "version"], ["sequence_id"], ["sequence_id", "node_id"], "refs").withColumn("refs", F.col("refs.node_id"))
    return _filled(ways.join(nested, ["id", "version"], "left"), "refs")


def with_members(relations: DataFrame, members: DataFrame) -> DataFrame:
    """Add ``members`` (member_type, member_id, member_role) in sequence."""
    fields = ["member_type", "member_id", "member_role"]
    nested = nest(members, ["id", "version"], ["sequence_id"], ["sequence_id", *fields], "members")
    nested = nested.withColumn("members", F.transform("members", lambda x: F.struct(*[x[f].alias(f) for f in fields])))
    return _filled(relations.join(nested, ["id", "version"], "left"), "members")


def _filled(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)))


def public_users(users: DataFrame) -> DataFrame:
    """``uid, user`` of those who let their data be public."""
    return users.filter("data_public").select(F.col("id").alias("uid"), F.col("display_name").alias("user"))


def with_owner(elements: DataFrame, changesets: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``user, uid`` of the changeset's owner, null unless public, and ``owned``, null if
    there is no such changeset.

    Owners are looked up on the changesets first; the planner broadcasts either side only
    where its size allows."""
    owners = changesets.select(F.col("id").alias("changeset_id"), F.col("uid").cast("long").alias("uid")).join(public_users(users), "uid", "left").select("changeset_id", F.when(F.col("user").isNotNull(), F.col("uid")).alias("uid"), "user", F.lit(True).alias("owned"))
    return elements.join(owners, "changeset_id", "left")


def shown_owner(owned: DataFrame, full: bool, must_exist: bool = False) -> DataFrame:
    """Hide the owner unless ``full``. With ``must_exist`` a shown owner whose changeset does
    not exist is an error."""
    user, uid = F.col("user"), F.col("uid")
    if not full:
        user, uid = F.lit(None).cast("string"), F.lit(None).cast("long")
    elif must_exist:
        message = F.concat(F.lit("no changeset "), F.col("changeset_id").cast("string"))
        user = F.when(F.col("owned").isNull(), F.raise_error(message).cast("string")).otherwise(user)
    return owned.withColumns({"user": user, "uid": uid}).drop("owned")
