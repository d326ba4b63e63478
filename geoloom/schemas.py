"""Tables of a dump: columns, types, sort keys, and which children belong to which parent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Member types in the order of their codes.
MEMBER_TYPES = ("Node", "Way", "Relation")


@dataclass(frozen=True)
class Column:
    name: str
    #: One of: long, int, string, boolean, timestamp, member_type.
    kind: str
    nullable: bool = False
    #: Its name in the dump if that differs; "*" is the first column whatever its name.
    dump_name: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        return {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "boolean": T.BooleanType(), "timestamp": T.TimestampNTZType(), "member_type": T.StringType()}[self.kind]


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    #: The leading columns that order the table.
    keys: int
    #: The column whose maximum counts towards the time of the dump.
    time_column: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, c.nullable) for c in self.columns])

    @property
    def key_columns(self) -> list[str]:
        return [c.name for c in self.columns[: self.keys]]


def _versioned(name: str, *more: Column) -> Table:
    id_column = Column("id", "long", dump_name=f"{name[:-1]}_id")
    return Table(name, (id_column, Column("version", "long"), Column("changeset_id", "long"), Column("visible", "boolean"), Column("timestamp", "timestamp"), Column("redaction_id", "long", True), *more), 2, "timestamp")


def _tags(name: str) -> Table:
    return Table(name, (Column("id", "long", dump_name="*"), Column("version", "long"), Column("k", "string"), Column("v", "string")), 3)


_ALL = (
    Table("users", (Column("id", "long"), Column("display_name", "string"), Column("data_public", "boolean")), 1),
    Table(
        "changesets",
        (Column("id", "long"), Column("uid", "int", dump_name="user_id"), Column("created_at", "timestamp"), *(Column(c, "int", True) for c in ("min_lat", "max_lat", "min_lon", "max_lon")), Column("closed_at", "timestamp"), Column("num_changes", "int")),
        1,
        "created_at",
    ),
    Table("changeset_tags", (Column("id", "long", dump_name="*"), Column("k", "string"), Column("v", "string")), 2),
    Table("changeset_comments", (Column("changeset_id", "long"), Column("created_at", "timestamp"), Column("author_id", "long"), Column("body", "string"), Column("visible", "boolean")), 2, "created_at"),
    _versioned("nodes", Column("latitude", "int"), Column("longitude", "int")),
    _versioned("ways"),
    _versioned("relations"),
    _tags("node_tags"),
    _tags("way_tags"),
    _tags("relation_tags"),
    Table("way_nodes", (Column("id", "long", dump_name="way_id"), Column("version", "long"), Column("sequence_id", "long"), Column("node_id", "long")), 3),
    Table("relation_members", (Column("id", "long", dump_name="relation_id"), Column("version", "long"), Column("sequence_id", "long"), Column("member_type", "member_type"), Column("member_id", "long"), Column("member_role", "string")), 3),
)
TABLES: dict[str, Table] = {t.name: t for t in _ALL}


@dataclass(frozen=True)
class Family:
    """A kind of element with the tables of its children."""

    kind: str
    order: int
    parent: str
    tags: str
    children: str | None
    versioned: bool


FAMILIES: dict[str, Family] = {
    f.kind: f
    for f in (
        Family("changeset", 0, "changesets", "changeset_tags", "changeset_comments", False),
        Family("node", 1, "nodes", "node_tags", None, True),
        Family("way", 2, "ways", "way_tags", "way_nodes", True),
        Family("relation", 3, "relations", "relation_tags", "relation_members", True),
    )
}
