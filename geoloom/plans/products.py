"""The twelve products: current or full history, as XML or blocks, and edit sessions with or
without discussions, each with contributors or anonymous."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changesets as C
from ..operators import elements as E
from ..schemas import FAMILIES
from ..sinks import blocks, fixed, xml
from . import staging

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Product:
    form: str  # "xml" or "blocks"
    history: bool = False
    full: bool = True
    #: Only edit sessions; with their discussions.
    sessions_only: bool = False
    discussions: bool = False


PRODUCTS: dict[str, Product] = {}
for _full in (True, False):
    _suffix = "" if _full else "-no-userinfo"
    PRODUCTS |= {
        f"xml{_suffix}": Product("xml", full=_full),
        f"history-xml{_suffix}": Product("xml", history=True, full=_full),
        f"blocks{_suffix}": Product("blocks", full=_full),
        f"history-blocks{_suffix}": Product("blocks", history=True, full=_full),
        f"changesets{_suffix}": Product("xml", full=_full, sessions_only=True),
        f"changeset-discussions{_suffix}": Product("xml", full=_full, sessions_only=True, discussions=True),
    }


@dataclass
class Options:
    """``outputs``: product name to file. ``meta`` replaces literals of the header."""

    dump: str
    staging: str
    outputs: dict[str, str]
    generator: str = "geoloom"
    compression: str = "bzip2"
    #: A shell command that XML is piped through instead.
    compress_command: str | None = None
    max_concurrency: int = 4
    dense_nodes: bool = True
    resume: bool = False
    compat: bool = False
    meta: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if not self.dump:
            raise ValueError("a dump is needed")
        if not self.outputs:
            raise ValueError("at least one output is needed")
        if unknown := set(self.outputs) - set(PRODUCTS):
            raise ValueError(f"no such product: {', '.join(sorted(unknown))}")
        literals = {"author": fixed.COPYRIGHT, "source": fixed.ORIGIN, "copyleft": fixed.LICENSE, "attribution": fixed.ATTRIBUTION}
        if unknown := set(self.meta) - set(literals):
            raise ValueError(f"no such header literal: {', '.join(sorted(unknown))}")
        self.meta = literals | self.meta


def nested(tables: dict[str, DataFrame], kind: str, history: bool = True) -> DataFrame:
    """Nodes, ways or relations with children and owners, and ``newest``; all that any
    product of them shows. Without ``history`` only current versions are carried along."""
    family = FAMILIES[kind]
    rows = E.eligible(tables[family.parent])
    rows = E.with_newest(rows) if history else E.newest(rows).filter("visible").withColumn("newest", F.lit(True))
    # owners come first, while rows are narrow: they are exchanged by session for that
    rows = E.with_owner(rows, E.eligible(tables["changesets"]), tables["users"])
    rows = E.with_tags(rows, tables[family.tags], ["id", "version"])
    if kind == "way":
        rows = E.with_way_nodes(rows, tables[family.children])
    elif kind == "relation":
        rows = E.with_members(rows, tables[family.children])
    return rows


def of_product(rows: DataFrame, product: Product) -> DataFrame:
    """What a product shows of ``nested`` rows."""
    if not product.history:
        rows = rows.filter("newest and visible")
    return E.shown_owner(rows, product.full, must_exist=product.form == "blocks").drop("newest")


def elements(tables: dict[str, DataFrame], kind: str, product: Product) -> DataFrame:
    """Nodes, ways or relations of one product."""
    return of_product(nested(tables, kind, product.history), product)


def sessions(tables: dict[str, DataFrame], product: Product, max_time) -> DataFrame:
    """Edit sessions of a product."""
    rows = E.eligible(tables["changesets"])
    comments = tables["changeset_comments"]
    rows = C.whole_box(C.with_open(rows, F.lit(max_time).cast("timestamp_ntz")))
    rows = C.with_comment_count(rows, comments)
    if product.discussions:
        rows = C.with_discussion(rows, comments, tables["users"])
    return C.with_owner(E.with_tags(rows, tables["changeset_tags"], ["id"]), tables["users"], product.full)


def document(spark: SparkSession, tables: dict[str, DataFrame], joined: dict[str, DataFrame], product: Product, max_time, generator: str, meta: dict[str, str]) -> DataFrame:
    """The rows of an XML product. Elements come with their sessions, as the format has it."""
    kinds = {"changeset": sessions(tables, product, max_time)}
    render = {"changeset": xml.changeset(product.discussions, product.full)}
    if not product.sessions_only:
        for kind, make in (("node", xml.node), ("way", xml.way), ("relation", xml.relation)):
            kinds[kind], render[kind] = of_product(joined[kind], product), make(product.history)
    return xml.document(spark, kinds, render, F.lit(max_time).cast("timestamp_ntz"), generator, meta)


def build(spark: SparkSession, options: Options) -> None:
    """Stage the dump and write every product that is asked for. Elements are joined with
    their children once and stored; all products read that."""
    staging.stage(spark, options.dump, options.staging, options.resume, options.compat, options.max_concurrency)
    tables, max_time = staging.staged(spark, options.staging), staging.staged_time(spark, options.staging)
    wanted = {name: PRODUCTS[name] for name in options.outputs}
    joined = {}
    if any(not p.sessions_only for p in wanted.values()):
        history = any(p.history for p in wanted.values())
        for kind in ("node", "way", "relation"):
            path = f"{options.staging}/joined_{kind}"
            nested(tables, kind, history).write.mode("overwrite").parquet(path)
            joined[kind] = spark.read.parquet(path)
    for name, product in wanted.items():
        out = options.outputs[name]
        if product.form == "xml":
            xml.write(document(spark, tables, joined, product, max_time, options.generator, options.meta), out, options.compression, options.compress_command)
            if product.discussions and (hidden := C.withheld_comments(tables["changeset_comments"], tables["users"]).count()):
                log.warning("%d visible comments are left out: their authors' data is not public", hidden)
            continue
        seconds = None if max_time is None else int((max_time - type(max_time)(1970, 1, 1)).total_seconds())
        head = blocks.header_block(seconds, options.generator, options.meta["source"], product.history, options.dense_nodes)
        blocks.write([blocks.encode(kind, of_product(joined[kind], product), product.history, product.full, options.dense_nodes) for kind in joined], head, out)
