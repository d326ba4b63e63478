"""Command line: ``python -m geoloom --dump-file dump.sql --staging staged --xml now.xml.bz2``.

There is an option for the file of each product; at least one must be given. ``--meta-file``
names a file of lines ``meta-author = text`` that stand for options of these names.
"""

from __future__ import annotations

import argparse

from .plans.products import PRODUCTS, Options

META = ("author", "source", "copyleft", "attribution")


def parse(args: list[str] | None = None) -> Options:
    parser = argparse.ArgumentParser(prog="geoloom", description="Extracts of a dump.")
    parser.add_argument("--dump-file", required=True, help="dump to read: plain text, or an archive that the database's own tool can turn to text")
    parser.add_argument("--staging", default="staged", help="folder of the staged tables")
    parser.add_argument("--generator", default="geoloom", help="generator named in the outputs")
    parser.add_argument("--compression", default="bzip2", choices=["bzip2", "gzip", "none"], help="of XML outputs")
    parser.add_argument("--compress-command", help="shell command that XML outputs are piped through instead")
    parser.add_argument("--max-concurrency", type=int, default=4, help="tables that are staged at a time")
    parser.add_argument("--dense-nodes", default="true", choices=["true", "false"])
    parser.add_argument("--resume", action="store_true", help="keep tables that are staged already")
    parser.add_argument("--compat", action="store_true", help="read malformed fields leniently")
    parser.add_argument("--meta-file", help="file of header literals")
    for name in META:
        parser.add_argument(f"--meta-{name}")
    for name in PRODUCTS:
        parser.add_argument(f"--{name}", metavar="FILE")
    given = vars(parser.parse_args(args))
    meta = {}
    if given["meta_file"]:
        with open(given["meta_file"], encoding="utf-8") as f:
            for line in f:
                key, _, value = (x.strip() for x in line.partition("="))
                if key.startswith("meta-") and key[5:] in META:
                    meta[key[5:]] = value
    meta |= {name: given[f"meta_{name}"] for name in META if given[f"meta_{name}"] is not None}
    outputs = {name: given[name.replace("-", "_")] for name in PRODUCTS if given[name.replace("-", "_")]}
    if not outputs:
        parser.error("no output file; give the file of at least one product")
    return Options(
        given["dump_file"], given["staging"], outputs, generator=given["generator"], compression=given["compression"], compress_command=given["compress_command"], max_concurrency=given["max_concurrency"],
        dense_nodes=given["dense_nodes"] == "true", resume=given["resume"], compat=given["compat"], meta=meta,
    )


def main() -> None:
    from pyspark.sql import SparkSession

    from .plans.products import build

    options = parse()
    build(SparkSession.builder.appName("geoloom").config("spark.sql.session.timeZone", "UTC").getOrCreate(), options)


if __name__ == "__main__":
    main()
