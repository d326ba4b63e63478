"""A small dump with the cases that matter."""

TABLES = {
    "users": ("id, display_name, data_public, extra", ["1\tann \"a\" <x>\tt\tz", "2\tbob\tf\tz", "3\tcy\tt\tz"]),
    "changesets": (
        "id, user_id, created_at, min_lat, max_lat, min_lon, max_lon, closed_at, num_changes",
        [
            "10\t1\t2010-01-01 00:00:00.742365\t10000000\t20000000\t-15\t30000000\t2010-01-02 00:00:00\t4",
            "11\t2\t2010-01-03 00:00:00\t1\t\\N\t1\t1\t2030-01-01 00:00:00\t1",
            "12\t3\t2010-01-04 00:00:00\t\\N\t\\N\t\\N\t\\N\t2010-01-05 00:00:00\t0",
            "-4\t1\t2010-01-04 00:00:00\t\\N\t\\N\t\\N\t\\N\t2010-01-05 00:00:00\t0",
        ],
    ),
    "changeset_tags": ("changeset_id, k, v", ["10\tcomment\ta\\tb\\\\n\\n\x01c", "10\tZ\t1"]),
    "changeset_comments": (
        "changeset_id, created_at, author_id, body, visible",
        ["10\t2010-01-02 00:00:00\t3\tsecond & <last>\tt", "10\t2010-01-01 12:00:00\t1\tfirst\tt", "10\t2010-01-01 13:00:00\t1\thidden\tf", "10\t2010-01-01 14:00:00\t2\tprivate\tt", "12\t2010-01-05 00:00:00\t2\tonly private\tt"],
    ),
    "nodes": (
        "node_id, latitude, longitude, changeset_id, visible, \"timestamp\", tile, version, redaction_id",
        [
            "1\t515000000\t-1000000\t10\tt\t2010-01-01 00:00:01\t0\t1\t\\N",
            "1\t515000001\t-1000000\t10\tt\t2010-01-01 00:00:02\t0\t2\t7",  # redacted: version 1 is current
            "2\t1\t2\t11\tt\t2010-01-03 00:00:00\t0\t1\t\\N",
            "2\t1\t2\t11\tf\t2010-01-03 00:00:01\t0\t2\t\\N",  # deleted
            "0\t5\t6\t12\tt\t2010-01-04 00:00:00\t0\t1\t\\N",
            "-5\t5\t6\t12\tt\t2010-01-06 00:00:00\t0\t1\t\\N",  # dropped, but it counts for the time
        ],
    ),
    "ways": ("way_id, changeset_id, \"timestamp\", version, visible, redaction_id", ["7\t10\t2010-01-01 00:00:05\t1\tt\t\\N"]),
    "relations": ("relation_id, changeset_id, \"timestamp\", version, visible, redaction_id", ["8\t10\t2010-01-01 00:00:06\t1\tt\t\\N"]),
    "node_tags": ("node_id, version, k, v", ["1\t1\tz\t1", "1\t1\té\t2", "1\t1\t\ufffd\t3", "1\t1\t\U0001f600\t4", "1\t9\tlost\tx", "2\t1\tn\tv"]),
    "way_tags": ("way_id, version, k, v", []),
    "relation_tags": ("relation_id, version, k, v", ["8\t1\ttype\troute"]),
    "way_nodes": ("way_id, node_id, version, sequence_id", ["7\t7\t1\t3", "7\t10\t1\t1", "7\t12\t1\t2"]),
    "relation_members": ("relation_id, member_type, member_id, member_role, version, sequence_id", ["8\tWay\t7\t\t1\t2", "8\tNode\t1\tstop\t1\t1"]),
}


def text(tables=TABLES, empty=False) -> str:
    out = ["--\n-- a dump\n--\n\nSET client_encoding = 'UTF8';\n\n"]
    for name, (columns, rows) in tables.items():
        out.append(f"COPY public.{name} ({columns}) FROM stdin;\n" + "".join(r + "\n" for r in ([] if empty else rows)) + "\\.\n\n\n")
    return "".join(out)
