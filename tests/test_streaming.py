from geoloom.streaming.newest import newest_stream

SCHEMA = "id long, version long, visible boolean, redaction_id long, v string"


def test_newest_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    batches = [
        [(1, 1, True, None, "a"), (2, 1, True, None, "b"), (-3, 1, True, None, "x")],
        [(1, 3, True, 7, "redacted"), (1, 2, True, None, "c"), (2, 2, False, None, "gone")],
        [(1, 1, True, None, "late")],
    ]
    query = None
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        query = query or newest_stream(spark.readStream.schema(SCHEMA).parquet(folder)).writeStream.outputMode("complete").format("memory").queryName("newest").start()
        query.processAllAvailable()
    query.stop()
    assert {r.id: (r.version, r.visible, r.v) for r in spark.table("newest").collect()} == {1: (2, True, "c"), 2: (2, False, "gone")}
