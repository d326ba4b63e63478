import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    """Each stage is the operator's own decision on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 100_000).unionByName(spark.createDataFrame([(200_000, None, "en", "s", None), (200_001, "", "en", "s", 0), (200_002, "!!! 123", "en", "s", 7)], docs.schema))
    now = docs.unionByName(extra)
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF).cache()
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            sizes.append(out.count())
            ids = {r.doc_id for r in out.select("doc_id").collect()}
            if name == "language_id":
                assert not ids & {200_000, 200_001, 200_002} and len(ids) == docs.count() + 3
            if name == "exact_dedup":
                assert {100_000 + r.doc_id for r in docs.limit(3).collect()} <= ids and out.select("text").distinct().count() == out.count()
            if name == "pii":
                assert out.filter(F.col("text").rlike(r"@(?!mail\d+\.example\.net)") | (F.length("text") != F.col("n_chars"))).count() == 0
        else:
            assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in now.select("doc_id").collect()}
        now = out
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "pii", "packing"]


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0
