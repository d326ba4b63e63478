"""Small tables with the cases every operator must handle."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_key string, digest int, `a.b` int"
LONG = "the quick brown fox jumps over the lazy dog and runs into the woods " * 3000

ROWS = [
    (1, "the same words in the same order make the same document again", "en", "src0"),
    (2, "the same words in the same order make the same document again", "en", "src0"),
    (3, "The same words in the same order make the same document again.", "en", "src1"),
    (4, None, None, None),
    (5, "", "en", "src0"),
    (6, " \n\t ", "en", "src0"),
    (7, LONG, "en", "src2"),
    (8, "ein ganz anderer Text über die Straße und das Haus am See", "de", "src3"),
    (8, "ein ganz anderer Text über die Straße und das Haus am See", "de", "src3"),
    (None, "no number but a text of its own that nobody else has", "en", "src0"),
    (9, "<|endoftext|> É É ΑΣ İstanbul it's 1234 !!! 日本語", "en", "src0"),
    (10, "mail to ann.lee@corp.org or call +1 (212) 555-0188", "en", "src0"),
    (11, "two words", "en", "src0"),
    (12, "x", None, "src9"),
]


def rows():
    return [(i, t, lang, source, None if t is None else len(t), "clash", 1, 2) for i, t, lang, source in ROWS]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
