from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, node string, row long, "
    "term string, block int, site string, text_hash long, slice long"
)


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """A stored table of (doc_id, text, lang, source) with columns that clash with inner names."""

    def make(rows):
        full = [(i, t, lang, source, None, "k", "n", 1, "t", 2, "s", 3, 4) for i, t, lang, source in rows]
        path = str(tmp_path_factory.mktemp("docs") / "d")
        spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(path)
        return spark.read.schema(SCHEMA).parquet(path)

    return make


@pytest.fixture(scope="session")
def rows(spark, sf_dir):
    """Rows of the smallest table with nulls, empty and long texts, ties and repeated rows among them."""
    given = [
        (r.doc_id, r.text, r.lang, r.source)
        for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60").collect()
    ]
    long = " ".join(f"w{i % 700} x{i % 911}." for i in range(4000))
    return [
        *given,
        (1000, None, None, None), (1001, "", "en", "s"), (1002, "   \n\t ", "en", None), (1003, long, "en", "s"),
        (1004, long + " end", None, "t"), (1005, "a" * 3000, "en", "s"), (1006, "one two", "xx", "s"),
        (1007, given[0][1], "en", "u"), (None, given[1][1], "en", "u"), (None, "no id here at all, is there", "en", "u"),
        (1008, "tie", "en", "s"), (1008, "tie", "en", "s"), (1008, "tie of another text", "en", "s"),
        (1009, "É x ý <|endoftext|> it's\t\tok  ", "fr", "s"), (1010, " odd  marks", "en", "s"),
    ]


@pytest.fixture(scope="session")
def docs(make_docs, rows):
    return make_docs(rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
