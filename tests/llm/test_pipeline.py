"""Stages of the pipeline on odd tables, against plain loops."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline as P
import pytest

PROSE = [" ".join(f"w{random.Random(i).randrange(10_000)}{k}" for k in range(60)) for i in range(12)]
ODD = [
    (1, "a b c", "en", "s"), (1, "another text altogether", "en", "s"), (2, "a b c", "en", "s"), (2, "a b c", "en", "s"),
    (None, "no id", "en", "s"), (None, "no id", "en", "s"), (None, "a b c", "en", "s"), (3, None, "en", "s"), (4, "", None, None),
    (5, PROSE[0], "en", "s"), (6, PROSE[0] + " more", "en", "s"), (6, PROSE[1], "en", "s"), (7, PROSE[0] + " more", "xx", "t"),
    (None, PROSE[2], "en", "s"), (8, PROSE[2] + " end", "en", "s"), (9, PROSE[3], "en", "s"), (9, PROSE[3], "en", "s"),
    *[(20 + i, PROSE[4 + i % 8] + (" x" if i % 3 else ""), "en", "s") for i in range(40)],
]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def one_of_each(rows, same, best):
    """Rows that stay: of each class of ``same`` rows the one that ``best`` takes."""
    classes = []
    for row in rows:
        near = [c for c in classes if any(same(row, other) for other in c)]
        classes = [c for c in classes if c not in near] + [[row, *[r for c in near for r in c]]]
    return Counter((r[0], r[1]) for r in (best(c) for c in classes))


def by_id(take, none):
    return lambda rows: take(rows, key=lambda r: none if r[0] is None else r[0])


def near(a, b):
    x, y = shingles(a[1]), shingles(b[1])
    return bool(x and y) and len(x & y) >= 0.8 * len(x | y)


@pytest.fixture(scope="module")
def table(make_docs):
    return make_docs(ODD)


def got(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_copies(spark, table):
    # A null text is an empty one, so either may stand for both; the larger id does.
    want = one_of_each(ODD, lambda a, b: (a[1] or "") == (b[1] or ""), by_id(max, -1))
    found = P.copies(spark, table, "")
    assert got(found) == want and found.columns == table.columns


def test_near_copies(spark, table):
    found = got(P.near_copies(spark, table, ""))
    assert found == one_of_each(ODD, near, by_id(min, -1))


def test_benchmark_and_quality(spark, table, tmp_path):
    words = PROSE[3].split()
    spark.createDataFrame([(1, " ".join(words[5:25]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(9, 1, 0), (None, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = P.benchmark(spark, table, str(tmp_path))
    assert got(found) == Counter((r[0], r[1]) for r in ODD if r[1] != PROSE[3])
    kept = P.quality(spark, table, str(tmp_path))
    assert kept.columns == table.columns and set(got(kept)) <= {(r[0], r[1]) for r in ODD}


def test_empty_table(spark, make_docs, sf_dir):
    empty = make_docs([])
    for _, stage in P.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
