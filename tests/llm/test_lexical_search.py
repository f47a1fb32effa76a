from __future__ import annotations

import math
import random
import re
from collections import Counter

from payscope.llm.lexical_search import search

_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text):
    return re.findall(_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, queries, k):
    """Sorted lists of (item_id, rank, doc_id, score) by scoring every document for every query."""
    docs = [(i, Counter(terms_of(t))) for i, t, *_ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, n_words = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    found = []
    for item, text in queries:
        scores = []
        for i, counts, n in docs:
            m = 10 + (90 * n * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in set(terms_of(text)) if t in counts
            )
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        found += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(found, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def asked(spark, queries):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in queries], "item_id long, text string, term string, row int")


def test_against_scoring_every_document(spark, docs, rows):
    queries = [
        (1, " ".join(rows[3][1].split()[:25])), (2, "The, the THE of and"), (3, None), (4, "qqqq zzzz"), (5, "tie one x1"),
        (5, "tie one x1"), (None, rows[8][1]), (6, "É ý ok w3 x7"), (7, ""),
    ]
    for k, block, growth in ((10, 1024, 8), (3, 2, 2), (1, 1, 3), (50, 8, 4)):
        assert got(search(docs, asked(spark, queries), k=k, block=block, growth=growth)) == plain(rows, queries, k)


def test_rounds_ties_and_early_ends(spark, make_docs):
    """Many copies tie; a query of one rare term ends in the round that has read its list."""
    draw = random.Random(3)
    words = [f"w{int(60 * draw.random() ** 3)}" for _ in range(4000)]
    rows = [(i, " ".join(draw.sample(words, draw.choice([2, 5, 5, 5, 40]))), "en", "s") for i in range(300)]
    rows += [(1000 + i, "w1 w2 w50", "en", "s") for i in range(40)] + [(2000, "only here w0 w1", "en", "s"), (2000, "only w3", "en", "s")]
    queries = [(1, "w0 w1 w2 w50"), (2, "only"), (3, "w59 w58 w57 w0 w1 w2 w3 w4 w5"), (4, "w1 w2 w50")]
    log = []
    assert got(search(make_docs(rows), asked(spark, queries), block=4, growth=2, log=log)) == plain(rows, queries, 10)
    assert len(log) > 2 and log[0][1] < 4 and log[-1][1:] == (0, 0)
    assert any(held < len(rows) * at_work for _, at_work, held in log)


def test_empty_tables(spark, docs, no_docs):
    assert got(search(no_docs, asked(spark, [(1, "a b")]))) == []
    assert got(search(docs, asked(spark, []))) == []
