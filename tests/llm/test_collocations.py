from __future__ import annotations

import random
import re
from collections import Counter

from payscope.llm.collocations import collocations


def plain(rows, top, min_count):
    """The contract by plain loops over all phrases."""
    f: dict[str, Counter] = {}
    for _, text, lang, _ in rows:
        found = f.setdefault("und" if lang is None else lang, Counter())
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            found.update(tuple(words[i : i + m]) for m in (1, 2, 3, 4) for i in range(len(words) - m + 1))
    want = set()
    for lang, n in f.items():
        often = {p: a for p, a in n.items() if len(p) > 1 and a >= min_count}
        gone = {
            q[i : i + m]
            for q, b in often.items() for m in range(2, len(q)) for i in range(len(q) - m + 1)
            if 100 * b >= 80 * often[q[i : i + m]]
        }
        scored = []
        for p in often.keys() - gone:
            score, k = min((2_000_000 * n[p] // (n[p[:k]] + n[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -n[p], " ".join(p).encode(), n[p[:k]], n[p[k:]]))
        total = sum(a for p, a in n.items() if len(p) == 1)
        want |= {
            (lang, rank + 1, phrase.decode(), -a, left, right, total, -score)
            for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top])
        }
    return want


def got(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def test_against_all_phrases(docs, rows):
    for top, min_count in ((10, 4), (2000, 3), (25, 2)):
        assert got(collocations(docs, top=top, min_count=min_count)) == plain(rows, top, min_count)


def test_growth_in_many_rounds_stops_early(make_docs):
    """Chains of words with every degree of cohesion; small batches, so that bounds and ties decide."""
    draw = random.Random(5)
    rows = []
    for i in range(120):
        words = []
        for _ in range(120):
            k = draw.randrange(40)
            words += [f"a{k}", f"b{k}", f"c{k}", f"d{k}"][: draw.choice([1, 2, 3, 4, 4, 4 if k % 3 else 2])]
            if draw.random() < 0.1:
                words.append(draw.choice([".", ",", "the", "The\t", "ü"]))
        rows.append((i, " ".join(words), draw.choice(["en", "de", None]), "s"))
    log = []
    docs = make_docs(rows)
    assert got(collocations(docs, top=5, min_count=3, first_batch=1, log=log)) == plain(rows, 5, 3)
    every = []
    assert got(collocations(docs, top=100_000, min_count=3, log=every)) == plain(rows, 100_000, 3)
    assert len(log) > 2 and sum(log) < sum(every)


def test_empty_and_odd(make_docs, no_docs):
    assert got(collocations(no_docs)) == set()
    rows = [(1, None, None, None), (2, "", "en", None), (3, "a b " * 50, "und", "s"), (4, "x" * 100_000 + " Y", "en", "s"), (None, "É é É é", None, "s")]
    assert got(collocations(make_docs(rows), min_count=2)) == plain(rows, 2000, 2)
