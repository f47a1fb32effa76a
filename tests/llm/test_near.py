"""The similarity join against all pairs, the pruning rule, and blocks of large groups."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from payscope.llm import near_join as N


def shingles(text):
    words = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def all_pairs(rows):
    sets = [shingles(r[1]) for r in rows]
    linked = [[] for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 5 * common >= 4 * (len(a) + len(b) - common):
                linked[i].append(j)
                linked[j].append(i)
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(linked):
            least = min([label[i], *[label[j] for j in near]])
            changed |= least != label[i]
            label[i] = least
    classes = {}
    for i, root in enumerate(label):
        if rows[i][0] is not None:
            classes[root] = min(rows[i][0], classes.get(root, rows[i][0]))
    return Counter(
        (rows[i][0], classes.get(root) if sets[i] else rows[i][0], len(linked[i])) for i, root in enumerate(label)
    )


def result(docs):
    return Counter(tuple(r) for r in N.near_join(docs).select("doc_id", "class_id", "n_links").collect())


def test_all_pairs(docs, rows):
    assert result(docs) == all_pairs(rows)


def near_family(n, seed):
    r = random.Random(seed)
    base = [f"t{r.randrange(10**6)}" for _ in range(150)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(r.randrange(7)):
            words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
        rows.append((k, " ".join(words), "en", "s"))
    return rows


def test_large_family_in_blocks(make_docs, monkeypatch):
    """Bands and families of more nodes than a block; blocks are shrunk for it."""
    monkeypatch.setattr(N, "BAND_BLOCK", 16)
    monkeypatch.setattr(N, "FAMILY_BLOCK", 8)
    rows = near_family(70, 1) + [(1000 + i, t, a, b) for i, t, a, b in near_family(5, 2)]
    assert result(make_docs(rows)) == all_pairs(rows)


def test_empty(no_docs):
    assert N.near_join(no_docs).count() == 0


def test_pruning_keeps_the_threshold_and_drops_the_rest():
    draw = np.random.default_rng(5)
    for similarity, kept in ((0.8, True), (0.25, False)):
        left = draw.integers(0, 1 << 32, (5000, N.VALUES), dtype=np.uint32)
        agree = draw.random(left.shape) < similarity
        both = np.concatenate([left, np.where(agree, left, left + np.uint32(1))])
        i, _ = N.surviving(both, np.arange(5000), np.arange(5000, 10_000), 0.8, 1e-9)
        assert len(i) == 5000 if kept else len(i) < 5


def test_signatures_estimate_similarity():
    a = [np.unique(np.random.default_rng(k).integers(0, 1 << 63, 1000, dtype=np.uint64)) for k in range(2)]
    mixed = np.unique(np.concatenate([a[0][:900], a[1][:100]]))
    values = N.signatures([a[0], mixed])
    assert abs((values[0] == values[1]).mean() - 900 / 1100) < 0.15
