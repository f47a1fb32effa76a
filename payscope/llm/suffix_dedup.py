"""Repeated byte strings by a prefix-free parse of the corpus.

Rolling-hash triggers (the anchors of ``repeats``) cut documents into overlapping phrases; a phrase holds
every string of ``width`` bytes whose first trigger is the phrase's own. No phrase's core can stand for
two phrases, so a string's occurrences are all behind equal triggers, and corpus order is needed only
among the phrases of one core:

1. *Dictionary*: phrases meet by the hash of their bytes. All but the first occurrence of a phrase
   repeat it whole; only the first, in corpus order, goes on.
2. *Suffixes*: the dictionary phrases that share their core with a different phrase are opened: the
   suffix of the phrase with what the parse continues it by, to the depth of ``width`` bytes, is hashed
   from every start. Of equal ones all but the first are repeats.

Corpus order is that of (id, row, start). Suffixes of a core are ordered by the hash of their first
``width`` bytes: equality at that depth is all that is asked of a suffix array here.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm import repeats as R
from payscope.llm.common import tasks
from payscope.llm.hashing import byte_codes

WIDTH = 100


def byte_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return byte_codes(np.frombuffer(b"".join(texts), np.uint8)), np.cumsum([0, *map(len, texts)])


def _report(texts, found):
    begins = np.cumsum([0, *map(len, texts)])
    gone = R.covered(found, begins)
    removed, spans, digests = [], [], []
    for k, text in enumerate(texts):
        out = gone[begins[k] : begins[k + 1]]
        n = int(out.sum())
        removed.append(n)
        spans.append(int(np.count_nonzero(np.diff(out.astype(np.int8), prepend=0) == 1)) if n else 0)
        kept = np.frombuffer(text, np.uint8)[~out].tobytes() if n else text
        digests.append(hashlib.sha256(kept).hexdigest())
    return {"n_bytes": [len(t) for t in texts], "n_removed": removed, "n_spans": spans, "kept_sha256": digests}


def _dictionary(width: int):
    """Marks the repeats of a phrase; opens first phrases whose core another phrase has too."""
    settle = R.Settling(first_stays=True, width=width, opens=False)

    def decide(items, docs, rank):
        hits, firsts = settle(items, rank)
        first = items[firsts]
        _, where, n = np.unique(first["core"], return_inverse=True, return_counts=True)
        return [
            R._findings(items[hits], docs, R.MARK, width), R._findings(first[n[where] > 1], docs, R.OPEN, 0)
        ]

    return decide


def suffix_dedup(
    docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``, a stored table.

    Each byte in a string of ``width`` bytes that also starts earlier (lesser id, or earlier in the same
    document) is removed; strings are judged on the input. Null ids come first; rows that share an
    id come in the order in which they are stored. Null texts are empty; other columns are ignored.
    """
    if width < 32:
        raise ValueError("strings shorter than 32 bytes have no room for triggers")
    if width > R.MOST_WIDTH:
        raise ValueError(f"strings longer than {R.MOST_WIDTH} bytes")
    rows = R.numbered(docs, id_col, text_col)
    n = tasks(docs.sparkSession)
    pick = width * 16 // 25
    phrase = R.Settling(first_stays=True, width=width, opens=False)
    make = R.anchors_of(byte_symbols, width, pick, 8, "phrase")
    first = R.exchange(
        rows.mapInArrow(R.send(make, phrase, n), R.PACKED), _dictionary(width), "phrases"
    )
    opened = R.with_texts(rows, first.where(F.col("kind") == R.OPEN), "inner")
    suffixes = R.exchange(
        opened.mapInArrow(R.send(R.starts_of(byte_symbols, width), phrase, n), R.PACKED),
        R.settle_bucket(phrase), "suffixes",
    )
    marks = first.where(F.col("kind") == R.MARK).unionByName(suffixes)
    return R.finish(rows, marks, _report, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
