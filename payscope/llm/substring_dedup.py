"""Passages of words that occur more than once, by levels of doubled length.

Level 1 looks at windows of half the length, one for each anchor (see ``repeats``), so that every
passage of full length holds one of them. Those found once are done with; the words around each of
the others are looked at again at twice the length (at most the full one), start by start, until the
full length is reached or no candidate is left.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm import repeats as R
from payscope.llm.common import tasks
from payscope.llm.hashing import word_hashes

WIDTH = 35
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _report(texts, found):
    words = [_WORD.findall(t) for t in texts]
    begins = np.cumsum([0, *map(len, words)])
    gone = R.covered(found, begins)
    removed, digests = [], []
    for k, mine in enumerate(words):
        out = gone[begins[k] : begins[k + 1]]
        n = int(out.sum())
        kept = [w for w, g in zip(mine, out.tolist()) if not g] if n else mine
        removed.append(n)
        digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return {"n_words": [len(w) for w in words], "n_removed": removed, "kept_sha256": digests}


def repeated_passages(rows: DataFrame, width: int) -> DataFrame:
    """Marks (slice, doc, begin, stop) of all words in windows that start anywhere else too."""
    n = tasks(rows.sparkSession)
    first = max(1, -(-width // 2))
    pick = width - first + 1
    level = R.Settling(first_stays=False, width=0, opens=True)
    make = R.anchors_of(word_hashes, width, pick, min(3, first), "core")
    found = R.exchange(
        rows.mapInArrow(R.send(make, level, n), R.PACKED), R.settle_bucket(level), f"level-{first}"
    )
    length = first
    while length < width:
        length = min(2 * length, width)
        last = length == width
        level = R.Settling(first_stays=False, width=width if last else 0, opens=not last)
        opened = R.with_texts(rows, found.where(F.col("kind") == R.OPEN), "inner")
        found = R.exchange(
            opened.mapInArrow(R.send(R.starts_of(word_hashes, length), level, n), R.PACKED),
            R.settle_bucket(level), f"level-{length}",
        )
    return found


def substring_dedup(
    docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``, a stored table.

    Each word in a window of ``width`` words whose words also start anywhere else, in this row or another,
    is removed; windows are judged on the input. Repeated rows remove each other, ids being without a
    part in this. Null or empty texts have no words; other columns are ignored.
    """
    if width < 2:
        raise ValueError("a passage has at least two words")
    if width > R.MOST_WIDTH:
        raise ValueError(f"passages longer than {R.MOST_WIDTH} words")
    rows = R.numbered(docs, id_col, text_col)
    marks = repeated_passages(rows, width)
    return R.finish(rows, marks, _report, "n_words long, n_removed long, kept_sha256 string")
