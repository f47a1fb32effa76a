"""Repeated strings, passages, lines and copies against plain loops."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from payscope.llm.exact_dedup import build_index, exact_dedup
from payscope.llm.line_dedup import line_dedup
from payscope.llm.substring_dedup import substring_dedup
from payscope.llm.suffix_dedup import suffix_dedup


def sha(data):
    return hashlib.sha256(data).hexdigest()


def bytes_left(rows, width):
    """(id, bytes, removed, runs, digest) in order of id; rows of one id in the order given."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - width + 1):
            part = data[s : s + width]
            if part in seen:
                gone[s : s + width] = b"\1" * width
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept)))
    return out


def words_left(rows, width):
    split = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    n = Counter(tuple(w[s : s + width]) for _, w in split for s in range(len(w) - width + 1))
    out = []
    for doc_id, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if n[tuple(w[s : s + width])] > 1:
                gone[s : s + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), sha(kept)))
    return out


def unique_ids(rows):
    """The order of rows that share an id is the table's own, so they are left out here."""
    n = Counter(r[0] for r in rows)
    return sorted(((r[0], r[1]) for r in rows if n[r[0]] == 1), key=lambda r: (r[0] is not None, r[0]))


@pytest.mark.parametrize("width", [100, 40])
def test_bytes(make_docs, rows, width):
    rows = [(i, t, "en", "s") for i, t in unique_ids(rows)]
    got = suffix_dedup(make_docs(rows), width).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    expected = bytes_left([r[:2] for r in rows], width)
    assert Counter(map(tuple, got.collect())) == Counter(expected)


def test_bytes_of_repetitive_texts(make_docs):
    r = random.Random(3)
    base = "".join(r.choice("ab") for _ in range(900))
    rows = [(k, base[r.randrange(300):][: r.randrange(700)] + "c" * r.randrange(260), "en", "s") for k in range(40)]
    rows += [(100, "ab" * 400, "en", "s"), (101, "ba" * 300, "en", "s"), (102, "x" * 99, "en", "s"), (103, "x" * 101, "en", "s")]
    got = suffix_dedup(make_docs(rows)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(bytes_left([r[:2] for r in rows], 100))


@pytest.mark.parametrize("width", [35, 7, 2])
def test_words(docs, rows, width):
    got = substring_dedup(docs, width).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(words_left([r[:2] for r in rows], width))


def test_lines(docs, rows):
    for min_sites in (2, 3):
        sites = defaultdict(set)
        for _, text, _, source in rows:
            for line in (text or "").split("\n"):
                if source is not None:
                    sites[line.strip(" ")].add(source)
        expected = Counter()
        for i, text, _, _ in rows:
            lines = (text or "").split("\n")
            kept = [x for x in lines if not x.strip(" ") or len(sites[x.strip(" ")]) < min_sites]
            expected[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
        assert Counter(map(tuple, line_dedup(docs, min_sites).collect())) == expected


@pytest.mark.parametrize(("key_bits", "bucket_rows"), [(64, 1_000_000), (64, 5), (3, 2)])
def test_copies(docs, rows, key_bits, bucket_rows):
    """With a hash of three bits all texts chain behind few keys, and bytes tell them apart."""
    got = exact_dedup(docs, key_bits=key_bits, bucket_rows=bucket_rows)
    groups = defaultdict(list)
    for i, text, _, _ in rows:
        groups[text or ""].append(i)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[i, keep, len(ids), i == keep, sha(text.encode())] += 1
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.select(columns).collect())) == expected


def test_directory_doubles(docs):
    index = build_index(docs, bucket_rows=5)
    assert index.directory.count() == 1 << index.depth > 1
    sizes = {r["bucket"]: r["count"] for r in index.pages.groupBy("bucket").count().collect()}
    assert max(sizes.values()) <= 5
    # A cell's bucket is that of all cells that share its first bits.
    for r in index.directory.groupBy("bucket", "depth").count().collect():
        assert r["count"] == 1 << (index.depth - r["depth"])


def test_empty_tables(no_docs):
    for operator in (suffix_dedup, substring_dedup, line_dedup, exact_dedup):
        assert operator(no_docs).count() == 0


def test_many_short_documents_and_wide_windows():
    """A slice that would pass the numbers of packed items, and spans beyond 255."""
    import numpy as np
    import pyarrow as pa

    from payscope.llm import repeats as R
    from payscope.llm.suffix_dedup import byte_symbols

    def make(part):
        head, n = part
        items = np.zeros(2, R._ITEM)
        items["core"], items["key"], items["doc"] = 7, [1, head + 2], [n - 1, n - 2]
        yield [(head, i, head + i) for i in range(n)], items

    settle = R.Settling(first_stays=True, width=40, opens=False)
    out = [row for b in R.send(make, settle, 4)([(0, 59_900), (100_000, 6_000), (200_000, 10)]) for row in b.to_pylist()]
    ends = [(h + n - k) for h, n in ((0, 59_900), (100_000, 6_000), (200_000, 10)) for k in (1, 2)]
    got = []
    for row in (r for r in out if r["items"]):
        docs = R._unpacked_docs(row["docs"])
        got += docs[2][np.frombuffer(row["items"], R._ITEM)["doc"]].tolist()
    found = [x for r in out for x in np.frombuffer(r["found"], R._FOUND)]
    got += [int(x["slice"] + x["doc"]) for x in found]
    assert sorted(got) == sorted(ends)

    rng = random.Random(3)
    batch = pa.RecordBatch.from_pydict({"row": [0], "doc_id": [1], "text": ["".join(rng.choices("abcdefgh", k=9000))]})
    ((_, items),) = R.anchors_of(byte_symbols, 2000, 1280, 8, "phrase")(batch)
    assert items["span"].max() > 255 and (items["span"].astype(int) + 1).sum() == 9000 - 2000 + 1


@pytest.mark.parametrize("width", [600])
def test_wide(make_docs, rows, width):
    text = " ".join(f"v{i}" for i in range(900))
    rows = [*((i, t, "en", "s") for i, t in unique_ids(rows)), (2000, text, "en", "s"), (2001, "x " + text, "en", "s")]
    found = substring_dedup(make_docs(rows), width).collect()
    assert Counter(map(tuple, found)) == Counter(words_left([r[:2] for r in rows], width))


def test_thue_morse_words_differ(make_docs):
    """Windows whose first words are a Thue-Morse word and its complement are different windows."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"r{i}" for i in range(34))
    for size in (64, 512, 1024, 4096):
        docs = make_docs([(1, f"{word[:size]} {rest}", "en", "s"), (2, f"{other[:size]} {rest}", "en", "s")])
        assert {r.n_removed for r in substring_dedup(docs).collect()} == {0}
        import numpy as np

        from payscope.llm.hashing import Prefix, byte_codes

        for a, b in ((word, other), (word[:size], other[:size])):
            codes = byte_codes(np.frombuffer((a + b).encode(), np.uint8))
            x, y = Prefix(codes).hashes(np.array([0, len(a)]), np.array([len(a), 2 * len(a)]))
            assert x != y
