"""Token files and packing against the tokenizers library and plain loops."""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from payscope.llm import packing, token_files
from payscope.llm.queries import vocabulary


def library_ids(name, texts, end):
    found = Tokenizer.from_file(vocabulary(name)).encode_batch(texts, add_special_tokens=False)
    return [[*x.ids, end] for x in found]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_code_round_trip(values):
    control, data = token_files.encode(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_files.decode(control, data, len(values)).tolist() == values


def test_token_files(spark, docs, rows, tmp_path):
    files = token_files.write_token_files(
        docs, vocabulary("word_bpe_49k.json"), False, 1, 49_408, folder=str(tmp_path / "f")
    )
    got = token_files.read_token_files(spark, files).collect()
    assert len(got) == len(rows)
    expected = Counter(
        (r[0], len(ids), crc(ids))
        for r, ids in zip(rows, library_ids("word_bpe_49k.json", [r[1] or "" for r in rows], 1))
    )
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == expected
    in_order = sorted(got, key=lambda r: r.start)
    before = 0
    for r in in_order:
        assert r.start == before
        before += r.n_tokens
    ids = [r.doc_id for r in in_order]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    ranks = spark.read.parquet(files.ranks).orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)


def test_no_documents(spark, no_docs):
    files = token_files.write_token_files(no_docs, vocabulary("word_bpe_49k.json"), False, 1, 49_408)
    assert token_files.read_token_files(spark, files).count() == 0
    assert packing.pack(no_docs, vocabulary("byte_bpe_50k.json")).count() == 0


def fewest_bins(sizes, capacity):
    """Least number of bins by trying all, for few items."""
    best = len(sizes)

    def place(left, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not left:
            best = len(bins)
            return
        for i, b in enumerate(bins):
            if b + left[0] <= capacity:
                place(left[1:], [*bins[:i], b + left[0], *bins[i + 1 :]])
        place(left[1:], [*bins, left[0]])

    place(sorted(sizes, reverse=True), [])
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_reduction_loses_no_bin(sizes):
    """What is fixed plus the best packing of the rest is the best packing of all."""
    groups, left = packing.reduce_instance(Counter(sizes), 20)
    fixed = sum(g.copies for g in groups)
    assert fixed + fewest_bins(list(left.elements()), 20) == fewest_bins(sizes, 20)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_packs_everything(sizes):
    groups, placed = packing.plan(Counter(sizes), 40), Counter()
    for group in groups:
        assert sum(s * n for s, n in group.sizes) <= 40
        for s, n in group.sizes:
            placed[s] += n * group.copies
    assert placed == Counter(sizes)


@pytest.mark.parametrize("capacity", [1024, 64])
def test_packing(docs, rows, capacity):
    got = packing.pack(docs, vocabulary("byte_bpe_50k.json"), capacity=capacity).collect()
    expected = Counter()
    for row, ids in zip(rows, library_ids("byte_bpe_50k.json", [r[1] or "" for r in rows], 2)):
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        expected.update(
            (row[0], k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
        )
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // capacity) + 3
    assert all(a is not b for a, b in combinations(sequences.values(), 2))


ODD_TEXTS = [
    "", " ", "\n \n", "a", " a", "a ", "a  b\n\nc ", "tab\there and  more", "x\x0b", "é x  y", " em", "“curly” – dash…  x",
    "　wide", "İstanbul  I", "Å Å Å", "don't <|endoftext|> stop", "日本語 テキスト  です", "z" * 5000, "a\x1cb c", "\x00 \x7f ﻿ b",
    "Straße\u0085neu", "\U0001f600 \U0001f600x", "1 000 000  20.5", "ΑΣ ΣΑΣ", "é x\r\ny",
]


@pytest.mark.parametrize("name, blanks", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_gives_the_ids_of_the_library(name, blanks, monkeypatch):
    import pyarrow as pa

    from payscope.llm import tokens

    texts = [*ODD_TEXTS, *[a + b for a in ODD_TEXTS[:12] for b in ODD_TEXTS], "nb" * 2_500_000]
    want = library_ids(name, texts, 7)
    for limit in (tokens.CACHE_BYTES, 0):
        monkeypatch.setattr(tokens, "CACHE_BYTES", limit)
        encode = tokens.Encoder(vocabulary(name), blanks)
        for _ in range(2):
            batch = pa.array(["sliced off", *texts]).slice(1)
            ids, begins = encode(batch, 7)
            assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == want
        assert all(len(p) <= tokens.LONG for p in encode._entries)
    assert encode(pa.array([], pa.string()), 7)[0].tolist() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é\n\t  İ'1.́"), max_size=20), max_size=6))
def test_encoder_on_any_texts(texts):
    import pyarrow as pa

    from payscope.llm import tokens

    for name, blanks in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        ids, begins = tokens.encoder(vocabulary(name), blanks)(pa.array(texts, pa.string()), 7)
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == library_ids(name, texts, 7)
