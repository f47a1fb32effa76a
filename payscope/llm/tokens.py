"""Tokenizing whole texts inside tasks, a batch of texts at a time.

Neither of the two vocabularies ever joins characters across the start of a run of blanks and line
ends, or from a letter or digit to a mark other than the apostrophe or back (all three of ASCII). So a text's ids are
those of its pieces, cut at these places, one after the other. Numpy cuts a batch into pieces, Arrow codes
them, and only distinct ones are looked up in a cache or go through the tokenizers library; a gather over the
cached ids gives the batch. A piece that is one Latin word goes straight to the library's model, as normal form and
splitting leave it as it is. Texts that hold any other white space or the name of a special token are one piece
and encoded whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from payscope.llm.hashing import LOWER

# A worker's cache is emptied beyond so many bytes, counting an entry as its text, its ids and ENTRY_BYTES;
# longer pieces than LONG bytes never enter it.
CACHE_BYTES, ENTRY_BYTES, LONG = 64 << 20, 160, 256
_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True
_ALNUM, _MARK = np.zeros((2, 256), bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[[c for c in range(0x21, 0x7F) if not _ALNUM[c] and c != ord("'")]] = True
# Words that are letters alone, by vocabulary: of lower case, and behind at most one blank.
_BARE_WORD = re.compile("[a-zß-öø-ÿ]+")
_WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
# How byte-level vocabularies write bytes; those that do not print follow from 256 on.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_WRITTEN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTS)}
# White space other than blanks and line ends: single bytes, and by their first byte the longer codes.
_ODD = np.zeros(256, bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20)]] = True
_LEADS = np.zeros(256, bool)
_ODD_CODES: set[bytes] = {
    chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
}
_LEADS[[c[0] for c in _ODD_CODES]] = True
_ODD_NUMBERS = np.array(sorted(int.from_bytes(c.ljust(3, b"\0"), "big") for c in _ODD_CODES))


def _odd_places(data: np.ndarray) -> np.ndarray:
    """Where white space other than blanks and line ends begins."""
    leads = np.flatnonzero(_LEADS[data])
    after = np.append(data, np.zeros(2, np.uint8)).astype(np.int64)
    code = (after[leads] << 16) | (after[leads + 1] << 8)
    code |= np.where(after[leads] >= 0xE0, after[leads + 2], 0)
    return np.append(np.flatnonzero(_ODD[data]), leads[np.isin(code, _ODD_NUMBERS)])


class Encoder:
    """ids of batches of texts."""

    def __init__(self, path: str, blanks: bool) -> None:
        """``blanks=False``: the vocabulary is of lower case and drops white space, so pieces are bare words."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._blanks = blanks
        # A text with one of these is odd, too: the library finds them before it splits.
        added = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added)).encode())
        self.cache_bytes: int | None = None
        self._forget()

    def _forget(self) -> None:
        self._entries: dict[str, int] = {}
        self._ids, self._sizes, self._bytes = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0

    def _pieces(self, texts: pa.StringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
        """(pieces, coded; number of the text that each belongs to)."""
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        offsets = (offsets - offsets[0]).astype(np.int64)
        blank = _BLANK[data]
        before = np.append(True, blank[:-1])[: len(data)]
        cut = blank & ~before if self._blanks else ~blank & before
        begins = offsets[:-1][offsets[1:] > offsets[:-1]]
        # Between a letter or digit and a mark.
        alnum, mark = _ALNUM[data], _MARK[data]
        cut[1:] |= (alnum[1:] & mark[:-1]) | (mark[1:] & alnum[:-1])
        cut[begins] = True if self._blanks else ~blank[begins]
        keep = None if self._blanks else ~blank
        places = np.append(_odd_places(data), [m.start() for m in self._added.finditer(data.tobytes())]).astype(np.int64)
        odd = np.unique(np.searchsorted(offsets, places, "right") - 1)
        for k in odd:
            a, b = offsets[k], offsets[k + 1]
            cut[a:b] = False
            cut[a] = True
            if keep is not None:
                keep[a:b] = True
        at = np.flatnonzero(cut)
        owner = np.searchsorted(offsets, at, "right") - 1
        if keep is None:
            ends = np.append(at, len(data))
        else:
            # Places among the kept bytes.
            ends = np.append(np.cumsum(keep)[at] - 1, keep.sum()) if len(at) else np.zeros(1, np.int64)
            data = LOWER[data[keep]]
        found = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))
        return found.dictionary_encode(), owner

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all one after the other, how many each has)."""
        model, plain = self._library.model.tokenize, (_WORD if self._blanks else _BARE_WORD).fullmatch
        ids = [
            [t.id for t in model(p.encode().decode("latin-1").translate(_WRITTEN))] if plain(p) else None for p in pieces
        ]
        rest = [i for i, x in enumerate(ids) if x is None]
        for i, found in zip(rest, self._library.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)):
            ids[i] = found.ids
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _looked_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each piece's begin, how many each has)."""
        if self._bytes > (CACHE_BYTES if self.cache_bytes is None else self.cache_bytes):
            self._forget()
        entries = self._entries
        number = np.fromiter((entries.get(p, -1) for p in pieces), np.int64, len(pieces))
        # What is new, long pieces last.
        missing = sorted(np.flatnonzero(number < 0).tolist(), key=lambda i: len(pieces[i]) > LONG)
        if missing:
            new = [pieces[i] for i in missing]
            ids, sizes = self._encoded(new)
            n, n_short = len(self._sizes), sum(len(p) <= LONG for p in new)
            number[missing] = n + np.arange(len(new))
            entries.update(zip(new[:n_short], range(n, n + n_short)))
            kept = int(sizes[:n_short].sum())
            all_ids, all_sizes = np.concatenate([self._ids, ids]), np.concatenate([self._sizes, sizes])
            self._bytes += sum(map(len, new[:n_short])) + 4 * kept + ENTRY_BYTES * n_short
            self._ids, self._sizes = all_ids[: len(self._ids) + kept], all_sizes[: n + n_short]
        else:
            all_ids, all_sizes = self._ids, self._sizes
        return all_ids, (np.cumsum(all_sizes) - all_sizes)[number], all_sizes[number]

    def __call__(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ``end_id`` behind each; where each text's ids begin, and at last their number)."""
        pieces, owner = self._pieces(texts)
        flat, begin, size = self._looked_up(pieces.dictionary.to_pylist())
        codes = pieces.indices.to_numpy()
        size = size[codes]
        total = np.cumsum(size)
        ends = np.cumsum(np.bincount(owner, size, len(texts)).astype(np.int64) + 1)
        # Each id's place in ``flat``, and in the result, where a text's number of end ids stands before it.
        source = np.arange(total[-1] if len(total) else 0) + np.repeat(begin[codes] - (total - size), size)
        found = np.full(ends[-1] if len(ends) else 0, end_id, np.uint32)
        ours = np.ones(len(found), bool)
        ours[ends - 1] = False
        found[ours] = flat[source]
        return found, np.append(0, ends)


def encoder(path: str, blanks: bool, cache_bytes: int | None = None) -> Encoder:
    """One encoder per vocabulary and Python worker; its cache takes ``CACHE_BYTES`` unless told otherwise."""
    if (path, blanks) not in _ENCODERS:
        _ENCODERS[path, blanks] = Encoder(path, blanks)
    found = _ENCODERS[path, blanks]
    found.cache_bytes = cache_bytes
    return found
