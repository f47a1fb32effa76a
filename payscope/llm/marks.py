"""Words of whole batches of texts by numpy, and bitmaps of a fixed size that tell which phrases matter."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.hashing import LOWER

MAX_WORDS = 4
_BITS = 25
_SLOT = (1 << _BITS) - 1
# The seed of Spark's xxhash64, and the primes of that function.
_SEED, _U = 42, np.uint64
_PRIMES = np.array([
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
], np.uint64)


def phrase_hash(words: Column) -> Column:
    """Of (lang, array of at most four words): each word's hash is hashed on top of those before it."""
    each = [F.xxhash64(F.get(words, F.lit(k))) for k in range(MAX_WORDS)]
    return F.coalesce(*[F.when(F.size(words) == m, F.xxhash64("lang", *each[:m])) for m in range(1, MAX_WORDS + 1)])


def chained(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of 64-bit numbers on top of the hashes ``seed``."""
    with np.errstate(over="ignore"):
        x = value * _PRIMES[1]
        x = (x << _U(31) | x >> _U(33)) * _PRIMES[0] ^ (seed + _PRIMES[4] + _U(8))
        x = (x << _U(27) | x >> _U(37)) * _PRIMES[0] + _PRIMES[3]
        x = (x ^ x >> _U(33)) * _PRIMES[1]
        x = (x ^ x >> _U(29)) * _PRIMES[2]
        return x ^ x >> _U(32)


class Marks:
    """A bitmap of 2^25 bits in which the hash of a (language, phrase) sets two."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    @staticmethod
    def of(phrases: DataFrame) -> "Marks":
        """Of the rows (lang, phrase): built on the cluster in 1,024 stretches, 4 MB in all."""
        code = phrase_hash(F.split("phrase", " "))
        # Spark's bitmaps count from 1.
        slots = F.array(code.bitwiseAND(F.lit(_SLOT)) + 1, F.shiftright(code, _BITS).bitwiseAND(F.lit(_SLOT)) + 1)
        found = phrases.select(F.explode(slots).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("k")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
        )
        bits = np.zeros((1 << _BITS) // 8, np.uint8)
        for k, part in found.collect():
            at = (k - 1) * 4096
            bits[at : at + 4096] |= np.frombuffer(part, np.uint8)
        return Marks(bits)

    def __or__(self, other: "Marks") -> "Marks":
        return Marks(self.bits | other.bits)

    def has(self, code: np.ndarray) -> np.ndarray:
        code = code.view(np.int64)
        found = np.ones(len(code), bool)
        for slot in (code & _SLOT, (code >> _BITS) & _SLOT):
            found &= (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return found


def text_hash(text: str) -> int:
    """Spark's xxhash64 of a string, unsigned."""
    return xxhash.xxh64_intdigest(text, _SEED)


def split_words(texts: list[str], kind: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(words in lower case of A-Z, coded; where in the joined bytes each begins; kind of every byte).

    ``kind`` of a byte is 0 within words; texts are joined by a line end, which must be of another kind.
    """
    data = LOWER[np.frombuffer("\n".join(texts).encode(), np.uint8)]
    kinds = kind[data]
    inside = kinds == 0
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    begin, sizes = edges[::2], edges[1::2] - edges[::2]
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    words = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    return words.dictionary_encode(), begin, kinds
