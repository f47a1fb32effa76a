"""Best-fit packing of documents into sequences, after a reduction by dominance.

Only sizes matter to the packing, and there are fewer sizes than ``capacity``; so the instance is its
histogram, at most ``capacity`` counts at any scale, and is solved on the driver:

1. *Reduction* (Martello and Toth): going down the sizes, a set of at most three documents that
   provably dominates every other set with its largest member is fixed for good, as many copies of it
   as the counts allow, and the instance shrinks; again until nothing more can be fixed.
2. *Best fit, decreasing*, for what remains: each size goes where it leaves the least room.

Both give groups of equal sequences. The rows then find their places by themselves: each has a number
among the rows of its size (task, rank in its task), and ranges of numbers belong to groups.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from payscope.llm.common import picked, released, slices, stored
from payscope.llm.tokens import encoder

SLICE_BYTES = 2 << 20


@dataclass(frozen=True)
class Group:
    """``copies`` sequences that all hold these sizes: (size, how many)."""

    sizes: tuple[tuple[int, int], ...]
    copies: int


def _dominating(size: int, counts: Counter, capacity: int) -> tuple[int, ...] | None:
    """A set with ``size`` that dominates all other feasible sets with it, or None."""
    others = counts.copy()
    others[size] -= 1
    present = sorted(s for s, n in others.items() if n > 0)
    least = [s for s in present[:3] for _ in range(min(3, others[s]))][:3]
    room = capacity - size
    if not least or least[0] > room:
        return (size,)
    best = max(s for s in present if s <= room)
    if best == room or len(least) < 2 or least[0] + least[1] > room:
        return (size, best)
    if len(least) > 2 and sum(least) <= room:
        return None
    # At most two others fit. The heaviest pair, with two pointers over the sizes present.
    heaviest, low, high = 0, 0, len(present) - 1
    while low <= high:
        a, b = present[low], present[high]
        if a + b > room or (low == high and others[a] < 2):
            high -= 1
        else:
            heaviest, low = max(heaviest, a + b), low + 1
    if best >= heaviest:
        return (size, best)
    others[best] -= 1
    second = max((s for s in present if s <= room - best and others[s] > 0), default=0)
    others[best] += 1
    if second and second >= max((s for s in present if s <= room // 2), default=0):
        return (size, best, second)
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Group], Counter]:
    """(groups fixed for good, what remains)."""
    left, groups, changed = Counter({s: n for s, n in counts.items() if n}), [], True
    while changed:
        changed = False
        for size in sorted(left, reverse=True):
            while left[size] > 0 and (found := _dominating(size, left, capacity)):
                need = Counter(found)
                copies = min(left[s] // n for s, n in need.items())
                if copies < 1:
                    break
                groups.append(Group(tuple(need.items()), copies))
                for s, n in need.items():
                    left[s] -= n * copies
                changed = True
        left = +left
    return groups, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best fit over the sizes in falling order, many equal sequences at a time."""
    by_room: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n > 0:
            room = min((r for r, b in by_room.items() if r >= size and b), default=None)
            if room is None:
                sizes, copies, room = (), n, capacity
            else:
                sizes, copies = by_room[room].pop()
            each = min(room // size, n)
            used = min(copies, n // each)
            if room < capacity and copies > used:
                by_room[room].append((sizes, copies - used))
            by_room.setdefault(room - each * size, []).append(((*sizes, (size, each)), used))
            n -= each * used
    return [Group(sizes, copies) for found in by_room.values() for sizes, copies in found]


def plan(counts: dict[int, int], capacity: int) -> list[Group]:
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True)
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for part in slices(batches, "text", SLICE_BYTES):
            flat, begins = encode(part.column("text"), end_id)
            n = np.diff(begins)
            pieces = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            # The first piece takes what the full ones leave.
            start = np.maximum(n[doc] - (pieces[doc] - piece) * capacity, 0)
            length = n[doc] - (pieces[doc] - piece - 1) * capacity - start
            places = (begins[doc] + start).tolist()
            bytes_ = memoryview(flat.astype("<u4").tobytes())
            crc = [zlib.crc32(bytes_[4 * a : 4 * (a + b)]) for a, b in zip(places, length.tolist())]
            order = np.argsort(length, kind="stable")
            among = np.arange(len(length)) - np.searchsorted(length[order], length[order])
            rank = np.empty(len(length), np.int64)
            rank[order] = among + seen[length[order]]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task, np.int32)), pa.array(rank),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"],
            )

    return released(run)


def _places(groups: list[Group]) -> dict[int, np.ndarray]:
    """size -> rows (first number, first sequence, copies in a sequence, offset of the first copy)."""
    found: dict[int, list] = {}
    taken: Counter = Counter()
    sequence = 0
    for group in groups:
        offset = 0
        for size, each in group.sizes:
            found.setdefault(size, []).append((taken[size], sequence, each, offset))
            taken[size] += each * group.copies
            offset += size * each
        sequence += group.copies
    return {s: np.array(rows, np.int64).T for s, rows in found.items()}


def _placed(places: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            numbers = batch.column("number").to_numpy()
            sequences, offsets = np.zeros((2, len(lengths)), np.int64)
            for size in np.unique(lengths):
                at = np.flatnonzero(lengths == size)
                first, sequence, each, offset = places[int(size)]
                k = np.searchsorted(first, numbers[at], "right") - 1
                within = numbers[at] - first[k]
                sequences[at] = sequence[k] + within // each[k]
                offsets[at] = offset[k] + within % each[k] * size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequences), pa.array(offsets)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return released(run)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row for each piece.

    A document (null text: empty) is its ids and ``end_id``, so none is without a piece. Longer ones
    than ``capacity`` are cut, the first piece takes what the full ones leave. Each repeated row is
    packed for itself; null ids are kept; an empty table gives an empty result.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = stored(
        picked(docs, id_col, text_col).mapInArrow(
            _pieces(tokenizer, end_id, capacity), f"{schema}, task int, rank long"
        ),
        "pieces",
    )
    tally = stored(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "sizes")
    # Fewer rows than ``capacity``. A full piece is a sequence by itself.
    counts = {s: n for s, n in tally.groupBy("length").agg(F.sum("n")).collect()}
    full = counts.pop(capacity, 0)
    groups = plan(counts, capacity) + ([Group(((capacity, 1),), full)] if full else [])
    before = F.sum("n").over(
        W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    )
    numbered = pieces.join(
        tally.select("length", "task", F.coalesce(before, F.lit(0)).alias("before")), ["length", "task"]
    ).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank")).alias("number")
    )
    return numbered.mapInArrow(_placed(_places(groups)), f"{schema}, sequence_id long, offset long")
