"""Stretches of symbols (bytes, words) that occur more than once in a corpus.

A *window* is ``n`` consecutive symbols of one document. Each window has an *anchor*: the place of the
least rolling hash among its first ``pick`` places. Equal windows have their anchors at equal places, so
windows meet through their anchors, of which there are about two in ``pick`` symbols:

* an anchor's *core* are the ``n - pick + 1`` symbols from it on, which lie in each of its windows;
* its *phrase* is all that its windows cover.

Rows go from task to task as packed arrays, by the hash of the core. A task first settles what recurs
among its own rows and sends one row for each, so a stretch in a third of all documents sends one row
per task, not one per document. Texts are read in *slices* of about a megabyte, which are found again
by the id of their first row; texts that must meet their findings travel as compressed slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import picked, released, slices, stored, tasks
from payscope.llm.hashing import Prefix, Rough, mixed

SLICE_BYTES = 1 << 20
FLUSH_ITEMS, FLUSH_DOCS = 1 << 19, 60_000
# What a packed item can number: documents, and window starts of one anchor, which are fewer than the width.
MOST_DOCS, MOST_WIDTH = 1 << 16, 1 << 16
MARK, OPEN = 0, 1
FOUND = "kind byte, slice long, doc int, begin int, stop int, core long"
PACKED = "bucket int, docs binary, items binary, found binary"
_FOUND = np.dtype([("kind", "i1"), ("slice", "i8"), ("doc", "i4"), ("begin", "i4"), ("stop", "i4"), ("core", "u8")])
_ITEM = np.dtype([("core", "u8"), ("key", "u8"), ("doc", "u2"), ("begin", "u4"), ("span", "u2")])
Symbols = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and the row's number, which is the same each time a stored table is read."""
    return picked(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())


def texts_of(part: pa.RecordBatch) -> list[bytes]:
    return [t.encode() for t in part.column("text").to_pylist()]


def anchored(symbols: np.ndarray, begins: np.ndarray, n: int, pick: int, gram: int):
    """(first window start, last window start, core hash, phrase hash) of every anchor in order."""
    counts = np.maximum(np.diff(begins) - n + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    starts = np.arange(total) + np.repeat(begins[:-1] - np.cumsum(counts) + counts, counts)
    prefix = Prefix(symbols)
    at = np.arange(len(symbols) - gram + 1)
    bits = np.uint64(len(symbols).bit_length())
    # The place in the low bits: of equal hashes the first wins.
    least = Rough(symbols).hashes(at, at + gram) >> bits << bits | at.astype(np.uint64)
    width = 1
    while 2 * width <= pick:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < pick:
        least = np.minimum(least[: len(least) - (pick - width)], least[pick - width :])
    anchor = (least[starts] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(first[1:], total) - 1
    a, b, t = starts[first], starts[last], anchor[first]
    return a, b, prefix.hashes(t, t + n - pick + 1), prefix.hashes(a, b + n)


def _packed_docs(docs: list[tuple[int, int, int]]) -> bytes:
    """(slice, number in it, id) of documents as differences, which compress well."""
    table = np.array(docs, np.int64).reshape(-1, 3)
    return np.diff(table, axis=0, prepend=np.zeros((1, 3), np.int64)).T.tobytes()


def _unpacked_docs(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.int64).reshape(3, -1), 1)


class Settling:
    """What a set of items decides: which are repeated (or not the first), and which go on.

    ``core`` and ``key`` together repeat (equal stretches have equal cores); ``first_stays``: the earliest of equal keys is not marked itself. ``width``: symbols
    that a start marks. ``opens``: findings are starts to look into, not marks.
    """

    def __init__(self, first_stays: bool, width: int, opens: bool) -> None:
        self.first_stays, self.width, self.opens = first_stays, width, opens

    def __call__(self, items: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of findings, positions of one item for each key, the earliest)."""
        order = np.lexsort((items["begin"], rank[items["doc"]], items["core"], items["key"]))
        key, core = items["key"][order], items["core"][order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (core[1:] != core[:-1])
        hit = ~new
        if not self.first_stays:
            hit[:-1] |= hit[1:]
        return order[hit], order[new]


def _findings(items: np.ndarray, docs: np.ndarray, kind: int, extra: int) -> np.ndarray:
    """Items as findings; neighbours that overlap become one where they are marks."""
    found = np.zeros(len(items), _FOUND)
    found["kind"], found["core"] = kind, items["core"]
    found["slice"], found["doc"] = docs[0][items["doc"]], docs[1][items["doc"]]
    found["begin"] = items["begin"]
    found["stop"] = items["begin"].astype(np.int64) + items["span"] + extra
    if kind == MARK and len(found):
        found = found[np.lexsort((found["begin"], found["doc"], found["slice"]))]
        reach = found["stop"]  # of equal widths but for spans: a later start ends later
        new = np.ones(len(found), bool)
        new[1:] = (
            (found["slice"][1:] != found["slice"][:-1]) | (found["doc"][1:] != found["doc"][:-1])
            | (found["begin"][1:] > reach[:-1])
        )
        first = np.flatnonzero(new)
        stop = np.maximum.reduceat(reach, first)
        found = found[first]
        found["stop"] = stop
    return found


def send(make: Callable, settle: Settling, buckets: int):
    """A task of packed rows. ``make(part)`` gives for a batch (docs, items) with items by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs = [], []

        def flush():
            items = np.concatenate(held)
            table = np.array(docs, np.int64).reshape(-1, 3).T
            hits, ones = settle(items, _ranks(table))
            kind, extra = (OPEN, 0) if settle.opens else (MARK, settle.width)
            local = _findings(items[hits], table, kind, extra)
            items = items[ones]
            bucket = (items["core"] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            parts = np.split(items[order], cuts[1:]) if len(cuts) else []
            packed = _packed_docs(docs)
            numbers = bucket[order][cuts]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([*numbers, int(docs[0][0] % buckets)], pa.int32()),
                    "docs": pa.array([*[packed] * len(parts), b""], pa.binary()),
                    "items": pa.array([*[p.tobytes() for p in parts], b""], pa.binary()),
                    "found": pa.array([*[b""] * len(parts), local.tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            for new_docs, items in make(batch):
                if len(docs) + len(new_docs) > MOST_DOCS:
                    if docs:
                        yield from flush()
                    held, docs = [], []
                items["doc"] += len(docs)
                docs.extend(new_docs)
                held.append(items)
                if sum(map(len, held)) >= FLUSH_ITEMS or len(docs) >= FLUSH_DOCS:
                    yield from flush()
                    held, docs = [], []
        if docs:
            yield from flush()

    return released(run)


def _ranks(docs: np.ndarray) -> np.ndarray:
    """Place of each document in the order of id, then of rows; nulls (least number) first."""
    rank = np.empty(docs.shape[1], np.int64)
    rank[np.lexsort((docs[1], docs[0], docs[2]))] = np.arange(docs.shape[1])
    return rank


def receive(decide: Callable):
    """A task of whole buckets: ``decide(items, docs, rank)`` gives the findings of one bucket."""

    def settled(rows: list[dict]) -> pa.RecordBatch:
        found = [np.frombuffer(r["found"], _FOUND) for r in rows]
        rows = [r for r in rows if r["items"]]
        if rows:
            tables = [_unpacked_docs(r["docs"]) for r in rows]
            docs, where = np.unique(np.concatenate(tables, 1), axis=1, return_inverse=True)
            begins = np.cumsum([0, *[t.shape[1] for t in tables]])
            items = np.concatenate([np.frombuffer(r["items"], _ITEM) for r in rows])
            wide = np.zeros(len(items), [(k, "u4" if k == "doc" else _ITEM[k]) for k in _ITEM.names])
            for k in _ITEM.names:
                wide[k] = items[k]
            sizes = [len(r["items"]) // _ITEM.itemsize for r in rows]
            wide["doc"] = where.reshape(-1)[items["doc"] + np.repeat(begins[:-1], sizes)]
            found += decide(wide, docs, _ranks(docs))
        out = np.concatenate(found)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[k].astype("i8") if k == "core" else out[k]) for k in _FOUND.names], names=_FOUND.names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["bucket"] != bucket:
                    yield settled(rows)
                    rows = []
                bucket = row["bucket"]
                rows.append(row)
        if rows:
            yield settled(rows)

    return released(run)


def exchange(rows: DataFrame, decide: Callable, name: str) -> DataFrame:
    """Packed rows to their buckets, and the findings stored."""
    n = tasks(rows.sparkSession)
    by_bucket = rows.repartition(n, "bucket").sortWithinPartitions("bucket")
    return stored(by_bucket.mapInArrow(receive(decide), FOUND), name)


def _id(doc_id: int | None) -> int:
    return -(1 << 63) if doc_id is None else doc_id


def anchors_of(symbols: Symbols, n: int, pick: int, gram: int, key: str):
    """Items of all anchors of a batch; ``key`` is what must recur: core or phrase."""

    def make(batch: pa.RecordBatch):
        for part in slices([batch], "text", SLICE_BYTES):
            codes, begins = symbols(texts_of(part))
            a, b, core, phrase = anchored(codes, begins, n, pick, gram)
            doc = np.searchsorted(begins, a, "right") - 1
            items = np.zeros(len(a), _ITEM)
            items["core"], items["key"] = core, core if key == "core" else phrase
            items["doc"], items["begin"], items["span"] = doc, a - begins[doc], b - a
            head = part.column("row")[0].as_py()
            ids = part.column("doc_id").to_pylist()
            yield [(head, i, _id(d)) for i, d in enumerate(ids)], items

    return make


def starts_of(symbols: Symbols, n: int):
    """Items of all windows that start in a stretch left open."""

    def make(batch: pa.RecordBatch):
        for head, part, found in sliced(batch):
            codes, begins = symbols(texts_of(part))
            ids = part.column("doc_id").to_pylist()
            docs = [(head, i, _id(d)) for i, d in enumerate(ids)]
            spans = (found["stop"] - found["begin"] + 1).astype(np.int64)
            base = np.repeat(found["begin"].astype(np.int64) - np.cumsum(spans) + spans, spans)
            begin = np.arange(int(spans.sum())) + base
            doc = np.repeat(found["doc"].astype(np.int64), spans)
            at = begins[doc] + begin
            items = np.zeros(len(at), _ITEM)
            items["core"] = np.repeat(found["core"], spans)
            items["key"] = Prefix(codes).hashes(at, at + n) if len(at) else 0
            items["doc"], items["begin"] = doc, begin
            yield docs, items

    return make


@released
def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for part in slices(batches, "text", SLICE_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as out:
            out.write_batch(part)
        yield pa.RecordBatch.from_pydict({"slice": part.column("row").slice(0, 1), "texts": pa.array([pack(sink.getvalue())])})


def with_texts(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Compressed slices with their findings; a slice is a bounded text and so are its findings."""
    texts = rows.mapInArrow(_compressed, "slice long, texts binary")
    lists = found.groupBy("slice").agg(F.collect_list(F.struct("doc", "begin", "stop", "core")).alias("found"))
    return texts.join(lists, "slice", how)


def sliced(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(slice, its rows, its findings) for rows of ``with_texts``."""
    unpack = zstandard.ZstdDecompressor().decompress
    for k in range(batch.num_rows):
        found = batch.column("found")[k].values
        out = np.zeros(0 if found is None else len(found), _FOUND)
        if len(out):
            for name in ("doc", "begin", "stop"):
                out[name] = found.field(name).to_numpy()
            out["core"] = found.field("core").to_numpy().view("u8")
            # One stretch may have been found by its own task and again in its bucket.
            out = np.unique(out)
        for part in pa.ipc.open_stream(unpack(batch.column("texts")[k].as_py())):
            yield batch.column("slice")[k].as_py(), part, out


def covered(found: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Which symbols of a slice the marks cover."""
    change = np.zeros(int(begins[-1]) + 1, np.int64)
    np.add.at(change, begins[found["doc"]] + found["begin"], 1)
    np.add.at(change, begins[found["doc"]] + found["stop"], -1)
    return np.cumsum(change)[:-1] > 0


def finish(rows: DataFrame, marks: DataFrame, report: Callable, schema: str) -> DataFrame:
    """One row per document: ``report(texts, found)`` gives the columns after doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part, found in sliced(batch):
                columns = report(texts_of(part), found)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, columns.values())], names=["doc_id", *columns]
                )

    return with_texts(rows, marks, "left").mapInArrow(released(run), f"doc_id long, {schema}")


def settle_bucket(settle: Settling):
    def decide(items, docs, rank):
        hits, _ = settle(items, rank)
        kind, extra = (OPEN, 0) if settle.opens else (MARK, settle.width)
        return [_findings(items[hits], docs, kind, extra)]

    return decide
