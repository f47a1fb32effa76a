"""Token ids in files: frequency-ranked ids in a byte-aligned code with separate control bytes.

The most frequent id becomes 0, the next 1, and so on, so that most ids take one byte. A block of
documents is coded as two byte strings: *control*, two bits per id (its byte count less one, four
ids to a byte), and *data*, the bytes themselves, low byte first. Decoding looks every control byte
up in numpy tables of byte counts and byte places; no loop over ids runs in Python.

File format (Parquet, no further compression): ``blocks``, one row per block with shard, block,
first (ids of its shard before it), doc_ids, n_tokens, control, data; ``ranks``: rank, id, n.
Shards are ranges of the document order and each is written by one task, so a lost executor costs a
rerun of its shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm.common import picked, released, scratch, slices, stored, tasks
from payscope.llm.tokens import encoder

BLOCK_IDS = 1 << 18
# No other work of this operator takes memory in Python, so its cache may be larger.
SLICE_BYTES, CACHE_BYTES = 4 << 20, 120 << 20

# For each control byte: bytes of its four ids, and for each of 16 output bytes its place in the data
# of the group, counted from 1; bytes that are not stored point far before the zero that stands first.
_COUNTS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1
_TOTAL = _COUNTS.sum(1).astype(np.int32)
_BEGIN = np.cumsum(_COUNTS, 1) - _COUNTS
_PLACE = np.where(
    np.arange(4) < _COUNTS[:, :, None], _BEGIN[:, :, None] + np.arange(4) + 1, -(1 << 30)
).reshape(256, 16).astype(np.int32)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    sizes = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = sizes - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < sizes[:, None]]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values behind (control, data). Ids that pad the last control byte have no data."""
    codes = np.frombuffer(control, np.uint8)
    total = _TOTAL[codes]
    begin = np.cumsum(total, dtype=np.int32) - total
    # The padding of the last group points past the end: give it bytes to read.
    source = np.frombuffer(b"\0" + data + b"\0" * 16, np.uint8)
    place = _PLACE[codes]
    place += begin[:, None]
    return source[np.maximum(place, 0, out=place)].reshape(-1).view("<u4")[:n]


_BLOCKS = "shard int, block int, first long, doc_ids array<long>, n_tokens array<int>, {}"


def _id_blocks(tokenizer: str, blanks: bool, end_id: int, wide: bool):
    dtype = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer, blanks, CACHE_BYTES)
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        ids: list[pa.Array] = []
        waiting = 0

        def flush():
            nonlocal block, first, held, sizes, ids, waiting
            flat, doc_ids, n = np.concatenate(held), pa.concat_arrays(ids), np.concatenate(sizes)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), doc_ids),
                    pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.array(n, pa.int32())),
                    pa.array([flat.tobytes()], pa.binary()),
                ],
                names=["shard", "block", "first", "doc_ids", "n_tokens", "ids"],
            )
            block, first, held, sizes, ids, waiting = block + 1, first + len(flat), [], [], [], 0
            return row

        for part in slices(batches, "text", SLICE_BYTES):
            flat, begins = encode_texts(part.column("text"), end_id)
            held.append(flat.astype(dtype))
            sizes.append(np.diff(begins))
            ids.append(part.column("doc_id"))
            waiting += len(flat)
            if waiting >= BLOCK_IDS:
                yield flush()
        if held:
            yield flush()

    return released(run)


def _counts(dtype: str, n_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(np.frombuffer(ids.as_buffer(), dtype), minlength=n_ids)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": seen, "n": total[seen]})

    return released(run)


def _coded(dtype: str, rank_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [
                encode(rank_of[np.frombuffer(ids.as_buffer(), dtype)]) for ids in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *[pa.array([c[i] for c in codes], pa.binary()) for i in (0, 1)]],
                names=[*batch.schema.names[:5], "control", "data"],
            )

    return released(run)


def _decoded(id_of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["n_tokens"], np.int64)
                ends = np.cumsum(sizes)
                flat = id_of[decode(row["control"], row["data"], int(sizes.sum()))]
                flat = memoryview(flat.tobytes())
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([row["shard"]] * len(sizes), pa.int32()),
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "start": row["first"] + ends - sizes,
                        "n_tokens": sizes,
                        "ids_crc32": pa.array(
                            [zlib.crc32(flat[4 * (e - s) : 4 * e]) for e, s in zip(ends, sizes)],
                            pa.int64(),
                        ),
                        "n_bytes": pa.array(
                            [len(row["control"]) + len(row["data"])] * len(sizes), pa.int64()
                        ),
                    }
                )

    return released(run)


@dataclass(frozen=True)
class TokenFiles:
    blocks: str
    ranks: str


def write_token_files(
    docs: DataFrame, tokenizer: str, blanks: bool, end_id: int, n_ids: int,
    id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
) -> TokenFiles:
    """Encodes every whole text (null: empty), appends ``end_id``, and writes the files.

    Documents come in ascending order of id, null ids first; rows that share an id in order of a hash
    of their text. ``n_ids`` is the size of the vocabulary. An empty table gives files without rows.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token-files")
    wide = n_ids > 1 << 16
    order = ("doc_id", F.xxhash64("text"))
    ids = stored(
        picked(docs, id_col, text_col)
        .repartitionByRange(tasks(spark), *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_id_blocks(tokenizer, blanks, end_id, wide), _BLOCKS.format("ids binary")),
        "token-ids",
    )
    dtype = "<u4" if wide else "<u2"
    counted = ids.select("ids").mapInArrow(_counts(dtype, n_ids), "id long, n long")
    # At most one row per id of the vocabulary.
    counts = sorted(
        ((n, i) for i, n in counted.groupBy("id").agg(F.sum("n")).collect()), key=lambda x: (-x[0], x[1])
    )
    rank_of = np.zeros(n_ids, "<u4")
    rank_of[[i for _, i in counts]] = np.arange(len(counts), dtype="<u4")
    spark.createDataFrame(
        [(r, i, n) for r, (n, i) in enumerate(counts)], "rank int, id long, n long"
    ).coalesce(1).write.parquet(f"{folder}/ranks")
    (
        ids.mapInArrow(_coded(dtype, rank_of), _BLOCKS.format("control binary, data binary"))
        .write.option("compression", "none").parquet(f"{folder}/blocks")
    )
    return TokenFiles(f"{folder}/blocks", f"{folder}/ranks")


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, shard, all taken from the decoded files."""
    ranks = spark.read.parquet(files.ranks).orderBy("rank").collect()  # bounded by the vocabulary
    id_of = np.array([r["id"] for r in ranks] or [0], "<u4")
    blocks = spark.read.schema(_BLOCKS.format("control binary, data binary")).parquet(files.blocks)
    # One row per shard, of which there are as many as the session has shuffle partitions.
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = blocks.select("shard", size.alias("n")).groupBy("shard").agg(F.sum("n")).collect()
    offsets, before = [], 0
    for shard, n in sorted(totals):
        offsets.append((shard, before))
        before += n
    begins = spark.createDataFrame(offsets, "shard int, before long")
    rows = blocks.mapInArrow(
        _decoded(id_of),
        "shard int, doc_id long, start long, n_tokens long, ids_crc32 long, n_bytes long",
    )
    return rows.join(F.broadcast(begins), "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )
