"""Similarity join of documents on word shingles, with Bayesian pruning of candidates.

Copies first collapse: texts of one shingle set are one *node*, found by a 128-bit digest. Then

1. nodes that share a band of MinHash values are candidates. With 32 bands of 3 values a pair at the
   threshold of 0.8 is missed with a probability of 5e-10;
2. MinHash values of a candidate pair are compared a few at a time. After n values of which m agree,
   the posterior probability (uniform prior) that the similarity reaches the threshold is
   P(Binomial(n + 1, threshold) <= m); a pair for which it falls below ``tolerance`` is dropped;
3. what is left binds nodes to families, and within a family all pairs that pass the same pruning are
   verified exactly on their shingle sets.

No task holds an unbounded group: a band or family of many nodes is cut into blocks, and each pair of
blocks is a group. A group emits no pairs, only the number of links of each node and a spanning
forest of the links, so output grows with the nodes and not with the square of a family.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import components, picked, released, slices, spread_join, stored, tasks
from payscope.llm.hashing import LOWER, mixed, window_hashes, word_hashes

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-9
BANDS, BAND_ROWS, STEP = 32, 3, 16
VALUES = BANDS * BAND_ROWS
BAND_BLOCK, FAMILY_BLOCK = 1024, 256
SLICE_BYTES, PAIRS = 1 << 19, 200_000
_RANDOM = np.random.default_rng(7)
_FLIPS = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes; a text of fewer words than a shingle has one shingle,
    a text without words none. Words are runs without white space, A-Z in lower case."""
    words, first = word_hashes(texts, LOWER)
    rolled = window_hashes(words, WORDS)
    found = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            found.append(np.unique(rolled[a : b - WORDS + 1]))
        else:
            found.append(window_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return found


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty sets, a row each."""
    flat = np.concatenate(sets)
    begin = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), VALUES), "<u4")
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((flat ^ _FLIPS[k]) * _FACTORS[k] >> np.uint64(32), begin)
    return out


@cache
def least_agreeing(n: int, threshold: float, tolerance: float) -> int:
    """Fewest agreeing values of n for which the posterior still reaches the tolerance."""
    below = 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n + 1


def surviving(
    values: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, tolerance: float
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j) of rows that incremental comparison does not drop."""
    agree = np.zeros(len(i), np.int32)
    for n in range(0, VALUES, STEP):
        agree += (values[i, n : n + STEP] == values[j, n : n + STEP]).sum(1)
        keep = agree >= least_agreeing(min(n + STEP, VALUES), threshold, tolerance)
        i, j, agree = i[keep], j[keep], agree[keep]
    return i, j


def _group_pairs(group: np.ndarray, block: np.ndarray, crossed: np.ndarray):
    """Pairs within equal neighbours of ``group``; of two blocks where ``crossed``. In pieces."""
    held, size = [], 0
    for d in range(1, len(group)):
        i = np.flatnonzero(group[:-d] == group[d:])
        if not len(i):
            break
        i = i[~crossed[i] | (block[i] != block[i + d])]
        held.append((i, i + d))
        size += len(i)
        if size >= PAIRS:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held, size = [], 0
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, least row of its component) for the rows that links bind to a lower row."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            break
    bound = np.flatnonzero(root < np.arange(n))
    return bound, root[bound]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows of equal ``keys``, with a group number per row; rows come sorted."""

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            column = table.column(key).combine_chunks()
            if pa.types.is_binary(column.type):
                column = column.dictionary_encode().indices
            column = column.to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
        return np.cumsum(new)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        group = numbered(table)
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield table.slice(0, cut), group[:cut]
        held = table.slice(cut).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, numbered(table)


def _prints(with_set: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets([t.encode() for t in part.column("text").to_pylist()])
            full = [s for s in sets if len(s)]
            values = iter(signatures(full) if full else [])
            columns = [
                part.column("doc_id"),
                pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([next(values).tobytes() if len(s) else b"" for s in sets], pa.binary()),
            ]
            names = ["doc_id", "node", "n_shingles", "signature"]
            if with_set:
                columns += [part.column("root"), part.column("members"), part.column("wanted")]
                columns.append(pa.array([s.tobytes() for s in sets], pa.binary()))
                names += ["root", "members", "wanted", "shingles"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return released(run)


def _signatures_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, VALUES)


@released
def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = _signatures_of(batch.column("signature")).reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
        key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
        for row in range(BAND_ROWS):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + values[:, :, row])
        at = np.repeat(np.arange(batch.num_rows), BANDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.reshape(-1).view(np.int64)), batch.column("node").take(pa.array(at))],
            names=["key", "node"],
        )


def _in_blocks(members: DataFrame, size: str, block_rows: int) -> DataFrame:
    """Adds (low, high, block): a member of a group of many blocks is in every pair with its own."""
    blocks = F.ceil(F.col(size) / block_rows).cast("int")
    own = members.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    return own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    ).drop("blocks", "other", size)


def _groups(members: DataFrame, key: str) -> DataFrame:
    keys = [key, "low", "high"]
    return members.repartition(tasks(members.sparkSession), *keys).sortWithinPartitions(*keys, "node")


def _linked(key: str, threshold: float, tolerance: float, exact: bool):
    """Rows (a, b, links): b null: a has so many links in this group; else a and b are bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _runs(batches, [key, "low", "high"]):
            values = _signatures_of(table.column("signature"))
            crossed = (table.column("low").to_numpy() != table.column("high").to_numpy())
            block = table.column("block").to_numpy()
            links, kept = np.zeros(table.num_rows, np.int64), []
            counts = _intersections(table, group) if exact else None
            copies = table.column("copies").to_numpy() if exact else None
            for i, j in _group_pairs(group, block, crossed):
                i, j = surviving(values, i, j, threshold, tolerance)
                if exact:
                    linked = counts(i, j, threshold)
                    i, j = i[linked], j[linked]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                kept.append(_forest(table.num_rows, i, j))
            if kept:  # a forest of the forests' edges
                i, j = (np.concatenate(x) for x in zip(*kept))
                i, j = _forest(table.num_rows, i, j)
            else:
                i = j = np.zeros(0, np.int64)
            some = np.flatnonzero(links)
            node = table.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([node.take(pa.array(i)), node.take(pa.array(some))]),
                    pa.concat_arrays([node.take(pa.array(j)), pa.nulls(len(some), pa.binary())]),
                    pa.array(np.concatenate([np.zeros(len(i), np.int64), links[some]])),
                ],
                names=["a", "b", "links"],
            )

    return released(run)


def _intersections(table: pa.Table, group: np.ndarray):
    """A test of pairs (i, j): is their exact similarity at least the threshold?"""
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    begins = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    dense: dict[int, np.ndarray] = {}

    def matrix(number: int) -> np.ndarray:
        """Common shingles of all rows of a group, a stretch of shingles at a time."""
        if number not in dense:
            dense.clear()
            rows = sets[begins[number] : begins[number + 1]]
            _, code, n = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            shared = n[code] > 1
            row, code = row[shared], (np.cumsum(n > 1) - 1)[code[shared]]
            order = np.argsort(code, kind="stable")
            row, code = row[order], code[order]
            found = np.zeros((len(rows), len(rows)), np.float32)
            for low in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
                a, b = np.searchsorted(code, [low, low + 4096])
                part = np.zeros((len(rows), 4096), np.float32)
                part[row[a:b], code[a:b] - low] = 1
                found += part @ part.T
            dense[number] = found
        return dense[number]

    def test(i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
        common = np.zeros(len(i), np.int64)
        for number in np.unique(group[i]):
            at = np.flatnonzero(group[i] == number)
            begin = begins[number]
            if begins[number + 1] - begin > 8:
                common[at] = matrix(number)[i[at] - begin, j[at] - begin].round()
            else:
                common[at] = [len(np.intersect1d(sets[x], sets[y], True)) for x, y in zip(i[at], j[at])]
        # Similarity as a quotient of whole numbers, a millionth part of a shingle aside.
        return common + 1e-6 >= threshold * (sizes[i] + sizes[j] - common)

    return test


def near_join(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, class_id, n_links, copies for every row.

    ``n_links`` is the number of other rows whose shingle set has a Jaccard similarity of at least
    ``threshold`` with the row's, copies among them; ``copies`` the number of rows of the same set
    (the row itself included); ``class_id`` the least id that links lead to. Texts without words (null
    ones too) link to nothing: class_id is their own id, copies 1. A null id counts as any other row
    but is a class_id only where the class has no id. Other columns are ignored.
    """
    docs = picked(docs, id_col, text_col)
    schema = "doc_id long, node binary, n_shingles int, signature binary"
    prints = stored(docs.mapInArrow(_prints(False), schema), "prints")
    nodes = stored(
        prints.where("n_shingles > 0").groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"),
            F.first("signature").alias("signature"),
        ),
        "nodes",
    )
    bands = nodes.mapInArrow(_band_keys, "key long, node binary")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = stored(bands.join(shared, "key"), "band-members")
    in_bands = _in_blocks(members, "members", BAND_BLOCK).join(nodes.select("node", "signature"), "node")
    links = "a binary, b binary, links long"
    bound = stored(
        _groups(in_bands, "key").mapInArrow(_linked("key", threshold, tolerance, False), links)
        .select("a", "b").distinct(),
        "candidates",
    )
    families = components(bound, "families").select("node", F.col("root"))
    sizes = families.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    wanted = families.join(sizes, "root").join(nodes.select("node", "first_id", "copies"), "node")
    # One text for each node of a family. Rows of one id may differ: the digest tells which is meant.
    texts = docs.join(
        wanted.select("first_id", "root", "members", F.struct("node", "copies").alias("wanted")),
        F.col("doc_id").eqNullSafe(F.col("first_id")),
    ).select("doc_id", "text", "root", "members", "wanted")
    sets = stored(
        texts.mapInArrow(
            _prints(True),
            f"{schema}, root binary, members long, wanted struct<node: binary, copies: long>, shingles binary",
        ).where("node = wanted.node").dropDuplicates(["node"])
        .select("node", "root", "members", "signature", "shingles", F.col("wanted.copies").alias("copies")),
        "family-sets",
    )
    found = stored(
        _groups(_in_blocks(sets, "members", FAMILY_BLOCK), "root")
        .mapInArrow(_linked("root", threshold, tolerance, True), links),
        "links",
    )
    classes = components(found.where("b IS NOT NULL").select("a", "b"), "classes")
    per_node = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    placed = (
        nodes.select("node", "copies", "first_id").join(classes, "node", "left")
        .join(per_node.withColumnRenamed("a", "node"), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = placed.groupBy("root").agg(F.min("first_id").alias("class_id"))
    known = stored(
        placed.join(least, "root").select(
            "node", "class_id", "copies",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "node-classes",
    )
    rows = prints.select("doc_id", F.when(F.col("n_shingles") > 0, F.col("node"))
                         .otherwise(F.concat(F.lit(b"-"), F.xxhash64("doc_id").cast("string").cast("binary"))).alias("node"))
    met = spread_join(rows, known, ["node"], "copies", F.col("doc_id"))
    return met.select(
        "doc_id", F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("copies"),
    )
