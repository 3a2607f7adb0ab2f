"""Token ids packed into rows of fixed length by best-fit-decreasing, as binary matrices."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_by_value

ship_by_value(__name__)

# Fixed value: how a byte-level vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(spark: SparkSession, path: str, max_bytes: int = 64 << 20) -> bytes:
    """The lines of a rank file, read by Spark, so that any store will do; refused beyond ``max_bytes``."""
    row = spark.read.format("binaryFile").load(path).where(F.col("length") <= max_bytes).select("content").first()
    if row is None:
        raise ValueError(f"no vocabulary of at most {max_bytes} bytes at {path}")
    return bytes(row.content)


def encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


class Rooms:
    """Open rows by free capacity; a segment tree over capacities finds the least one that is enough."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.open: list[list[int]] = [[] for _ in range(most + 1)]
        self.tree = [0] * (2 * self.size)  # rows below each node

    def _add(self, capacity: int, n: int) -> None:
        at = capacity + self.size
        while at:
            self.tree[at] += n
            at >>= 1

    def put(self, capacity: int, row: int) -> None:
        if capacity:
            self.open[capacity].append(row)
            self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, row) of the tightest row with at least ``least`` free, the earliest freed one first."""
        at = least + self.size
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at *= 2
                if not self.tree[at]:
                    at += 1
        capacity = at - self.size
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Rows of positions in ``lengths``: longest first, each into the fullest row that still has room."""
    rows: list[list[int]] = []
    rooms = Rooms(most)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = rooms.take(lengths[i])
        capacity, row = found or (most, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(i)
        rooms.put(capacity - lengths[i], row)
    return rows


def pack(
    docs: DataFrame, ranks: bytes, key: str = "doc_id", text: str = "text", width: int = 2048, end_id: int = 50256,
    pad_id: int = 50256, buffer_tokens: int = 8 << 20, pattern: str = PATTERN,
) -> DataFrame:
    """Packed rows: ``pack_id, doc_ids, pieces, cu_seqlens, n_tokens, ids, positions``.

    Every document is encoded whole and closed by ``end_id``, so an empty or null text is one token. Documents
    longer than ``width`` are split into numbered pieces without loss. Pieces are packed by
    best-fit-decreasing within a buffer of ``buffer_tokens`` of an input partition, without a shuffle; a row
    is ``width`` little-endian numbers (two bytes if all ids fit, else four), padded by ``pad_id``.
    ``cu_seqlens`` are the cumulative segment lengths from 0, ``positions`` count from 0 in each segment and in
    the padding. ``pack_id`` is the input partition and the row's number in it. An empty table has no rows.
    """
    kind = docs.schema[key].dataType
    wide = max([end_id, pad_id, *(int(r.split()[1]) for r in ranks.splitlines())]) > 0xFFFF
    dtype = np.dtype("<u4" if wide else "<u2")

    def made(keys: list, pieces: list[int], parts: list[np.ndarray], first: int, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        rows = best_fit([len(p) for p in parts], width)
        for at in range(0, len(rows), 512):
            some = rows[at : at + 512]
            ids = np.full((len(some), width), pad_id, dtype)
            places = np.empty((len(some), width), dtype)
            ends = []
            for r, row in enumerate(some):
                edges = np.cumsum([0, *(len(parts[i]) for i in row)])
                for i, a in zip(row, edges.tolist(), strict=False):
                    ids[r, a : a + len(parts[i])] = parts[i]
                starts = np.repeat(edges, np.diff(np.append(edges, width)))
                places[r] = np.arange(width) - starts
                ends.append(edges.tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(first + at, first + at + len(some)), pa.int64()),
                    pa.array([[keys[i] for i in row] for row in some], pa.list_(key_type)),
                    pa.array([[pieces[i] for i in row] for row in some], pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())), pa.array([e[-1] for e in ends], pa.int32()),
                    pa.array([r.tobytes() for r in ids], pa.binary()), pa.array([r.tobytes() for r in places], pa.binary()),
                ],
                ["pack_id", "doc_ids", "pieces", "cu_seqlens", "n_tokens", "ids", "positions"],
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern).encode_ordinary
        keys: list = []
        pieces: list[int] = []
        parts: list[np.ndarray] = []
        held, first, key_type = 0, TaskContext.get().partitionId() << 33, None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(value.as_py() or ""), end_id], dtype)
                for n, a in enumerate(range(0, len(ids), width)):
                    keys.append(k)
                    pieces.append(n)
                    parts.append(ids[a : a + width])
                held += len(ids)
                if held >= buffer_tokens:
                    for out in made(keys, pieces, parts, first, key_type):
                        first += out.num_rows
                        yield out
                    keys, pieces, parts, held = [], [], [], 0
        if parts:
            yield from made(keys, pieces, parts, first, key_type)

    schema = f"pack_id long, doc_ids array<{kind.simpleString()}>, pieces array<int>, cu_seqlens array<int>, n_tokens int, ids binary, positions binary"
    return docs.select(key, text).mapInArrow(work, schema)
