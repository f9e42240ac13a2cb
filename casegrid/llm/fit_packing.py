"""Best-fit-decreasing packing into id matrices.

Documents become token ids; one longer than a sequence is split into pieces of
full length and a rest, and no id is lost.  Pieces in descending length each go
to the fullest sequence that still has room, found in a segment tree over the
capacities left; without one, to a new sequence.

A sequence is a row of the matrix: ``ids`` (padded), the cumulative lengths of
its segments, and positions that start again at zero in every segment.

Work is done in groups of about ``GROUP_TOKENS`` tokens of a task's rows: no
shuffle, bounded memory, the same sequences when a task runs again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm.common import gathered, keyed

CAPACITY, GROUP_TOKENS, PAD_ID = 2048, 1 << 20, 0
#: Text that is turned into ids at a time.
TEXT_BYTES = 1 << 20


class Rooms:
    """Sequences by capacity left; the least capacity of at least ``n`` is
    found by a walk down a segment tree of counts."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.at.setdefault(room, []).append(sequence)
        self._add(room, 1)

    def take(self, n: int) -> tuple[int, int] | None:
        """``(capacity left, sequence)`` of the tightest fit, taken out."""
        node = self.leaves + n
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.at[room].pop()


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)``."""
    pieces = [(min(capacity, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, capacity)]
    pieces.sort(key=lambda x: (-x[0], x[1], x[2]))
    rooms, out = Rooms(capacity), []
    for n, d, s in pieces:
        found = rooms.take(n)
        if found is None:
            found = capacity, len(out)
            out.append([])
        room, seq = found
        out[seq].append((d, s, n))
        if room > n:
            rooms.put(room - n, seq)
    return out


SCHEMA = ("sequence_id long, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, "
          "input_ids binary, position_ids binary")


def fit_packed(docs: DataFrame, ids_of: Callable[[list[bytes]], list[np.ndarray]], end_id: int | None,
               capacity: int = CAPACITY, pad_id: int = PAD_ID, group_tokens: int = GROUP_TOKENS,
               wide: bool = False) -> DataFrame:
    """One row per sequence.

    ``doc_ids`` and ``starts`` name the segments (``starts``: ids of the
    document before the segment); ``cu_seqlens`` has one number more than there
    are segments; ``input_ids`` and ``position_ids`` are rows of ``capacity``
    little-endian unsigned numbers of 16 bits (``wide``: ids of 32).

    Defined cases: a null or empty text is the end id alone (nothing where
    there is no end id); rows that repeat are packed as often as they occur; a
    null doc_id stays null; an empty table gives no rows.
    """
    dtype = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        tokens = 0

        def flush():
            nonlocal held, tokens, made
            sequences = best_fit([len(t) for _, t in held], capacity)
            for k in range(0, len(sequences), 256):
                rows = []
                for seq in sequences[k:k + 256]:
                    lengths = [n for _, _, n in seq]
                    bounds = np.concatenate(([0], np.cumsum(lengths)))
                    ids = np.full(capacity, pad_id, dtype)
                    ids[:bounds[-1]] = np.concatenate([held[d][1][s:s + n] for d, s, n in seq])
                    positions = np.zeros(capacity, "<u2")
                    positions[:bounds[-1]] = np.arange(bounds[-1]) - np.repeat(bounds[:-1], lengths)
                    rows.append(((part << 32) + made, int(bounds[-1]), [held[d][0] for d, _, _ in seq],
                                 [s for _, s, _ in seq], bounds.tolist(), ids.tobytes(), positions.tobytes()))
                    made += 1
                types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                         pa.list_(pa.int32()), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [
                    "sequence_id", "n_tokens", "doc_ids", "starts", "cu_seqlens", "input_ids", "position_ids"])
            held, tokens = [], 0

        for some, texts in gathered(batches, TEXT_BYTES):
            for doc, ids in zip(some, ids_of(texts)):
                ids = ids if end_id is None else np.append(ids, np.int32(end_id))
                if len(ids):
                    held.append((doc, ids))
                    tokens += len(ids)
                if tokens >= group_tokens:
                    yield from flush()
        yield from flush()

    rows = keyed(docs).select("id", F.col("row.text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def write_matrices(packed: DataFrame, path: str) -> None:
    """The sequences as Parquet files: a file's ``input_ids`` column, read in
    order, is an id matrix."""
    packed.write.mode("errorifexists").parquet(path)


def unpacked(spark: SparkSession, path: str, wide: bool = False) -> DataFrame:
    """``(doc_id, start, ids)`` segments of written matrices, ``ids`` as an
    array: the way back from matrices to documents."""
    dtype = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x in b.to_pylist():
                ids = np.frombuffer(x["input_ids"], dtype).astype(np.int32)
                rows += [(d, s, ids[a:e].tolist()) for d, s, a, e in zip(
                    x["doc_ids"], x["starts"], x["cu_seqlens"], x["cu_seqlens"][1:])]
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.list_(pa.int32()))], ["doc_id", "start", "ids"])

    return spark.read.parquet(path).select("doc_ids", "starts", "cu_seqlens", "input_ids").mapInArrow(
        run, "doc_id long, start long, ids array<int>")
