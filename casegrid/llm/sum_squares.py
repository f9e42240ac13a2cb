"""Sum-of-squares packing of documents into token sequences.

The gap of an open sequence is the number of tokens that it still takes.  With
``N(g)`` open sequences of gap ``g``, a piece goes where the sum of all
``N(g) ** 2`` is smallest afterwards: into an open sequence of some gap, or into
a new one.  So gaps of all sizes stay about, and almost every sequence gets
filled to the last token.

Documents become token ids in tasks and are written once with their lengths.
Only narrow rows (key, length, checksum) are dealt out, by hash, to groups of about
``GROUP_TOKENS`` tokens: few enough for one task, many enough that the one
sequence or two that a group leaves unfilled do not count.  A group takes its
pieces in hash order, ``BATCH`` at a time in descending length; open sequences
carry over from batch to batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import gathered, keyed
from casegrid.session import materialise

CAPACITY, END_ID = 4096, 1
#: Tokens and pieces of a group, at most about.
GROUP_TOKENS, GROUP_PIECES = 8 << 20, 1 << 20
BATCH = 4096
#: Text that is turned into ids at a time.
TEXT_BYTES = 20 << 20


class OpenSequences:
    """The open sequences by gap, and the rule that picks one."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)  # N(g); N(0) stays zero
        self.at: dict[int, list[int]] = {}
        self.made = 0

    def gap_for(self, n: int) -> int:
        """The gap to put ``n`` tokens into; the capacity means a new
        sequence.  Ties: an open sequence first, then the smallest gap."""
        count, full = self.count, self.capacity
        gaps = np.flatnonzero(count[n:full]) + n
        new = 2 * count[full - n] + 1 if n < full else 0
        if not len(gaps):
            return full
        # (N(g) - 1)^2 - N(g)^2 = 1 - 2 N(g);  (N(h) + 1)^2 - N(h)^2 = 1 + 2 N(h), and 0 for h = 0
        change = 1 - 2 * count[gaps] + np.where(gaps > n, 1 + 2 * count[gaps - n], 0)
        best = int(change.argmin())
        return int(gaps[best]) if change[best] <= new else full

    def put(self, n: int) -> tuple[int, int]:
        """``(sequence, offset)`` of a piece of ``n`` tokens."""
        gap = self.gap_for(n)
        if gap == self.capacity:
            sequence = self.made
            self.made += 1
        else:
            sequence = self.at[gap].pop()
            self.count[gap] -= 1
        if gap > n:
            self.at.setdefault(gap - n, []).append(sequence)
            self.count[gap - n] += 1
        return sequence, self.capacity - gap


def pack(lengths: list[int], capacity: int = CAPACITY, into: OpenSequences | None = None) -> list[tuple[int, int]]:
    """``(sequence, offset)`` per piece; pieces are placed in descending length."""
    into = into or OpenSequences(capacity)
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        out[i] = into.put(lengths[i])
    return out


_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, ids_of: Callable[[list[bytes]], list[np.ndarray]], end_id: int | None,
                 capacity: int, with_ids: bool) -> DataFrame:
    """``(row, doc_id, piece, start, length, ids_crc32[, ids])``: documents as
    ids, cut where they are longer than a sequence; ``row`` is unique."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 40, 0
        names = [x.split()[0] for x in _PIECES.split(", ")] + ["ids"] * with_ids
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for some, texts in gathered(batches, TEXT_BYTES):
            for doc, ids in zip(some, ids_of(texts)):
                ids = (ids if end_id is None else np.append(ids, end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity].tobytes()
                    rows.append((base + made, doc, piece, start, len(part) // 4, zlib.crc32(part))
                                + (part,) * with_ids)
                    made += 1
                    if len(rows) == 4096:
                        yield batch()
        if rows:
            yield batch()

    rows = keyed(docs).select("id", F.col("row.text").cast("string").alias("text"))
    return rows.mapInArrow(run, _PIECES + ", ids binary" * with_ids)


def sum_of_squares_packed(docs: DataFrame, ids_of: Callable[[list[bytes]], list[np.ndarray]],
                          end_id: int | None = END_ID, capacity: int = CAPACITY,
                          group_tokens: int = GROUP_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``, and with ``with_ids`` also ``ids``, little-endian
    unsigned 32-bit numbers.

    Defined cases: a null or empty text has the end id alone (no row where
    there is no end id); a very long text is cut into pieces of ``capacity``
    and a rest, each packed like a document; of equal lengths any may come
    first, by hash; rows that repeat are packed as often as they occur; a null
    doc_id stays null; extra columns are not read; an empty table gives no
    rows.
    """
    pieces = materialise(token_pieces(docs, ids_of, end_id, capacity, with_ids), "pieces")
    total, many = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(-(-total // group_tokens), -(-many // GROUP_PIECES), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, into = TaskContext.get().partitionId() << 32, OpenSequences(capacity)
        held: list[pa.RecordBatch] = []

        def placed() -> pa.RecordBatch:
            some = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            at = pack(some.column("length").to_pylist(), capacity, into)
            for name, x in (("sequence_id", [base + s for s, _ in at]), ("offset", [o for _, o in at])):
                some = some.append_column(name, pa.array(x, pa.int64()))
            return some.to_batches()[0]

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= BATCH:
                yield placed()
        if sum(x.num_rows for x in held):
            yield placed()

    narrow = pieces.select(*[x.split()[0] for x in _PIECES.split(", ")])
    dealt = narrow.repartition(groups, "row").sortWithinPartitions(F.xxhash64("row"), "row")
    out = dealt.mapInArrow(run, _PIECES + ", sequence_id long, offset long")
    if with_ids:
        out = out.join(pieces.select("row", "ids"), "row")
    return out.drop("row")
