"""Cost-balanced packing of documents into token sequences.

A piece of ``n`` tokens costs ``n + n * n / EQUAL`` (linear work plus attention
inside the piece).  Documents are dealt in descending length, each to the
sequence of lowest cost so far that still has room for it.  What fits nowhere
whole is cut and fills the rooms that are left.

Work is done in groups of about ``GROUP_TOKENS`` tokens, taken in turn from a
task's rows: no shuffle, bounded memory, and a task that runs again on the same
rows gives the same sequences.  A document of a full sequence or more fills
whole sequences first.  A group of ``t`` tokens has ``t // capacity`` sequences
of full capacity; the rest goes to sequences of a power of two of tokens, one
per binary digit of the rest, so nothing is padded.
"""

from __future__ import annotations

import heapq

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import gathered, keyed

CAPACITY, GROUP_TOKENS, EQUAL = 2048, 1 << 20, 4096
END_ID = 1
#: Text that is turned into ids at a time.
TEXT_BYTES = 20 << 20


def cost(n: int) -> float:
    return n + n * n / EQUAL


def room_sizes(total: int, capacity: int) -> list[int]:
    """Sequence sizes that ``total`` tokens fill exactly."""
    rest = total % capacity
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [capacity] * (total // capacity) + tail


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)`` for one group."""
    out: list[list[tuple[int, int, int]]] = []
    rest = []
    for d, n in enumerate(lengths):
        whole = n // capacity * capacity
        out += [[(d, s, capacity)] for s in range(0, whole, capacity)]
        if n > whole:
            rest.append((n - whole, d, whole))
    rest.sort(key=lambda x: (-x[0], x[1]))
    room = room_sizes(sum(x[0] for x in rest), capacity)
    made: list[list] = [[] for _ in room]
    heap = [(0.0, s) for s in range(len(room))]
    left, spent = room[:], [0.0] * len(room)

    def put(s: int, d: int, start: int, n: int) -> None:
        made[s].append((d, start, n))
        left[s] -= n
        spent[s] += cost(n)
        if left[s]:
            heapq.heappush(heap, (spent[s], s))

    over, widest = [], capacity
    for n, d, start in rest:
        if n > widest:  # rooms only shrink, and so does n
            over.append((n, d, start))
            continue
        passed = []
        while heap and left[heap[0][1]] < n:
            passed.append(heapq.heappop(heap))
        if heap:
            put(heapq.heappop(heap)[1], d, start, n)
        else:
            over.append((n, d, start))
            widest = max((left[s] for _, s in passed), default=0)
        for x in passed:
            heapq.heappush(heap, x)
    for n, d, start in over:
        while n:
            s = heapq.heappop(heap)[1]
            k = min(n, left[s])
            put(s, d, start, k)
            start, n = start + k, n - k
    return out + made


def cost_packed(docs: DataFrame, ids_of: Callable[[list[bytes]], list[np.ndarray]], end_id: int | None = END_ID,
                capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens,
    sequence_id, offset``; ``ids`` are the piece's ids as little-endian
    unsigned 32-bit numbers.

    Defined cases: a null or empty text has the end id alone (no row where
    there is no end id); rows that repeat are packed as often as they occur; a
    null doc_id stays null; an empty table gives no rows.
    """
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        tokens = 0

        def flush():
            nonlocal held, tokens, made
            rows = []
            for seq in pack([len(t) for _, t in held], capacity):
                offset = 0
                for d, start, n in seq:
                    doc, ids = held[d]
                    rows.append((doc, start, n, ids[start:start + n].astype("<u4").tobytes(), len(ids),
                                 (part << 32) + made, offset))
                    offset += n
                made += 1
            held, tokens = [], 0
            for k in range(0, len(rows), 4096):
                cols = list(zip(*rows[k:k + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if x == "ids" else pa.int64()) for x, c in zip(names, cols)], names)

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
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                "sequence_id long, offset long")


