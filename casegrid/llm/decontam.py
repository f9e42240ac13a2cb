"""Benchmark decontamination by the q-gram lemma.

A region within edit distance ``e`` of an item of length ``m`` shares at least
``m - q + 1 - e * q`` q-grams with it, on diagonals (text position minus item
position) that spread over at most ``e + 1``.  Shared q-grams are counted in
overlapping bands of diagonals; a band that reaches the bound is a candidate,
and a banded alignment of the item against the region decides.

Texts and items are compared as UTF-8 bytes with A-Z lower-cased and white
space made single; the budget is ``RATE`` of an item's bytes, lowered for short
items as far as the lemma needs at least one shared q-gram.

The items are a stated query set: they go to the tasks in blocks of at most
``BLOCK_BYTES``, as they are, and a task builds a block's q-gram index (some 32
bytes per byte of its items).  Items shorter than a q-gram are matched exactly,
on word bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm.common import keyed, texts_of, unkeyed
from casegrid.session import materialise

Q, RATE = 10, 0.08
BLOCK_BYTES = 1 << 20
TABLE_BITS = 22
#: Bits of the table that holds the q-grams of all blocks.
WHOLE_BITS = 27
#: Pairs of a shared q-gram's places in text and items that are looked at together.
PART = 1 << 18
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def gram_keys(text: bytes) -> np.ndarray:
    """A 64-bit key of every q-gram: two mixed words of eight bytes."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text + bytes(8), np.uint8)
    words = np.empty(n + Q - 8, np.uint64)
    for k in range(8):  # the eight bytes from each position on
        part = raw[k:k + (len(words) - k + 7) // 8 * 8 + 8]
        whole = part[:len(part) // 8 * 8].view("<u8")
        words[k::8] = whole[:len(words[k::8])]
    return words[:n] * _ONE ^ (words[Q - 8:Q - 8 + n] + _TWO) * _TWO


def budget(m: int, rate: float = RATE) -> int:
    """Edits allowed for an item of ``m`` bytes."""
    return max(0, min(int(rate * m), (m - Q) // Q))


def distance(item: bytes, region: bytes, most: int, low: int, high: int) -> tuple[int, int, int] | None:
    """Least edit distance of the item to any part of the region, on diagonals
    ``low`` to ``high``, with the part's start and end; None if above ``most``."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    text = np.frombuffer(region, np.uint8)
    width, n = high - low + 1, len(region)
    far = len(item) + len(region) + 1
    diag = np.arange(width)
    col = diag + low  # column j of row 0
    cost = np.where((col >= 0) & (col <= n), 0, far)
    start = col.copy()
    for i, c in enumerate(item, 1):
        col = diag + low + i
        ok = (col >= 0) & (col <= n)
        same = np.zeros(width, bool)
        inside = (col >= 1) & (col <= n)
        same[inside] = text[col[inside] - 1] == c
        step = np.where(inside, cost + ~same, far)  # along the diagonal
        up = np.append(cost[1:], far) + 1  # an item byte left out
        take = up < step
        new, begin = np.where(take, up, step), np.where(take, np.append(start[1:], 0), start)
        new = np.where(ok, new, far)
        # a text byte put in: running minimum of cost minus place
        rel = new - diag
        best = np.minimum.accumulate(rel)
        owner = np.maximum.accumulate(np.where(rel == best, diag, 0))
        put = best + diag
        begin = np.where(put < new, begin[owner], begin)
        cost, start = np.where(ok, np.minimum(new, put), far), begin
        if cost.min() > most:
            return None
    k = int(np.argmin(cost))
    return int(cost[k]), int(start[k]), int(k + low + len(item))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by value of several parts as one."""
    value, where = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return value, np.bincount(where, np.concatenate([n for _, n in parts]), len(value)).astype(np.int64)


@dataclass
class ItemBlock:
    """Items with the postings of their q-grams."""
    ids: list
    texts: list[bytes]
    edits: np.ndarray
    bound: np.ndarray
    keys: np.ndarray = None
    first: np.ndarray = None
    item: np.ndarray = None
    place: np.ndarray = None
    table: np.ndarray = None
    short: dict[bytes, list] = None

    @classmethod
    def of(cls, rows: list[tuple], rate: float) -> ItemBlock:
        rows, short = [(i, normal(t)) for i, t in rows], {}
        for i, t in rows:
            if 0 < len(t) < Q:
                short.setdefault(t, []).append(i)
        rows = [(i, t) for i, t in rows if len(t) >= Q]
        size = np.array([len(t) for _, t in rows], np.int64)
        edits = np.array([budget(m, rate) for m in size.tolist()], np.int64)
        out = cls([i for i, _ in rows], [t for _, t in rows], edits, size - Q + 1 - edits * Q,
                  short=short)
        if rows:
            grams = [gram_keys(t) for _, t in rows]
            keys = np.concatenate(grams)
            item = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
            place = np.concatenate([np.arange(len(g)) for g in grams])
            order = np.argsort(keys, kind="stable")
            out.keys, at = np.unique(keys[order], return_index=True)
            out.first = np.append(at, len(keys))
            out.item, out.place = item[order], place[order]
            out.table = np.zeros(1 << TABLE_BITS, bool)
            out.table[(out.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        return out

    def found(self, text: bytes) -> list[tuple]:
        """``(item id, distance, start, end)`` of the best region per item, in
        bytes of the normal text."""
        exact = self._short_found(text)
        keys = gram_keys(text)
        if self.table is None:
            return exact
        at = np.flatnonzero(self.table[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        if not len(at):
            return exact
        k = np.searchsorted(self.keys, keys[at])
        real = (k < len(self.keys)) & (self.keys[np.minimum(k, len(self.keys) - 1)] == keys[at])
        at, k = at[real], k[real]
        if not len(at):
            return exact
        # band b holds the diagonals of cells b and b + 1: any run of ``width``
        # diagonals lies whole in one band
        thin = int(self.edits.min()) + 1
        base = -(int(self.place.max()) // thin) - 2
        cells = len(text) // thin - base + 3
        value, count = _added([np.unique(code, return_counts=True) for code, _ in self._shared(at, k, base, cells)])
        # no band holds more than its two cells: most texts end here
        full = np.zeros(len(value) + 1, np.int64)
        nxt = np.searchsorted(value, value + 1)
        full[:-1] = count
        pair = count + np.where(value[np.minimum(nxt, len(value) - 1)] == value + 1, full[nxt], 0)
        prev = np.searchsorted(value, value - 1)
        back = count + np.where(value[prev] == value - 1, full[prev], 0)
        high = np.maximum(pair, back) >= self.bound[value // cells]
        if not high.any():
            return exact
        found = []
        for code, pos in self._shared(at, k, base, cells):
            near = np.isin(code, value[high])
            code, pos = code[near], pos[near]
            # a text position, which lies in one part alone, counts once per item and band
            names, code = np.unique(np.concatenate([code, code - 1]), return_inverse=True)
            rows = np.unique(code * (len(text) + 1) + np.concatenate([pos, pos]))
            some, n = np.unique(rows // (len(text) + 1), return_counts=True)
            found.append((names[some], n))
        bands, count = _added(found)
        bands = np.column_stack([bands // cells, bands % cells + base])
        best: dict[int, tuple] = {}
        for (x, b), c in zip(bands.tolist(), count.tolist()):
            if c < self.bound[x] or best.get(x, (1,))[0] == 0:
                continue
            w, own = int(self.edits[x]) + 1, self.texts[x]
            low = max(0, b * w - w)
            region = text[low:max(low, (b + 2) * w + len(own) + w)]
            got = distance(own, region, int(self.edits[x]), b * w - low, (b + 2) * w - 1 - low)
            if got and got[0] <= self.edits[x] and (x not in best or got[0] < best[x][0]):
                best[x] = (got[0], low + got[1], low + got[2])
        return exact + [(self.ids[x], *v) for x, v in sorted(best.items())]

    def _short_found(self, text: bytes) -> list[tuple]:
        """Items that are shorter than a q-gram: equal runs of whole words."""
        out = []
        words = text.split(b" ") if self.short else []
        for k in sorted({x.count(b" ") + 1 for x in self.short}):
            at = 0
            for i in range(len(words) - k + 1):
                run = b" ".join(words[i:i + k])
                for item in self.short.get(run, ()):
                    if (item, run) not in {x[:2] for x in out}:
                        out.append((item, run, at))
                at += len(words[i]) + 1
        return [(item, 0, at, at + len(run)) for item, run, at in out]

    def _shared(self, at: np.ndarray, k: np.ndarray, base: int, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Cells and text positions of the q-grams that text and items share.
        A gram that repeats in an item is paired with all its places there, so
        text positions are taken in parts of about ``PART`` pairs."""
        n = self.first[k + 1] - self.first[k]
        cuts = np.flatnonzero(np.diff(np.cumsum(n) // PART)) + 1
        for some, which, size in zip(np.split(at, cuts), np.split(k, cuts), np.split(n, cuts)):
            ends = np.cumsum(size)
            post = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(self.first[which], size)
            pos, item = np.repeat(some, size), self.item[post]
            yield item * cells + ((pos - self.place[post]) // (self.edits[item] + 1) - base), pos


def item_blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in lists of bounded size, read one partition at a time."""
    rows, size = [], 0
    for r in (items.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t"))
              .dropna().distinct().toLocalIterator()):
        text = r["t"].encode("utf-8", "replace")
        rows.append((r["i"], text))
        size += len(text)
        if size >= BLOCK_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


@lru_cache(maxsize=1)
def _index(key: int, rows, rate: float) -> ItemBlock:
    """The index of a block, built once per Python worker and block."""
    return ItemBlock.of(rows.value, rate)


def _may_hold(rows: DataFrame, blocks: list, rate: float) -> DataFrame:
    """The rows whose texts share enough q-grams with any item, or hold a short
    one: one scan, by a bit table of all blocks' q-grams.  It leaves out no text
    that holds an item; a bit that q-grams share costs time alone."""
    bits, short, least = np.zeros(1 << WHOLE_BITS, bool), {}, None
    for rows_of in blocks:
        for i, t in rows_of.value:
            t = normal(t)
            if 0 < len(t) < Q:
                short.setdefault(t, []).append(i)
            elif t:
                bits[(gram_keys(t) >> np.uint64(64 - WHOLE_BITS)).astype(np.int64)] = True
                bound = len(t) - Q + 1 - budget(len(t), rate) * Q
                least = bound if least is None else min(least, bound)
    sent = rows.sparkSession.sparkContext.broadcast((np.packbits(bits, bitorder="little"), short, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, short, least = sent.value
        words = ItemBlock([], [], None, None, short=short)
        for b in batches:
            keep = []
            for raw in texts_of(b.column(2)):
                text = normal(raw)
                at = (gram_keys(text) >> np.uint64(64 - WHOLE_BITS)).astype(np.int64)
                hits = int(((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).sum())
                keep.append(least is not None and hits >= max(least, 1) or bool(words._short_found(text)))
            yield b.filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def contamination(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """``(id, digest, item_id, edits, region)``: one row per document row and
    benchmark item that it holds; ``region`` is the best matching part, in the
    compared form of the text.

    Items of one block are looked for in one scan of ``docs``.  Of several
    blocks one scan finds the few texts that may hold an item of any, they are
    stored, and each block is looked for in those.

    Defined cases: null and empty texts and items hold and find nothing; an
    item shorter than a q-gram is found where its words stand in a text
    unchanged; very long texts are searched whole, in memory in proportion to
    their length; items that share an id are matched one by one; rows that
    repeat give rows that repeat; an empty table on either side gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    rows = keyed(docs).select("id", "digest", F.col("row.text").cast("string").alias("text"))
    schema = "id long, digest binary, item_id long, edits int, region string"
    blocks = [spark.sparkContext.broadcast(x) for x in item_blocks(items)]
    if len(blocks) > 1:
        rows = materialise(_may_hold(rows, blocks, rate), "may-hold-items")
    parts = []
    for number, sent in enumerate(blocks):
        def run(batches: Iterator[pa.RecordBatch], sent=sent, number=number) -> Iterator[pa.RecordBatch]:
            block = _index(number, sent, rate)
            for b in batches:
                at, out = [], []
                for r, raw in enumerate(texts_of(b.column(2))):
                    text = normal(raw)
                    for i, edits, s, e in block.found(text):
                        at.append(r)
                        out.append((i, edits, text[s:e].decode("utf-8", "replace")))
                at = pa.array(at, pa.int64())
                cols = list(zip(*out)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(cols[0], pa.int64()),
                     pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string())],
                    ["id", "digest", "item_id", "edits", "region"])

        parts.append(rows.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows that hold no benchmark item, with their columns.

    Defined cases: as ``contamination``; rows with a null doc_id or text, and
    rows that repeat, stay unless their text holds an item.
    """
    hits = materialise(contamination(docs, items, rate).select("id", "digest").distinct(), "contaminated")
    rows = keyed(docs)
    return unkeyed(rows.join(hits, rows["id"].eqNullSafe(hits["id"]) & (rows["digest"] == hits["digest"]),
                             "left_anti"))
