"""SimHash near-duplicates over a Gray-ordered hierarchical index.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word
shingles.  Fingerprints link when few bits differ; linked documents form
groups.

Search.  Two fingerprints that differ in at most ``d`` of ``b`` blocks of bits
agree in at least ``b - d`` blocks.  For each choice of ``b - d`` blocks (a
*table*) the distinct fingerprints are dealt by the agreed bits and, among
those, sorted by the Gray rank of the other bits, so that neighbours differ in
few bits.  A sorted run of at most ``BLOCK`` fingerprints becomes a tree: each
upper node holds the bits that all codes under it have in common.  Two nodes
whose common bits already differ in more than ``d`` places are dropped with
everything under them.  The choice of tables loses no link (pigeonhole), and
the tree drops only pairs that are too far apart.

Skew.  Equal fingerprints are reduced to one before the search.  The sort
splits an agreed-bits group that is larger than one run over several runs and
tasks; the runs' common bits then decide which pairs of runs meet, and each
such pair is a row of its own.  Within a run only a spanning forest of the
links leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import keyed, texts_of, unkeyed
from casegrid.llm.components import components
from casegrid.session import materialise

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Codes of one tree, and children of one node.
BLOCK, FANOUT = 2048, 8
#: Codes that an agreed-bits group should hold when bits are even; with more
#: fingerprints the tables agree in more bits (and there are more of them).
GROUP = 4096

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# ---------------------------------------------------------------------------
# Fingerprints
# ---------------------------------------------------------------------------

def simhash(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one UTF-8 text: A-Z lower-cased, words
    between white space, shingles of ``width`` words with repeats (fewer
    words: the whole sequence; none: zero)."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first, last = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    ones, n = np.zeros(64, np.int64), len(first)
    for k in range(0, n, 1 << 16):
        part = range(k, min(n, k + (1 << 16)))
        h = np.fromiter((digest(joined[first[i]:last[i]], SEED) for i in part), np.uint64, len(part))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.where(2 * ones > n, np.uint64(1), np.uint64(0)) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, digest, fp)`` per row; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t, width) for t in texts_of(b.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp, pa.int64())],
                                             ["id", "digest", "fp"])

    rows = keyed(docs).select("id", "digest", F.col("row.text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, digest binary, fp long")


# ---------------------------------------------------------------------------
# Tables of agreed bits
# ---------------------------------------------------------------------------

def tables_for(n: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of the agreed bits, one per table, for ``n`` fingerprints."""
    blocks = max_bits + 1
    while True:
        parts = np.array_split(np.arange(64), blocks)
        agreed = sum(sorted(len(p) for p in parts)[:blocks - max_bits])
        if n >> agreed <= GROUP or blocks >= max_bits + 3:
            break
        blocks += 1
    return [sum(1 << int(i) for k in chosen for i in parts[k])
            for chosen in combinations(range(blocks), blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(code: Column) -> Column:
    """Place of a code in Gray order, as a long whose signed order is right."""
    rank = code
    for k in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, k))
    return rank.bitwiseXOR(F.lit(_signed(1 << 63)))


# ---------------------------------------------------------------------------
# Trees of common bits
# ---------------------------------------------------------------------------

def tree(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the codes up; a node has the bits that are one, and the
    bits that are one somewhere, among the codes under it."""
    levels = [(codes, codes)]
    while len(levels[-1][0]) > FANOUT:
        ones, some = levels[-1]
        at = np.arange(0, len(ones), FANOUT)
        levels.append((np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(some, at)))
    return levels


def _apart(a, i, b, j) -> np.ndarray:
    """Bits that are common under both nodes and differ between them."""
    return np.bitwise_count((a[0][i] & ~b[1][j]) | (b[0][j] & ~a[1][i]))


def search(left: list, right: list | None, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of codes at most ``max_bits`` apart; ``right`` None: within."""
    own = right is None
    right = left if own else right
    top_l, top_r = len(left) - 1, len(right) - 1
    i = np.repeat(np.arange(len(left[-1][0])), len(right[-1][0]))
    j = np.tile(np.arange(len(right[-1][0])), len(left[-1][0]))
    while True:
        keep = (_apart(left[top_l], i, right[top_r], j) <= max_bits) & ((i <= j) if own else True)
        i, j = i[keep], j[keep]
        if top_l == 0 and top_r == 0:
            return (i[i < j], j[i < j]) if own else (i, j)
        if top_l >= top_r:
            top_l -= 1
            i, j = (i[:, None] * FANOUT + np.arange(FANOUT)).ravel(), np.repeat(j, FANOUT)
            i, j = i[ok := i < len(left[top_l][0])], j[ok]
            if own:  # both sides go down together
                top_r = top_l
                i, j = np.repeat(i, FANOUT), (j[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                i, j = i[ok := j < len(right[top_r][0])], j[ok]
        else:
            top_r -= 1
            i, j = np.repeat(i, FANOUT), (j[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            i, j = i[ok := j < len(right[top_r][0])], j[ok]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest linked position of each of ``n`` positions."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


_OUT = "a long, b long, t int, agreed long, run long, ones long, some long, codes binary, ids binary"
_NAMES = ["a", "b", "t", "agreed", "run", "ones", "some", "codes", "ids"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
          pa.binary(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs ``(t, agreed, codes, ids, edge)`` of a sorted partition: codes of
    one group, at most ``BLOCK``; ``edge`` if the group may go on in another
    run (the first and last groups of the partition, and cut groups)."""
    held, first = None, True
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
        t, g, codes, ids = held
        new = np.flatnonzero((t[1:] != t[:-1]) | (g[1:] != g[:-1])) + 1
        bounds = [0, *new.tolist()]
        for s, e in zip(bounds, bounds[1:]):
            for k in range(s, e, BLOCK):
                yield t[s], g[s], codes[k:min(e, k + BLOCK)], ids[k:min(e, k + BLOCK)], first or e - s > BLOCK
            first = False
        at = bounds[-1]
        while len(t) - at > BLOCK:  # a group that never ends leaves in full runs
            yield t[at], g[at], codes[at:at + BLOCK], ids[at:at + BLOCK], True
            at, first = at + BLOCK, True
        held = [x[at:] for x in held]
    if held is not None and len(held[0]):
        yield held[0][0], held[1][0], held[2], held[3], True


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that join every pair of ``fps(fp, node)`` whose
    distinct fingerprints are at most ``max_bits`` apart into one component
    (a spanning forest per run, not all pairs)."""
    masks = tables_for(fps.count(), max_bits)
    entries = fps.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("t"), F.lit(_signed(m)).alias("mask"))
                            for k, m in enumerate(masks)])).alias("x"), "fp", "node")
    entries = entries.select(
        F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("agreed"),
        gray_rank(F.col("fp").bitwiseAND(F.bitwise_not("x.mask"))).alias("rank"), "fp", "node")
    dealt = (entries.repartitionByRange("t", "agreed", "rank").sortWithinPartitions("t", "agreed", "rank")
             .select("t", "agreed", "fp", "node"))

    def within(batches):
        rows, made, part = [], 0, TaskContext.get().partitionId()
        for t, g, codes, ids, edge in _runs(batches):
            codes = codes.astype(np.int64).view(np.uint64)
            if len(codes) > 1:
                label = forest(len(codes), *search(tree(codes), None, max_bits))
                rows += [(int(ids[x]), int(ids[y]), None, None, None, None, None, None, None)
                         for x, y in enumerate(label.tolist()) if x != y]
            if edge:
                made += 1
                rows.append((None, None, int(t), int(g), (part << 32) + made,
                             int(np.bitwise_and.reduce(codes).view(np.int64)),
                             int(np.bitwise_or.reduce(codes).view(np.int64)),
                             codes.tobytes(), ids.astype(np.int64).tobytes()))
            if len(rows) >= 1024 or edge and rows:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    found = materialise(dealt.mapInArrow(within, _OUT), "simhash-runs")
    runs = found.where("run is not null")
    heads = runs.select("t", "agreed", "run", "ones", "some")
    other = heads.select("t", "agreed", *[F.col(c).alias(f"{c}2") for c in ("run", "ones", "some")])
    apart = F.bit_count(
        F.col("ones").bitwiseAND(F.bitwise_not("some2")).bitwiseOR(
            F.col("ones2").bitwiseAND(F.bitwise_not("some"))))
    pairs = (heads.join(other, ["t", "agreed"])
             .where((F.col("run") < F.col("run2")) & (apart <= max_bits)).select("run", "run2"))
    load = runs.select("run", "codes", "ids")
    pairs = pairs.join(load, "run").join(
        load.select(*[F.col(c).alias(f"{c}2") for c in ("run", "codes", "ids")]), "run2")

    def across(batches):
        for b in batches:
            for x in b.to_pylist():
                one, two = np.frombuffer(x["codes"], np.uint64), np.frombuffer(x["codes2"], np.uint64)
                ids = np.concatenate([np.frombuffer(x["ids"], np.int64), np.frombuffer(x["ids2"], np.int64)])
                i, j = search(tree(one), tree(two), max_bits)
                label = forest(len(ids), i, j + len(one))
                at = np.flatnonzero(label != np.arange(len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[label[at]])], ["a", "b"])

    return found.where("run is null").select("a", "b").unionByName(
        pairs.select("codes", "ids", "codes2", "ids2").mapInArrow(across, "a long, b long"))


# ---------------------------------------------------------------------------
# Groups
# ---------------------------------------------------------------------------

def simhash_groups(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(id, digest, fp, component)`` per row of ``docs``.

    ``component`` is the smallest doc_id that can be reached over links of at
    most ``max_bits`` differing bits.  Defined cases: a null or empty text has
    fingerprint zero and is linked like any other; equal fingerprints are
    linked; a row without doc_id is no document: it has a fingerprint, takes
    part in no group, and its component is null; an empty table gives no rows.
    """
    fps = materialise(fingerprints(docs, width), "simhash-fps")
    own = materialise(fps.where("id is not null").groupBy("fp").agg(F.min("id").alias("low")), "simhash-codes")
    # nodes are the fingerprints themselves; their groups take the smallest doc_id
    star = components(links(own.select("fp", F.col("fp").alias("node")), max_bits))
    named = own.join(star.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root"))
    root = named.groupBy("root").agg(F.min("low").alias("component"))
    label = named.join(root, "root").select("fp", "component")
    return fps.join(label, "fp", "left").select(
        "id", "digest", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def near_dedup(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of one document of each group: that with the smallest doc_id.

    Rows without doc_id stay.  Of rows that repeat (same doc_id and text) one
    stays; of rows that share the smallest doc_id but not the text, each that
    is first of a group by fingerprint stays.
    """
    groups = simhash_groups(docs, width, max_bits)
    keep = groups.where("id = component").select("id", "digest").distinct()
    rows = keyed(docs)
    kept = (rows.where("id is not null").join(keep, ["id", "digest"], "left_semi")
            .dropDuplicates(["id", "digest"]))
    return unkeyed(kept.unionByName(rows.where("id is null")))
