"""Prefix trie of conversations by vertical bitmaps.

A node is a distinct sequence of first turns; its members are the
conversations that start with it.  Conversations lie in shards by ranges of
their ids.  A shard indexes each ``(position, turn)`` to the bitset of the
conversations that have this turn there.  From the root down, depth first, the
intersection of a node's bitset with the postings of the turns that follow
gives its children; a popcount gives their members, the intersection with the
bitset of conversations of that length the list of those that end there.

A node can have members in many shards, so a shard's counts are parts of the
whole.  A node's *owner* is the shard that holds its smallest member; all its
ancestors have members there too.  Sums over subtrees (leaves, tokens) take
each node once, in its owner, as differences of running sums in depth-first
order, and the shards' parts are added up.  A node with a third of all
conversations is one row per shard, with its ends as one packed list.

Turns are dealt out as digests, never as texts.  A shard is closed at
``SHARD_CONVS`` conversations or ``SHARD_TURNS`` turns; a task holds one shard
at a time, and so at least one whole conversation, at about 200 bytes a turn.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casegrid.session import materialise

SHARD_CONVS, SHARD_TURNS = 4096, 1 << 17
ROOT = bytes(16)
#: A conversation is its id and its turns, each a digest and a size.
Turns = list[tuple[bytes, int]]


def same_head(conv: int, span: int = 5) -> int:
    """The conversation whose first turns ``conv`` takes over."""
    return conv - (conv % span if conv >= 0 else -(-conv % span))


def shared_heads(convs: dict[int, Turns]) -> dict[int, Turns]:
    """Every conversation with the first ``h`` turns of ``same_head`` in place
    of its own first ``h``, ``h`` = CRC-32 of its decimal id modulo 9."""
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(b"%d" % c) % 9
        out[c] = convs.get(same_head(c), [])[:h] + own[h:]
    return out


def _bitset(numbers: list[int]) -> int:
    if len(numbers) == 1:
        return 1 << numbers[0]
    flags = np.zeros(max(numbers) + 1, np.uint8)
    flags[numbers] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _numbers(bits: int) -> np.ndarray:
    raw = np.frombuffer(bits.to_bytes(bits.bit_length() + 7 >> 3, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def shard_nodes(convs: list[tuple[int, Turns]]) -> list[list]:
    """Depth-first rows ``[node, pre, last, parent, depth, n, n_ends, first,
    size, ends]`` of the trie over ``convs`` (ascending ids): ``pre`` is the
    row's number, ``last`` that of the last row of its subtree, ``parent`` that
    of its parent (-1), ``size`` the bytes of its last turn."""
    at: dict[tuple[int, bytes], list[int]] = {}
    over: dict[int, list[int]] = {}
    for n, (_, turns) in enumerate(convs):
        for d, (key, _) in enumerate(turns):
            at.setdefault((d, key), []).append(n)
        over.setdefault(len(turns), []).append(n)
    postings = {k: _bitset(x) for k, x in at.items()}
    at.clear()
    over_at = {d: _bitset(x) for d, x in over.items()}
    ids = np.array([c for c, _ in convs], np.int64)
    rows: list[list] = []
    stack = [((1 << len(convs)) - 1, ROOT, -1, 0, 0)]
    while stack:
        bits, node, parent, depth, size = stack.pop()
        ends = bits & over_at.get(depth, 0)
        packed = ids[_numbers(ends)].astype("<i8").tobytes() if ends else None
        first = (bits & -bits).bit_length() - 1
        rows.append([node, len(rows), len(rows), parent, depth, bits.bit_count(), ends.bit_count(),
                     convs[first][0], size, packed])
        pre, rest, kids = len(rows) - 1, bits ^ ends, []
        while rest:
            key, size = convs[(rest & -rest).bit_length() - 1][1][depth]
            child = rest & postings[depth, key]
            rest ^= child
            kids.append((child, hashlib.blake2b(node + key, digest_size=16).digest(), pre, depth + 1, size))
        stack += reversed(kids)
    for row in reversed(rows):
        if row[3] >= 0:
            rows[row[3]][2] = max(rows[row[3]][2], row[2])
    return rows


_LOCAL = ("node binary, shard long, pre int, last int, parent int, depth long, n long, n_ends long, first long, "
          "size long, ends binary")
_ARROW = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32()}


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, (_, t) in zip(columns, fields)],
                                      [name for name, _ in fields])


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for a role and a text."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def _local(conversations: DataFrame, span: int, rebuild: Callable[[dict[int, Turns]], dict[int, Turns]] | None,
           shard_convs: int, shard_turns: int) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % span).alias("home"), conv.alias("conv"), F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("key"), F.octet_length(text).cast("long").alias("size"))
    turns = turns.repartitionByRange("home").sortWithinPartitions(
        "home", "conv", F.col("turn").asc_nulls_first(), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId() << 32, 0
        shard: list[tuple[int, Turns]] = []
        near: dict[int, Turns] = {}
        held, home = 0, None

        def settle() -> None:
            nonlocal held
            done = rebuild(near) if rebuild else near
            for c in sorted(done):
                shard.append((c, done[c]))
                held += len(done[c])
            near.clear()

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal held, made
            rows = [[r[0], part + made, *r[1:]] for r in shard_nodes(shard)]
            made += 1
            shard.clear()
            held = 0
            for k in range(0, len(rows), 8192):
                yield _batch(rows[k:k + 8192], _LOCAL)

        for b in batches:
            for h, c, key, size in zip(*(b.column(x).to_pylist() for x in ("home", "conv", "key", "size"))):
                if h != home:
                    settle()
                    home = h
                    if len(shard) >= shard_convs or held >= shard_turns:
                        yield from closed()
                near.setdefault(c, []).append((key, size))
        settle()
        if shard:
            yield from closed()

    return turns.mapInArrow(run, _LOCAL)


_PARTS = ("node binary, shard long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends binary")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of subtree sums, shard by shard; rows come by shard and ``pre``."""
    def parts(t: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {c: t.column(c).to_numpy() for c in t.column_names if c != "node"}
        owned = col["first"] == col["conv_id"]
        leaf = owned & (col["n_convs"] == col["all_ends"])
        saved = np.where(owned, (col["n_convs"] - 1) * col["size"], 0)
        pre, last, parent = col["pre"], col["last"], col["parent"]

        def below(x):
            run = np.concatenate(([0], np.cumsum(x.astype(np.int64))))
            return run[last + 1] - run[pre]

        kids = np.bincount(parent[owned & (parent >= 0)], minlength=len(pre)).astype(np.int64)
        up = pa.array(col["conv_id"][parent], mask=~owned | (parent < 0))
        out = pa.table([t.column("node").combine_chunks(), t.column("shard"), t.column("depth"), t.column("conv_id"), up,
                        t.column("n_convs"), pa.array(kids), pa.array(below(leaf)), pa.array(below(saved)),
                        pa.nulls(len(pre), pa.binary())], [x.split()[0] for x in _PARTS.split(", ")])
        yield from out.to_batches(8192)

    held: list[pa.RecordBatch] = []
    for b in batches:
        shards = b.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            if held and s < e and held[-1].column("shard")[0].as_py() != shards[s]:
                yield from parts(pa.Table.from_batches(held))
                held = []
            if s < e:
                held.append(b.slice(s, e - s))
    if held:
        yield from parts(pa.Table.from_batches(held))


_NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 binary")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node; rows come by node and shard, a list of ends at a time."""
    out: list[tuple] = []
    node, total, hashed, comma = None, [], None, False

    def row() -> tuple:
        conv, depth, up, n, kids, leaves, saved = total
        return conv, depth, up, n, kids, leaves, saved, hashed.hexdigest().encode()

    for b in batches:
        for key, _, depth, conv, up, n, kids, leaves, saved, ends in zip(*(c.to_pylist() for c in b.columns)):
            if key != node:
                if node is not None:
                    out.append(row())
                    if len(out) == 8192:
                        yield _batch(out, _NODES)
                        out = []
                node, total, hashed, comma = key, [None, None, None, None, 0, 0, 0], hashlib.sha256(), False
            if ends is not None:
                some = ",".join(map(str, np.frombuffer(ends, "<i8").tolist()))
                hashed.update((("," if comma else "") + some).encode())
                comma = True
                continue
            total[0], total[1], total[3] = conv, depth, n
            total[2] = up if total[2] is None else total[2]
            total[4] += kids
            total[5] += leaves
            total[6] += saved
    if node is not None:
        out.append(row())
        yield _batch(out, _NODES)


def trie_nodes(conversations: DataFrame, span: int = 1,
               rebuild: Callable[[dict[int, Turns]], dict[int, Turns]] | None = None,
               shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie over ``conversations(conv_id, turn, role,
    text)``: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the
    parent's smallest member, null for the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (nodes without children in its subtree), ``saved_tokens``
    (over its subtree, ``n_convs - 1`` times the UTF-8 bytes of the last text)
    and ``ends_sha256`` (of the decimal ids, ascending and comma-joined, of the
    members that end there).

    ``rebuild`` may change conversations before they are indexed.  It is given
    all those of one ``conv_id - conv_id % span`` at a time, turns in order, and
    returns the turns per conversation.

    Defined cases: a null role or text is empty; a null turn comes first; equal
    turn numbers are ordered by the digest of role and text; rows that repeat
    are turns that repeat; rows without a conv_id belong to no conversation and
    are left out; a conversation without turns ends in the root; very long
    texts count by their digest and size; extra columns are not read; an empty
    table gives no rows.
    """
    local = materialise(_local(conversations, span, rebuild, shard_convs, shard_turns), "trie")
    w = Window.partitionBy("node")
    whole = local.drop("ends").select(
        "*", F.min("first").over(w).alias("conv_id"), F.sum("n").over(w).alias("n_convs"),
        F.sum("n_ends").over(w).alias("all_ends")).drop("n", "n_ends")
    parts = whole.repartition("shard").sortWithinPartitions("shard", "pre").mapInArrow(_summed, _PARTS)
    ends = local.where("ends IS NOT NULL").select("node", "shard", *[
        F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in _PARTS.split(", ")[2:-1])], "ends")
    nodes = parts.unionByName(ends).repartition("node").sortWithinPartitions("node", "shard").mapInArrow(_merged, _NODES)
    return nodes.withColumn("ends_sha256", F.col("ends_sha256").cast("string"))
