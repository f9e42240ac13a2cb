"""Removal of repeated passages by content-defined chunking.

A gear rolling hash over the last 16 bytes picks chunk boundaries, so a passage
is cut alike wherever it stands; bytes put in before it move the boundaries
near them only.  Chunks are grouped by a 128-bit digest.  Of a chunk that
occurs more than once, those in the document with the smallest doc_id stay (its
*home*).  Occurrences in other documents are repeats; a run of repeats that lie
next to each other and hold ``MIN_RUN_WORDS`` words or more goes.  A text's own
repetitions stay, unless ``within`` asks for them too: then only the first
occurrence in the home stays.

Only numbers are grouped and dealt out (two digest halves, doc_id, byte
range); a frequent chunk is one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import texts_of
from casegrid.session import materialise

MIN_CHUNK, MAX_CHUNK, MASK_BITS = 16, 256, 5
MIN_RUN_WORDS = 16
#: One number per byte value, from a seeded generator.
GEAR = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hashes(text: bytes) -> np.ndarray:
    """At every byte the gear hash ``h = (h << 1) + GEAR[byte]`` of 16 bits;
    a byte's share is shifted out after 16 steps, so the hash is a sum over a
    window and doubles its reach per step."""
    h = GEAR[np.frombuffer(text, np.uint8)]
    for reach in (1, 2, 4, 8):
        out = h.copy()
        out[reach:] += h[:-reach] << np.uint16(reach)
        h = out
    return h


def chunk_ends(text: bytes) -> list[int]:
    """Ends of the chunks that cover the text."""
    n = len(text)
    if n == 0:
        return []
    ends, at = [], 0
    for c in np.flatnonzero(gear_hashes(text) >> np.uint16(16 - MASK_BITS) == 0).tolist():
        c += 1
        while c - at > MAX_CHUNK:
            at += MAX_CHUNK
            ends.append(at)
        if c - at >= MIN_CHUNK:
            at = c
            ends.append(at)
    while n - at > MAX_CHUNK:
        at += MAX_CHUNK
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def word_counts(text: bytes, starts: list[int]) -> np.ndarray:
    """Words that begin in each chunk."""
    raw = np.frombuffer(text, np.uint8)
    gap = (raw == 32) | (raw >= 9) & (raw <= 13)
    begin = ~gap
    begin[1:] &= gap[:-1]
    return np.add.reduceat(begin, starts, dtype=np.int64)


def chunk_table(docs: DataFrame) -> DataFrame:
    """``(id, key, no, one, two)`` per chunk: its number in the text and the
    halves of its digest."""
    names = ["id", "key", "no", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            count, found = [], []

            def made(at):
                halves = np.frombuffer(b"".join(found), ">i8").reshape(-1, 2)
                row = pa.array(np.repeat(np.arange(at - len(count), at), count), pa.int64())
                no = np.concatenate([np.arange(n, dtype=np.int32) for n in count])
                return pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), pa.array(no, pa.int32()),
                     pa.array(halves[:, 0].astype(np.int64)), pa.array(halves[:, 1].astype(np.int64))], names)

            for r, text in enumerate(texts_of(b.column(2))):
                ends = chunk_ends(text)
                count.append(len(ends))
                found += [digest(text[s:e]) for s, e in zip([0, *ends], ends)]
                if len(found) > 1 << 17:
                    yield made(r + 1)
                    count, found = [], []
            if found:
                yield made(b.num_rows)

    return _rows(docs).mapInArrow(run, "id long, key long, no int, one long, two long")


def repeated_chunks(docs: DataFrame, within: bool = False) -> DataFrame:
    """``(id, key, hits)`` per document with repeats: the numbers of the
    chunks that occur in a home elsewhere (``within``: all that occur again,
    with their digest and whether this is their home)."""
    chunks = chunk_table(docs)
    low = F.coalesce(F.col("id"), F.lit(-(1 << 63)))  # a null doc_id orders first
    many = (chunks.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.min(low).alias("low"))
            .where("n > 1").select("one", "two", "low"))
    # stored, so that the join below deals both sides out itself and splits a chunk that is everywhere
    many = materialise(many, "substring-repeats")
    home = low == F.col("low")
    hits = chunks.join(many, ["one", "two"])
    hits = hits.withColumn("home", home) if within else hits.where(~home)
    hit = F.struct("no", "one", "two", "home") if within else F.struct("no")
    return hits.groupBy("id", "key").agg(F.collect_set(hit).alias("hits"))


def _runs(text: bytes, hits: list[dict]) -> list[dict]:
    """Byte ranges of the runs of repeats that are long enough."""
    ends = chunk_ends(text)
    starts = [0, *ends[:-1]]
    words = word_counts(text, starts)
    seen, runs = set(), []
    for h in sorted(hits, key=lambda h: h["no"]):
        if h.get("home") and (name := (h["one"], h["two"])) not in seen:
            seen.add(name)  # the occurrence that stays
            continue
        k = h["no"]
        if runs and runs[-1]["stop"] == starts[k]:
            runs[-1]["stop"] = ends[k]
            runs[-1]["words"] += int(words[k])
        else:
            runs.append({"start": starts[k], "stop": ends[k], "words": int(words[k])})
    return [x for x in runs if x["words"] >= MIN_RUN_WORDS]


def dedup_substrings(docs: DataFrame, within: bool = False) -> DataFrame:
    """``(doc_id, text, spans, removed_words)`` per row: the text without its
    repeated runs, and the byte ranges of the old text that went.

    A cut may fall inside a character or word: bytes of a split character are
    kept out of the range, so the text stays valid.

    Defined cases: a null text counts as empty; an empty text has no chunk;
    rows that repeat (same doc_id and text) are one document and share its
    decision; texts that share a doc_id are one home; a null doc_id orders
    before all others; an empty table gives no rows.
    """
    rows, found = _rows(docs), materialise(repeated_chunks(docs, within), "substring-hits")
    rows = rows.join(found, rows["id"].eqNullSafe(found["id"]) & (rows["key"] == found["key"]), "left").select(
        rows["id"].alias("doc_id"), "text", "hits")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("words", pa.int32())]))
    schema = "doc_id long, text string, spans array<struct<start:int,stop:int,words:int>>, removed_words int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans, gone = [], [], []
            for text, hits in zip(texts_of(b.column(1)), b.column(2).to_pylist()):
                at, kept, new = 0, [], []
                for s in _runs(text, hits):
                    start, stop = s["start"], s["stop"]
                    while start < stop and text[start] & 0xC0 == 0x80:
                        start += 1
                    while stop > start and stop < len(text) and text[stop] & 0xC0 == 0x80:
                        stop -= 1
                    kept.append(text[at:start])
                    at = stop
                    new.append({"start": start, "stop": stop, "words": s["words"]})
                texts.append(b"".join([*kept, text[at:]]).decode())
                spans.append(new)
                gone.append(sum(s["words"] for s in new))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array(spans, kind), pa.array(gone, pa.int32())],
                ["doc_id", "text", "spans", "removed_words"])

    none = F.array().cast("array<struct<start:int,stop:int,words:int>>")
    return rows.where("hits is not null").mapInArrow(run, schema).unionByName(
        rows.where("hits is null").select("doc_id", "text", none.alias("spans"), F.lit(0).alias("removed_words")))
