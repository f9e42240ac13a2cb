"""Removal of repeated multi-line passages.

A rolling hash runs over the hashes of a text's lines, a window of two lines
that are not blank (and any blank ones between) at a time.  Boundaries lie
where its values begin or cease to occur elsewhere: they depend on a passage's
own lines alone, so a passage of two lines or more is cut out alike whatever
stands before and after it, and is found whole.

Without ``every_line`` boundaries are picked inside a text alone, where the
rolling hash of the last ``WINDOW`` lines is divisible by ``ONE_IN``, and chunks
of whole lines are compared.  That makes fewer rows, but loses the chunks at
either end of a passage, and most passages of a few lines.

Of windows (chunks) with the same lines, wherever they occur, that with the
smallest ``(doc_id, text digest, position)`` stays and the others go; one that
overlaps it stays too.  A chunk needs two lines that are not blank; single
lines are left alone.  A line's first occurrence never goes.

Digests group the chunks; a group's removal is decided by the bytes
themselves: the smallest and the largest byte string of the group must be
equal.  Only narrow rows (digest, key, byte range) are grouped, and they are
stored once; a frequent chunk is reduced to one row per task before it is dealt
out.  Texts move once, to their spans, and only those that change reach Python.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import keyed, texts_of, unkeyed
from casegrid.session import materialise

WINDOW, ONE_IN, MIN_LINES, MAX_LINES = 2, 2, 2, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ROLL, _MASK = 0x9E3779B97F4A7C15F39CC0605CEDC835, (1 << 128) - 1
#: Rows of chunks that a task holds before it hands them on.
BATCH_ROWS = 1 << 15


def line_chunks(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, end, lines)`` byte ranges that cover the text; the line break
    after a chunk belongs to its range.  ``lines`` counts those not blank."""
    if not text:
        return []
    lines = text.split(b"\n")
    hashes = np.fromiter((xxhash.xxh64_intdigest(x) for x in lines), np.uint64, len(lines))
    rolled = hashes.copy()
    for k in range(1, WINDOW):
        rolled[k:] += hashes[:-k] * _MIX ** np.uint64(k)
    cut = ((rolled * _MIX >> np.uint64(40)) % np.uint64(ONE_IN) == 0).tolist()
    out, start, at, held, full = [], 0, 0, 0, 0
    for i, line in enumerate(lines):
        at += len(line) + 1
        held += 1
        full += not line.isspace() and bool(line)
        if held >= MIN_LINES and cut[i] or held == MAX_LINES or i == len(lines) - 1:
            out.append((start, min(at, len(text)), full))
            start, held, full = at, 0, 0
    return [x for x in out if x[1] > x[0]]


def _chunk_bytes(text: bytes, start: int, end: int) -> bytes:
    part = text[start:end]
    return part[:-1] if part.endswith(b"\n") else part


def line_pairs(text: bytes) -> list[tuple[int, int]]:
    """``(start, end)`` byte ranges of every line that is not blank with the
    next one, with the blank lines between them and the line break after."""
    out, at, prior = [], 0, None
    for line in text.split(b"\n"):
        end = at + len(line) + 1
        if line and not line.isspace():
            if prior is not None:
                out.append((prior, min(end, len(text))))
            prior = at
        at = end
    return out


def line_windows(text: bytes) -> list[tuple[int, int, bytes]]:
    """``line_pairs`` with the rolling hash of each, 16 bytes: that of the one
    before without its first line, times ``_ROLL``, plus the next line's."""
    out, at, prior, rolled = [], 0, None, 0
    for line in text.split(b"\n"):
        end = at + len(line) + 1
        own = xxhash.xxh3_128_intdigest(line)
        if line and not line.isspace():
            if prior is not None:
                value = (rolled * _ROLL + own) & _MASK
                out.append((prior, min(end, len(text)), value.to_bytes(16, "big")))
            prior, rolled = at, own
        elif prior is not None:
            rolled = (rolled * _ROLL + own) & _MASK
        at = end
    return out


def _full_chunks(text: bytes) -> list[tuple[int, int, bytes]]:
    return [(s, e, hashlib.blake2b(_chunk_bytes(text, s, e), digest_size=16).digest())
            for s, e, full in line_chunks(text) if full >= MIN_LINES]


def chunk_table(docs: DataFrame) -> DataFrame:
    """``(id, digest, start, stop, chunk)`` per chunk of two or more lines;
    ``chunk`` is the digest of its bytes without the last line break."""
    return _digests(docs, _full_chunks)


def pair_table(docs: DataFrame) -> DataFrame:
    """The same per window of ``line_windows``, with its rolling hash."""
    return _digests(docs, line_windows)


def _digests(docs: DataFrame, cut: Callable[[bytes], list[tuple[int, int, bytes]]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, found = [], []

            def batch() -> pa.RecordBatch:
                at = pa.array(row, pa.int64())
                start, stop, chunk = list(zip(*found)) or [[], [], []]
                return pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(start, pa.int64()),
                     pa.array(stop, pa.int64()), pa.array(chunk, pa.binary())],
                    ["id", "digest", "start", "stop", "chunk"])

            for r, text in enumerate(texts_of(b.column(2))):
                some = cut(text)
                found += some
                row += [r] * len(some)
                if len(row) >= BATCH_ROWS:
                    yield batch()
                    row.clear()
                    found.clear()
            yield batch()

    rows = keyed(docs).select("id", "digest", F.col("row.text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, digest binary, start long, stop long, chunk binary")


def _marked(docs: DataFrame, every_line: bool) -> DataFrame:
    """``(id, digest, text, rest, spans)`` per row: ``rest`` holds the other
    columns, ``spans`` the chunks that occur elsewhere too, ``stays`` for the
    occurrence that is kept."""
    # stored, here and below: read twice, and each join deals its sides out itself and splits a chunk that is everywhere
    chunks = materialise(pair_table(docs) if every_line else chunk_table(docs), "line-chunks")
    place = F.struct("id", "digest", "start")
    many = (chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
            .where("n > 1").select("chunk", "first"))
    many = materialise(many, "line-repeats")
    stays = (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest"))
             & (F.col("start") - F.col("first.start") < F.col("stop") - F.col("start")))
    spans = (chunks.join(many, "chunk").groupBy("id", "digest")
             .agg(F.sort_array(F.collect_set(F.struct(
                 "start", "stop", "chunk", stays.alias("stays")))).alias("spans")))
    others = [c for c in docs.columns if c != "text"]
    rows = keyed(docs).select("id", "digest", F.col("row.text").cast("string").alias("text"),
                              F.struct(*[F.col("row").getField(c).alias(c) for c in others]).alias("rest"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return rows.join(spans, rows["id"].eqNullSafe(spans["id"]) & (rows["digest"] == spans["digest"]), "left").select(
        rows["id"], rows["digest"], "text", "rest", F.coalesce("spans", none).alias("spans"))


def dedup_lines(docs: DataFrame, every_line: bool = False) -> DataFrame:
    """``(id, digest, row, spans)``: the rows with ``text`` shortened (and
    ``n_chars``, where there is one, set to its new length), and the byte
    ranges ``(start, stop)`` of the old text that went; ranges that overlap are
    one.

    Defined cases: a null text stays null; an empty text and texts of one line
    are unchanged; very long texts are compared whole; rows that repeat (same doc_id and text) are one document
    and all keep what it keeps; a null doc_id orders before all others; a
    document may lose all its lines and then has an empty text; digests that
    agree for unequal bytes remove nothing; an empty table gives no rows.
    """
    marked = materialise(_marked(docs, every_line), "line-marked")
    body = F.col("text").cast("binary")
    part = lambda x: F.substring(body, x["start"].cast("int") + 1, (x["stop"] - x["start"]).cast("int"))
    # cut before they are dealt out, so that no text is copied per span
    bytes_ = marked.where(F.size("spans") > 0).select(F.explode(F.transform("spans", lambda x: F.struct(
        x["chunk"].alias("chunk"), part(x).alias("part")))).alias("x")).select("x.chunk", "x.part")
    bytes_ = bytes_.select("chunk", F.when(F.endswith("part", F.lit(b"\n")), F.substring(
        "part", F.lit(1), F.octet_length("part") - 1)).otherwise(F.col("part")).alias("part"))
    unequal = materialise(bytes_.groupBy("chunk").agg(F.min("part").alias("a"), F.max("part").alias("b"))
                          .where("a != b").select("chunk"), "line-unequal")
    going = marked
    if not unequal.isEmpty():  # equal digests of unequal bytes: those chunks stay
        parts = (marked.select("id", "digest", F.explode("spans").alias("span"))
                 .join(unequal, F.col("span.chunk") == unequal["chunk"], "left_anti"))
        parts = parts.groupBy("id", "digest").agg(F.sort_array(F.collect_set("span")).alias("left_spans"))
        going = marked.alias("m").join(
            parts.alias("p"), F.expr("m.id <=> p.id AND m.digest = p.digest"), "left").select(
            "m.id", "m.digest", "m.text", "m.rest", F.coalesce(
                "left_spans", F.array().cast(marked.schema["spans"].dataType)).alias("spans"))
    going = going.withColumn("spans", F.transform(F.filter("spans", lambda x: ~x["stays"]),
                                                  lambda x: F.struct(x["start"], x["stop"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, gone = [], []
            for text, spans in zip(texts_of(b.column(2)), b.column(4).to_pylist()):
                at, kept, runs = 0, [], []
                for s in spans:
                    if runs and s["start"] < at:
                        runs[-1]["stop"] = s["stop"]
                    else:
                        kept.append(text[at:s["start"]])
                        runs.append(s)
                    at = s["stop"]
                out.append(b"".join([*kept, text[at:]]))
                gone.append(runs)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.binary()).cast(pa.string()), b.column(3),
                 pa.array(gone, b.column(4).type)], ["id", "digest", "text", "rest", "spans"])

    def rows_of(frame: DataFrame, changed: bool) -> DataFrame:
        types = {c: docs.schema[c].dataType for c in docs.columns}
        value = lambda c: (F.col("text") if c == "text" else F.length("text") if c == "n_chars" and changed
                           else F.col("rest").getField(c)).cast(types[c]).alias(c)
        return frame.select("id", "digest", F.struct(*[value(c) for c in docs.columns]).alias("row"), "spans")

    touched = going.where(F.size("spans") > 0)
    return rows_of(touched.mapInArrow(run, touched.schema), True).unionByName(
        rows_of(going.where(F.size("spans") == 0), False))


def drop_repeated_lines(docs: DataFrame, every_line: bool = False) -> DataFrame:
    """``dedup_lines`` with the columns of its input, whatever they are called.

    Defined cases: as there; no row goes, a document that loses all its lines
    stays with an empty text.
    """
    return unkeyed(dedup_lines(docs, every_line))
