"""SpotSigs document fingerprints.

A signature is a chain of ``CHAIN`` content words that follow a common word
(the anchor), every ``STEP``-th of them.  A document's fingerprint is the set
of its signatures, kept as sorted 32-bit hashes; two fingerprints are compared
by their Jaccard similarity.

``similar_pairs`` finds all pairs of fingerprints of at least a threshold.  It
deals fingerprints out by partitions of set length (sets whose lengths differ
too much can't be similar, so a set meets its own partition and the next), and
within those by their rarest signatures; pairs are compared with early exit.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import text_or_empty, texts_of
from casegrid.session import materialise

#: Common words of English, German, French and Spanish.
ANCHORS = frozenset(w.encode() for w in (
    "a an the and or of to in on at by for with from is are was be been this that it as "
    "der die das und oder ein eine einer einen dem den des zu im mit von für auf ist nicht sich "
    "le la les de du des et ou un une en dans sur par pour avec est que qui au aux "
    "el los las del y o una por con para se su es lo al no").split())
CHAIN, STEP, TAU = 2, 1, 0.8
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def signatures(text: bytes) -> np.ndarray:
    """Sorted distinct 32-bit hashes of a text's signatures.

    A signature is the anchor and its chain, cut short at the end of the text.
    A text without a common word or without a content word has all runs of
    ``CHAIN`` words (fewer words: the whole sequence) as its signatures, and
    one without any word the hash of the text itself; the empty text has the
    empty set.  Case of A-Z does not count.
    """
    words = _WORDS.findall(text.lower())
    content = [w for w in words if w not in ANCHORS]
    crc = zlib.crc32
    if content and len(content) < len(words):
        found, at, span = set(), 0, CHAIN * STEP
        for w in words:
            if w in ANCHORS:
                chain = content[at:at + span:STEP]
                if chain:
                    found.add(crc(b" ".join(chain), crc(w)))
            else:
                at += 1
        if found:
            return np.sort(np.fromiter(found, np.uint32, len(found)))
    if words:
        found = {crc(b" ".join(words[i:i + CHAIN])) for i in range(max(1, len(words) - CHAIN + 1))}
        return np.sort(np.fromiter(found, np.uint32, len(found)))
    return np.array([crc(text)] if text else [], np.uint32)


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Similarity of two sorted sets; 0 where it is below ``least``.  Lengths
    alone bound it from above, so far-off lengths are not compared.  Two empty
    sets are alike."""
    if not len(a) and not len(b):
        return 1.0
    short, long_ = sorted((len(a), len(b)))
    if short < least * long_ or not short:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    got = both / (len(a) + len(b) - both)
    return got if got >= least else 0.0


def fingerprint_text(sig: np.ndarray) -> str:
    """A fingerprint as text: eight hex digits per signature, ascending."""
    return sig.astype(">u4").tobytes().hex()


# ---------------------------------------------------------------------------
# Documents in order
# ---------------------------------------------------------------------------

def in_order_with_next(docs: DataFrame, parts: int | None = None) -> tuple[DataFrame, int]:
    """Rows ``(part, id, text, last)`` sorted by doc_id within ``part``, where
    each part also ends with the first row of the next one (``last``); the
    part after the last is the first.

    The bounds of the parts are quantiles of doc_id.  Only a part's smallest
    row is copied, so each text moves once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # several parts to a task: their hash deals them out more evenly than one each
    parts = parts or PARTS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.unique(rows.approxQuantile("id", [k / parts for k in range(1, parts)], 0.5 / parts)).astype(np.int64)

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(np.int64), side="right").astype(np.int32))

    ids = rows.where("id is not null").withColumn("part", part_of("id"))
    heads = sorted((r["part"], r["low"]) for r in ids.groupBy("part").agg(F.min("id").alias("low")).collect())
    if not heads:
        return ids.select("part", "id", "text", F.lit(False).alias("last")), 0
    # one row per part: bounded by the number of parts
    before = spark.createDataFrame([(low, heads[k - 1][0]) for k, (_, low) in enumerate(heads)], "id long, part int")
    # of rows that share the smallest id the one whose text orders first
    first = rows.join(F.broadcast(before), "id").groupBy("id", "part").agg(F.min("text").alias("text"))
    rows = ids.select("part", "id", "text", F.lit(False).alias("last")).unionByName(
        first.select("part", "id", "text", F.lit(True).alias("last")))
    return rows, len(heads)


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, text string, edited string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
PARTS_PER_TASK = 8
#: Rows taken from a batch at a time, and text held before rows are handed on.
ROWS_AT_ONCE, HELD_BYTES = 128, 1 << 20


def fingerprinted(docs: DataFrame, least: float = 0.0, texts: bool = True) -> DataFrame:
    """Per document its text, its *edited* text (both null where ``texts`` is
    not asked for: they need not leave the task), the number of code points and
    the digest of the edited text, the fingerprints of both as text, and how like the document's is to that of the edited text
    (``near_edited``) and to that of the next document (``near_next``); likeness
    below ``least`` is given as 0.

    The edited text has the last half (rounded down) of the code points
    replaced by as many first ones of the next document by doc_id (all of a
    shorter one); after the last comes the first.  Each document is
    fingerprinted once: a task walks its documents in order and holds one.

    Defined cases: a null text is empty; a row without doc_id has no place in
    the order: it has a fingerprint, and null for all that takes an edited text
    or a next document; very long texts are fingerprinted whole; of rows that share a doc_id the order is that
    of their texts; a single document is its own next one.
    """
    rows, n = in_order_with_next(docs)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 5, *[pa.float64()] * 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, size, part = None, [], 0, None
        for b in batches:
            for k in range(0, b.num_rows, ROWS_AT_ONCE):
                some = b.slice(k, ROWS_AT_ONCE)
                for p, i, text, last in zip(*(some.column(c).to_pylist() for c in range(4))):
                    sig = signatures(text.encode("utf-8", "surrogatepass"))
                    if p != part:
                        held, part = None, p
                    if held is not None:
                        doc, old, own = held
                        half = len(old) // 2
                        edited = old[:len(old) - half] + text[:half]
                        raw = edited.encode("utf-8", "surrogatepass")
                        other = signatures(raw)
                        out.append((doc, len(old), hashlib.sha256(raw).hexdigest(),
                                    *((old, edited) if texts else (None, None)), fingerprint_text(own),
                                    fingerprint_text(other), jaccard(own, other, least), jaccard(own, sig, least)))
                        size += len(old)
                    held = None if last else (i, text, sig)
                if size > HELD_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(t, signatures(t.encode("utf-8", "surrogatepass"))) for t in b.column(0).to_pylist()]
            out = [(None, len(t), None, t if texts else None, None, fingerprint_text(sig), None, None, None)
                   for t, sig in found]
            columns = list(zip(*out)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    unnumbered = (docs.where(F.col("doc_id").cast("long").isNull()).select(text_or_empty().alias("text"))
                  .mapInArrow(alone, SCHEMA))
    if not n:
        return unnumbered
    tasks = min(n, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (rows.repartition(tasks, "part").sortWithinPartitions("part", "last", "id", "text")
            .select("part", "id", "text", "last").mapInArrow(run, SCHEMA).unionByName(unnumbered))


# ---------------------------------------------------------------------------
# All similar pairs
# ---------------------------------------------------------------------------

def fingerprints(docs: DataFrame) -> DataFrame:
    """``(id, sig)`` per document; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([signatures(t).tobytes() for t in texts_of(b.column(1))], pa.binary())],
                ["id", "sig"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, sig binary")


def similar_pairs(docs: DataFrame, tau: float = TAU) -> tuple[DataFrame, DataFrame]:
    """``(classes, pairs)``: ``classes(id, class_id)`` puts documents with
    equal fingerprints into one class, named by its smallest doc_id;
    ``pairs(a, b, likeness)`` are all pairs of classes, ``a < b``, whose
    Jaccard similarity is at least ``tau``.  Rows without doc_id are left out.

    A pair of sets of lengths n <= m is only possible with n >= tau * m, and
    shares one of the first ``n - ceil(tau * n) + 1`` signatures of each set
    in any fixed order, here from rare to frequent over all documents.  Where the
    places of the shared signatures leave too few to follow, a pair is dropped
    before its sets are compared.
    """
    fps = materialise(fingerprints(docs).where("id is not null"), "spot-sigs")
    low = fps.groupBy("sig").agg(F.min("id").alias("class_id"))
    low = materialise(low, "spot-classes")
    classes = fps.join(low, "sig").select("id", "class_id")

    def exploded(batches):
        for b in batches:
            sets = [np.frombuffer(x, np.uint32) for x in b.column(1).to_pylist()]
            n = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(b.column(0).to_numpy(), n), pa.int64()),
                pa.array(np.concatenate([*sets, np.zeros(0, np.uint32)]).astype(np.int64), pa.int64()),
                pa.array(np.repeat(n, n), pa.int32())], ["id", "s", "n"])

    sets = low.select(F.col("class_id").alias("id"), "sig").where(F.length("sig") > 0)
    each = sets.mapInArrow(exploded, "id long, s long, n int")
    counts = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    prefix = F.col("n") - F.ceil(F.lit(tau) * F.col("n") - 1e-9).cast("int") + 1
    ordered = (each.join(counts, "s").groupBy("id", "n")
               .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("all")))
    ordered = materialise(ordered.select("id", "n", F.transform("all", lambda x: x["s"]).alias("sig"), prefix.alias("k")),
                          "spot-ordered")
    # partitions of set length: powers of 1 / tau; a set meets its own and the next
    band = F.floor(F.log(F.col("n").cast("double")) / float(-np.log(tau)) + 1e-9).cast("int")
    heads = ordered.select("id", "n", band.alias("band"), F.posexplode(F.slice("sig", F.lit(1), F.col("k"))))
    left = heads.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("col").alias("s"),
                        F.col("pos").alias("pa"), F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    right = heads.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("col").alias("s"),
                         F.col("pos").alias("pb"), "band")
    # the first shared signature stands at pa and pb: what may still follow bounds the overlap
    left_over = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    most = left_over / (F.col("na") + F.col("nb") - left_over)
    cand = (left.join(right, ["band", "s"])
            .where(((F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
                   & (F.col("na") >= F.col("nb") * tau - 1e-9))
            .groupBy("a", "b").agg(F.max(most).alias("most")).where(F.col("most") >= tau - 1e-9)
            .select("a", "b"))
    load = ordered.select("id", "sig")
    cand = cand.join(load.withColumnsRenamed({"id": "a", "sig": "sa"}), "a").join(
        load.withColumnsRenamed({"id": "b", "sig": "sb"}), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    like = both / (F.size("sa") + F.size("sb") - both)
    pairs = cand.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), like.alias("likeness"))
    return classes, pairs.where(F.col("likeness") >= tau - 1e-9)
