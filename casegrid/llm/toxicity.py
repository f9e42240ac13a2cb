"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
A window of words that the toxic dictionary shortens more than the ordinary
one leans toxic; its *gain* is the difference of the two compressed lengths.

Training (on a bounded sample of labelled documents, ``SAMPLE_DOCS`` per class
and ``SAMPLE_BYTES`` of text per class; see ``learn``; the background takes
``BACKGROUND_PIECES`` of it):

* Both dictionaries share a background that zstandard trains on ordinary text,
  so that ordinary words cost the same under either.
* Each class adds its own segments: byte k-mers that are frequent in documents
  of the class and rare in the other class, taken by greedy set cover until
  every document is covered ``COVER`` times, and grown while nine in ten of
  their documents agree on the next byte.
* A logistic regression on a document's largest window gains and its length
  turns gains into a probability, with the classes weighted as in all labels.

Scoring is per document and goes through the whole text: windows of
``COARSE`` words; where a coarse window leans toxic, its windows of ``FINE``
words decide.  Every window starts with the same background bytes, so that a
short window is never stored raw.
"""

from __future__ import annotations

import heapq
import random
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import keyed, text_or_empty, texts_of, unkeyed
from casegrid.session import materialise

SAMPLE_DOCS = 1500
SAMPLE_BYTES = 12_000_000
#: Pieces of 64 bytes, in random order, of the ordinary sample that the background is trained on.
BACKGROUND_PIECES = 60_000
KMER, COVER, LEAST_SHARE, OTHER_RATIO = 5, 3, 0.01, 0.05
BACKGROUND_BYTES = 1 << 15
COARSE, FINE, PREFIX = 10, 2, 48
THRESHOLD = 0.7

_PARAMETERS = dict(compression_level=3, strategy=zstandard.STRATEGY_BTLAZY2, min_match=KMER, window_log=17,
                   hash_log=17, chain_log=17, search_log=4, write_content_size=False,
                   write_checksum=False, write_dict_id=False)


def normal(text: bytes) -> bytes:
    """A-Z lower-cased, white space made single, a space at either end."""
    return b" " + b" ".join(text.lower().split()) + b" "


def _kmers(text: bytes) -> set[bytes]:
    return {text[i:i + KMER] for i in range(len(text) - KMER + 1)}


def _grown(seed: bytes, texts: list[bytes]) -> bytes:
    """``seed`` with the bytes that nine in ten of its documents have next."""
    seg, changed = seed, True
    while changed and len(seg) < 24:
        changed = False
        for left in (True, False):
            seen = Counter()
            for t in texts:
                found, i = set(), t.find(seg)
                while i >= 0:
                    found.add(t[i - 1:i + len(seg)] if left else t[i:i + len(seg) + 1])
                    i = t.find(seg, i + 1)
                seen.update(x for x in found if len(x) > len(seg))
            if seen and (top := seen.most_common(1)[0])[1] >= 0.9 * len(texts):
                seg, changed = top[0], True
    return seg


def class_segments(own: list[bytes], other: list[bytes]) -> list[bytes]:
    """Segments that mark documents of ``own`` against those of ``other``."""
    if not own:
        return []
    least = max(3, LEAST_SHARE * len(own))
    count: Counter = Counter()
    for t in own:
        count.update(_kmers(t))
    count = {k: n for k, n in count.items() if n >= least}
    against: Counter = Counter()
    for t in other:
        against.update(_kmers(t) & count.keys())
    where = defaultdict(list)
    ok = {k for k, n in count.items() if against[k] * len(own) < OTHER_RATIO * n * max(1, len(other))}
    for d, t in enumerate(own):
        for k in _kmers(t) & ok:
            where[k].append(d)
    need, out = [COVER] * len(own), []
    heap = [(-len(v), k) for k, v in where.items()]
    heapq.heapify(heap)
    while heap:
        _, k = heapq.heappop(heap)
        if any(k in s for s in out):
            continue
        worth = sum(need[d] > 0 for d in where[k])
        if worth < least:
            continue
        if heap and -worth > heap[0][0]:
            heapq.heappush(heap, (-worth, k))
            continue
        out.append(_grown(k, [own[d] for d in where[k]]))
        for d in where[k]:
            need[d] -= 1
    return out


def background(texts: list[bytes]) -> bytes:
    """A zstandard dictionary of ordinary text (too little text: the text)."""
    pieces = [t[i:i + 64] for t in texts for i in range(0, len(t), 64)]
    random.Random(0).shuffle(pieces)
    try:
        return zstandard.train_dictionary(BACKGROUND_BYTES, pieces[:BACKGROUND_PIECES], k=48, d=6).as_bytes()
    except zstandard.ZstdError:
        return (b"".join(pieces) + bytes(PREFIX))[:BACKGROUND_BYTES]


@dataclass
class ToxicityModel:
    """Plain bytes and numbers, sent to tasks with the function's closure."""
    shared: bytes
    ordinary: list[bytes]
    toxic: list[bytes]
    weights: list[float] = field(default_factory=list)
    prior: float = 0.5
    _made: tuple | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"} | {"_made": None}

    def _compressors(self):
        if self._made is None:
            ends = [b"".join(reversed(x)) for x in (self.ordinary, self.toxic)]
            size = max(map(len, ends))
            params, made = zstandard.ZstdCompressionParameters(**_PARAMETERS), []
            for end in ends:  # of one length, so that shared matches lie equally far back
                d = zstandard.ZstdCompressionDict(self.shared + end.rjust(size, b"\0"),
                                                  dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params)
                made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)
            self._made = (*made, self.shared[-400:][:PREFIX] + b" ")
        return self._made

    def gains(self, text: bytes) -> list[float]:
        """The three largest window gains of a text, and its log length."""
        ordinary, toxic, prefix = self._compressors()
        words = text.lower().split()
        fine = []
        for i in range(0, max(1, len(words) - 1), COARSE - 1):
            part = words[i:i + COARSE]
            window = prefix + b" ".join(part) + b" "
            if len(ordinary(window)) > len(toxic(window)):
                for j in range(max(1, len(part) - FINE + 1)):
                    window = prefix + b" ".join(part[j:j + FINE]) + b" "
                    fine.append(max(0, len(ordinary(window)) - len(toxic(window))))
        top = sorted(fine, reverse=True)[:2 * 3:2]  # neighbours share words: every other one
        return [*top, *[0.0] * (3 - len(top)), float(np.log1p(len(words)))]

    def scores(self, texts: list[bytes]) -> list[float]:
        if not self.weights:
            return [self.prior] * len(texts)
        x = np.array([self.gains(t) for t in texts], float).reshape(-1, 4)
        return _probability(_features(x), np.array(self.weights)).tolist()


def _features(x: np.ndarray) -> np.ndarray:
    top = np.minimum(x[:, :3], 8)
    return np.column_stack([np.ones(len(x)), top, top[:, :2] ** 2 / 8, x[:, 3]])


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _probability(x, w)
        g = x.T @ (c * (y - p)) - 0.01 * w
        step = np.linalg.solve((x * (c * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.01 * np.eye(len(w)), g)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(toxic: list[bytes], ordinary: list[bytes], n_toxic: int | None = None,
        n_ordinary: int | None = None) -> ToxicityModel:
    """A model from sampled texts; the counts are those of all labels."""
    n_toxic, n_ordinary = n_toxic or len(toxic), n_ordinary or len(ordinary)
    prior = (n_toxic + 1) / (n_toxic + n_ordinary + 2)
    own, other = [normal(t) for t in toxic], [normal(t) for t in ordinary]
    model = ToxicityModel(background(other or own), class_segments(other, own), class_segments(own, other),
                          prior=prior)
    if toxic and ordinary:
        x = np.array([model.gains(t) for t in toxic + ordinary])
        y = np.repeat([1.0, 0.0], [len(toxic), len(ordinary)])
        c = np.where(y == 1, n_toxic / len(toxic), n_ordinary / len(ordinary))
        model.weights = _logistic(_features(x), y, c / c.mean()).tolist()
    return model


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def learn(docs: DataFrame, labels: DataFrame, only=None) -> ToxicityModel:
    """Fit on a bounded sample of the labelled documents.

    Per class the ``SAMPLE_DOCS`` documents with the smallest hash of their
    doc_id, as far as their texts fit in ``SAMPLE_BYTES``; whole texts.  That
    bound is what may come to the driver.  ``only``: a condition on doc_id.
    Null labels, ids and texts are left out; of labels that repeat the largest
    counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("y"))
    known = known.dropna().groupBy("id").agg(F.max("y").alias("y"))
    known = known.where(only(F.col("id"))) if only else known
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    narrow = materialise(rows.groupBy("id").agg(F.max(F.octet_length("text")).alias("size")).join(known, "id"),
                         "toxicity-labelled")
    counts = dict(narrow.groupBy("y").count().collect())
    got: dict[int, list[bytes]] = {0: [], 1: []}
    for y in got:
        first = (narrow.where((F.col("y") == y) & (F.col("size") > 0)).orderBy(F.xxhash64("id"), "id")
                 .limit(SAMPLE_DOCS).collect())
        ids, room = [], SAMPLE_BYTES
        for r in first:
            if r["size"] <= room:
                ids.append(r["id"])
                room -= r["size"]
        if ids:
            texts = rows.where(F.col("id").isin(ids)).groupBy("id").agg(F.max("text").alias("text"))
            found = [r["text"].encode("utf-8", "replace") for r in texts.orderBy("id").select("text").collect()]
            got[y] = list(dict.fromkeys(found))
    return fit(got[1], got[0], counts.get(1, 0), counts.get(0, 0))


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(id, digest, score)`` per row; a null text counts as empty.

    Defined cases: an empty text has no window and takes the score of zero
    gains; very long texts are scored whole; rows that repeat get equal scores; a model without both classes
    gives every text the share of toxic labels; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(model.scores(texts_of(b.column(2))), pa.float64())],
                ["id", "digest", "score"])

    rows = keyed(docs).select("id", "digest", F.col("row.text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, digest binary, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with their columns.

    Defined cases: as ``toxicity_scores``; rows with a null doc_id or text are
    scored like any other, and rows that repeat go or stay together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("row")
            text = b.column(at).field("text").cast(pa.string())
            yield b.filter(pa.array([s < threshold for s in model.scores(texts_of(text))], pa.bool_()))

    rows = keyed(docs).select("row")
    return unkeyed(rows.mapInArrow(run, rows.schema))
