"""Phrase collocations, counted exactly in burstable tries of word ids.

A task gives words numbers of its own and counts the phrases of each length in
a HAT-trie: a shallow trie over the bits of word ids whose leaves are array
hashes, filled a batch at a time.  A container that grows past ``BURST`` entries
becomes a trie node with containers by the next bits that tell its phrases
apart.  When a task's tries hold more than ``ENTRIES`` phrases, whole subtrees,
the largest first, are spilled as sorted runs of ``(phrase, count)``.  The runs
are dealt out by phrase prefix, the first three words, and merged there.

Words and pairs are counted first.  A phrase of three or four words that
occurs ``LEAST`` times has only pairs that do, so the second pass leaves out
phrases with a pair that does not.  The frequent pairs reach the tasks as a bit
table of fixed size (``TABLE_BITS``) under a hash of the pair: a pair that
shares another's bit costs time, not exactness, and so does a full table.

Everything is per language.  Phrases that are kept are few (``LEAST``
occurrences each); scores and the comparison with longer phrases are joins of
narrow rows, with frequent keys salted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import gathered, slices, text_or_empty
from casegrid.operators.joins import balanced_join
from casegrid.session import materialise

LEAST, LONGEST, COVERED, TOP = 30, 4, 80, 2000
SCALE = 2_000_000
BURST, ENTRIES, WORDS = 1 << 16, 1 << 21, 1 << 20
TABLE_BITS, BLOCK_BITS = 27, 15
#: Text that is cut into words at a time.
TEXT_BYTES = 8 << 20
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

_END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
#: Classes of bytes: part of a word, blank, end of a piece.
_WORD, _BLANK, _STOP = range(3)
_CLASS = bytes(_STOP if _END.match(bytes([b])) else _BLANK if b in b" \t" else _WORD for b in range(256))


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts in turn, lower-cased, and a number per word that
    is the same for words of one piece."""
    text = b"\n".join([b"", *texts, b""]).lower()  # of bytes, A to Z only
    kind = np.frombuffer(text.translate(_CLASS), np.uint8)
    inside = kind == _WORD
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, stops = edges[::2], edges[1::2]
    piece = np.cumsum(kind == _STOP, dtype=np.int32)[starts]
    offsets = np.concatenate(([0], np.cumsum(stops - starts)))
    body = np.frombuffer(text, np.uint8)[inside]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)]), piece


def shorter(texts: list[bytes]) -> Iterator[bytes]:
    """The texts, very long ones cut at ends of pieces."""
    for t in texts:
        at = 0
        while len(t) - at > TEXT_BYTES and (end := _END.search(t, at + TEXT_BYTES // 2)):
            yield t[at:end.end()]
            at = end.end()
        yield t[at:] if at else t


class Node(dict):
    """Four bits of a phrase, those from ``shift`` of column ``column`` -> ``Node`` or ``Bucket``."""

    def __init__(self, column: int = 0, shift: int = 0):
        super().__init__()
        self.column, self.shift = column, np.uint64(shift)

    def parts(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The places of the keys by child."""
        digit = (keys[:, self.column] >> self.shift & np.uint64(15)).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        cuts = np.searchsorted(digit[order], np.arange(17))
        yield from ((d, order[s:e]) for d, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s)


class Bucket:
    """An array hash: phrases as rows of 64-bit columns -> counts, by linear
    probing, many phrases at a time.  A free slot counts 0."""

    def __init__(self, columns: int):
        self.size, self.keys, self.counts = 0, np.zeros((8, columns), np.uint64), np.zeros(8, np.int64)

    def __len__(self) -> int:
        return self.size

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.counts)
        return self.keys[used], self.counts[used]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Distinct phrases and how often they occur, once or more."""
        if 3 * (self.size + len(keys)) > 2 * len(self.counts):
            held = self.rows()
            slots = 1 << (3 * (self.size + len(keys)) // 2).bit_length()
            self.size, self.keys = 0, np.zeros((slots, self.keys.shape[1]), np.uint64)
            self.counts = np.zeros(slots, np.int64)
            self._place(*held)
        self._place(keys, counts)

    def _place(self, keys: np.ndarray, counts: np.ndarray) -> None:
        slot, mask = _mixed(keys), len(self.counts) - 1
        slot &= mask
        while len(keys):
            free = self.counts[slot] == 0
            self.keys[slot[free]] = keys[free]  # of several, one stays
            here = (self.keys[slot] == keys).all(axis=1)
            at = slot[here]
            self.size += int(np.count_nonzero(free & here))
            self.counts[at] += counts[here]
            keys, counts, slot = keys[~here], counts[~here], slot[~here] + 1 & mask


def _mixed(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), np.uint64)
    for column in keys.T:
        out = (out ^ column) * _MIX[0]
        out ^= out >> np.uint64(32)
    return (out * _MIX[1] >> np.uint64(24)).astype(np.int64)


class HatTrie:
    """Counts of phrases of one length; a phrase is a row of word ids, two to a
    64-bit column.  Below the root, which goes by bits of the first word, all
    phrases with the same first word are in one subtree."""

    def __init__(self, burst: int = BURST):
        self.burst, self.root, self.entries, self.words = max(burst, 1), Node(), 0, 0

    def add(self, phrases: np.ndarray, counts: np.ndarray) -> None:
        """Distinct phrases, a row of word ids each, and how often they occur."""
        self.words = phrases.shape[1]
        if not self.words:
            raise ValueError("a phrase has a first word")
        ids = np.zeros((len(phrases), self.words + self.words % 2), "<u4")
        ids[:, :self.words] = phrases
        self.entries += self._put(self.root, ids.view("<u8"), counts)

    def _put(self, node: Node, keys: np.ndarray, counts: np.ndarray) -> int:
        """Adds phrases below ``node``; how many of them are new."""
        new = 0
        for digit, at in node.parts(keys):
            child = node.get(digit)
            if child is None:
                child = Bucket(keys.shape[1])
            if type(child) is Node:
                new += self._put(child, keys[at], counts[at])
                continue
            new -= len(child)
            child.add(keys[at], counts[at])
            new += len(child)
            node[digit] = self._burst(child) if len(child) > self.burst else child
        return new

    def _burst(self, full: Bucket) -> Node:
        """A node with buckets for a bucket's phrases, by the first bits that differ."""
        keys, counts = full.rows()
        differ = np.bitwise_or.reduce(keys ^ keys[0])
        column = int(np.flatnonzero(differ)[0])
        bits = int(differ[column])
        node = Node(column, (bits & -bits).bit_length() - 1)
        self._put(node, keys, counts)
        return node

    def _leaves(self, node: Node | Bucket) -> Iterator[Bucket]:
        if type(node) is Bucket:
            yield node
        else:
            for below in node.values():
                yield from self._leaves(below)

    def spill(self, keep: int) -> tuple[list[bytes], list[int]]:
        """Takes out whole subtrees, the largest first, until at most ``keep``
        phrases are left; a phrase comes as four bytes per word."""
        sizes = {digit: sum(map(len, self._leaves(x))) for digit, x in self.root.items()}
        keys, counts = [np.zeros((0, max(self.words + 1 >> 1, 1)), np.uint64)], [np.zeros(0, np.int64)]
        for digit in sorted(sizes, key=sizes.get, reverse=True):
            if self.entries <= keep:
                break
            for leaf in self._leaves(self.root.pop(digit)):
                for held, some in zip((keys, counts), leaf.rows()):
                    held.append(some)
            self.entries -= sizes[digit]
        ids = np.ascontiguousarray(np.concatenate(keys).view("<u4")[:, :self.words], ">u4")
        return ids.view(f"V{max(4 * self.words, 1)}").ravel().tolist(), np.concatenate(counts).tolist()


def _hash_words(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair_bits(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Places in a table of ``2 ** bits`` bits of pairs of hashed words."""
    mixed = (first * _MIX[0]) ^ (second * _MIX[1] + (first >> np.uint64(29)))
    return ((mixed ^ (mixed >> np.uint64(32))) * _MIX[0] >> np.uint64(64 - bits)).astype(np.int64)


def _in_order(rows: np.ndarray, base: int) -> np.ndarray:
    """A number per row of numbers below ``base``: equal for equal rows, else in their order."""
    number, top = rows[:, 0].astype(np.int64), base
    for column in rows.T[1:]:
        if top * base >= 1 << 63:
            number, top = np.unique(number, return_inverse=True)[1], len(number)
        number, top = number * base + column, top * base
    return number


_RUN = "lang string, prefix binary, rest binary, n long"
PREFIX_WORDS = 3


def _values(column: pa.Array) -> list[bytes]:
    """A large binary array without nulls as a list, straight from its buffers."""
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1].tolist()
    body = (column.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
    return [body[a:b] for a, b in zip(at, at[1:])]


class Counter:
    """The tries of a task, one per language and length, with the words' numbers."""

    def __init__(self, burst: int = BURST, entries: int = ENTRIES):
        self.burst, self.entries = burst, entries
        self.tries: dict[tuple[str, int], HatTrie] = {}
        self.total: dict[str, int] = {}
        self.number: dict[bytes, int] = {}
        self.words: list[bytes] = []

    def count(self, lang: str, texts: list[bytes], lengths: tuple[int, ...], table: np.ndarray | None) -> None:
        """Adds the phrases of ``lengths`` words; with a ``table``, those whose
        pairs have their bits set.  With length 1 all words are counted too."""
        words, piece = words_of(texts)
        if not len(words):
            return
        if 1 in lengths:
            self.total[lang] = self.total.get(lang, 0) + len(words)
        coded = words.dictionary_encode()
        distinct = _values(coded.dictionary)
        for w in distinct:
            if w not in self.number:
                self.number[w] = len(self.words)
                self.words.append(w)
        which = coded.indices.to_numpy()
        ids = np.array([self.number[w] for w in distinct], np.uint32)[which]
        near = piece[1:] == piece[:-1]  # a word and the next one are in one piece
        if table is not None:
            hashes = _hash_words(lang, distinct)[which]
            near &= _bits_at(table, _pair_bits(hashes[:-1], hashes[1:], (8 * len(table)).bit_length() - 1))
        for k in lengths:
            held = np.ones(max(len(ids) - k + 1, 0), bool)
            for j in range(k - 1):
                held &= near[j:j + len(held)]
            at = np.flatnonzero(held)
            if not len(at):
                continue
            code = _in_order(which[at[:, None] + np.arange(k)], len(distinct))
            order = np.argsort(code)
            code = code[order]
            cuts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1], [True])))
            phrases = ids[at[order[cuts[:-1]]][:, None] + np.arange(k)]
            self.tries.setdefault((lang, k), HatTrie(self.burst)).add(phrases, np.diff(cuts))

    def held(self) -> int:
        return sum(t.entries for t in self.tries.values())

    def full(self) -> bool:
        return self.held() > self.entries or len(self.words) > WORDS

    def runs(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """Spilled subtrees as sorted runs; all that is left, if ``last`` or
        when the words' numbers are given up too."""
        every, held = last or len(self.words) > WORDS, self.held()
        words = pa.array(self.words, pa.large_binary())
        rank = np.empty(len(words), np.int64)  # of a word by its bytes
        rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        for (lang, k), trie in self.tries.items():
            phrases, counts = trie.spill(0 if every else trie.entries * self.entries // (2 * held))
            ids = np.frombuffer(b"".join(phrases), ">u4").reshape(-1, k).astype(np.int64)
            order = np.argsort(_in_order(rank[ids], len(words)))
            yield from self._run(lang, words, ids[order], np.array(counts, np.int64)[order])
        if every:
            self.tries, self.number, self.words = {}, {}, []
        if last:
            for lang, n in self.total.items():  # the phrase of no words
                yield from self._run(lang, words, np.zeros((1, 0), np.int64), np.array([n], np.int64))

    @staticmethod
    def _run(lang: str, words: pa.Array, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A sorted run as rows: the first three words of a phrase, and the rest of it."""
        def joined(part: np.ndarray) -> pa.Array:
            if not part.shape[1]:
                return pa.repeat(pa.scalar(b"", pa.large_binary()), len(part))
            return pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in part.T], pa.scalar(b" ", pa.large_binary()))

        for s in range(0, len(ids), 16384):
            some = ids[s:s + 16384]
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang), len(some)),
                 joined(some[:, :PREFIX_WORDS]).cast(pa.binary()), joined(some[:, PREFIX_WORDS:]).cast(pa.binary()),
                 pa.array(counts[s:s + 16384])], ["lang", "prefix", "rest", "n"])


def _bits_at(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def phrase_counts(docs: DataFrame, lengths: tuple[int, ...], table=None, least: int = LEAST, burst: int = BURST,
                  entries: int = ENTRIES) -> DataFrame:
    """``(lang, phrase, n)`` of the phrases of ``lengths`` words that occur
    ``least`` times, and with length 1 the empty phrase, which counts all words;
    ``table`` is a broadcast bit table of pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(burst, entries)
        bits = None if table is None else np.frombuffer(table.value, np.uint8)
        for langs, texts in gathered(batches, TEXT_BYTES):
            order = sorted(range(len(texts)), key=langs.__getitem__)
            for lang, some in groupby(order, key=langs.__getitem__):
                parts = list(shorter([texts[i] for i in some]))
                for s, e in slices(parts, TEXT_BYTES):
                    counter.count(lang, parts[s:e], lengths, bits)
                    if counter.full():
                        yield from counter.runs()
        yield from counter.runs(last=True)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty().alias("text"))
    # a shuffle by prefix; the counts of a prefix's phrases are merged where they arrive
    counts = (rows.mapInArrow(run, _RUN).repartition("lang", "prefix")
              .groupBy("lang", "prefix", "rest").agg(F.sum("n").alias("n"))
              .where((F.col("n") >= least) | (F.octet_length("prefix") == 0)))
    text = lambda c: F.col(c).cast("string")
    return counts.select("lang", F.when(F.octet_length("rest") == 0, text("prefix")).otherwise(
        F.concat_ws(" ", text("prefix"), text("rest"))).alias("phrase"), "n")


def pair_table(pairs: DataFrame, table_bits: int = TABLE_BITS) -> bytes:
    """The bit table of ``pairs(lang, phrase)``: blocks are put together in
    tasks, the driver joins a fixed number of them."""
    blocks = 1 << table_bits - BLOCK_BITS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, pairs = b.column(0).to_pylist(), [x.split(b" ") for x in b.column(1).to_pylist()]
            at = np.zeros(len(langs), np.int64)
            for lang in set(langs):
                some = [i for i, x in enumerate(langs) if x == lang]
                at[some] = _pair_bits(*(_hash_words(lang, [pairs[i][j] for i in some]) for j in (0, 1)), table_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> BLOCK_BITS).astype(np.int32)), pa.array((at & (1 << BLOCK_BITS) - 1).astype(np.int32))],
                ["block", "place"])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: dict[int, np.ndarray] = {}
        for b in batches:
            block, place = (c.to_numpy() for c in b.columns)
            for k in np.unique(block):
                part.setdefault(int(k), np.zeros(1 << BLOCK_BITS, bool))[place[block == k]] = True
                if len(part) > 64:  # rows come by block: the earlier ones are done
                    old = next(iter(part))
                    yield _block(old, part.pop(old))
        for k, bits in part.items():
            yield _block(k, bits)

    def _block(k: int, bits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array(
            [np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

    rows = pairs.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(places, "block int, place int")
    done = (rows.distinct().repartition("block").sortWithinPartitions("block")
            .mapInArrow(filled, "block int, bits binary"))
    out = bytearray(blocks << BLOCK_BITS - 3)
    for r in done.toLocalIterator():
        at = r["block"] << BLOCK_BITS - 3
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out)


def frequent_phrases(docs: DataFrame, least: int = LEAST, burst: int = BURST, entries: int = ENTRIES,
                     table_bits: int = TABLE_BITS) -> DataFrame:
    """``(lang, phrase, n, words)`` of all phrases of at most four words that
    occur ``least`` times, with the empty phrase per language."""
    spark = docs.sparkSession
    short = materialise(phrase_counts(docs, (1, 2), None, least, burst, entries), "words")
    table = spark.sparkContext.broadcast(pair_table(short.where("phrase LIKE '% %'"), table_bits))
    long = materialise(phrase_counts(docs, (3, LONGEST), table, least, burst, entries), "phrases")
    table.destroy()
    return short.unionByName(long).withColumn("words", F.when(F.col("phrase") == "", 0).otherwise(
        F.size(F.split("phrase", " "))))


def _key(phrase) -> F.Column:
    return F.concat_ws("\n", "lang", phrase)  # a phrase holds no line break


def scored(counts: DataFrame) -> DataFrame:
    """``(lang, phrase, a, l, r, score)`` of the phrases of two words or more,
    at the cut with the lowest score."""
    words = F.split("phrase", " ")
    cuts = (counts.where("words >= 2").select("lang", "phrase", F.col("n").alias("a"), F.explode(
        F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
        .select("*", _key(F.array_join(F.slice(words, 1, F.col("cut")), " ")).alias("first"),
                _key(F.array_join(F.slice(words, F.col("cut") + 1, LONGEST), " ")).alias("rest")))
    parts = counts.where("words BETWEEN 1 AND 3").select(_key("phrase").alias("part"), "n")
    cuts = materialise(cuts, "cuts")
    one = F.concat_ws("\n", "lang", "phrase", "cut")
    for name, out in (("first", "l"), ("rest", "r")):
        cuts = balanced_join(cuts, parts.select(F.col("part").alias(name), F.col("n").alias(out)), name, one, "inner")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    value = cuts.select("lang", "phrase", "a", "cut", "l", "r", (wide("a") * F.lit(SCALE)).alias("above"),
                        (wide("l") + wide("r")).alias("below")).withColumn("score", F.expr("above div below"))
    best = value.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("x"))
    return best.select("lang", "phrase", "x.a", "x.l", "x.r", "x.score")


def uncovered(candidates: DataFrame, counts: DataFrame, covered: int = COVERED) -> DataFrame:
    """The candidates without a longer phrase around them that has ``covered``
    per cent of their occurrences."""
    words = F.split("phrase", " ")
    inner = F.expr("flatten(transform(sequence(2, words - 1), k -> transform(sequence(1, words - k + 1), "
                   "s -> array_join(slice(w, s, k), ' '))))")
    around = (counts.where("words >= 3").select("lang", "n", "words", words.alias("w"))
              .select("lang", "n", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("n").alias("around")))
    both = candidates.join(around, ["lang", "phrase"], "left")
    wide = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by)
    return both.where(F.col("around").isNull() | (wide("around", 100) < wide("a", covered))).drop("around")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, burst: int = BURST,
                 entries: int = ENTRIES, table_bits: int = TABLE_BITS) -> DataFrame:
    """Each language's ``top`` phrases of two to four words that occur
    ``least`` times: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n``
    all words; the score is ``floor(2000000 a / (l + r))``.

    Defined cases: a null text is empty, a null lang ``und``; an empty text has
    no words; very long texts and words count whole; rows that repeat count as
    often as they occur; equal scores are ordered by ``a`` descending, then by
    the phrase's bytes; a language without a frequent phrase gives no rows; the
    doc_id and extra columns are not read; an empty table gives no rows.
    """
    counts = frequent_phrases(docs, least, burst, entries, table_bits)
    kept = materialise(uncovered(scored(counts), counts, covered), "collocations")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for salts in (parts, int(parts ** 0.5)):  # the first of each part, then of fewer parts, at last of all
        salt = F.pmod(F.xxhash64("phrase"), F.lit(max(salts, 1)))
        kept = kept.withColumn("_rank", F.row_number().over(
            Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("_rank") <= top).drop("_rank")
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    total = counts.where("words = 0").select("lang", "n")
    return kept.where(F.col("rank") <= top).join(total, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
