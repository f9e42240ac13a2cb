import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from casegrid.llm import sum_squares as S
from casegrid.llm.tokens import WordIds

IDS = WordIds(public_tokenizers.path("word_bpe_49k.json"))


def slow_pack(lengths, capacity):
    """Tries every open sequence and a new one, and adds all squares up."""
    gaps, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n, best = lengths[i], None
        for s in [*range(len(gaps)), None]:
            after = [*gaps, capacity] if s is None else gaps[:]
            at = len(after) - 1 if s is None else s
            if after[at] < n or s is not None and not gaps[s]:
                continue
            left = after[at]
            after[at] -= n
            squares = sum(after.count(g) ** 2 for g in set(after) if g)
            choice = (squares, s is None, left)
            if best is None or choice < best[0]:
                best = choice, left, after
        gaps = best[2]
        out[i] = capacity - best[1]
    return len(gaps), out


@pytest.mark.parametrize("capacity", [8, 13, 30])
def test_places_where_the_squares_are_smallest(capacity):
    rng = random.Random(capacity)
    for _ in range(30):
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(0, 40))]
        at = S.pack(lengths, capacity)
        n, offsets = slow_pack(lengths, capacity)
        assert [o for _, o in at] == offsets and len({s for s, _ in at}) == n
        check_gapless([(s, o, n) for (s, o), n in zip(at, lengths)], capacity)


def check_gapless(places, capacity):
    used = {}
    for s, o, n in sorted(places):
        assert o == used.get(s, 0)
        used[s] = o + n
    assert all(n <= capacity for n in used.values())


def test_fills_sequences(spark):
    rng = random.Random(2)
    lengths = [min(4096, int(rng.lognormvariate(6, 1.3)) + 1) for _ in range(20_000)]
    into = S.OpenSequences(4096)
    places = []
    for k in range(0, len(lengths), S.BATCH):
        places += S.pack(lengths[k:k + S.BATCH], 4096, into)
    check_sizes = {}
    for (s, _), n in zip(places, lengths):
        check_sizes[s] = check_sizes.get(s, 0) + n
    assert max(check_sizes.values()) <= 4096
    assert into.made <= 1.002 * -(-sum(lengths) // 4096)


def check(rows, docs, capacity=4096):
    """The definition: ids by the tokenizer, cut only where too long."""
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, text in docs:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, p, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
                 for p, s in enumerate(range(0, len(ids), capacity))]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows], key=key) \
        == sorted(want, key=key)
    check_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], capacity)
    return -(-sum(x[3] for x in want) // capacity)


def test_edge_rows(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    rows = S.sum_of_squares_packed(edge_docs, IDS, with_ids=True).collect()
    least = check(rows, docs)
    assert len({r["sequence_id"] for r in rows}) <= least + 1
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    assert S.sum_of_squares_packed(no_docs, IDS).count() == 0
    check(S.sum_of_squares_packed(edge_docs, IDS, capacity=64, group_tokens=1000).collect(), docs, 64)
    assert S.sum_of_squares_packed(edge_docs.where("text = ''"), IDS, None).count() == 0


def test_query(spark):
    from casegrid.llm.queries import op12_best_fit
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = op12_best_fit(spark, sf).collect()
    least = check(rows, docs)
    assert len({r["sequence_id"] for r in rows}) <= 1.01 * least + 1
