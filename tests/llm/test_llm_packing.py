import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from casegrid.llm import cost_packing as C
from casegrid.llm import fit_packing as B
from casegrid.llm.tokens import ByteIds, WordIds

WORD = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", "  ", "It's A. b,c. D'S x́  y\x1cz\x85w İstanbul ΑΣ. end<|endoftext|>foo", "<|startoftext|>A. B",
       "<|ENDOFTEXT|> 12.34, a.b, C. D", "é. É. é. K. ", "''s 's'll don't. 'S", "x" * 5000,
       "日本 語. ａ. ", "a b c　d", "ŉ ǰ ﬃx İİ ."]


def test_word_ids_equal_the_tokenizer():
    own, other = WordIds(WORD), Tokenizer.from_file(WORD)
    for batch in (ODD, ODD[4:], ODD[:2], ODD[4:5], ODD[8:]):
        got = own([t.encode() for t in batch])
        assert [g.tolist() for g in got] == [other.encode(t, add_special_tokens=False).ids for t in batch]
    for t in ODD:
        assert own([t.encode()])[0].tolist() == other.encode(t, add_special_tokens=False).ids


def test_pieces_fill_sequences_exactly():
    rng = random.Random(1)
    for _ in range(100):
        cap = rng.choice([1, 4, 16, 64])
        lengths = [rng.randrange(0, 3 * cap + 1) for _ in range(rng.randrange(0, 40))]
        seqs = C.pack(lengths, cap)
        sizes = [sum(n for _, _, n in s) for s in seqs]
        assert all(x == cap or x & (x - 1) == 0 and x for x in sizes)
        got = {}
        for s in seqs:
            for d, start, n in s:
                got.setdefault(d, []).append((start, n))
        for d, n in enumerate(lengths):
            at = 0
            for start, k in sorted(got.get(d, [])):
                assert start == at and k > 0
                at += k
            assert at == n


def test_costs_are_balanced():
    rng = random.Random(2)
    lengths = [rng.randrange(10, 800) for _ in range(2000)]
    costs = [sum(C.cost(n) for _, _, n in s) for s in C.pack(lengths) if sum(n for _, _, n in s) == C.CAPACITY]
    in_order, room = [0.0], C.CAPACITY
    for n in lengths:  # the same documents one after the other
        while n:
            k = min(n, room)
            in_order[-1] += C.cost(k)
            n, room = n - k, room - k
            if not room:
                in_order.append(0.0)
                room = C.CAPACITY
    assert np.std(costs) < 0.7 * np.std(in_order[:-1])


def check_pieces(rows, docs, end=(1,)):
    """rows: pieces; docs: Counter of (doc_id, ids)."""
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        assert len(bytes(r["ids"])) == 4 * r["length"]
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == C.CAPACITY or at & (at - 1) == 0
    whole = Counter()
    for (doc, n), pieces in by_doc.items():
        left = sorted(pieces, key=lambda r: (r["start"], bytes(r["ids"])))
        while left:  # rows that repeat give the pieces of several documents
            ids, at = b"", 0
            while at < n:
                k = next(k for k, r in enumerate(left) if r["start"] == at)
                r = left.pop(k)
                ids, at = ids + bytes(r["ids"]), at + r["length"]
            whole[doc, ids] += 1
    assert whole == docs


def wanted(rows):
    other = Tokenizer.from_file(WORD)
    return Counter((r["doc_id"], np.array(
        other.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for r in rows)


def test_edge_rows(edge_docs, no_docs):
    rows = [r for r in edge_docs.collect() if r["doc_id"] not in (9, 13, 14)]
    some = edge_docs.where("doc_id is null or doc_id not in (9, 13, 14)")
    check_pieces(C.cost_packed(some, WordIds(WORD)).collect(), wanted(rows))
    assert C.cost_packed(no_docs, WordIds(WORD)).count() == 0
    total = sum(r["length"] for r in C.cost_packed(edge_docs, WordIds(WORD)).collect())
    assert total == sum(len(k[1]) // 4 * n for k, n in wanted(edge_docs.collect()).items())


def test_query_round_trip(spark):
    from casegrid.llm.queries import op5_packing
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    own = {r["doc_id"]: np.frombuffer(i, "<u4") for r in docs
           for i in [next(iter(wanted([r])))[1]]}
    rows = op5_packing(spark, sf).collect()
    seen, used = Counter(), Counter()
    for r in rows:
        ids = own[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        part = ids[r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        seen[r["doc_id"]] += r["length"]
        used[r["sequence_id"]] += r["length"]
    assert seen == {i: len(x) for i, x in own.items()}
    assert all(n == 2048 or n & (n - 1) == 0 for n in used.values())


# ---------------------------------------------------------------------------
# Best fit
# ---------------------------------------------------------------------------

def slow_best_fit(lengths, cap):
    pieces = sorted(((min(cap, n - s), d, s) for d, n in enumerate(lengths) for s in range(0, n, cap)),
                    key=lambda x: (-x[0], x[1], x[2]))
    left = []
    for n, _, _ in pieces:
        fits = [(r, i) for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(cap - n)
    return sorted(left)


def test_best_fit_equals_a_scan():
    rng = random.Random(3)
    for _ in range(150):
        cap = rng.choice([1, 2, 7, 64, 100])
        lengths = [rng.randint(0, cap * 3) for _ in range(rng.randint(0, 50))]
        seqs = B.best_fit(lengths, cap)
        assert sorted(cap - sum(n for _, _, n in s) for s in seqs) == slow_best_fit(lengths, cap)


def check_matrices(rows):
    whole = {}
    for r in rows:
        ids, pos = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2")
        assert len(ids) == len(pos) == B.CAPACITY
        cu = r["cu_seqlens"]
        assert cu[0] == 0 and cu[-1] == r["n_tokens"] and len(cu) == len(r["doc_ids"]) + 1 == len(r["starts"]) + 1
        assert (ids[cu[-1]:] == B.PAD_ID).all() and (pos[cu[-1]:] == 0).all()
        for d, s, a, e in zip(r["doc_ids"], r["starts"], cu, cu[1:]):
            assert (pos[a:e] == np.arange(e - a)).all()
            whole.setdefault(d, []).append((s, ids[a:e].tolist()))
    return whole


def test_matrices_round_trip(spark, edge_docs, no_docs, tmp_dir):
    coder = ByteIds(RANKS, public_tokenizers.PATTERN)
    one = edge_docs.where("doc_id not in (3, 9, 13, 14)")
    packed = B.fit_packed(one, coder, 50256)
    whole = check_matrices(packed.collect())
    for r in one.collect():
        ids = [i for _, part in sorted(whole[r["doc_id"]]) for i in part]
        assert ids[-1] == 50256 and coder.text(ids[:-1]) == (r["text"] or "")
    B.write_matrices(packed, f"{tmp_dir}/m")
    back = {}
    for r in B.unpacked(spark, f"{tmp_dir}/m").collect():
        back.setdefault(r["doc_id"], []).append((r["start"], list(r["ids"])))
    assert {k: sorted(v) for k, v in back.items()} == {k: sorted(v) for k, v in whole.items()}
    assert B.fit_packed(no_docs, coder, 50256).count() == 0
    every = B.fit_packed(edge_docs, coder, None).collect()
    assert sum(r["n_tokens"] for r in every) == sum(
        len(coder([(r["text"] or "").encode()])[0]) for r in edge_docs.collect())


@pytest.mark.parametrize("wide", [False, True])
def test_query_restores_texts(spark, wide):
    from casegrid.llm.queries import op7_token_matrices
    sf = "/root/testdata/sf0.001"
    coder = ByteIds(RANKS, public_tokenizers.PATTERN)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    if wide:
        rows = B.fit_packed(spark.read.parquet(f"{sf}/documents.parquet"), coder, None, wide=True).collect()
        assert all(len(r["input_ids"]) == 4 * B.CAPACITY for r in rows)
        return
    whole = check_matrices(op7_token_matrices(spark, sf).collect())
    assert {d: coder.text([i for _, part in sorted(x) for i in part][:-1]) for d, x in whole.items()} == docs
