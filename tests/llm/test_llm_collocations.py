import random
import re
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import prose

from casegrid.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = {c: c + 32 for c in range(65, 91)}


def slow(rows, least=30, top=2000):
    """rows: (lang, text) -> result rows, by the definition."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3, 4):
                f.setdefault(lang, Counter()).update(tuple(w[s:s + k]) for s in range(len(w) - k + 1))
    out = []
    for lang in f:
        c, found = f[lang], []
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        around = {}
        for p, a in cands.items():
            for k in range(2, len(p)):
                for s in range(len(p) - k + 1):
                    around[p[s:s + k]] = max(a, around.get(p[s:s + k], 0))
        for p, a in cands.items():
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if 100 * around.get(p, 0) < 80 * a:
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def found(frame, **options):
    out = C.collocations(frame, **options)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def some_rows(seed, n):
    rng = random.Random(seed)
    words = ["New", "new", "york", "City", "Ünder", "ünder", "of", "the", "a\x1cb", "x y", "é", "it's"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "!?", " ; "]
    return [(rng.choice(["en", "de", "", None]), "".join(
        rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("limits", [{}, {"burst": 3, "entries": 40}, {"burst": 1, "entries": 1}])
def test_equals_definition(spark, limits):
    """Tries that burst and spill all the time count the same."""
    rows = some_rows(1, 400)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    want = slow(rows, least=5)
    assert found(frame, least=5, **limits) == want and len(want) > 100
    assert found(frame, least=5, top=7, **limits) == slow(rows, least=5, top=7)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert found(edge_docs) == slow(rows)
    assert found(edge_docs, least=2) == slow(rows, least=2)
    assert found(no_docs) == []


def test_very_long_texts_are_cut_between_pieces(spark, monkeypatch):
    rows = some_rows(2, 30) + [("en", " ".join(t for _, t in some_rows(3, 200)))]
    parts = []
    monkeypatch.setattr(C, "TEXT_BYTES", 200)
    for _, t in rows:
        some = list(C.shorter([t.encode()]))
        assert b"".join(some) == t.encode()
        parts += [("en", x.decode()) for x in some]
    assert len(parts) > 40
    assert slow(parts, 5) == slow([("en", t) for _, t in rows], 5)


def test_trie_bursts_and_spills_whole_subtrees():
    rng = random.Random(4)
    for k in (1, 2, 4):
        trie, want = C.HatTrie(burst=4), Counter()
        for _ in range(30):
            some = Counter(tuple(rng.randrange(5) for _ in range(k)) for _ in range(60))
            trie.add(np.array(list(some), ">u4"), np.array(list(some.values())))
            want += some
        assert trie.entries == len(want)
        assert k == 1 or any(type(x) is C.Node for x in trie.root.values())
        run = dict(zip(*trie.spill(len(want) // 2)))
        assert trie.entries == len(want) - len(run) <= len(want) // 2
        left = dict(zip(*trie.spill(0)))
        assert not {x[:4] for x in run} & {x[:4] for x in left} and not trie.root
        got = {tuple(np.frombuffer(x, ">u4").tolist()): n for x, n in (run | left).items()}
        assert got == dict(want)


def test_phrases_are_added_a_batch_at_a_time():
    """No call per phrase or per first word, and some dozen bytes a phrase."""
    rng = np.random.default_rng(7)
    some = np.unique(rng.integers(0, 20_000, (60_000, 2)), axis=0).astype(">u4")
    trie, counts, calls = C.HatTrie(), np.ones(len(some), np.int64), Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        trie.add(some, counts)
        trie.add(some, counts)
    finally:
        sys.setprofile(None)
    assert trie.entries == len(some) and calls["call"] + calls["c_call"] < len(some) / 4
    assert set(trie.spill(0)[1]) == {2}
    tracemalloc.start()
    try:
        trie.add(some, counts)
        assert tracemalloc.get_traced_memory()[0] < 100 * len(some)
    finally:
        tracemalloc.stop()


def test_array_hash_with_phrases_in_one_slot(monkeypatch):
    monkeypatch.setattr(C, "_mixed", lambda keys: np.full(len(keys), 5))
    rng, bucket, want = random.Random(8), C.Bucket(2), Counter()
    for _ in range(20):
        some = Counter((rng.randrange(6), rng.randrange(6)) for _ in range(30))
        bucket.add(np.array(list(some), np.uint64), np.array(list(some.values())))
        want += some
        assert len(bucket) == len(want)
    keys, counts = bucket.rows()
    assert dict(zip(map(tuple, keys.tolist()), counts.tolist())) == dict(want)


def test_numbers_of_rows_past_64_bits():
    """Four words of a large vocabulary have one number, in the rows' order."""
    rng = np.random.default_rng(9)
    for base in (5, 1 << 22, 1 << 31):
        rows = base - 1 - rng.integers(0, 4, (500, 4))
        order = np.lexsort(rows.T[::-1])
        got = C._in_order(rows, base)[order]
        assert ((np.diff(got) > 0) == (np.diff(rows[order], axis=0) != 0).any(axis=1)).all()
        assert (np.diff(got) >= 0).all()


def test_words_of_raw_bytes():
    texts = [" Ab  c.\td", "", "É\x1c,Z", "e\x85\u00a0f\r\n!g "]
    words, piece = C.words_of([t.encode() for t in texts])
    assert [w.decode() for w in words.to_pylist()] == ["ab", "c", "d", "É\x1c", "z", "e\x85\u00a0f", "g"]
    assert (piece[1:] == piece[:-1]).tolist() == [True] + [False] * 5
    assert len(C.words_of([b"", b" ."])[0]) == len(C.words_of([])[0]) == 0


def test_shared_bits_cost_no_exactness(spark):
    """Many pairs share their bit in a table of few bits."""
    rng = random.Random(5)
    rows = [("en", prose(rng, 400)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    pairs = C.phrase_counts(frame, (1, 2), None, 2).where("phrase LIKE '% %'")
    table = np.frombuffer(C.pair_table(pairs, C.BLOCK_BITS), np.uint8)
    assert int(np.unpackbits(table).sum()) < 0.8 * pairs.count()
    assert found(frame, least=2, table_bits=C.BLOCK_BITS) == slow(rows, least=2)


def test_products_past_64_bits(spark):
    big = 5 * 10 ** 12
    counts = spark.createDataFrame([("en", "", 9 * big, 0), ("en", "a", 3 * big, 1), ("en", "b", 3 * big + 1, 1),
                                    ("en", "a b", 2 * big + 1, 2)], "lang string, phrase string, n long, words int")
    row = C.scored(counts).first()
    assert (row["a"], row["l"], row["r"]) == (2 * big + 1, 3 * big, 3 * big + 1)
    assert row["score"] == 2_000_000 * (2 * big + 1) // (6 * big + 1)


def test_hot_words_and_ties(spark):
    rng = random.Random(6)
    rows = [("en", f"hot {prose(rng, 1)} hot hot. hot tail{i % 40}, tail{i % 40} hot") for i in range(1500)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert found(frame) == slow(rows)


def test_query(spark):
    from casegrid.llm.queries import op11_collocations
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    want = slow(rows)
    assert sorted(tuple(r) for r in op11_collocations(spark, sf).select(COLUMNS).collect()) == want and want
