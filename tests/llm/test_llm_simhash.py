import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from casegrid.llm import simhash as S

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text, width=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    runs = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, max_bits=4):
    """rows: (doc_id, fingerprint); component per row."""
    fps = sorted({f for i, f in rows if i is not None})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(fps):
        for b in fps[k + 1:]:
            if bin(a ^ b).count("1") <= max_bits:
                root[find(a)] = find(b)
    low = {}
    for i, f in rows:
        if i is not None:
            low[find(f)] = min(low.get(find(f), i), i)
    return {(i, f): None if i is None else low[find(f)] for i, f in rows}


def unsigned(x):
    return x & (1 << 64) - 1


def test_fingerprint_equals_definition():
    for text in ["", " \t", "One", "a b c", "A b C d", "a b c d a b c d a", "é ß Ñ \x1c x\x85y   z k", "w " * 900]:
        assert S.simhash(text.encode()) == slow_fingerprint(text), text


def test_hash_is_sparks(spark):
    from pyspark.sql import functions as F
    got = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert unsigned(got) == xxhash.xxh64_intdigest(b"one two three", 42)


@pytest.mark.parametrize("n", [10, 1 << 26, 1 << 40])
def test_tables_lose_no_link(n):
    rng = np.random.default_rng(1)
    masks = S.tables_for(n)
    for _ in range(300):
        apart = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(apart & m == 0 for m in masks)


def test_search_equals_all_pairs():
    rng = np.random.default_rng(2)
    codes = [int(x) for x in rng.integers(0, 2**63, 80)]
    for c in codes[:30]:
        codes += [c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(15)]
    codes = np.unique(np.array(codes, np.uint64))
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 4
    want = set(zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1)))))
    i, j = S.search(S.tree(codes), None, 4)
    assert set(zip(i.tolist(), j.tolist())) == want
    half = len(codes) // 3
    i, j = S.search(S.tree(codes[:half]), S.tree(codes[half:]), 4)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near[:half, half:]))))


def test_groups_on_edge_rows(edge_docs):
    got = [(r["id"], unsigned(r["fp"]), r["component"]) for r in S.simhash_groups(edge_docs).collect()]
    rows = [(r["doc_id"], slow_fingerprint(r["text"] or "")) for r in edge_docs.collect()]
    want = slow_groups(rows)
    assert Counter(got) == Counter((i, f, want[i, f]) for i, f in rows)


def test_groups_of_cut_runs(spark, monkeypatch):
    """Groups larger than a run, over many partitions, equal brute force."""
    monkeypatch.setattr(S, "BLOCK", 8)
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**62))
    codes = {base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in range(150)}
    codes = sorted(codes | {int(x) for x in rng.integers(0, 2**62, 60)})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    fps = spark.createDataFrame([(c, c) for c in signed], "fp long, node long")
    edges = {(r["a"], r["b"]) for r in S.links(fps.repartition(5)).collect()}
    root = {c: c for c in signed}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in edges:
        assert bin(unsigned(a) ^ unsigned(b)).count("1") <= 64
        root[find(a)] = find(b)
    want = slow_groups([(k, c) for k, c in enumerate(codes)])
    groups, found = {}, {}
    for (k, c), g in want.items():
        groups.setdefault(g, set()).add(c)
        found.setdefault(find(signed[k]), set()).add(c)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_near_dedup_keeps_one_row_of_each_group(edge_docs, no_docs):
    kept = S.near_dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = [(r["doc_id"], slow_fingerprint(r["text"] or "")) for r in edge_docs.collect()]
    want = slow_groups(rows)
    survivors = Counter((r["doc_id"], slow_fingerprint(r["text"] or "")) for r in kept.collect())
    assert all(n == 1 for (i, _), n in survivors.items() if i is not None)
    assert {k for k in survivors if k[0] is not None} == {k for k in want if k[0] is not None and want[k] == k[0]}
    assert sum(n for (i, _), n in survivors.items() if i is None) == 2
    assert S.near_dedup(no_docs).count() == 0 and S.simhash_groups(no_docs).count() == 0


def test_query_equals_brute_force(spark):
    from casegrid.llm.queries import op10_simhash
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [(r["doc_id"], slow_fingerprint(r["text"] or "")) for r in docs]
    want = slow_groups(rows)
    got = {(r["doc_id"], int(r["fingerprint"], 16)): r["component_id"] for r in op10_simhash(spark, SF).collect()}
    assert got == want
