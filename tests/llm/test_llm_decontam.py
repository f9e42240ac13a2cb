import random
from collections import Counter

import pytest
from llm_fixtures import prose

from casegrid.llm import decontam as D


def slow_distance(item, text):
    """Least edit distance of item to any part of text, by the full table."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        cur = [i]
        for j, x in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (c != x), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = "q"
        elif kind == 1:
            out.insert(k, "j")
        else:
            del out[k]
    return "".join(out)


def test_gram_keys_tell_grams_apart():
    text = bytes(random.Random(1).choices(b"abc ", k=2000))
    keys = D.gram_keys(text)
    by = {}
    for i in range(len(text) - D.Q + 1):
        by.setdefault(text[i:i + D.Q], set()).add(int(keys[i]))
    assert all(len(v) == 1 for v in by.values())
    assert len({min(v) for v in by.values()}) == len(by)
    assert len(D.gram_keys(b"short")) == 0


def test_found_equals_brute_force():
    """Every item within the budget is found, and no other."""
    rng = random.Random(5)
    items = [(k, prose(rng, rng.randrange(9, 25)).encode()) for k in range(12)] + [(99, b"tiny"), (98, b"")]
    block = D.ItemBlock.of(items, D.RATE)
    for _ in range(60):
        k = rng.randrange(12)
        item = items[k][1].decode()
        part = edited(rng, item, rng.randrange(0, 2 + int(len(item) * D.RATE * 1.3)))
        text = D.normal(f"{prose(rng, rng.randrange(0, 40))} {part.upper()}\n {prose(rng, rng.randrange(0, 40))}".encode())
        got = {i: e for i, e, _, _ in block.found(text)}
        for x, body in items[:12]:
            want = slow_distance(D.normal(body), text)
            if want <= D.budget(len(D.normal(body))):
                assert got[x] == want
            else:
                assert x not in got


@pytest.mark.parametrize("blocks", [False, True])
def test_edge_rows(spark, edge_docs, no_docs, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(D, "BLOCK_BYTES", 10)
    texts = {r["doc_id"]: r["text"] for r in edge_docs.collect()}
    items = spark.createDataFrame(
        [(1, texts[0][20:150]), (1, texts[8][:120]), (2, None), (3, ""), (4, "word"), (None, texts[0][:90]),
         (5, texts[0][20:150])], "item_id long, text string")
    hits = D.contamination(edge_docs, items).collect()
    got = Counter((r["id"], r["item_id"]) for r in hits)
    want = Counter()
    held = {t for _, t in items.distinct().collect() if t}
    for r in edge_docs.collect():
        for x, body in items.distinct().dropna().collect():
            body, text = D.normal(body.encode()), D.normal((r["text"] or "").encode())
            if body and (body in text if len(body) >= D.Q else b" " + body + b" " in b" " + text + b" "):
                want[r["doc_id"], x] += 1
    assert got == want and held
    kept = D.drop_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns
    bad = {(i, t) for (i, _), t in [((r["id"], r["item_id"]), bytes(r["digest"])) for r in hits]}
    assert kept.count() == edge_docs.count() - sum(
        1 for r in D.keyed(edge_docs).select("id", "digest").collect() if (r["id"], bytes(r["digest"])) in bad)
    assert D.contamination(no_docs, items).count() == 0
    assert D.contamination(edge_docs, items.limit(0)).count() == 0
    assert D.drop_contaminated(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_short_items_are_matched_on_word_bounds():
    block = D.ItemBlock.of([(1, b"Two  words"), (2, b"a b"), (3, b"b"), (4, b"a b"), (5, b"")], D.RATE)
    assert block.found(b"x a b c a b") == [(2, 0, 2, 5), (4, 0, 2, 5), (3, 0, 4, 5)] or sorted(
        block.found(b"x a b c a b")) == [(2, 0, 2, 5), (3, 0, 4, 5), (4, 0, 2, 5)]
    assert [x[0] for x in block.found(b"two words")] == [1] and block.found(b"ab bb") == [] == block.found(b"")


def test_repetitive_text_takes_bounded_memory():
    """Each of the text's many q-grams meets each of its many places in the item."""
    import tracemalloc
    block = D.ItemBlock.of([(1, b"ha " * 330), (2, prose(random.Random(1), 30).encode())], D.RATE)
    for n in (2_000, 20_000):
        text = D.normal(b"ha " * n)
        tracemalloc.start()
        got = block.found(text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert [x[:2] for x in got] == [(1, 0)]
        assert peak < 200 << 20


def test_near_matches_in_parts_equal_the_full_table(monkeypatch):
    """With parts of a few pairs the counts add up to the same."""
    monkeypatch.setattr(D, "PART", 7)
    test_found_equals_brute_force()


def test_many_blocks_cost_one_scan(spark, monkeypatch, tmp_dir):
    """The documents are read once, and near matches of every block equal the full table."""
    rng = random.Random(8)
    items = [(k, prose(rng, rng.randrange(8, 14))) for k in range(10)]
    rows = []
    for i in range(50):
        part = items[i % 10][1]
        part = edited(rng, part, rng.randrange(0, 2 + int(len(part) * D.RATE))) if i % 3 else prose(rng, 12)
        rows.append((i, f"{prose(rng, 20)} {part} {prose(rng, 20)}"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/d")
    docs = spark.read.parquet(f"{tmp_dir}/d")
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    out = D.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert not any(f"{tmp_dir}/d" in f for f in out.inputFiles())  # they were read, once, for the stored candidates
    got = {(r["id"], r["item_id"]): r["edits"] for r in out.collect()}
    want = {}
    for i, text in rows:
        for k, body in items:
            body, e = D.normal(body.encode()), slow_distance(D.normal(body.encode()), D.normal(text.encode()))
            if e <= D.budget(len(body)):
                want[i, k] = e
    assert got == want and len(want) > 15


def test_query_equals_containment(spark):
    from casegrid.llm.queries import op4_decontamination
    sf = "/root/testdata/sf0.001"
    got = {(r["doc_id"], r["item_id"]) for r in op4_decontamination(spark, sf).collect()}
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items
            if D.normal(i["text"].encode()) in D.normal((d["text"] or "").encode())}
    assert want <= got
    items, docs = {i["item_id"]: i["text"] for i in items}, {d["doc_id"]: d["text"] for d in docs}
    for d, i in got - want:
        body = D.normal(items[i].encode())
        assert slow_distance(body, D.normal(docs[d].encode())) <= D.budget(len(body))
