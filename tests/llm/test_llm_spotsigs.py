import hashlib
import random
import zlib

from llm_fixtures import prose

from casegrid.llm import spotsigs as G


def slow_signatures(text):
    """Signatures as word tuples."""
    import re
    words = [w for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.lower())]
    out = set()
    if any(w in G.ANCHORS for w in words):
        for k, w in enumerate(words):
            if w in G.ANCHORS:
                chain = [x for x in words[k + 1:] if x not in G.ANCHORS][:G.CHAIN * G.STEP:G.STEP]
                if chain:
                    out.add((w, *chain))
    if not out:
        out = {tuple(words[i:i + G.CHAIN]) for i in range(max(1, len(words) - G.CHAIN + 1))} if words else {(text,)} - {(b"",)}
    return out


TEXTS = ["", " ", "...", "the", "The of a", "word", "one two three", "the cat and the dog of a house", "Über der ßtraße die katze",
         "cat the dog", "the The tHE x"]


def test_signatures_equal_definition():
    rng = random.Random(1)
    for t in TEXTS + [" ".join(rng.choice(["the", "of", "and", *prose(rng, 3).split()]) for _ in range(80)) for _ in range(30)]:
        assert len(G.signatures(t.encode())) == len(slow_signatures(t.encode())), t


def test_jaccard_and_its_bound():
    rng = random.Random(2)
    import numpy as np
    for _ in range(200):
        a, b = ({rng.randrange(30) for _ in range(rng.randrange(25))} for _ in range(2))
        want = len(a & b) / len(a | b) if a | b else 1.0
        x, y = (np.array(sorted(s), np.uint32) for s in (a, b))
        assert G.jaccard(x, y) == want
        least = rng.random()
        assert G.jaccard(x, y, least) in ((want,) if want >= least else (0.0,))


def slow_rows(rows):
    """rows: (doc_id, text) -> (doc_id, n, sha of edited, near_edited, near_next)."""
    rows = sorted((i, t or "") for i, t in rows if i is not None)
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        like = lambda a, b: G.jaccard(G.signatures(a.encode()), G.signatures(b.encode()))
        out.append((i, t, hashlib.sha256(edited.encode()).hexdigest(), like(t, edited), like(t, nxt)))
    return sorted(out)


def got_rows(frame):
    """Rows in order; those without doc_id have a fingerprint alone."""
    for r in frame.where("doc_id is null").collect():
        assert r["fingerprint"] == G.fingerprint_text(G.signatures(r["text"].encode()))
        assert r["n_chars"] == len(r["text"])
        assert r["edited"] is r["edited_sha256"] is r["edited_fingerprint"] is r["near_edited"] is r["near_next"] is None
    frame = frame.where("doc_id is not null")
    assert all((r["n_chars"], r["edited_sha256"]) == (len(r["text"]), hashlib.sha256(r["edited"].encode()).hexdigest())
               for r in frame.collect())
    return sorted((r["doc_id"], r["text"], hashlib.sha256(r["edited"].encode()).hexdigest(), r["near_edited"],
                   r["near_next"]) for r in frame.collect())


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got_rows(G.fingerprinted(edge_docs)) == slow_rows(rows)
    assert G.fingerprinted(edge_docs).count() == len(rows)
    unnumbered = edge_docs.where("doc_id is null")
    assert got_rows(G.fingerprinted(unnumbered)) == [] and G.fingerprinted(unnumbered).count() == 2
    assert G.fingerprinted(no_docs).count() == 0
    one = spark.createDataFrame([(4, "the one text of it")], "doc_id long, text string")
    assert got_rows(G.fingerprinted(one)) == slow_rows([(4, "the one text of it")])


def test_equal_texts_have_equal_fingerprints(edge_docs):
    by = {}
    for r in G.fingerprinted(edge_docs).collect():
        by.setdefault(r["text"], set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in by.values())


def own_signatures(text):
    """The definition, written without the library's code: what follows each common word."""
    words, now = [], ""
    for c in text + " ":
        if c.isascii() and not c.isalnum():
            words, now = words + [now] * bool(now), ""
        else:
            now += c.lower() if c.isascii() else c
    common = {a.decode() for a in G.ANCHORS}
    parts = []
    for k, w in enumerate(words):
        if w in common:
            chain = [x for x in words[k + 1:] if x not in common][:2]
            if chain:
                parts.append(w + " ".join(chain))
    if not parts:
        parts = [" ".join(words[k:k + 2]) for k in range(max(1, len(words) - 1))] if words else [text] if text else []
    return "".join(f"{x:08x}" for x in sorted({zlib.crc32(p.encode()) for p in parts}))


def test_fingerprints_equal_an_independent_definition(spark, edge_docs):
    """Both fingerprints and both likenesses, from texts alone."""
    def like(a, b):
        a, b = ({x[k:k + 8] for k in range(0, len(x), 8)} for x in (a, b))
        return len(a & b) / len(a | b) if a | b else 1.0

    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for frame in (documents, edge_docs):
        rows = G.fingerprinted(frame).where("doc_id is not null").collect()
        by = sorted((r["doc_id"], r["text"]) for r in rows)
        following = {x: by[(k + 1) % len(by)][1] for k, x in enumerate(by)}
        seen = {}
        for r in rows:
            for text, got in ((r["text"], r["fingerprint"]), (r["edited"], r["edited_fingerprint"])):
                assert got == seen.setdefault(text, own_signatures(text))
            assert r["near_edited"] == like(r["fingerprint"], r["edited_fingerprint"])
            if frame is documents:
                nxt = following[r["doc_id"], r["text"]]
                assert r["near_next"] == like(r["fingerprint"], seen.setdefault(nxt, own_signatures(nxt)))


def test_similar_pairs_equal_all_pairs(spark):
    rng = random.Random(6)
    docs = []
    for k in range(40):
        base = " ".join(rng.choice(["the", "of", *prose(rng, 2).split()]) for _ in range(rng.randrange(1, 120)))
        docs.append(base)
        for _ in range(rng.randrange(0, 4)):
            w = base.split()
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            docs.append(" ".join(w))
    docs += ["", "", "?"]
    rows = [(k, t) for k, t in enumerate(docs)] + [(None, docs[0]), (3, docs[3])]
    classes, pairs = G.similar_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    sig = [frozenset(G.signatures(t.encode()).tolist()) for t in docs]
    low = {}
    for k, s in enumerate(sig):
        low[s] = min(low.get(s, k), k)
    assert {(r["id"], r["class_id"]) for r in classes.collect()} == {(k, low[s]) for k, s in enumerate(sig)}
    want = {}
    reps = sorted(low.values())
    for x, a in enumerate(reps):
        for b in reps[x + 1:]:
            both = sig[a] & sig[b]
            if both and len(both) / len(sig[a] | sig[b]) >= G.TAU:
                want[a, b] = len(both) / len(sig[a] | sig[b])
    assert {(r["a"], r["b"]): r["likeness"] for r in pairs.collect()} == want


def test_query(spark):
    from casegrid.llm.queries import op6_fingerprints
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (len(t), s, e, n) for i, t, s, e, n in slow_rows(rows)}
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"])
           for r in op6_fingerprints(spark, sf).collect()}
    assert got == want
