import random
from collections import Counter

from llm_fixtures import prose

from casegrid.llm import line_dedup as L


def slow(rows):
    """rows: (doc_id, text) -> new text, by comparing the chunk bytes."""
    seen = {}
    keyed = sorted({(-1 if i is None else i, L_digest(t), t) for i, t in rows if t is not None})
    for i, d, t in keyed:
        raw = t.encode()
        for s, e, full in L.line_chunks(raw):
            if full >= L.MIN_LINES:
                part = raw[s:e].removesuffix(b"\n")
                seen.setdefault(part, []).append((i, d, s, e))
    gone = {}
    for places in seen.values():
        for i, d, s, e in sorted(places)[1:]:
            gone.setdefault((i, d), []).append((s, e))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None))
            continue
        raw, at, kept = t.encode(), 0, []
        for s, e in sorted(gone.get((-1 if i is None else i, L_digest(t)), [])):
            kept.append(raw[at:s])
            at = e
        out.append((i, b"".join([*kept, raw[at:]]).decode()))
    return out


def L_digest(t):
    import hashlib
    return hashlib.md5(t.encode()).digest()


def test_chunks_cover_the_text():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 40, 300):
        text = "\n".join(prose(rng, rng.randrange(0, 6)) for _ in range(n)).encode()
        chunks = L.line_chunks(text)
        assert b"".join(text[s:e] for s, e, _ in chunks) == text
        assert all(text[s - 1:s] == b"\n" for s, _, _ in chunks if s)


def test_boundaries_resist_shifts():
    rng = random.Random(2)
    passage = [prose(rng, 8) for _ in range(60)]
    one = "\n".join(passage).encode()
    two = "\n".join(["new line", "another"] + passage).encode()
    cut = lambda t: {t[s:e] for s, e, _ in L.line_chunks(t)}
    assert len(cut(one) & cut(two)) >= 0.8 * len(cut(one))


def test_equals_brute_force_on_edge_rows(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    out = L.drop_repeated_lines(edge_docs)
    assert out.columns == edge_docs.columns
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(slow(rows))
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    assert L.drop_repeated_lines(no_docs).count() == 0


def test_hot_chunk(spark):
    rng = random.Random(9)
    # whole chunks repeat wherever boundaries fall, so use the passage as a text
    passage = "\n".join(prose(rng, 7) for _ in range(10))
    rows = [(i, passage if i % 3 == 0 else prose(rng, 20)) for i in range(300)]
    got = {r["id"]: r["row"]["text"] for r in L.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(slow(rows))


def test_unequal_bytes_of_one_digest_stay(spark, monkeypatch):
    """With a digest that always agrees nothing may go: the bytes differ."""
    rng = random.Random(11)
    rows = [(i, "\n".join(prose(rng, 6) for _ in range(8))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = L.chunk_table

    def clash(d):
        from pyspark.sql import functions as F
        return real(d).withColumn("chunk", F.lit(bytes(16)))

    monkeypatch.setattr(L, "chunk_table", clash)
    assert {r["doc_id"]: r["text"] for r in L.drop_repeated_lines(docs).collect()} == dict(rows)


def test_default_form_on_documents(spark):
    """Boundaries picked inside the texts; the query's form is tested in test_llm_line_runs."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"]: r["text"] for r in L.drop_repeated_lines(docs).collect()} == dict(slow(rows))
