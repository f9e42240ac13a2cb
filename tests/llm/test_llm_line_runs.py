"""Line dedup against a search for repeated runs of lines that knows no chunks."""

import hashlib
import random
from collections import Counter

from llm_fixtures import prose

from casegrid.llm import line_dedup as L


def slow_runs(rows):
    """rows: (doc_id, text) -> new text; a run of lines grows while the texts
    before it, or its own text before its start, hold its bytes."""
    order = sorted({(-1 if i is None else i, hashlib.md5(t.encode()).digest(), t) for i, t in rows if t is not None})
    before, new = b"", {}
    for i, _, t in order:
        raw = t.encode()
        parts = raw.split(b"\n")
        at = [sum(len(x) + 1 for x in parts[:k]) for k in range(len(parts) + 1)]
        full = [k for k, x in enumerate(parts) if x.strip()]
        gone = set()
        for n, k in enumerate(full):
            for m in full[n + 1:]:
                run = b"\n" + raw[at[k]:at[m + 1]].removesuffix(b"\n") + b"\n"
                if run not in before and run not in b"\n" + raw[:at[k]]:
                    break
                gone.update(range(k, m + 1))
        new[i, t] = b"".join(raw[at[k]:at[k + 1]] for k in range(len(parts)) if k not in gone).decode()
        before += b"\x00\n" + raw + b"\n\x00"
    return [(i, None if t is None else new[-1 if i is None else i, t]) for i, t in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_short_passages_between_other_lines_go(spark):
    rng = random.Random(21)
    rows, left = [], {}
    for k in range(90):
        passage = [prose(rng, rng.randrange(1, 9)) for _ in range(2 + k % 9)]
        for i in (2 * k, 2 * k + 1):
            before, after = ([prose(rng, 6) for _ in range(rng.randrange(1, 4))] for _ in range(2))
            rows.append((i, "\n".join(before + passage + after)))
            left[i] = "\n".join(before + (passage if i % 2 == 0 else []) + after)
    got = {r["id"]: r for r in L.dedup_lines(frame(spark, rows), every_line=True).collect()}
    assert {i: r["row"]["text"] for i, r in got.items()} == left
    assert all(len(r["spans"]) == i % 2 for i, r in got.items())


def test_equals_run_search(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    out = L.drop_repeated_lines(edge_docs, every_line=True)
    assert out.dtypes == edge_docs.dtypes
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(slow_runs(rows))
    assert L.drop_repeated_lines(no_docs, every_line=True).count() == 0
    rng = random.Random(22)  # few lines, so that runs overlap, repeat in a text and meet blank lines
    rows = [(i, "\n".join(rng.choices(("a", "b", "c", "d", "", " "), k=rng.randrange(9)))) for i in range(8)]
    rows += [(9 + i, "\n".join("x" * n)) for i, n in enumerate((3, 4, 7))]
    got = L.drop_repeated_lines(frame(spark, rows), every_line=True).collect()
    assert {r["doc_id"]: r["text"] for r in got} == dict(slow_runs(rows))
    own = [(1, "a\na\na\na\na\n"), (2, "p\nq\nr\np\nq")]
    got = L.drop_repeated_lines(frame(spark, own), every_line=True).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: "a\na\n", 2: "p\nq\nr\n"} == dict(slow_runs(own))


def test_unequal_bytes_of_one_digest_stay(spark, monkeypatch):
    from pyspark.sql import functions as F
    rng = random.Random(23)
    rows = [(i, "\n".join(prose(rng, 6) for _ in range(8))) for i in range(4)]
    real = L.pair_table
    monkeypatch.setattr(L, "pair_table", lambda d: real(d).withColumn("chunk", F.lit(bytes(16))))
    got = L.drop_repeated_lines(frame(spark, rows), every_line=True).collect()
    assert {r["doc_id"]: r["text"] for r in got} == dict(rows)


def test_query(spark):
    from casegrid.llm.queries import op9_line_dedup
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r["doc_id"]: r["text"] for r in op9_line_dedup(spark, sf).collect()} == dict(slow_runs(rows))
