from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from casegrid.llm import decontam as D
from casegrid.llm import line_dedup as L
from casegrid.llm import toxicity as X
from test_llm_line_runs import slow_runs
from test_llm_simhash import slow_fingerprint, slow_groups

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
                                        "packing"]


def test_pipeline_equals_brute_force(spark):
    """Each stage again, on plain Python rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = X.learn(docs, labels, only=lambda i: ~X.held_out(i))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if model.scores([t.encode()])[0] < X.THRESHOLD]
    rows = slow_runs(rows)
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    group = slow_groups(prints)
    rows = [r for r, p in zip(rows, prints) if group[p] == r[0]]
    items = [D.normal(r["text"].encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    block = D.ItemBlock.of(list(enumerate(items)), D.RATE)
    rows = [(i, t) for i, t in rows if not block.found(D.normal(t.encode()))]
    assert not any(x in D.normal(t.encode()) for _, t in rows for x in items)
    other = Tokenizer.from_file(P.public_tokenizers.path(P.WORD_FILE))
    want = {i: np.array(other.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes() for i, t in rows}
    got = {}
    for r in P.run(spark, SF).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    assert {i: b"".join(x for _, x in sorted(p)) for i, p in got.items()} == want


def test_stages_on_edge_rows(spark, edge_docs, no_docs):
    columns = edge_docs.columns
    for docs in (edge_docs, no_docs):
        frame = docs
        for name, stage in P.STAGES:
            out = stage(spark, frame, SF)
            if name != "packing":
                assert out.columns == columns, name
                assert out.dtypes == edge_docs.dtypes, name
            n = out.count()
            assert (n > 0) == (docs is edge_docs), name
            frame = out


def test_line_stage_keeps_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = P.dedup_lines(spark, docs, SF)
    assert Counter(r[0] for r in out.select("doc_id").collect()) == Counter(r[0] for r in docs.select("doc_id").collect())
    assert out.columns == docs.columns and L.MIN_LINES == 2


@pytest.mark.parametrize("name", ["pipeline", "op1_toxicity", "op10_simhash"])
def test_registered(name):
    import __spark_entry__ as entry
    assert name in entry.queries()
