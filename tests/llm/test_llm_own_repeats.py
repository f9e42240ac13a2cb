"""The registered substring dedup takes a document's own repeats too."""

import random

from llm_fixtures import prose
from test_llm_substring_dedup import slow

from casegrid.llm.queries import op2_substring_dedup


def test_query_removes_own_repeats(spark, tmp_dir):
    rng = random.Random(31)
    rows = []
    for i in range(20):
        passage = prose(rng, 80)
        rows.append((i, " ".join([prose(rng, 30), passage, prose(rng, 30), passage if i % 2 else "", prose(rng, 30)])))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in op2_substring_dedup(spark, tmp_dir).collect()}
    assert {i: r["text"] for i, r in got.items()} == dict(slow(rows, within=True))
    assert all((got[i]["removed_words"] >= 50) == (i % 2 == 1) for i, _ in rows)
    assert all(got[i]["text"].split()[:100] == t.split()[:100] for i, t in rows)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((r["doc_id"], r["text"]) for r in op2_substring_dedup(spark, sf).collect()) == sorted(slow(rows, True))
