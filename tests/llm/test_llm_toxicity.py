import random
import zlib

from llm_fixtures import prose

from casegrid.llm import toxicity as X

SF = "/root/testdata/sf0.01"


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = prose(rng, rng.randrange(5, 80)).split()
        if k % 4 == 0:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["zonkhead", "Blurgwit", "vexoid"]))
        out.append((" ".join(words), int(k % 4 == 0)))
    return out


def test_learns_planted_words_and_holds_out():
    seen, unseen = corpus(600, 1), corpus(400, 2)
    model = X.fit([t.encode() for t, y in seen if y], [t.encode() for t, y in seen if not y])
    scores = model.scores([t.encode() for t, _ in unseen])
    right = sum((s >= X.THRESHOLD) == bool(y) for s, (_, y) in zip(scores, unseen))
    assert right >= 0.97 * len(unseen)
    assert all(0 <= s <= 1 for s in scores)


def test_window_late_in_a_long_text_counts():
    seen = corpus(600, 1)
    model = X.fit([t.encode() for t, y in seen if y], [t.encode() for t, y in seen if not y])
    rng = random.Random(8)
    long_ = prose(rng, 20_000)
    clean, late = model.scores([long_.encode(), (long_ + " zonkhead vexoid blurgwit " + prose(rng, 30)).encode()])
    assert late > clean


def test_models_without_a_class():
    for toxic, ordinary in (([], []), ([b"a b"], []), ([], [b"a b", b"c"])):
        model = X.fit(toxic, ordinary)
        scores = model.scores([b"", b"some text"])
        assert scores[0] == scores[1] and 0 < scores[0] < 1


def test_edge_rows_and_learning(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(0, 0, 1), (2, 1, 0), (7, 1, 0), (8, 1, None), (None, 0, 1), (0, 0, 0), (99, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = X.learn(edge_docs, labels)
    rows = X.toxicity_scores(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r["id"], bytes(r["digest"])), set()).add(r["score"])
    assert all(len(s) == 1 for s in by.values())
    kept = X.drop_toxic(edge_docs, model)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["score"] < X.THRESHOLD for r in rows)
    assert X.toxicity_scores(no_docs, model).count() == 0 and X.drop_toxic(no_docs, model).count() == 0
    assert X.learn(no_docs, labels.limit(0)).weights == []


def test_query_holds_out_a_third_and_beats_the_base_rate(spark):
    from casegrid.llm.queries import op1_toxicity
    rows = {r["doc_id"]: r for r in op1_toxicity(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert set(rows) == {r["doc_id"] for r in docs}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows.values())
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(rows[i], y) for i, y in labels.items() if rows[i]["held_out"]]
    right = sum(r["predicted"] == y for r, y in held) / len(held)
    base = sum(y == 0 for _, y in held) / len(held)
    assert right > base + 0.05 and right >= 0.9
    assert not any(r["predicted"] and not y for r, y in held)
