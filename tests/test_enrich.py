from datetime import datetime

import pytest
from pyspark.sql import functions as F

from casegrid.functions.prompt import NARRATIVE_FIELDS
from casegrid.operators.enrich import (
    empty_cache,
    empty_enrichment,
    enrich,
    pandas_classifier,
    rule_classifier,
)

TS = datetime(2025, 1, 15, 8)
VALID = ('{"contributing_factor": "x", "severity_tier": "minor", "event_category": "other", '
         '"recurrence_prevention": "y", "confidence": 0.5}')


def staged(spark, rows):
    cols = ["incident_id", *NARRATIVE_FIELDS, "industry_description"]
    data = [(i, None, None, None, ev, None, None, ind) for i, ev, ind in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))


def fixed_reply(reply):
    def classify(requests):
        return requests.withColumn("reply", F.lit(reply))
    return classify


def counters(res):
    return res.counters.first().asDict()


def test_run_writes_enrichment_rows(spark):
    s = staged(spark, [("a", "slipped", "Warehousing"), ("b", "cut hand", "Manufacturing")])
    res = enrich(s, empty_cache(spark), empty_enrichment(spark), fixed_reply(VALID), TS, "m")
    c = counters(res)
    assert (c["rows_processed"], c["rows_succeeded"], c["rows_failed"]) == (2, 2, 0)
    assert res.target.count() == 2


def test_run_skips_failed_rows_and_continues(spark):
    s = staged(spark, [("a", "slipped", "W"), ("b", "cut hand", "M")])

    def classify(requests):
        return requests.withColumn("reply", F.when(F.col("rep_id") == "a", F.lit(None)).otherwise(F.lit(VALID)))
    res = enrich(s, empty_cache(spark), empty_enrichment(spark), classify, TS, "m")
    c = counters(res)
    assert (c["rows_succeeded"], c["rows_failed"]) == (1, 1)
    assert [r.incident_id for r in res.target.collect()] == ["b"]


def test_second_run_is_all_cache_hits(spark):
    s = staged(spark, [("a", "slipped on ice", "W"), ("b", "slipped on ice", "X"), ("c", "fell off a ladder", "Y")])
    first = enrich(s, empty_cache(spark), empty_enrichment(spark), rule_classifier(), TS, "m")
    c1 = counters(first)
    # duplicate text within one run: one classification, the other row is a hit
    assert c1["texts_classified"] == 2 and c1["rows_from_cache"] == 1
    cache = spark.createDataFrame(first.cache.collect(), first.cache.schema)
    target = spark.createDataFrame(first.target.collect(), first.target.schema)

    def must_not_call(requests):
        return requests.withColumn("reply", F.raise_error(F.lit("model called on a cache hit")).cast("string"))
    second = enrich(s, cache, target, must_not_call, TS, "m")
    c2 = counters(second)
    assert c2["rows_from_cache"] == 3 and c2["texts_classified"] == 0 and c2["rows_failed"] == 0
    assert second.target.count() == 3 and second.cache.count() == cache.count()


def test_failed_row_keeps_older_enrichment(spark):
    s = staged(spark, [("a", "hi", "W")])
    old = spark.createDataFrame([("a", "f", "minor", "other", "p", 0.3, "v1", "old", TS)],
                                empty_enrichment(spark).schema)
    res = enrich(s, empty_cache(spark), old, fixed_reply('{"broken'), TS, "m")
    assert counters(res)["rows_failed"] == 1
    assert [r.model_name for r in res.target.collect()] == ["old"]


def test_pandas_classifier_retries_and_isolates(spark):
    valid = VALID

    def make_client():
        return {"calls": 0}

    def call(client, prompt):
        client["calls"] += 1
        if "boom" in prompt:
            raise ValueError("bad request")          # not retried, row fails
        if "flaky" in prompt and client["calls"] % 2 == 1:
            raise ConnectionError("transient")      # retried
        return valid

    s = staged(spark, [("a", "flaky text", "W"), ("b", "boom text", "W"), ("c", "fine text", "W")])
    classify = pandas_classifier(make_client, call, base_seconds=0.0)
    res = enrich(s, empty_cache(spark), empty_enrichment(spark), classify, TS, "m")
    rows = {r.incident_id: (r.status, r.cause) for r in res.rows.collect()}
    assert rows == {"a": ("classified", None), "b": ("failed", "ValueError: bad request"), "c": ("classified", None)}


def test_cache_key_can_include_the_sector(spark):
    s = staged(spark, [("a", "slipped on ice", "Warehousing"), ("b", "slipped on ice", "Retail")])
    same = counters(enrich(s, empty_cache(spark), empty_enrichment(spark), rule_classifier(), TS, "m"))
    split = counters(enrich(s, empty_cache(spark), empty_enrichment(spark), rule_classifier(), TS, "m",
                            key_includes_sector=True))
    assert (same["texts_classified"], same["rows_from_cache"]) == (1, 1)
    assert (split["texts_classified"], split["rows_from_cache"]) == (2, 0)


def test_model_called_once_per_distinct_text(spark):
    """The answers are stored: reading the rows, the target, the cache and the
    counters of one run never calls the model again."""
    calls = spark.sparkContext.accumulator(0)

    def call(client, prompt):
        calls.add(1)
        return VALID

    s = staged(spark, [("a", "slipped on ice", "W"), ("b", "slipped on ice", "W"),
                       ("c", "fell off a ladder", "W"), ("d", "cut on a blade", "W")])
    res = enrich(s, empty_cache(spark), empty_enrichment(spark),
                 pandas_classifier(lambda: None, call, base_seconds=0.0), TS, "m")
    res.rows.collect()
    assert res.target.count() == 4 and res.cache.count() == 3
    assert counters(res)["texts_classified"] == 3
    assert calls.value == 3


def test_every_text_is_answered_from_its_content(spark):
    from casegrid.operators.enrich import with_rule_reply
    texts = {"": ("minor", "other"), "x": ("minor", "other"), "he died": ("severe", "other"),
             "a" * 9000: ("minor", "other"), "Fell. Broken arm, then swelling": ("serious", "fall_slip_trip"),
             "padding " * 3000 + "sprained at the press": ("moderate", "contact_with_equipment")}
    import json
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in with_rule_reply(df, "t").collect():
        got = json.loads(r.reply)
        assert (got["severity_tier"], got["event_category"]) == texts[r.t]


def test_waits_double_up_to_the_cap():
    from casegrid.operators.enrich import waits
    for bound, w in zip((1, 2, 4, 5, 5), waits(5, 1.0, 5.0)):
        assert 0 <= w <= bound
    assert list(waits(0, 1.0, 5.0)) == []


def test_transient_errors_run_out(spark):
    from casegrid.operators.enrich import ask
    seen = []

    def call(client, prompt):
        seen.append(prompt)
        raise TimeoutError("slow")

    assert ask(call, None, "p", iter([0.0, 0.0]), (TimeoutError,)) == (None, "TimeoutError: slow")
    assert len(seen) == 3


def test_a_restart_asks_only_for_unanswered_texts(spark, tmp_dir):
    import pytest
    s = staged(spark, [(f"i{k}", f"text number {k}", "W") for k in range(12)])
    calls = spark.sparkContext.accumulator(0)
    path = f"{tmp_dir}/answers"

    def dies(requests):
        """Breaks the run off at its third batch."""
        dies.n = getattr(dies, "n", 0) + 1
        reply = F.lit(VALID) if dies.n < 3 else F.raise_error(F.lit("gone")).cast("string")
        return requests.withColumn("reply", reply)

    with pytest.raises(Exception):  # noqa: B017 - Spark's own error
        enrich(s, empty_cache(spark), empty_enrichment(spark), dies, TS, "m", batches=4, answers_path=path)
    stored = spark.read.parquet(path).count()
    assert 0 < stored < 12

    def call(client, prompt):
        calls.add(1)
        return VALID

    res = enrich(s, empty_cache(spark), empty_enrichment(spark),
                 pandas_classifier(lambda: None, call, base_seconds=0.0), TS, "m", batches=4, answers_path=path)
    assert counters(res)["rows_succeeded"] == 12 and calls.value == 12 - stored
    assert res.cache.count() == 12


def test_limit_takes_the_first_ids(spark):
    s = staged(spark, [(f"i{k}", f"text {k}", "W") for k in range(9)])
    res = enrich(s, empty_cache(spark), empty_enrichment(spark), fixed_reply(VALID), TS, "m", limit=4)
    assert sorted(r.incident_id for r in res.rows.collect()) == ["i0", "i1", "i2", "i3"]


def test_requests_carry_instructions_and_use_the_asked_parallelism(spark):
    s = staged(spark, [(f"i{k}", f"text {k}", "W") for k in range(20)])
    seen = {}

    def classify(requests):
        seen["columns"] = requests.columns
        seen["partitions"] = requests.rdd.getNumPartitions()
        return requests.withColumn("reply", F.lit(VALID))

    enrich(s, empty_cache(spark), empty_enrichment(spark), classify, TS, "m", calls=5)
    assert seen["partitions"] == 5 and {"instructions", "prompt", "rep_id"} <= set(seen["columns"])


def prompts(spark, texts):
    return spark.createDataFrame([(f"h{k}", f"r{k}", t) for k, t in enumerate(texts)],
                                 "content_hash string, rep_id string, prompt string").repartition(1)


def test_a_call_that_never_returns_ends_at_its_deadline(spark):
    import time

    def call(client, prompt):
        if "hang" in prompt:
            time.sleep(3600)
        return f"{prompt}!"

    classify = pandas_classifier(dict, call, max_retries=1, base_seconds=0.0, deadline_seconds=0.3, concurrency=2)
    started = time.time()
    rows = {r["prompt"]: r for r in classify(prompts(spark, ["a", "hang 1", "b", "hang 2", "c"])).collect()}
    assert time.time() - started < 60
    assert [rows[p]["reply"] for p in "abc"] == ["a!", "b!", "c!"] and rows["a"]["cause"] is None
    for p in ("hang 1", "hang 2"):
        assert rows[p]["reply"] is None and rows[p]["cause"].startswith("Deadline")


def test_calls_of_a_partition_run_at_the_same_time(spark):
    import time

    def make_client():
        return {"busy": False}

    def call(client, prompt):
        assert not client["busy"]  # no two calls share a client
        client["busy"] = True
        time.sleep(0.4)
        client["busy"] = False
        return prompt

    texts = [f"p{k}" for k in range(24)]
    classify = pandas_classifier(make_client, call, concurrency=12)
    classify(prompts(spark, ["warm"])).collect()
    started = time.time()
    rows = classify(prompts(spark, texts)).collect()
    assert time.time() - started < 0.4 * 24 * 0.8
    assert sorted(r["reply"] for r in rows) == sorted(texts) and all(r["prompt"] == r["reply"] for r in rows)


def test_errors_pass_a_deadline_unchanged():
    from casegrid.operators.enrich import within

    def call(client, prompt):
        raise ValueError(prompt)

    with pytest.raises(ValueError, match="x"):
        within(5.0, call)(None, "x")
    assert within(None, call) is call


@pytest.mark.parametrize("batches", [1, 5])
def test_batches_read_the_staged_texts_once(spark, batches):
    """The texts are staged for the keys and for the misses, however many batches there are."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = staged(spark, [(str(k), f"fell off ladder {k}", "x") for k in range(40)])
    field = NARRATIVE_FIELDS[3]
    result = enrich(rows.withColumn(field, counted(field)), empty_cache(spark), empty_enrichment(spark),
                    rule_classifier(), TS, "m", batches=batches)
    assert result.counters.first()["texts_classified"] == 40
    assert result.updates.count() == result.new_answers.count() == 40
    assert 40 <= seen.value <= 3 * 40  # the hash and the field itself are taken from it
