from pyspark.sql import functions as F

from casegrid.operators.dedupe import latest_per_key
from casegrid.operators.filters import any_present, sample_many, sample_n
from casegrid.operators.merge import insert_if_absent, upsert_by_key


def test_filter_before_sample(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "NEW_NAR_WHAT_HAPPENED string, other int")
    kept = any_present(df, ["NEW_NAR_WHAT_HAPPENED"])
    assert kept.count() == 2
    assert sample_n(kept, 5, 7, "other").count() == 2  # min(n, rows)


def test_sample_is_deterministic_and_partition_independent(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    a = [r.k for r in sample_n(df, 5, 7, "k").collect()]
    b = [r.k for r in sample_n(df.repartition(7), 5, 7, "k").collect()]
    c = [r.k for r in sample_n(df, 5, 8, "k").collect()]
    assert a == b and len(a) == 5 and a != c


def test_a_large_sample_has_the_rows_of_a_small_one(spark):
    df = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), (F.col("id") * 2).alias("v"))
    for n in (1, 2, 999, 2999, 3000, 5000):
        want = sorted((tuple(r) for r in sample_n(df, n, 7, "k").collect()), key=str)
        for border in (1, 4, 100_000):
            got = sorted((tuple(r) for r in sample_many(df, n, 7, "k", border).collect()), key=str)
            assert got == want, (n, border)


def test_a_large_sample_orders_the_border_alone(spark):
    import re
    df = spark.range(0, 200_000, 1, 8).withColumnRenamed("id", "k")
    out = sample_many(df, 100_000, 7, "k", border_rows=1000)
    assert out.count() == out.distinct().count() == 100_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    limits = [int(x) for x in re.findall(r"(?:limit|Limit)[=( ]*([0-9]+)", plan)]
    assert all(x <= 1000 for x in limits)


def test_latest_per_key_text_order_nulls_last_and_ties(spark):
    rows = [("e1", "28FEB2025:10:00:00", "1"), ("e1", "04MAR2025:09:00:00", "2"),
            ("e2", None, "3"), ("e2", "01JAN2024:00:00:00", "4"),
            ("e3", "01JAN2024:00:00:00", "5"), ("e3", "01JAN2024:00:00:00", "6"),
            ("e4", None, "7")]
    df = spark.createDataFrame(rows, "k string, ts string, id string")
    got = {r.k: r.id for r in latest_per_key(df, ["k"], [F.col("ts")], [F.col("id")]).collect()}
    # text order: '28FEB..' sorts after '04MAR..'; nulls last; ties by id desc
    assert got == {"e1": "1", "e2": "4", "e3": "6", "e4": "7"}


def test_upsert_and_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(tuple(r) for r in upsert_by_key(target, updates, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "C")]
    assert sorted(tuple(r) for r in insert_if_absent(target, updates, ["k"]).collect()) == [(1, "a"), (2, "b"), (3, "C")]
    twice = upsert_by_key(upsert_by_key(target, updates, ["k"]), updates, ["k"])
    assert sorted(tuple(r) for r in twice.collect()) == [(1, "a"), (2, "B"), (3, "C")]
