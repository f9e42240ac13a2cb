"""Uniqueness of many columns in one shuffle."""

import pytest
from pyspark.sql import functions as F

from casegrid.operators import quality as Q


def tables(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "y"), (None, "z"), (2, "z"), (2, None), (2, "w")], "k long, v string")
    b = spark.createDataFrame([("1", 1.5), ("2", 1.5), ("3", None)], "k string, d double")
    return a, b


def keys(spark):
    a, b = tables(spark)
    return [("a.k", a, "k"), ("a.v", a, "v"), ("b.k", b, "k"), ("b.d", b, "d"), ("empty", a.limit(0), "k")]


def test_counts_equal_single_checks(spark):
    got = {r["check_name"]: (r["violations"], r["passed"]) for r in Q.report(
        [Q.KeyCheck(n, df, c) for n, df, c in keys(spark)]).collect()}
    want = {n: Q.unique(df, c).count() for n, df, c in keys(spark)}
    assert got == {n: (k, k == 0) for n, k in want.items()}
    assert want == {"a.k": 2, "a.v": 2, "b.k": 0, "b.d": 1, "empty": 0}


def test_equal_values_of_other_columns_do_not_meet(spark):
    df = spark.range(50).select(F.col("id").alias("a"), F.col("id").alias("b"))
    assert Q.repeated_keys([Q.KeyCheck("a", df, "a"), Q.KeyCheck("b", df, "b")]).count() == 0


def test_all_key_checks_share_one_shuffle_of_keys(spark):
    plan = Q.report([Q.KeyCheck(n, df, c) for n, df, c in keys(spark)[:4]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_repeated_key_fails_the_gate(spark):
    a, _ = tables(spark)
    with pytest.raises(Q.QualityGateError, match="a.k"):
        Q.gate(Q.report([Q.KeyCheck("a.k", a, "k"), Q.scan_row_count("a.rows", a)]))
    Q.gate(Q.report([Q.KeyCheck("a.k", a, "k", Q.WARN)]))


def test_counts_from_masks_equal_the_report(spark):
    a, _ = tables(spark)
    rows = [Q.row_not_null("k", "k"), Q.row_accepted("v", "v", ["x", "y"]), Q.row_between("range", "k", 2, 9)]
    failing = Q.violating_rows(a, rows)
    got = {r["check_name"]: r["violations"] for r in Q.mask_counts(failing, rows).collect()}
    scans = [Q.scan_not_null("k", a, "k"), Q.scan_accepted("v", a, "v", ["x", "y"]), Q.scan_between("range", a, "k", 2, 9)]
    assert got == {r["check_name"]: r["violations"] for r in Q.report(scans).collect()} == {"k": 2, "v": 3, "range": 2}
    masks = sorted((r["k"] or 0, r["v"] or "", r[Q.MASK]) for r in failing.collect())
    assert masks == [(0, "y", 1), (0, "z", 3), (1, "x", 4), (1, "y", 4), (2, "w", 2), (2, "z", 2)]
    assert "Exchange" not in failing._jdf.queryExecution().executedPlan().toString()


def test_a_mask_holds_63_checks(spark):
    df = spark.createDataFrame([(1,)], "k int")
    many = [Q.RowCheck(f"c{k}", F.col("k") == (1 if k in (0, 62) else 0)) for k in range(63)]
    assert Q.violating_rows(df, many).first()[Q.MASK] == 1 | 1 << 62
    with pytest.raises(ValueError):
        Q.violating_rows(df, many + many[:1])
