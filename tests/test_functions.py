import hashlib

import pytest
from pyspark.sql import functions as F

from casegrid.functions import (
    bucketize,
    cast_int,
    cast_round,
    census_region,
    clean_text,
    coarse_event_from_category,
    coarse_event_from_code,
    content_hash,
    naics_sector,
    null_tokens,
    outcome_label,
    ownership_label,
    sas_date,
    sas_timestamp,
    surrogate_key,
    trim_to_null,
)


def one(spark, col, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_surrogate_key_single_column_is_md5_of_text(spark):
    assert one(spark, surrogate_key("x"), [("1001",)]) == [hashlib.md5(b"1001").hexdigest()]


def test_surrogate_key_is_null_safe_and_order_sensitive(spark):
    rows = [("a", None), (None, "a"), (None, None)]
    keys = one(spark, surrogate_key("x", "y"), rows, "x string, y string")
    assert None not in keys and len(set(keys)) == 3
    placeholder = "_dbt_utils_surrogate_key_null_"
    assert keys[0] == hashlib.md5(f"a-{placeholder}".encode()).hexdigest()


def test_content_hash_matches_python(spark):
    sep = "␟"
    got = one(spark, content_hash("x", "y"), [("fell", None)], "x string, y string")[0]
    assert got == hashlib.sha256(f"fell{sep}".encode()).hexdigest()


def test_trim_to_null_strips_spaces_only(spark):
    assert one(spark, trim_to_null("x"), [("  a ",), ("   ",), ("\ta",), (None,)]) == ["a", None, "\ta", None]


def test_clean_text_strips_all_unicode_whitespace(spark):
    vals = [("\t a ",), (" 　",), ("x\u0085",), (None,), ("in side",)]
    assert one(spark, clean_text("x"), vals) == ["a", None, "x", None, "in side"]
    # same as Python's str.strip on every input
    for (v,), got in zip(vals, one(spark, clean_text("x"), vals)):
        assert got == ((v.strip() or None) if v is not None else None)


def test_cast_round_half_away_from_zero(spark):
    assert one(spark, cast_round("x"), [("2.5",), ("-2.5",), ("1.4",), (None,), ("7",)]) == [3, -3, 1, None, 7]


def test_cast_int_strict_rejects_decimal_text(spark):
    assert one(spark, cast_int("x", strict=False), [("1.0",), (" 12 ",), ("E1",)]) == [None, 12, None]
    with pytest.raises(Exception):
        one(spark, cast_int("x"), [("1.0",)])


def test_sas_date_one_and_two_digit_days(spark):
    import datetime as dt
    got = one(spark, sas_date("x"), [("01MAR2024",), ("1MAR2024",), ("28FEB2025",), (None,)])
    assert got == [dt.date(2024, 3, 1), dt.date(2024, 3, 1), dt.date(2025, 2, 28), None]
    assert one(spark, sas_date("x", strict=False), [("31FEB2024",)]) == [None]
    with pytest.raises(Exception):
        one(spark, sas_date("x"), [("not a date",)])


def test_sas_timestamp_is_wall_clock(spark):
    import datetime as dt
    got = one(spark, sas_timestamp("x"), [("04MAR2025:17:09:00",)])
    assert got == [dt.datetime(2025, 3, 4, 17, 9)]
    assert spark.createDataFrame([("04MAR2025:17:09:00",)], "x string").select(
        sas_timestamp("x").alias("t")).schema["t"].dataType.simpleString() == "timestamp_ntz"


def test_null_tokens(spark):
    df = spark.createDataFrame([("N/A", "keep"), ("None", "NA"), ("x", "")], "a string, b string")
    out = [tuple(r) for r in null_tokens(df).collect()]
    assert out == [(None, "keep"), (None, None), ("x", None)]


def test_lookups(spark):
    assert one(spark, naics_sector("x"), [("311812",), ("999999",), (None,)]) == [
        "Manufacturing", "Unknown", "Unknown"]
    assert one(spark, census_region("x"), [("tx",), ("DC",), ("ZZ",), (None,)]) == [
        "South", "South", "Other", "Other"]
    assert one(spark, coarse_event_from_category("x"), [("struck_by_or_against",), ("contact_with_equipment",),
                                                       ("bogus",), (None,)]) == [
        "contact_or_struck", "contact_or_struck", "other", "other"]
    assert one(spark, coarse_event_from_code("x"), [(4210,), (5,), (9999,), (None,)], "x int") == [
        "fall_slip_trip", "exposure", "other", None]
    assert one(spark, outcome_label("x"), [(1,), (4,), (9,), (None,)], "x int") == [
        "Death", "Other recordable", "Unknown", "Unknown"]
    assert one(spark, ownership_label("x"), [(3,), (0,)], "x int") == ["Local government", "Unknown"]


def test_bucketize_boundaries(spark):
    col = bucketize("x", (50, 250, 1000), ("S", "M", "L", "XL"), "U")
    assert one(spark, col, [(None,), (49,), (50,), (249,), (250,), (999,), (1000,)], "x int") == [
        "U", "S", "M", "M", "L", "L", "XL"]


def test_whitespace_set_and_regex_class_agree():
    import re

    from casegrid.functions.clean import PY_WHITESPACE, PY_WHITESPACE_CLASS
    # \x{h} (Java / RE2 syntax) -> \uhhhh (Python syntax)
    cls = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: "\\u%04x" % int(m.group(1), 16),
                            PY_WHITESPACE_CLASS))
    assert "".join(chr(c) for c in range(0x110000) if cls.fullmatch(chr(c))) == PY_WHITESPACE


def test_rule_category_one_pass_equals_per_rule(spark):
    from pyspark.sql import functions as F

    from casegrid.operators.enrich import RULES, keyword_pattern, rule_category
    texts = [("He fell; then a fire.",), ("fire then fell",), ("falling object hit him",), ("éfall",),
             ("carrying",), ("nothing here",), ("", ), (None,), ("Forklift-collision",), ("falls.",)]
    df = spark.createDataFrame(texts, "t string")
    per_rule = None
    for cat, words, _, _ in RULES:
        cond = F.lower("t").rlike(keyword_pattern(words))
        per_rule = F.when(cond, cat) if per_rule is None else per_rule.when(cond, cat)
    got = df.select(rule_category(F.col("t")).alias("a"), per_rule.otherwise("other").alias("b")).collect()
    assert all(r.a == r.b for r in got), got
