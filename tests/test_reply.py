from casegrid.functions.reply import with_validated

VALID = ('{"contributing_factor": "wet floor", "severity_tier": "moderate", '
         '"event_category": "fall_slip_trip", "recurrence_prevention": '
         '"install anti-slip matting at the sink", "confidence": 0.7}')


def check(spark, reply):
    df = spark.createDataFrame([(reply,)], "reply string")
    return with_validated(df, "reply", "v").select("v.*").collect()[0]


def test_valid_reply(spark):
    r = check(spark, VALID)
    assert r.is_valid and r.event_category == "fall_slip_trip" and r.confidence == 0.7


def test_out_of_range_confidence_rejected(spark):
    r = check(spark, VALID.replace("0.7", "5.0"))
    assert not r.is_valid and r.reject_reason == "confidence_out_of_range" and r.event_category is None


def test_unknown_category_coerced(spark):
    assert check(spark, VALID.replace("fall_slip_trip", "cut_laceration")).event_category == "other"


def test_missing_category_coerced(spark):
    r = check(spark, VALID.replace('"event_category": "fall_slip_trip", ', ""))
    assert r.is_valid and r.event_category == "other"


def test_long_factor_rejected(spark):
    r = check(spark, VALID.replace("wet floor", "x" * 201))
    assert r.reject_reason == "contributing_factor_too_long"
    assert check(spark, VALID.replace("wet floor", "x" * 200)).is_valid


def test_severity_not_coerced(spark):
    assert check(spark, VALID.replace('"moderate"', '"Moderate"')).reject_reason == "severity_tier_invalid"


def test_broken_missing_and_lax_number(spark):
    assert check(spark, '{"contributing_factor": "x').reject_reason == "invalid_json"
    assert check(spark, "[1, 2]").reject_reason == "not_an_object"
    assert check(spark, None).reject_reason == "no_reply"
    no_prev = VALID.replace('"recurrence_prevention": "install anti-slip matting at the sink", ', "")
    assert check(spark, no_prev).reject_reason == "recurrence_prevention_missing"
    assert check(spark, VALID.replace("0.7", '"0.7"')).confidence == 0.7
    assert check(spark, VALID.replace('"wet floor"', "5")).reject_reason == "contributing_factor_missing"
    extra = VALID.replace("}", ', "extra": [1]}')
    assert check(spark, extra).is_valid
    assert check(spark, VALID.replace("0.7", "true")).confidence == 1.0
    assert check(spark, VALID.replace("0.7", "false")).confidence == 0.0
    assert check(spark, VALID.replace("0.7", "null")).reject_reason == "confidence_missing"
