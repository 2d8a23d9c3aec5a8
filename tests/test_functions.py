from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewater import functions as fn
from tidewater.functions.masking import PHONE


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], schema=[*values]) if values else spark.range(1)
    return df.select(column.alias("c")).first()["c"]


@pytest.mark.parametrize("phone, short, middle", [
    ("13812345678", "138*", "138****5678"), ("12012345678", None, None), ("1381234567", None, None), ("", None, None)])
def test_phone_masks(spark, phone, short, middle):
    assert one(spark, fn.mask_phone(F.col("p")), p=phone) == short
    assert one(spark, fn.mask_phone(F.col("p"), "middle"), p=phone) == middle


def test_masks_of_null_and_mail(spark):
    nothing = F.lit(None).cast("string")
    assert one(spark, fn.mask_phone(nothing)) is None
    assert one(spark, fn.mask_name(nothing)) is None
    assert one(spark, fn.mask_email(F.lit("a.b@c"))) is None
    assert one(spark, fn.mask_email(F.lit("ab@c.de"))) == "*@c.de"
    assert one(spark, fn.mask_email(F.lit("ab@c.de"), "middle")) == "***@c.de"
    assert one(spark, fn.anon(F.lit("12"), PHONE)) is None
    with pytest.raises(ValueError):
        fn.mask_phone(F.lit("x"), "none")


def test_java_hash_matches_the_definition(spark):
    def java(text):
        h = 0
        for ch in text:
            h = (h * 31 + ord(ch)) & 0xFFFFFFFF
        return h

    for text in ["", "a", "user-1234567890", "zzzzzzzzzzzzzzzzzzzzzzz"]:
        assert one(spark, fn.java_string_hash(F.lit(text))) == java(text)
        bucket = (java(text) & 0x7FFFFFFF) % 16
        assert one(spark, fn.salted_key("dim", F.lit(text))) == f"dim_{text}_{bucket:02d}"


def test_hash_mod(spark):
    import hashlib

    want = int(hashlib.md5(b"abc").hexdigest()[-3:], 16) % 128
    assert one(spark, fn.hash_mod(F.lit("abc"), 128)) == f"{want:04d}"
    assert one(spark, fn.hash_mod(F.lit("ABC"), 128, {"abc": "9001"})) == "9001"


def test_times(spark):
    assert one(spark, fn.iso_trim(F.lit("2025-07-09T10:11:12Z"))) == "2025-07-09 10:11:12"
    assert one(spark, fn.ms_to_time(F.lit("1704067200000"))) == "2024-01-01 00:00:00"
    assert one(spark, fn.duration_sec(F.lit("1000"), F.lit("3999"))) == 2
    assert one(spark, fn.fmt_day(F.lit(1704067200))) == one(spark, fn.fmt_day(F.lit(1704067200000))) == "20240101"
    assert one(spark, fn.event_ts(F.lit(0), F.lit(None), F.lit(7))) == 7
    assert one(spark, fn.event_ts(F.lit(0), F.lit(None))) is None
    days = [r[0] for r in fn.day_range(spark, "2024-02-28", "2024-03-01").collect()]
    assert days == [20240228, 20240229, 20240301]


def test_visitor_and_text(spark):
    assert one(spark, fn.visitor_id(F.lit("NULL"), F.lit("m"))) == "m"
    assert one(spark, fn.visitor_id(F.lit(""), F.lit(""), F.lit("top"))) == "top"
    assert one(spark, fn.visitor_id(F.lit("u"), F.lit("m"))) == "u"
    assert one(spark, fn.is_blank(F.lit("  "))) and not one(spark, fn.is_blank(F.lit("x")))
    assert one(spark, fn.last_token(F.lit("a,b,,"))) == "b"
    assert one(spark, fn.last_token(F.lit(",,"))) == ""
    assert one(spark, fn.step_label(F.lit(2), F.lit(None).cast("string"))) is None


def test_rule_text(spark):
    df = spark.createDataFrame([("3201", 100, 2, 10, 8), ("3203", 1, 1, 5, 1), ("3101", 3, 1, 2, 1)],
                               "t string, condition_amount int, condition_num int, benefit_amount int, benefit_discount int")
    assert [r[0] for r in df.select(fn.rule_text(F.col("t"), "32")).collect()] == ["满100元减10元", "减5元", None]


def test_ratio_with_zero_denominator(spark):
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.ratio(F.lit(2), F.lit(3))) == Decimal("0.67")


def test_middle_masks_use_the_merge_patterns(spark):
    assert one(spark, fn.mask_phone(F.lit("14212345678"), "middle")) == "142****5678"
    assert one(spark, fn.mask_phone(F.lit("14212345678"))) is None
    assert one(spark, fn.mask_email(F.lit("a.b@x.org"), "middle")) == "***@x.org"
    assert one(spark, fn.mask_email(F.lit("a.b@x.org"))) is None
