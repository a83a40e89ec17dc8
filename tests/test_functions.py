import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from buyerlens.functions import bands, calendar, scores, text


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def day(d):
    return F.lit(d).cast("date")


@pytest.mark.parametrize(
    "d,sign",
    [
        ("2001-12-21", "射手座"), ("2001-12-22", "摩羯座"), ("2001-01-01", "摩羯座"), ("2001-01-19", "摩羯座"),
        ("2001-01-20", "水瓶座"), ("2001-02-18", "水瓶座"), ("2001-02-19", "双鱼座"), ("2000-02-29", "双鱼座"),
        ("2001-03-20", "双鱼座"), ("2001-03-21", "白羊座"), ("2001-04-19", "白羊座"), ("2001-04-20", "金牛座"),
        ("2001-05-20", "金牛座"), ("2001-05-21", "双子座"), ("2001-06-21", "双子座"), ("2001-06-22", "巨蟹座"),
        ("2001-07-22", "巨蟹座"), ("2001-07-23", "狮子座"), ("2001-08-22", "狮子座"), ("2001-08-23", "处女座"),
        ("2001-09-22", "处女座"), ("2001-09-23", "天秤座"), ("2001-10-23", "天秤座"), ("2001-10-24", "天蝎座"),
        ("2001-11-22", "天蝎座"), ("2001-11-23", "射手座"), ("2001-12-31", "摩羯座"),
    ],
)
def test_zodiac(spark, d, sign):
    assert one(spark, calendar.zodiac(day(d))) == sign


@pytest.mark.parametrize(
    "birth,now,years",
    [
        ("2000-02-29", "2001-02-28", 0), ("2000-02-29", "2001-03-01", 1), ("2000-02-29", "2004-02-29", 4),
        ("1999-01-09", "2025-01-08", 25), ("1999-01-09", "2025-01-09", 26),
    ],
)
def test_age(spark, birth, now, years):
    assert one(spark, calendar.age(day(birth), day(now))) == years


def test_birthday_and_decade(spark):
    assert one(spark, calendar.birthday(F.lit(13826))) == dt.date(2007, 11, 9)
    assert one(spark, calendar.birthday(F.lit(None).cast("int"))) is None
    assert one(spark, calendar.decade(day("1999-01-09"))) == 1990
    assert one(spark, calendar.zodiac(F.lit(None).cast("date"))) is None


def test_local_time_ignores_session_zone(spark):
    ms = F.lit(1_746_757_085_000)  # 02:18:05 UTC
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert one(spark, calendar.hour_of_day(ms)) == 10
            assert one(spark, calendar.hour_of_day(ms, "America/New_York")) == 22
            assert one(spark, calendar.day_partition(ms)) == "20250509"
            assert one(spark, calendar.day_partition(ms, "America/New_York")) == "20250508"
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, calendar.event_time(F.lit(None).cast("long"))) == one(spark, F.timestamp_millis(F.lit(0)))


def test_hour_bands(spark):
    want = {0: "凌晨", 5: "凌晨", 6: "早晨", 8: "早晨", 9: "上午", 11: "上午", 12: "中午", 13: "中午",
            14: "下午", 17: "下午", 18: "晚上", 21: "晚上", 22: "夜间", 23: "夜间", 24: "夜间", -1: "夜间"}
    for hour, band in want.items():
        assert one(spark, calendar.hour_band(F.lit(hour))) == band
    assert one(spark, calendar.hour_band(F.lit(None).cast("int"))) is None


def test_price_bands(spark):
    want = {"499": "低价商品", "500": "中价商品", "1000": "中价商品", "1001": "高价商品", "x": None}
    for price, band in want.items():
        assert one(spark, bands.price_band(F.lit(price))) == band


def test_os_family(spark):
    for os, first in {"Android 13.0": "Android", "iOS": "iOS", "": ""}.items():
        assert one(spark, bands.os_family(F.lit(os))) == first


def test_last_token(spark):
    want = {"a,b": "b", "a,b,,": "b", ",": "", ",,,": "", "": "", "word": "word", "a, b ": " b "}
    for given, token in want.items():
        assert one(spark, text.last_token(F.lit(given))) == token
    assert one(spark, text.last_token(F.lit(None).cast("string"))) is None


def test_prompt(spark):
    bad = one(spark, text.comment_prompt(F.lit("差评"), F.lit("Lamp")))
    good = one(spark, text.comment_prompt(F.lit("好评"), F.lit("Lamp")))
    assert text.BAD_REVIEW_TONE in bad and text.BAD_REVIEW_TONE not in good
    assert "好评" in good and "Lamp" in good


def test_score_samples():
    table = {(r[0], r[1]): dict(zip(scores.BANDS, r[2:])) for r in scores.score_rows()}
    assert table["device", "iOS"]["18_24"] == Decimal("0.070")
    assert table["price", "低价商品"]["35_39"] == Decimal("0.045")
    assert table["price", "中价商品"]["50以上"] == Decimal("0.105")
    assert table["category", "潮流服饰"]["18_24"] == Decimal("0.270")


def test_score_frame(spark):
    frame = scores.score_frame(spark)
    assert frame.count() == len(scores.score_rows()) * 6
    assert frame.filter("dimension = 'tm' AND label = '苹果' AND band = '40_49'").first().score == Decimal("0.160")


#: Every score: dimension, label and the six bands from 18_24 to 50以上.
ALL_SCORES = [
    ("device", "iOS", "0.070 0.060 0.050 0.040 0.030 0.020"),
    ("device", "Android", "0.080 0.070 0.060 0.050 0.040 0.030"),
    ("search", "时尚与潮流", "0.135 0.105 0.075 0.045 0.030 0.015"),
    ("search", "性价比", "0.030 0.060 0.090 0.105 0.120 0.120"),
    ("search", "健康与养生", "0.015 0.030 0.060 0.090 0.120 0.105"),
    ("search", "家庭与育儿", "0.015 0.030 0.060 0.090 0.120 0.105"),
    ("search", "科技与数码", "0.120 0.090 0.060 0.045 0.030 0.015"),
    ("search", "学习与发展", "0.060 0.075 0.090 0.105 0.120 0.105"),
    ("tm", "索芙特", "0.180 0.140 0.100 0.060 0.040 0.020"),
    ("tm", "小米", "0.180 0.140 0.100 0.060 0.040 0.020"),
    ("tm", "Redmi", "0.180 0.140 0.100 0.060 0.040 0.020"),
    ("tm", "CAREMiLLE", "0.180 0.140 0.100 0.060 0.040 0.020"),
    ("tm", "TCL", "0.180 0.140 0.100 0.060 0.040 0.020"),
    ("tm", "联想", "0.180 0.140 0.100 0.060 0.040 0.020"),
    ("tm", "金沙河", "0.180 0.140 0.100 0.060 0.040 0.020"),
    ("tm", "苹果", "0.020 0.060 0.100 0.140 0.160 0.180"),
    ("tm", "长粒香", "0.020 0.060 0.100 0.140 0.160 0.180"),
    ("tm", "香奈儿", "0.020 0.060 0.100 0.140 0.160 0.180"),
    ("category", "潮流服饰", "0.270 0.240 0.180 0.120 0.060 0.030"),
    ("category", "家具用品", "0.060 0.120 0.180 0.240 0.270 0.210"),
    ("category", "健康食品", "0.030 0.060 0.120 0.180 0.240 0.270"),
    ("price", "低价商品", "0.120 0.090 0.060 0.045 0.030 0.015"),
    ("price", "中价商品", "0.030 0.060 0.090 0.105 0.120 0.105"),
    ("price", "高价商品", "0.015 0.030 0.045 0.060 0.075 0.090"),
    ("time", "凌晨", "0.020 0.010 0.010 0.010 0.010 0.010"),
    ("time", "早晨", "0.010 0.010 0.010 0.010 0.020 0.030"),
    ("time", "上午", "0.020 0.020 0.020 0.020 0.030 0.040"),
    ("time", "中午", "0.040 0.040 0.040 0.040 0.040 0.030"),
    ("time", "下午", "0.040 0.050 0.050 0.050 0.050 0.040"),
    ("time", "晚上", "0.080 0.070 0.060 0.050 0.040 0.030"),
    ("time", "夜间", "0.090 0.070 0.050 0.030 0.020 0.010"),
]


def test_every_score():
    from buyerlens.functions.scores import score_rows

    got = [(r[0], r[1], " ".join(str(v) for v in r[2:])) for r in score_rows()]
    assert sorted(got) == sorted(ALL_SCORES)


def test_label_with_a_space():
    from buyerlens.functions.scores import score_rows

    rows = score_rows([("tm", ("Estee Lauder",), ["0.5"] * 6)], {"tm": "0.2"})
    assert [r[:2] for r in rows] == [("tm", "Estee Lauder")]
