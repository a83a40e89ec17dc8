import shop
from pyspark.sql import functions as F

from buyerlens import schemas
from buyerlens.operators import cdc
from conftest import rows


def test_routing_and_rejects(spark):
    tables, rejects = cdc.parse_cdc(shop.texts(spark, [*shop.topic(), None]))
    assert tables["user_info"].count() == 11
    assert tables["order_info"].count() == 60 + 40 + 1
    assert tables["order_detail"].count() == 300
    assert tables["comment_info"].count() == 0
    assert rows(rejects) == [("",), ("not json",), ('{"op": "c"}',), ('{"truncated": {"source": ',)]


def test_escaped_table_name_is_kept(spark):
    line = '{"op":"c","after":{"id":5},"source":{"table":"user\\u005finfo"},"ts_ms":1}'
    tables, _ = cdc.parse_cdc(shop.texts(spark, [line]))
    assert rows(tables["user_info"].select("after.id")) == [(5,)]


def test_value_of_another_table_does_not_leak(spark):
    line = shop.change("order_info", {"id": 1, "trade_body": '"user_info"'}, 3)
    tables, _ = cdc.parse_cdc(shop.texts(spark, [line]))
    assert tables["user_info"].count() == 0 and tables["order_info"].count() == 1


def test_wrong_field_type_is_null(spark):
    line = shop.change("order_info", {"id": 1, "user_id": "abc", "consignee": "x"}, 3)
    tables, rejects = cdc.parse_cdc(shop.texts(spark, [line]))
    assert rows(cdc.flatten_image(tables["order_info"]).select("id", "user_id", "ts_ms")) == [(1, None, 3)]
    assert rejects.count() == 0


def test_image_fallback(spark):
    image = "id BIGINT, v STRING"
    lines = [
        shop.change("t", {"id": 1, "v": "new"}, 1, "u", {"id": 1, "v": "old"}),
        shop.change("t", None, 2, "d", {"id": 2, "v": "gone"}),
        shop.change("t", {}, 3, "d", {"id": 3, "v": "kept"}),
        shop.change("t", None, 4, None),
    ]
    tables, _ = cdc.parse_cdc(shop.texts(spark, lines), {"t": image})
    got = cdc.flatten_image(tables["t"], fallback_before=True)
    assert rows(got) == [(None, None, "no op", 4), (1, "new", "u", 1), (2, "gone", "d", 2), (3, "kept", "d", 3)]


def test_base_labels(spark):
    tables, _ = cdc.parse_cdc(shop.texts(spark, shop.topic()))
    got = {r.uid: r for r in cdc.base_labels(tables["user_info"], F.lit("2025-06-01").cast("date")).collect()}
    assert set(got) == {str(i) for i in range(1, 9)} | {"20"}
    assert got["3"].gender == "home" and got["1"].gender == "F"
    assert (got["20"].birthday, got["20"].age, got["20"].zodiac_sign) == (None, None, None)
    assert got["1"].birthday == "2000-02-13" and got["1"].age == 25 and got["1"].decade == 2000


def test_json_and_csv_lines(spark):
    df = spark.createDataFrame([(1, None, "x,y")], "a int, b string, c string")
    assert cdc.to_json_value(df).first().value == '{"a":1,"c":"x,y"}'
    assert cdc.to_csv_line(df).first().value == "1,null,x,y"
    back, _ = cdc.parse_records(cdc.to_json_value(df), "a INT, b STRING, c STRING")
    assert rows(back) == rows(df)


def test_page_log_without_item_type(spark):
    line = '{"common": {"uid": "7", "os": "iOS 1"}, "page": {"item": "x"}, "ts": 4}'
    log, _ = cdc.parse_records(shop.texts(spark, [line]), schemas.PAGE_LOG)
    row = cdc.project_page_log(log).first()
    assert (row.uid, row.ts, row.os, row.search_item) == ("7", 4, "iOS", None)


def test_one_parse_equals_a_parse_per_table(spark):
    texts = [
        '{"before":null,"after":{"id":1,"user_id":7,"total_amount":12.5,"consignee":"坏 \\u0041"},"source":{"table":"order_info"},"op":"c","ts_ms":5}',
        '{"after":{"id":"x","user_id":8},"source":{"table":"order_info"},"op":"u","ts_ms":6}',
        '{"before":{"id":3},"after":null,"source":{"table":"order_info"},"op":"d","ts_ms":7,"other":[1,{"a":2}]}',
        '{"after":{"id":4},"source":{"table":"comment_info"},"op":"c","ts_ms":8}',
        '{"after":{"id":4},"source":{"table":"unwanted"},"op":"c","ts_ms":8}',
        '{"after":{"id":4},"source":{},"op":"c"}', "[1]", "5", "{broken", "", None,
    ]
    topic = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, arrival long")
    wanted = {"order_info": schemas.ORDER_INFO, "comment_info": schemas.COMMENT_INFO}
    once, bad = cdc.parse_cdc_once(topic, wanted)
    each, _ = cdc.parse_cdc(topic, wanted)
    for name in wanted:
        assert set(once[name].columns) == set(each[name].columns)
        cols = sorted(each[name].columns)
        assert once[name].schema["after"].dataType == each[name].schema["after"].dataType
        got, want = ([r.asDict(True) for r in d.select(cols).orderBy("arrival").collect()] for d in (once[name], each[name]))
        assert got == want
    assert rows(bad) == sorted([(t,) for t in texts[5:10]])
    assert once["order_info"].count() == 3
    assert cdc.parse_cdc_once(topic.limit(0), wanted)[1].count() == 0
