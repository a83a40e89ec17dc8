import json
import uuid

import pytest
from pyspark.sql import functions as F

import shop
from buyerlens import schemas
from buyerlens.operators import cdc
from buyerlens.sinks import writers
from buyerlens.sources import files, jdbc, kafka
from conftest import rows


def test_kafka_options():
    plain = kafka.kafka_read_options("h:1", "t")
    assert plain == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest"}
    full = kafka.kafka_read_options("h:1", "t", group="g", starting={0: 5, 2: 7}, max_per_batch=10)
    assert json.loads(full["startingOffsets"]) == {"t": {"0": 5, "2": 7}}
    assert full["kafka.group.id"] == "g" and full["maxOffsetsPerTrigger"] == "10"
    sink = writers.kafka_write_options("h:1", "t")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"


def test_tombstones_are_dropped(spark):
    raw = spark.createDataFrame([(bytearray(b"x"),), (None,)], "value binary")
    assert rows(kafka.text_values(raw)) == [("x",)]


def test_jdbc_options():
    assert jdbc.jdbc_options("u", "select 1")["query"] == "select 1"
    split = jdbc.jdbc_options("u", "select id from t", split=("id", 0, 100, 8), user="me")
    assert split["dbtable"] == "(select id from t) q" and split["numPartitions"] == "8"
    assert "query" not in split and split["user"] == "me"


def test_camel_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, category_name int, CATEGORY1_ID int")
    assert jdbc.camel_columns(df).columns == ["id", "categoryName", "category1Id"]


def test_files(spark, tmp_path):
    path = shop.write_lines(tmp_path / "w", ["a", "", " b "])
    assert rows(files.word_lines(spark, path)) == [("",), (" b ",), ("a",)]
    spark.createDataFrame([(1201, "good")], "dic_code int, dic_name string").write.parquet(str(tmp_path / "d"))
    assert rows(files.key_values(spark, str(tmp_path / "d"))) == [("1201", "good")]


def test_portrait_csv(spark, tmp_path):
    values = {c: c[:3] for c in schemas.PORTRAIT_COLUMNS}
    df = spark.createDataFrame([{**values, "zodiac_sign": None, "extra": "no"}],
                               ", ".join(f"{c} string" for c in [*schemas.PORTRAIT_COLUMNS, "extra"]))
    path = str(tmp_path / "csv")
    writers.write_portrait_csv(df, path, "csv")
    line = spark.read.text(path).first().value
    assert line.split(",") == ["null" if c == "zodiac_sign" else c[:3] for c in schemas.PORTRAIT_COLUMNS]


def test_json_lines_static_and_streaming(spark, tmp_path):
    df = spark.createDataFrame([("Ann", "P0", "bad")], "consignee string, violation_grade string, violation_msg string")
    writers.write_json_lines(df, str(tmp_path / "a"), "a")
    df.write.json(str(tmp_path / "src"))
    stream = spark.readStream.schema(df.schema).json(str(tmp_path / "src"))
    writers.write_json_lines(stream, str(tmp_path / "b"), "json-" + uuid.uuid4().hex).awaitTermination()
    for name in ("a", "b"):
        assert rows(spark.read.schema(df.schema).json(str(tmp_path / name))) == rows(df)


def test_merge_by_key(spark):
    old = spark.createDataFrame([(1, 5, "old"), (2, 5, "old"), (3, 9, "old")], "k int, ts long, v string")
    new = spark.createDataFrame([(1, 5, "new"), (3, 8, "new"), (4, 1, "new")], "k int, ts long, v string")
    got = writers.merge_by_key(old, new, ["k"], "ts", ["v"])
    assert rows(got, "k", "v") == [(1, "new"), (2, "old"), (3, "old"), (4, "new")]
    assert writers.as_cells(got, "k").dtypes == [("k", "string"), ("ts", "string"), ("v", "string")]


def test_tables(spark):
    space = "shop_" + uuid.uuid4().hex[:8]
    assert not writers.table_exists(spark, "dims", space)
    assert writers.ensure_table(spark, "dims", "id BIGINT, name STRING", space)
    assert writers.ensure_table(spark, "dims", "id BIGINT, name STRING", space)
    assert writers.table_exists(spark, "dims", space)
    # The namespace counts: the same name elsewhere is another table.
    assert not writers.table_exists(spark, "dims", "default")
    spark.sql(f"DROP DATABASE {space} CASCADE")


def test_dictionary_round_trip(spark, tmp_path):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    writers.write_dictionary(words, str(tmp_path / "words"))
    assert rows(spark.read.parquet(str(tmp_path / "words"))) == rows(words)


@pytest.mark.parametrize("stream", [False, True])
def test_routed_landing(spark, tmp_path, stream):
    lines = shop.topic()
    src = shop.write_lines(tmp_path / "cdc", lines)
    df = files.text_stream(spark, src) if stream else files.text_batch(spark, src)
    q = writers.write_routed(df, str(tmp_path / "landed"), "landing-" + uuid.uuid4().hex)
    if stream:
        q.awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "landed"))
    counts = {r["table"]: r["count"] for r in landed.groupBy("table").count().collect()}
    assert counts["order_detail"] == 300 and counts["user_info"] == 11
    part = landed.filter(F.col("table") == "user_info")
    assert "PartitionFilters: [isnotnull(table" in part._jdf.queryExecution().executedPlan().toString()
    pruned, rejects = cdc.parse_cdc(landed)
    whole, _ = cdc.parse_cdc(shop.texts(spark, lines))
    for table in whole:
        assert rows(pruned[table]) == rows(whole[table])
        plan = pruned[table]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(table" in plan
    assert rejects.count() == 4


def test_console(spark, capsys):
    writers.write_console(spark.range(1), "console")
    assert "id" in capsys.readouterr().out
