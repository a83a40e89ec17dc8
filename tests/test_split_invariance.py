"""The same rows give the same output however they fall into micro-batches."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

import shop
from buyerlens.operators import cdc
from buyerlens.operators.dedup import keep_if_newer
from buyerlens.plans import portrait
from buyerlens.sinks import writers
from buyerlens.sources.files import table_stream, text_stream
from buyerlens.streaming.event_time import timed
from buyerlens.streaming.stateful import keep_if_newer_stream
from buyerlens.streaming.windows import activity_windows, last_of_interval
from conftest import rows
from test_streaming import drain

MINUTE = 60_000
T0 = 120_000 * 14_000_000
VIEWS = [
    ("1", T0 + 60_000, "Android", None),
    ("1", T0 + 50_000, "iOS", None),  # late for the watermark, its window still open
    ("-1", T0 + 61_000, None, "term0"),
    ("-1", T0 + 62_000, "Web", "term0"),
    ("-1", T0 + 59_000, "Android", "term1"),
    ("-1", T0 + 119_999, "Android", None),
    ("2", T0 + 118_000, "iOS", "term1"),
    ("1", T0 + 121_000, "Android", "term0"),
    ("-1", T0 + 119_000, "iOS", None),
    ("1", T0 + 60_000, "Android", None),  # a repeated view
    ("2", T0 + 5 * MINUTE, "iOS", "term1"),
    ("end", T0 + 500 * MINUTE, "iOS", None),
]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """State of two partitions: many small micro-batches run here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def in_files(spark, df, tmp_path, per_file):
    path = str(tmp_path / uuid.uuid4().hex)
    data = df.collect()
    for i in range(0, len(data), per_file):
        spark.createDataFrame(data[i : i + per_file], df.schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01)  # files are taken in order of their times
    return table_stream(spark, path, df.schema, max_files=1)


@pytest.mark.parametrize(("per_file", "salts"), [(len(VIEWS), 8), (4, 1), (1, 8)])
def test_windows(spark, tmp_path, per_file, salts):
    log = spark.createDataFrame(VIEWS, "uid string, ts long, os string, search_item string")
    dims = shop.dimensions(spark)
    want = portrait.device_scores(log, dims).filter("uid <> 'end'")
    got = drain(portrait.device_scores(in_files(spark, log, tmp_path, per_file), dims, salts=salts)).filter("uid <> 'end'")
    assert rows(got, *want.columns) == rows(want) and want.count() == 5


def test_hot_user_is_spread(spark, tmp_path):
    """A third of the rows are one user's: the first step has it in as many groups as there are salts."""
    data = [("-1" if i % 3 == 0 else str(i % 50), T0 + i * 100, f"os{i % 7}", f"t{i % 11}") for i in range(3000)]
    log = spark.createDataFrame([*data, ("end", T0 + 10**8, "x", None)], "uid string, ts long, os string, search_item string")
    got = drain(activity_windows(in_files(spark, log, tmp_path, 1001))).filter("uid = '-1'").collect()
    assert max(r.pv for r in got) == 1000 and len(got) == 3
    spread = log.filter("uid = '-1'").groupBy(F.pmod(F.xxhash64("ts", "os", "search_item"), F.lit(8))).count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 250


VERSIONS = [(1, 3000, 0), (1, 1000, 1), (2, 2500, 2), (1, 2000, 3), (1, 3000, 4), (2, 2400, 5), (1, 4500, 6), (9, 10**6, 7)]


@pytest.mark.parametrize("per_file", [len(VERSIONS), 3, 1])
def test_versions_in_event_order(spark, tmp_path, per_file):
    df = spark.createDataFrame(VERSIONS, "order_id long, ts_ms long, seq long")
    want = keep_if_newer(df, ["order_id"], "ts_ms", ["ts_ms", "seq"]).filter("order_id < 9")
    stream = timed(in_files(spark, df, tmp_path, per_file), "ts_ms", "order_ts")
    got = keep_if_newer_stream(stream, ["order_id"], "ts_ms", ["ts_ms", "seq"], "order_ts", release=True)
    assert rows(drain(got).filter("order_id < 9"), "order_id", "ts_ms") == rows(want, "order_id", "ts_ms")
    assert want.count() == 6


def changes():
    """Orders of one user, out of order by up to two seconds, and of a later one that moves the watermarks."""
    out = []
    for k, (oid, late) in enumerate([(1, 0), (2, 1500), (3, 0), (4, 1900)]):
        ts = shop.T0 + k * 1000 - late
        out += [shop.order(oid, 1, ts), shop.detail(oid, oid % 6, ts + 10)]
    later = shop.T0 + shop.DAY
    return [*out, shop.order(99, 999, later), shop.detail(99, 1, later), shop.detail(99, 1, later + 9000)]


@pytest.mark.parametrize("per_file", [100, 4, 1])
def test_labels_in_event_order(spark, tmp_path, per_file):
    lines, folder = changes(), tmp_path / "cdc"
    folder.mkdir()
    for i in range(0, len(lines), per_file):
        (folder / f"{i:03d}.txt").write_text("\n".join(lines[i : i + per_file]) + "\n", encoding="utf-8")
        time.sleep(0.01)
    dims = shop.dimensions(spark)
    static, _ = cdc.parse_cdc(spark.read.text(str(folder)))
    want = portrait.order_scores(static["order_info"], static["order_detail"], dims).filter("user_id = '1'")
    stream, _ = cdc.parse_cdc(text_stream(spark, str(folder), max_files=1))
    got = drain(portrait.order_scores(stream["order_info"], stream["order_detail"], dims)).filter("user_id = '1'")
    assert rows(got, *want.columns) == rows(want) and want.count() >= 3


def test_interval_of_the_clock(spark, tmp_path):
    """The last state per key leaves at the clock's tick, though no later row moves a watermark."""
    path = str(tmp_path / "in")
    schema = "uid string, pv long, ts long"
    spark.createDataFrame([("a", 1, 5), ("a", 3, 1), ("b", 1, 7), ("a", 2, 9)], schema).coalesce(1).write.parquet(path)
    name = "clock" + uuid.uuid4().hex
    df = last_of_interval(table_stream(spark, path, schema), ["uid"], ["pv"], 2000)
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            if spark.table(name).count() >= 2:
                break
            time.sleep(1)
        assert rows(spark.table(name)) == [("a", 3, 1), ("b", 1, 7)]
        spark.createDataFrame([("a", 4, 0)], schema).coalesce(1).write.mode("append").parquet(path)
        for _ in range(60):
            if spark.table(name).count() >= 3:
                break
            time.sleep(1)
        assert rows(spark.table(name)) == [("a", 3, 1), ("a", 4, 0), ("b", 1, 7)]
    finally:
        q.stop()


def test_arrival_survives_landing(spark, tmp_path):
    """Offsets decide on versions after landing as they do before, in batches and streams."""
    texts = [shop.order(1, 1, shop.T0 + d, op="u") for d in (1000, 3000, 2000, 4000)]
    raw = spark.createDataFrame(list(enumerate(texts)), "arrival long, value string")
    landed = str(tmp_path / "landed")
    writers.write_routed(raw, landed, "unused")
    again = spark.read.schema("value string, arrival long, table string").parquet(landed)
    tables, _ = cdc.parse_cdc(again)
    heads = cdc.order_heads(cdc.flatten_image(tables["order_info"]))
    got = keep_if_newer(heads, ["order_id"], "ts_ms", ["arrival"])
    assert rows(got, "ts_ms") == [(shop.T0 + d,) for d in (1000, 3000, 4000)]
    path = str(tmp_path / "in")
    raw.coalesce(1).write.parquet(path)
    other, name = str(tmp_path / "streamed"), "land-" + uuid.uuid4().hex
    writers.write_routed(table_stream(spark, path, raw.schema), other, name).awaitTermination()
    assert rows(spark.read.parquet(other), "arrival", "table") == [(i, "order_info") for i in range(4)]
