"""Static and streaming runs of the same transformation give equal rows."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

import shop
from buyerlens import schemas
from buyerlens.operators import cdc
from buyerlens.operators.activity import user_activity
from buyerlens.operators.dedup import dedup_exact, keep_if_newer
from buyerlens.operators.joins import interval_join
from buyerlens.operators.labels import label_changes
from buyerlens.plans import comments, portrait
from buyerlens.sinks import writers
from buyerlens.sources.files import table_stream, text_stream
from buyerlens.streaming.event_time import timed, window_last
from buyerlens.streaming.stateful import keep_if_newer_stream, label_changes_stream
from conftest import rows

def as_of():
    return F.lit("2025-06-01").cast("date")


def drain(df, mode="append"):
    """Run a stream over what is available and return its rows."""
    name = "q" + uuid.uuid4().hex
    q = df.writeStream.format("memory").queryName(name).outputMode(mode)
    q = q.trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def streamed(spark, df, tmp_path, files=1):
    """A static frame as a file stream of ``files`` files, one per micro-batch."""
    path = str(tmp_path / uuid.uuid4().hex)
    df.coalesce(1).write.option("maxRecordsPerFile", -(-df.count() // files)).parquet(path)
    return table_stream(spark, path, df.schema, max_files=1)


def test_exact_dedup(spark, tmp_path):
    df = spark.createDataFrame([(i % 5, i % 3) for i in range(60)], "a int, b int")
    got = drain(dedup_exact(streamed(spark, df, tmp_path, 3)))
    assert rows(got) == rows(dedup_exact(df))


def test_dedup_within_watermark(spark, tmp_path):
    df = spark.createDataFrame([(i % 4, 1000 + i % 4) for i in range(40)], "order_id int, ts_ms long")
    stream = timed(streamed(spark, df, tmp_path, 2), "ts_ms", "t", "1 hour")
    got = drain(dedup_exact(stream, ["order_id", "ts_ms"], within="1 day"))
    assert rows(got.select("order_id", "ts_ms")) == rows(df.distinct())


def test_keep_if_newer(spark, tmp_path):
    data = [(i % 3, (i * 37) % 50, i) for i in range(90)]
    df = spark.createDataFrame(data, "k int, ts long, seq long")
    got = drain(keep_if_newer_stream(streamed(spark, df, tmp_path, 4), ["k"], "ts", ["seq"]))
    assert rows(got) == rows(keep_if_newer(df, ["k"], "ts", ["seq"]))


def test_label_changes(spark, tmp_path):
    data = [
        (i % 2, i, ["a", "b", None, "ü"][(i * 7 + i // 5) % 4], ["x", "y"][(i * 3) % 2]) for i in range(80)
    ]
    df = spark.createDataFrame(data, "u int, seq long, p string, q string")
    got = drain(
        label_changes_stream(streamed(spark, df, tmp_path, 3), "u", ["p", "q"], ["seq"], ["seq"])
    )
    assert rows(got) == rows(label_changes(df, "u", ["p", "q"], ["seq"], ["seq"]))


def test_update_mode_activity(spark, tmp_path):
    views = cdc.project_page_log(cdc.parse_records(shop.texts(spark, shop.pages()), schemas.PAGE_LOG)[0])
    got = drain(user_activity(dedup_exact(streamed(spark, views, tmp_path))), "complete")
    assert rows(got) == rows(user_activity(dedup_exact(views)))


def test_interval_join_bounds(spark, tmp_path):
    left = spark.createDataFrame([(1, 100_000), (2, 100_000)], "k int, l_ms long")
    right = spark.createDataFrame(
        [(1, 100_000 + d, d) for d in (-5001, -5000, 0, 5000, 5001)], "rk int, r_ms long, d int"
    )
    static = interval_join(left, right, [("k", "rk")], "l_ms", "r_ms", -5000, 5000)
    ls = timed(streamed(spark, left, tmp_path), "l_ms", "lt")
    rs = timed(streamed(spark, right, tmp_path), "r_ms", "rt")
    got = drain(interval_join(ls, rs, [("k", "rk")], "lt", "rt", -5000, 5000))
    assert rows(got, "k", "d") == rows(static, "k", "d") == [(1, -5000), (1, 0), (1, 5000)]


def test_window_last(spark, tmp_path):
    t0 = 120_000 * 1000
    data = [("u", t0 + s * 1000, s) for s in (0, 60, 119, 120, 200)] + [("end", t0 + 10**7, 0)]
    df = spark.createDataFrame(data, "uid string, ts long, n int")
    got = drain(window_last(timed(streamed(spark, df, tmp_path), "ts", "t"), "uid", "t", ["ts", "n"]))
    assert rows(got, "uid", "n") == [("u", 119), ("u", 200)]


LATER = shop.T0 + 90 * shop.DAY


def _inputs(spark, tmp_path, files):
    # Later records of user 999 move the watermarks past every row that is to be compared.
    pages = shop.pages() + [shop.view("999", LATER)]
    later = [shop.order(999, 999, LATER), shop.detail(999, 1, LATER), shop.detail(999, 1, LATER + 9000)]
    lines = shop.write_lines(tmp_path / "cdc", shop.topic() + later, files)
    views = shop.write_lines(tmp_path / "pages", pages, files)
    return lines, views


def _portrait_args(spark, read, lines, views):
    tables, _ = cdc.parse_cdc(read(spark, lines))
    return tables, cdc.project_page_log(cdc.parse_records(read(spark, views), schemas.PAGE_LOG)[0])


def test_portrait_streams_equal_batch(spark, tmp_path):
    lines, views = _inputs(spark, tmp_path, 1)
    dims = shop.dimensions(spark)
    tables, log = _portrait_args(spark, lambda s, p: s.read.text(p), lines, views)
    batch = portrait.portrait(tables, log, dims, as_of())

    tables, log = _portrait_args(spark, text_stream, lines, views)
    out = str(tmp_path / "out")
    portrait.run_streams(spark, tables, log, dims, out, as_of(), prefix=uuid.uuid4().hex)
    got = spark.read.schema(batch.schema).parquet(f"{out}/portraits")
    assert rows(got, *batch.columns) == rows(batch)
    assert batch.count() >= 6


def test_order_scores_stream_equals_batch(spark, tmp_path):
    lines, _ = _inputs(spark, tmp_path, 1)
    dims = shop.dimensions(spark)
    static, _ = cdc.parse_cdc(spark.read.text(lines))
    stream, _ = cdc.parse_cdc(text_stream(spark, lines))
    want = portrait.order_scores(static["order_info"], static["order_detail"], dims).filter("user_id <> '999'")
    got = drain(portrait.order_scores(stream["order_info"], stream["order_detail"], dims)).filter("user_id <> '999'")
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_arrival_order_decides_in_batch_and_stream(spark, tmp_path, parts):
    """An older version that arrives late is dropped, however the records fall into micro-batches."""
    rows_in = [(0, 1, 1000), (1, 1, 3000), (2, 1, 2000), (3, 2, 500), (4, 1, 4000), (5, 2, 400)]
    df = spark.createDataFrame(rows_in, "arrival long, order_id long, ts_ms long")
    want = [(1, 1000), (1, 3000), (1, 4000), (2, 500)]
    batch = keep_if_newer(df, ["order_id"], "ts_ms", ["arrival"])
    assert rows(batch, "order_id", "ts_ms") == want
    source, out, name = str(tmp_path / "in"), str(tmp_path / "out"), "arrival-" + uuid.uuid4().hex
    for k in range(parts):
        df.filter(F.floor(F.col("arrival") * parts / 6) == k).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        writers.write_files(keep_if_newer_stream(stream, ["order_id"], "ts_ms", ["arrival"]), out, name).awaitTermination()
    assert rows(spark.read.parquet(out), "order_id", "ts_ms") == want


def test_order_scores_follow_arrival(spark, tmp_path):
    lines, _ = _inputs(spark, tmp_path, 1)
    dims = shop.dimensions(spark)
    text = spark.read.text(lines).withColumn("arrival", F.monotonically_increasing_id())
    tables, _ = cdc.parse_cdc(text)
    assert "arrival" in tables["order_info"].columns
    plain, _ = cdc.parse_cdc(text.drop("arrival"))
    got = portrait.order_scores(tables["order_info"], tables["order_detail"], dims)
    want = portrait.order_scores(plain["order_info"], plain["order_detail"], dims)
    assert got.columns == want.columns and got.count() <= want.count()


def _comment_lines():
    out = [shop.order(i, 1, shop.T0 + i, op="c") for i in range(20)]
    out += [shop.comment(i, i, 1, str(1200 + i % 3), shop.T0 + i + d) for i, d in
            zip(range(20), [-60_001, -60_000, 0, 60_000, 60_001] * 4)]
    return out


def test_comment_job_stream_equals_batch(spark, tmp_path):
    path = shop.write_lines(tmp_path / "c", _comment_lines())
    names = spark.createDataFrame([("1200", "好评"), ("1201", "差评")], "dic_code string, dic_name string")
    words = spark.createDataFrame([("bad",), ("worse",)], "word string")

    def run(text):
        t, _ = cdc.parse_cdc(text)
        return comments.comment_facts(t["comment_info"], t["order_info"], names, words=words, rate=0.5)

    want = run(spark.read.text(path))
    got = drain(run(text_stream(spark, path)))
    assert rows(got, *want.columns) == rows(want)
    assert {r.dic_name for r in want.collect()} == {"好评", "差评", "N/A"}
    assert want.count() == 12

    p1 = spark.createDataFrame([("商品",)], "word string")
    moderated = comments.moderated(want, words, p1)
    out, name = str(tmp_path / "moderated"), "moderation-" + uuid.uuid4().hex
    comments.run_moderation(run(text_stream(spark, path)), words, p1, out, name).awaitTermination()
    assert rows(spark.read.parquet(out), *moderated.columns) == rows(moderated)


def test_restart_from_checkpoint(spark, tmp_path):
    """A second start takes up new files only; state from the first run still counts."""
    src, out, name = tmp_path / "src", str(tmp_path / "out"), "restart-" + uuid.uuid4().hex
    src.mkdir()

    def run(data, no):
        text = "\n".join(json.dumps({"k": k, "ts": ts, "seq": s}) for k, ts, s in data)
        (src / f"{no}.json").write_text(text)
        stream = spark.readStream.schema("k int, ts long, seq long").json(str(src))
        writers.write_files(keep_if_newer_stream(stream, ["k"], "ts", ["seq"]), out, name).awaitTermination()
        return rows(spark.read.parquet(out), "k", "ts")

    assert run([(1, 10, 1), (1, 5, 2), (2, 7, 3)], 1) == [(1, 10), (2, 7)]
    assert run([(1, 10, 4), (1, 11, 5), (2, 6, 6), (2, 8, 7)], 2) == [(1, 10), (1, 11), (2, 7), (2, 8)]


def test_change_log_upserts(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (2, 1, "c"), (1, 7, "d")], "k int, ts long, v string")
    path = str(tmp_path / "log")
    stream = streamed(spark, df, tmp_path, 2)
    writers.write_changes(stream, path, "log-" + uuid.uuid4().hex).awaitTermination()
    assert rows(writers.current_rows(spark, path, ["k"], "ts"), "k", "v") == [(1, "b"), (2, "c")]
    with pytest.raises(ValueError):
        writers.write_changes(df, path, "static")
