"""Late page views are counted, however a backlog falls into micro-batches."""

import pytest

import shop
from buyerlens.plans import portrait
from buyerlens.sources.files import table_stream
from conftest import rows
from test_streaming import drain

MINUTE = 60_000
T0 = 120_000 * 14_000_000
VIEWS = [
    ("1", T0 + 1000, "Android", None),
    ("2", T0 + 10 * MINUTE, "iOS", None),
    ("1", T0 + 2000, "iOS", "no such term"),  # its window is over when it comes
    ("1", T0 + 20 * MINUTE, "Android", None),
    ("3", T0 + 1000 * MINUTE, "iOS", None),
    ("3", T0 + 2000 * MINUTE, "iOS", None),
]


@pytest.mark.parametrize("per_file", [len(VIEWS), 1])
def test_late_views_count_in_later_windows(spark, tmp_path, per_file):
    log = spark.createDataFrame(VIEWS, "uid string, ts long, os string, search_item string")
    path = str(tmp_path / "views")
    for i in range(0, len(VIEWS), per_file):
        spark.createDataFrame(VIEWS[i : i + per_file], log.schema).coalesce(1).write.mode("append").parquet(path)
    dims = shop.dimensions(spark)
    later = f"uid = '1' and ts = {T0 + 20 * MINUTE}"
    want = portrait.device_scores(log, dims).filter(later)
    got = drain(portrait.device_scores(table_stream(spark, path, log.schema, max_files=1), dims)).filter(later)
    assert rows(got, *want.columns) == rows(want) and want.count() == 1
    # Without the late view the window would have other scores.
    alone = portrait.device_scores(log.filter("search_item is null"), dims).filter(later)
    assert rows(alone) != rows(want)
