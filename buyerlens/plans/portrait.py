"""User portraits: base labels, device and search scores, order scores, inferred shopper age.

Every step takes static or streaming frames. Static input gives the whole result in one plan; on
streams each scored branch is written to a table and the merge reads the tables as streams (see
:func:`run_streams`), since a stream allows only limited chains of stateful steps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from buyerlens.functions.bands import price_band
from buyerlens.functions.calendar import DAY_MS, hour_band, hour_of_day
from buyerlens.functions.scores import BANDS, SCORE_TYPE
from buyerlens.operators import cdc
from buyerlens.operators.activity import activity_snapshots
from buyerlens.operators.dedup import dedup_exact, keep_if_newer
from buyerlens.operators.joins import interval_join, prefixed
from buyerlens.operators.labels import ORDER_DIMS, label_changes
from buyerlens.operators.lookups import last_sku, lookup, search_category
from buyerlens.operators.scoring import score, top_band, total_scores
from buyerlens.operators.validity import history, paired_times
from buyerlens.session import DEFAULT_TZ, at_once, settle
from buyerlens.sinks.writers import write_files
from buyerlens.streaming.event_time import WATERMARK, timed
from buyerlens.streaming.stateful import keep_if_newer_stream, label_changes_stream, running_activity_stream
from buyerlens.streaming.windows import SALTS, activity_windows, last_of_interval

SCORE_DIMS = ["time", "price", "category", "tm", "device", "search"]
DEVICE_SUMS = [f"d_{b}" for b in BANDS]


@dataclass
class Dimensions:
    """Static tables of the portrait job."""

    skus: DataFrame  # sku_id, tm_name, sku_price, order_category
    categories: DataFrame  # id, b3name, b2name, b1name
    search_compare: DataFrame  # id, category_name, search_category


def base_profile(
    users: DataFrame, sups: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Base labels of users with body labels recorded within seven days."""
    left = timed(cdc.base_labels(users, as_of), "ts_ms", "user_time")
    right = timed(cdc.body_labels(sups).drop("create_ts"), "ts_ms", "sup_time")
    right = prefixed(right.drop("ts_ms"), "s_", ["sup_time"])
    joined = interval_join(
        left, right, [("uid", "s_uid")], "user_time", "sup_time", -7 * DAY_MS, 7 * DAY_MS
    )
    body = ["height", "unit_height", "weight", "unit_weight"]
    return joined.select(
        *[c for c in left.columns if c != "user_time"], *[F.col(f"s_{c}").alias(c) for c in body]
    )


def device_scores(
    views: DataFrame, dims: Dimensions, delay: str = WATERMARK, salts: int = SALTS, clock_ms: int | None = None
) -> DataFrame:
    """Device and search scores per user at the end of each two-minute window with views.

    Input: projected page views (:func:`buyerlens.operators.cdc.project_page_log`). On streams a window is
    given out ``delay`` after its end, once, with all views that came before; later views count in the user's
    next window. ``salts`` is the number of tasks that share a user. With ``clock_ms`` windows are intervals of
    processing time instead: the state of every user with views, at each multiple of ``clock_ms``.
    """
    if not views.isStreaming:
        seen = activity_snapshots(dedup_exact(views))
    elif clock_ms is None:
        seen = activity_windows(dedup_exact(views), delay=delay, salts=salts)
    else:
        once = timed(dedup_exact(views), "ts", "view_time", None)
        running = running_activity_stream(once, "uid", "view_time", ["ts", "os", "search_item"])
        seen = last_of_interval(running.drop("view_time"), ["uid"], ["pv"], clock_ms)
    found = search_category(seen, dims.categories, dims.search_compare)
    kept = found.select("uid", "ts", "judge_os", "search_category")
    return score(kept, {"device": "judge_os", "search": "search_category"})


def order_scores(
    orders: DataFrame, details: DataFrame, dims: Dimensions, tz: str = DEFAULT_TZ
) -> DataFrame:
    """Order-label scores per user, one row whenever the user's leading labels change.

    On streams versions (unless the source gives their arrival) and labels are handled in order of event time when
    the watermark has passed it, so the result does not depend on where micro-batches end.
    """
    heads = cdc.order_heads(cdc.flatten_image(orders))
    # Versions count in order of arrival where the source gives it, else in order of their own time.
    first = "arrival" if "arrival" in heads.columns else "ts_ms"
    version_order = [first, "order_time", "user_id"]
    # Repeated records have equal times, so keep-if-newer also removes exact copies.
    if heads.isStreaming:
        timed_heads = timed(heads, "ts_ms", "order_ts")
        newer = keep_if_newer_stream(
            timed_heads, ["order_id"], "ts_ms", version_order, "order_ts", release=first == "ts_ms"
        )
    else:
        newer = timed(keep_if_newer(heads, ["order_id"], "ts_ms", version_order), "ts_ms", "order_ts")
    # Bands are found once per version and sku, before lines multiply them.
    newer = newer.withColumn("order_time", hour_band(hour_of_day("order_time", tz)))
    skus = last_sku(dims.skus).withColumn("order_price", price_band("sku_price"))
    lines = timed(prefixed(cdc.order_lines(details), "d_"), "d_ts_ms", "line_ts")
    joined = interval_join(
        newer, lines, [("order_id", "d_order_id")], "order_ts", "line_ts", -5_000, 5_000
    )
    known = lookup(
        joined.drop("line_ts"),
        skus,
        ("d_sku_id", "sku_id"),
        ["tm_name", "order_price", "order_category"],
        how="inner",
    )
    labelled = known.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts_ms").alias("ts"),
        *(["order_ts"] if known.isStreaming else []),
        "order_id",
        F.col("d_sku_id").alias("sku_id"),
        "tm_name",
        "order_category",
        "order_price",
        "order_time",
    ).filter(F.col("user_id").isNotNull())
    order = ["ts", "order_id", "sku_id"]
    if labelled.isStreaming:
        changes = label_changes_stream(
            labelled, "user_id", ORDER_DIMS, order, ["ts", "order_ts"], "order_ts", release="ts"
        ).drop("order_ts")
    else:
        # Written once: the count of heavy keys and the windows read these narrow rows, not all before them.
        changes = label_changes(settle(labelled), "user_id", ORDER_DIMS, order, ["ts"])
    return score(
        changes,
        {"tm": "tm_name", "category": "order_category", "price": "order_price", "time": "order_time"},
    )


def shopper_age(
    orders: DataFrame, devices: DataFrame, fix_50_plus: bool = False, late: str | None = None
) -> DataFrame:
    """Inferred age band for order and device scores at most one day apart.

    On streams ``late`` bounds the state: rows later than that are dropped. Without it all are kept.
    """
    # Pairs carry one subtotal per band and side, not the scores of all dimensions.
    left = _subtotals(orders, "user_id", "o_", SCORE_DIMS[:4], fix_50_plus)
    if not (orders.isStreaming or devices.isStreaming):
        return _ages_by_runs(left, _device_history(devices, fix_50_plus))
    right = _subtotals(devices, "uid", "d_", SCORE_DIMS[4:], fix_50_plus)
    left, right = timed(left, "o_ts", "order_ts", late), timed(right, "d_ts", "device_ts", late)
    joined = interval_join(
        left, right, [("user_id", "uid")], "order_ts", "device_ts", -DAY_MS, DAY_MS
    )
    return _banded(joined).select("user_id", "shop_age", F.greatest("o_ts", "d_ts").alias("ts"), "order_ts")


def _banded(pairs: DataFrame) -> DataFrame:
    totals = [(F.col(f"`o_{b}`") + F.col(f"`d_{b}`")).cast(SCORE_TYPE).alias(b) for b in BANDS]
    return top_band(pairs.select("*", *totals))


def _device_history(devices: DataFrame, fix_50_plus: bool) -> DataFrame:
    """Device and search subtotals with the runs in which they stay equal."""
    rows = _subtotals(devices, "uid", "d_", SCORE_DIMS[4:], fix_50_plus)
    return history(rows.withColumnsRenamed({"uid": "user_id", "d_ts": "ts"}), "user_id", "ts", DEVICE_SUMS)


def _ages_by_runs(left: DataFrame, devices: DataFrame) -> DataFrame:
    """Device scores change a few times per user, so order scores meet their runs, not all windows."""
    return paired_times(left.withColumnRenamed("o_ts", "ts"), devices, "user_id", "ts", DEVICE_SUMS, DAY_MS, _banded, "shop_age")


def _subtotals(df: DataFrame, key: str, prefix: str, dims: list[str], fix_50_plus: bool) -> DataFrame:
    """The key, the time and the sum of the dimensions' scores per band."""
    bands = [F.col(f"`{b}`").alias(prefix + b) for b in BANDS]
    return total_scores(df, dims, fix_50_plus).select(key, F.col("ts").alias(f"{prefix}ts"), *bands)


def merge_profile(ages: DataFrame, base: DataFrame, late: str | None = None) -> DataFrame:
    """Portrait rows: shopper age beside base labels at most one day apart, each row once.

    On streams the order's time stays the watermarked column; the join bound is widened by the first
    join's own day and the exact one-day test on the later time stands beside it.
    """
    left = timed(base.withColumnRenamed("ts_ms", "b_ts"), "b_ts", "base_ts", late)
    if ages.isStreaming:
        joined = interval_join(
            left, ages, [("uid", "user_id")], "base_ts", "order_ts", -2 * DAY_MS, 2 * DAY_MS,
            extra=F.abs(F.col("ts") - F.col("b_ts")) <= DAY_MS,
        )
    else:
        right = timed(ages, "ts", "age_ts")
        joined = interval_join(
            left, right, [("uid", "user_id")], "base_ts", "age_ts", -DAY_MS, DAY_MS
        )
    labels = [c for c in base.columns if c not in ("uid", "ts_ms")]
    return dedup_exact(joined.select("user_id", "shop_age", *labels))


def portrait(
    tables: dict[str, DataFrame],
    views: DataFrame,
    dims: Dimensions,
    as_of: Column | None = None,
    tz: str = DEFAULT_TZ,
    fix_50_plus: bool = False,
) -> DataFrame:
    """The whole portrait of static input; ``tables`` as given by ``parse_cdc``."""
    base = base_profile(tables["user_info"], tables["user_info_sup_msg"], as_of)
    # Both sides are written on the way; their jobs need not wait for each other.
    orders, devices = at_once(
        views.sparkSession,
        lambda: order_scores(tables["order_info"], tables["order_detail"], dims, tz),
        lambda: _device_history(device_scores(views, dims), fix_50_plus),
    )
    ages = _ages_by_runs(_subtotals(orders, "user_id", "o_", SCORE_DIMS[:4], fix_50_plus), devices)
    return merge_profile(ages, base)


def run_streams(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    views: DataFrame,
    dims: Dimensions,
    folder: str,
    as_of: Column | None = None,
    tz: str = DEFAULT_TZ,
    once: bool = True,
    prefix: str = "portrait",
    fix_50_plus: bool = False,
    late: str | None = None,
    files_per_batch: int | None = None,
    view_delay: str = WATERMARK,
) -> list:
    """Start the portrait as streams: three scored branches to tables, then the merge.

    With ``once`` each query works off what is there and the branches finish before the merge. ``late``
    bounds the merge's state (for instance "7 days") at the price of later rows; by default it keeps all.
    ``files_per_batch`` bounds how much of a backlog the merge takes at a time, ``view_delay`` is how long
    activity windows wait for late views; views that come later count in the next window given out.
    """
    branches = {
        "base": base_profile(tables["user_info"], tables["user_info_sup_msg"], as_of),
        "devices": device_scores(views, dims, view_delay),
        "orders": order_scores(tables["order_info"], tables["order_detail"], dims, tz),
    }
    queries = [
        write_files(df, f"{folder}/{name}", f"{prefix}-{name}", once=once)
        for name, df in branches.items()
    ]
    if once:
        for q in queries:
            q.awaitTermination()
    read = {
        name: spark.readStream.schema(df.schema)
        .options(**({"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}))
        .parquet(f"{folder}/{name}")
        for name, df in branches.items()
    }
    ages = shopper_age(read["orders"], read["devices"], fix_50_plus, late)
    merged = merge_profile(ages, read["base"], late)
    queries.append(write_files(merged, f"{folder}/portraits", f"{prefix}-merge", once=once))
    if once:
        queries[-1].awaitTermination()
    return queries
