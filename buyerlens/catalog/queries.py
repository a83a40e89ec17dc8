"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerlens import schemas
from buyerlens.catalog import standins as t
from buyerlens.functions import bands, calendar, text
from buyerlens.operators import activity, cdc, dedup, enrich, joins, labels, lookups, moderation, scoring, skew, versions, wordsearch
from buyerlens.plans import comments, portrait
from buyerlens.schemas import PORTRAIT_COLUMNS
from buyerlens.session import shared_dir
from buyerlens.sinks import keyed, writers

QUERIES = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return t.tidy(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


AS_OF = "2025-02-28"


def as_of():
    return F.lit(AS_OF).cast("date")


# -- parsing, routing, projections -------------------------------------------------------------


@query
def route_filter(spark, sf):
    orders = t.table(spark, sf, "orders")
    return cdc.route(orders, "F", "o_orderstatus").select(
        "o_orderkey", "o_custkey", "o_totalprice", t.millis("o_orderdate").alias("ts_ms")
    )


@query
def page_projection(spark, sf):
    return cdc.project_page_log(t.page_log(spark, sf))


@query
def json_round_trip(spark, sf):
    pages, _ = cdc.parse_records(cdc.to_json_value(t.page_log(spark, sf)), schemas.PAGE_LOG)
    return pages.select("common.mid", "common.uid", "common.os", "page.item", "page.during_time", "ts")


@query
def json_rejects(spark, sf):
    ev = t.table(spark, sf, "events")
    broken = F.when(F.col("event_id") % 10 != 0, F.col("props"))
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("#"), F.col("props"))).otherwise(broken)
    _, bad = cdc.parse_records(ev.select(broken.alias("value")), "k BIGINT")
    return bad.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query
def cdc_flatten(spark, sf):
    tables, _ = cdc.parse_cdc(t.order_records(spark, sf), {"order_info": schemas.ORDER_INFO})
    return cdc.flatten_image(tables["order_info"]).select(
        "id", "user_id", "consignee", "order_status", "total_amount", "create_time", "ts_ms"
    )


@query
def cdc_flatten_once(spark, sf):
    topic = t.order_records(spark, sf).unionAll(t.comment_records(spark, sf))
    wanted = {"order_info": schemas.ORDER_INFO, "comment_info": schemas.COMMENT_INFO}
    tables, _ = cdc.parse_cdc_once(topic, wanted)
    return cdc.flatten_image(tables["order_info"]).select(
        "id", "user_id", "consignee", "order_status", "total_amount", "create_time", "ts_ms"
    )


@query
def cdc_rejects_once(spark, sf):
    ev = t.table(spark, sf, "events")
    broken = F.when(F.col("event_id") % 10 != 0, F.col("props"))
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("#"), F.col("props"))).otherwise(broken)
    topic = ev.select(broken.alias("value")).unionAll(t.order_records(spark, sf).select("value"))
    _, bad = cdc.parse_cdc_once(topic, {"order_info": schemas.ORDER_INFO})
    return bad.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query
def cdc_image_fallback(spark, sf):
    o = t.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    image = F.struct(key.alias("id"), F.col("o_custkey").alias("user_id"))
    body = F.struct(
        F.when(key % 3 != 0, image).alias("before"),
        F.when(key % 2 == 0, image).alias("after"),
        F.struct(F.lit("order_info").alias("table")).alias("source"),
        F.when(key % 5 != 0, "d").alias("op"),
        t.order_ms("o_orderkey").alias("ts_ms"),
    )
    tables, _ = cdc.parse_cdc(
        o.select(F.to_json(body).alias("value")), {"order_info": "id BIGINT, user_id BIGINT"}
    )
    return cdc.flatten_image(tables["order_info"], fallback_before=True)


@query
def base_labels(spark, sf):
    tables, _ = cdc.parse_cdc(t.user_records(spark, sf), {"user_info": schemas.USER_INFO})
    return cdc.base_labels(tables["user_info"], as_of())


@query
def age_decade_zodiac(spark, sf):
    born = calendar.birthday((F.col("c_custkey") * 37) % 20000)
    return t.table(spark, sf, "customer").select(
        "c_custkey",
        born.cast("string").alias("birthday"),
        calendar.age(born, as_of()).alias("age"),
        calendar.decade(born).alias("decade"),
        calendar.zodiac(born).alias("zodiac_sign"),
    )


@query
def day_partition(spark, sf):
    return t.table(spark, sf, "events").select(
        "event_id", calendar.day_partition(t.millis("ts")).alias("ds")
    )


@query
def hour_band(spark, sf):
    hour = calendar.hour_of_day(t.millis("ts"))
    return t.table(spark, sf, "events").select(
        "event_id", hour.alias("hour"), calendar.hour_band(hour).alias("order_time")
    )


@query
def price_band(spark, sf):
    return t.table(spark, sf, "part").select(
        "p_partkey", bands.price_band("p_retailprice", 930, 960).alias("order_price")
    )


# -- deduplication and versions ----------------------------------------------------------------


@query
def exact_dedup(spark, sf):
    ev = t.table(spark, sf, "events").select("user_id", "event_type", t.event_k().alias("k"))
    return dedup.dedup_exact(ev.unionAll(ev))


@query
def key_time_dedup(spark, sf):
    li = t.table(spark, sf, "lineitem").select(
        "l_orderkey", t.millis("l_shipdate").alias("ship_ms"), "l_linenumber", "l_partkey",
        "l_suppkey", "l_extendedprice",
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return dedup.keep_first(li, ["l_orderkey", "ship_ms"], order)


def _versions(spark, sf):
    return t.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", t.millis("o_orderdate").alias("ts_ms")
    )


@query
def keep_if_newer(spark, sf):
    return dedup.keep_if_newer(_versions(spark, sf), ["o_custkey"], "ts_ms", ["o_orderkey"])


@query
def latest_state(spark, sf):
    return dedup.latest_state(_versions(spark, sf), ["o_custkey"], "ts_ms", ["o_orderkey"])


@query
def keyed_merge(spark, sf):
    rows = _versions(spark, sf)
    old, new = rows.filter("o_orderkey % 2 = 0"), rows.filter("o_orderkey % 2 = 1")
    merged = writers.merge_by_key(old, new, ["o_custkey"], "ts_ms", ["o_orderkey"])
    return writers.as_cells(merged, "o_custkey")


@query
def keyed_upserts(spark, sf):
    rows, path = _versions(spark, sf), f"{shared_dir(spark)}/keyed/{uuid.uuid4().hex}"
    for part in (0, 1):
        keyed.upsert(rows.filter(F.col("o_orderkey") % 2 == part), path, ["o_custkey"], "ts_ms", ["o_orderkey"])
    return writers.as_cells(keyed.keyed_rows(spark, path), "o_custkey").select(
        "o_custkey", "o_orderkey", "o_orderstatus", "ts_ms"
    )


# -- activity ----------------------------------------------------------------------------------


def _views(spark, sf):
    return dedup.dedup_exact(cdc.project_page_log(t.page_log(spark, sf)))


@query
def user_activity_sets(spark, sf):
    return activity.user_activity(_views(spark, sf))


@query
def user_activity_bounded(spark, sf):
    return activity.activity_bounded(_views(spark, sf), limit=2).drop("pv", "ts")


@query
def tumbling_last(spark, sf):
    ev = t.table(spark, sf, "events").select(
        "user_id", t.millis("ts").alias("ts"), "event_id", "event_type"
    )
    return activity.tumbling_last(ev, "user_id", "ts", ["event_id"])


@query
def activity_snapshots(spark, sf):
    return activity.activity_snapshots(_views(spark, sf))


@query
def device_search_scores(spark, sf):
    views = cdc.project_page_log(t.page_log(spark, sf))
    return portrait.device_scores(views, t.dimensions(spark, sf))


# -- joins and lookups -------------------------------------------------------------------------


def _events_at(spark, sf, prefix, shift_ms=0):
    return t.table(spark, sf, "events").select(
        F.col("event_id").alias(f"{prefix}id"),
        F.col("user_id").alias(f"{prefix}user"),
        (t.millis("ts") + shift_ms).alias(f"{prefix}ms"),
    )


@query
def interval_join_seconds(spark, sf):
    left, right = _events_at(spark, sf, "v_"), _events_at(spark, sf, "p_", 300_000)
    return joins.interval_join(
        left, right, [("v_user", "p_user")], "v_ms", "p_ms", -300_000, 300_000
    )


@query
def interval_join_days(spark, sf):
    o = t.table(spark, sf, "orders").select("o_orderkey", t.millis("o_orderdate").alias("o_ms"))
    li = t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", t.millis("l_shipdate").alias("l_ms")
    )
    week = 7 * calendar.DAY_MS
    return joins.interval_join(o, li, [("o_orderkey", "l_orderkey")], "o_ms", "l_ms", -week, week)


@query
def interval_join_prefixed(spark, sf):
    left = _events_at(spark, sf, "")
    right = joins.prefixed(_events_at(spark, sf, "", 7_200_000), "info_")
    hour = calendar.HOUR_MS
    return joins.interval_join(left, right, [("user", "info_user")], "ms", "info_ms", -hour, hour)


@query
def dim_lookup_default(spark, sf):
    nation = t.table(spark, sf, "nation")
    dim = nation.select(F.col("n_nationkey").alias("dic_code"), F.col("n_name").alias("dic_name"))
    unlisted = F.when(F.col("c_custkey") % 5 == 0, 100).otherwise(0)
    c = t.table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") + unlisted).alias("c_nationkey"))
    return lookups.lookup(c, dim, ("c_nationkey", "dic_code"), ["dic_name"], "N/A")


@query
def dim_as_of(spark, sf):
    orders, lines = t.table(spark, sf, "orders"), t.table(spark, sf, "lineitem")
    names = orders.select(
        (F.col("o_custkey") % 50).alias("dic_code"), t.millis("o_orderdate").alias("valid_from"),
        F.col("o_orderpriority").alias("dic_name"),
    )
    code = F.when(F.col("l_partkey") % 9 != 0, F.col("l_suppkey") % 60)
    facts = lines.select("l_orderkey", "l_linenumber", code.alias("code"), t.millis("l_shipdate").alias("ts"))
    return versions.as_of_lookup(facts, names, ("code", "dic_code"), "ts", "valid_from", ["dic_name"], "N/A")


@query
def dim_chain_inner(spark, sf):
    c1, c2, _ = t.levels(spark, sf)
    unlisted = F.when(F.col("s_suppkey") % 7 == 0, 100).otherwise(0)
    c3 = t.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        (F.col("s_nationkey") + unlisted).alias("category2_id"),
    )
    return lookups.category_dim(c1, c2, c3)


@query
def dim_chain_left(spark, sf):
    return t.skus(spark, sf)


@query
def term_category_lookup(spark, sf):
    views = cdc.project_page_log(t.page_log(spark, sf)).select("uid", "ts", "search_item")
    return lookups.search_category(views, t.categories(spark, sf), t.search_compare(spark, sf))


@query
def sku_value_bands(spark, sf):
    unlisted = F.when(F.col("l_partkey") % 7 == 0, -1 - F.col("l_partkey"))
    li = t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.coalesce(unlisted, "l_partkey").alias("l_partkey"),
        t.order_ms("l_orderkey").alias("create_ms"),
    )
    known = lookups.last_sku(t.repeated_skus(spark, sf))
    cols = ["tm_name", "sku_price", "order_category"]
    joined = lookups.lookup(li, known, ("l_partkey", "sku_id"), cols, how="inner")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "tm_name",
        "order_category",
        bands.price_band("sku_price").alias("order_price"),
        calendar.hour_band(calendar.hour_of_day("create_ms")).alias("order_time"),
    )


# -- labels and scores -------------------------------------------------------------------------


def _labelled_lines(spark, sf):
    o = t.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        t.millis("o_orderdate").alias("ts"),
    )
    li = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = t.table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    count = li.count()  # from the files' footers
    o, li = skew.spread(o, count, "o_orderkey"), skew.spread(li, count, "l_orderkey")
    joined = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        "o_custkey", "ts", "o_orderkey", "l_linenumber", "l_partkey",
        F.col("p_brand").alias("tm_name"),
        F.col("p_type").alias("order_category"),
        F.col("o_orderstatus").alias("order_price"),
        F.col("o_orderpriority").alias("order_time"),
    )


@query
def label_mode(spark, sf):
    return labels.label_profile(_labelled_lines(spark, sf), "o_custkey", labels.ORDER_DIMS)


@query
def label_changes(spark, sf):
    return labels.label_changes(
        _labelled_lines(spark, sf), "o_custkey", labels.ORDER_DIMS,
        ["ts", "o_orderkey", "l_linenumber", "l_partkey"], ["ts", "o_orderkey"],
    )


@query
def emit_on_change(spark, sf):
    ev = t.table(spark, sf, "events").select(
        "user_id", t.millis("ts").alias("ts"), "event_id", "event_type"
    )
    return labels.emit_on_change(ev, "user_id", ["event_type"], ["ts", "event_id"])


SCORE_LABELS = {
    "time": "order_time",
    "price": "order_price",
    "category": "order_category",
    "tm": "tm_name",
    "device": "os",
    "search": "search_category",
}


def _event_labels(spark, sf):
    """Each event with one label per score dimension, some unlisted."""
    ev = t.table(spark, sf, "events").withColumn("k", t.event_k())
    hour = calendar.hour_of_day(t.millis("ts"))

    def pick(values, by):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))

    return ev.select(
        "event_id",
        calendar.hour_band(hour).alias("order_time"),
        bands.price_band("value", 100, 300).alias("order_price"),
        pick(["潮流服饰", "家具用品", "健康食品", "none"], F.col("k")).alias("order_category"),
        pick(t.BRANDS, F.col("user_id")).alias("tm_name"),
        pick(["iOS", "Android", "Harmony"], F.col("event_id")).alias("os"),
        pick([*t.SEARCH_NAMES.values(), "健康与养生", "unknown"], F.col("k") + F.col("user_id")).alias(
            "search_category"
        ),
    )


@query
def score_table(spark, sf):
    return scoring.score(_event_labels(spark, sf), SCORE_LABELS).drop(*SCORE_LABELS.values())


@query
def age_band_argmax(spark, sf):
    scored = scoring.score(_event_labels(spark, sf), SCORE_LABELS)
    banded = scoring.top_band(scoring.total_scores(scored, portrait.SCORE_DIMS))
    return banded.select("event_id", *scoring.BANDS, "shop_age")


@query
def age_band_argmax_fixed(spark, sf):
    scored = scoring.score(_event_labels(spark, sf), SCORE_LABELS)
    banded = scoring.top_band(scoring.total_scores(scored, portrait.SCORE_DIMS, fix_50_plus=True))
    return banded.select("event_id", *scoring.BANDS, "shop_age")


# -- moderation --------------------------------------------------------------------------------


@query
def dictionary_load(spark, sf):
    return moderation.load_dictionary(t.tail_words(spark, sf))


@query
def word_membership(spark, sf):
    words = moderation.load_dictionary(t.bench_words(spark, sf))
    turns = t.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.split("text", " ").alias("words")
    )
    return moderation.batch_membership(turns, words, "words", ["conv_id", "turn"])


@query
def last_token_flag(spark, sf):
    words = t.tail_words(spark, sf).select(F.col("value").alias("word"))
    docs = t.table(spark, sf, "documents").select("doc_id", "text")
    token = text.last_token("text")
    flagged = moderation.flag_membership(docs, words, token, "is_violation")
    return flagged.select("doc_id", token.alias("token"), "is_violation")


def _found(spark, sf):
    words = moderation.load_dictionary(t.bench_words(spark, sf))
    return t.table(spark, sf, "documents").select("doc_id", "text"), words


@query
def find_all_words(spark, sf):
    docs, words = _found(spark, sf)
    return wordsearch.find_words(docs, "doc_id", "text", words)


@query
def find_words_joined(spark, sf):
    docs, words = _found(spark, sf)
    found = wordsearch.finds_by_digest(docs, "text", words)
    return docs.join(found, F.sha2("text", 256) == F.col("__id")).select("doc_id", "found")


@query
def find_words_folded(spark, sf):
    docs, words = _found(spark, sf)
    return wordsearch.find_words(docs, "doc_id", "text", words, fold=True)


def _moderated(spark, sf):
    heads = t.tail_words(spark, sf).select(F.col("value").alias("word"))
    p1 = moderation.load_dictionary(t.bench_words(spark, sf))
    return comments.moderated(t.doc_comments(spark, sf), heads, p1)


@query
def moderation_result(spark, sf):
    return _moderated(spark, sf).withColumn("msg", F.md5("msg"))


@query
def violations_only(spark, sf):
    return moderation.violations(_moderated(spark, sf))


@query
def violation_feed(spark, sf):
    results, _ = cdc.parse_records(
        cdc.to_json_value(_moderated(spark, sf)), schemas.MODERATED
    )
    return comments.violation_feed(results)


@query
def seeded_injection(spark, sf):
    words = moderation.load_dictionary(t.bench_words(spark, sf))
    turns = t.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return moderation.inject_words(turns, words, "text", ["conv_id", "turn"], 0.2, 7)


@query
def text_generation(spark, sf):
    turns = t.table(spark, sf, "conversations")
    kind = F.when(F.col("role") == "user", text.BAD_REVIEW).otherwise("好评")
    return enrich.enrich_text(
        turns, "prompt", text.comment_prompt(kind, F.col("conv_id").cast("string"))
    ).select("conv_id", "turn", "prompt")


@query
def text_generation_udf(spark, sf):
    turns = t.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return enrich.enrich_text(
        turns, "text", F.col("text"), lambda prompts: [f"{len(p)} chars: {p}" for p in prompts]
    )


@query
def text_generation_bounded(spark, sf):
    turns = t.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    opening = F.concat("role", F.lit(": "), F.substring("text", 1, 12))
    answered = enrich.enrich_bounded(turns, "answer", lambda p: f"{len(p)} chars: {p}", opening, in_flight=4, tasks=8)
    return answered.select("conv_id", "turn", "answer")


@query
def comment_facts(spark, sf):
    tables, _ = cdc.parse_cdc(
        t.comment_records(spark, sf).unionAll(t.order_records(spark, sf)),
        {"comment_info": schemas.COMMENT_INFO, "order_info": schemas.ORDER_INFO},
    )
    names = t.table(spark, sf, "region").select(
        (F.lit(1200) + F.col("r_regionkey")).cast("string").alias("dic_code"),
        F.when(F.col("r_regionkey") == 2, text.BAD_REVIEW).otherwise(F.col("r_name")).alias("dic_name"),
    )
    facts = comments.comment_facts(tables["comment_info"], tables["order_info"], names)
    return facts.select(
        "id", "order_id", "user_id", "appraise", "dic_name", "commentTxt", "table", "op", "ts_ms", "ds",
        "info_consignee", "info_trade_body", "info_order_status", "info_op", "info_ts_ms",
    )


# -- portraits ---------------------------------------------------------------------------------


def _tables(spark, sf, *names):
    # As landed by ``write_routed``: each consumer reads the records of its own table only.
    return {
        name: cdc.parse_cdc(t.TOPICS[name](spark, sf), {name: schemas.CDC_TABLES[name]})[0][name] for name in names
    }


def _portrait_inputs(spark, sf):
    names = ["user_info", "user_info_sup_msg", "order_info", "order_detail"]
    pages, _ = cdc.parse_records(cdc.to_json_value(t.page_log(spark, sf)), schemas.PAGE_LOG)
    return (
        _tables(spark, sf, *names),
        cdc.project_page_log(pages),
        t.dimensions(spark, sf),
    )


@query
def base_profile(spark, sf):
    tables = _tables(spark, sf, "user_info", "user_info_sup_msg")
    return portrait.base_profile(tables["user_info"], tables["user_info_sup_msg"], as_of())


@query
def order_scores(spark, sf):
    tables = _tables(spark, sf, "order_info", "order_detail")
    return portrait.order_scores(
        tables["order_info"], tables["order_detail"], t.dimensions(spark, sf)
    )


@query
def portrait_full(spark, sf):
    tables, views, dims = _portrait_inputs(spark, sf)
    return portrait.portrait(tables, views, dims, as_of())


@query
def csv_export(spark, sf):
    tables, views, dims = _portrait_inputs(spark, sf)
    rows = portrait.portrait(tables, views, dims, as_of())
    return cdc.to_csv_line(rows, *PORTRAIT_COLUMNS)
