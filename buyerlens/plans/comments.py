"""Enriched comments and their moderation; static and streaming input alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from buyerlens.functions.calendar import day_partition
from buyerlens.operators import cdc, moderation
from buyerlens.operators.dedup import dedup_exact, keep_first
from buyerlens.operators.enrich import enrich_text
from buyerlens.operators.joins import interval_join, prefixed
from buyerlens.operators.lookups import lookup
from buyerlens.session import DEFAULT_TZ
from buyerlens.sinks.writers import write_changes, write_files
from buyerlens.streaming.event_time import timed

MINUTE_MS = 60_000


def comment_facts(
    comments: DataFrame,
    orders: DataFrame,
    dictionary: DataFrame,
    generator: Callable | None = None,
    words: DataFrame | None = None,
    rate: float = 0.2,
    seed: int = 0,
    tz: str = DEFAULT_TZ,
) -> DataFrame:
    """Comments with the dictionary name of their rating and their order's ``info_*`` fields.

    ``dictionary`` is (dic_code, dic_name). The comment text is generated from rating and product;
    with ``words`` a share of the texts gets a listed word appended. ``ds`` is the day of the record.
    """
    facts = lookup(
        cdc.comment_facts(comments), dictionary, ("appraise", "dic_code"), ["dic_name"], "N/A"
    )
    left = timed(facts, "ts_ms", "comment_time")
    info = prefixed(cdc.flatten_image(orders, fallback_before=True), "info_")
    right = timed(info, "info_ts_ms", "info_time")
    joined = interval_join(
        left, right, [("order_id", "info_id")], "comment_time", "info_time", -MINUTE_MS, MINUTE_MS
    ).drop("comment_time", "info_time")
    text = enrich_text(joined, "commentTxt", generator=generator)
    if words is not None:
        text = moderation.inject_words(text, words, "commentTxt", ["id", "ts_ms"], rate, seed)
    return text.withColumn("ds", day_partition("ts_ms", tz))


def first_check(facts: DataFrame, words: DataFrame, within: str | None = None) -> DataFrame:
    """First check of comment facts, each (order, time) once; static and streaming input."""
    if facts.isStreaming:
        once = dedup_exact(facts, ["order_id", "ts_ms"], within)
    else:
        order = [c for c in ("id", "info_ts_ms", "commentTxt") if c in facts.columns]
        once = keep_first(facts, ["order_id", "ts_ms"], order)
    return moderation.moderate(once, words)


def moderated(facts: DataFrame, words: DataFrame, p1_words: DataFrame) -> DataFrame:
    """Moderation result of static comment facts: ``words`` is the P0 dictionary, ``p1_words`` the P1 one."""
    return moderation.second_check(first_check(facts, words), p1_words)


def run_moderation(
    facts: DataFrame,
    words: DataFrame,
    p1_words: DataFrame,
    path: str,
    name: str = "moderation",
    within: str | None = None,
    once: bool = True,
):
    """Start the moderation of a stream of comment facts: results to a folder per micro-batch.

    Both checks run for dictionaries of any size. A retried batch rewrites its own folder, so results
    are there once; state and progress survive a restart under ``name``.
    """
    graded = first_check(facts, words, within)
    return write_changes(graded, path, name, once, lambda batch: moderation.second_check(batch, p1_words))


def run_violation_feed(spark: SparkSession, path: str, out: str, name: str = "violation-feed", once: bool = True):
    """Start the consumer of moderation results: violations as JSON lines."""
    schema = spark.read.parquet(path).schema
    results = spark.readStream.schema(schema).parquet(path)
    return write_files(moderation.violations(results), out, name, "json", once)


def violation_feed(results: DataFrame) -> DataFrame:
    """JSON lines of violation records from moderation results given as JSON text or as rows."""
    return cdc.to_json_value(moderation.violations(results))
