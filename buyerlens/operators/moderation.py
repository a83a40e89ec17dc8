"""Sensitive-word checks of comments.

Grade P0: the last comma-separated token of a comment is a listed word. Grade P1: a comment without
a P0 finding contains listed words anywhere. Only P0 rows count as violations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from buyerlens.functions.text import last_token
from buyerlens.operators.wordsearch import finds_by_digest
from buyerlens.session import settle


def flag_membership(
    df: DataFrame, dictionary: DataFrame, word: Column | str, out: str, dict_col: str = "word"
) -> DataFrame:
    """Add whether the word is listed; null and empty words never are.

    Distributed existence join: Spark broadcasts the distinct dictionary if its size allows.
    """
    word = F.col(word) if isinstance(word, str) else word
    listed = dictionary.select(F.col(dict_col).alias("__w")).filter(F.col("__w") != "").distinct()
    joined = df.withColumn("__word", word).join(listed, F.col("__word") == F.col("__w"), "left")
    return joined.select(*df.columns, F.col("__w").isNotNull().alias(out))


def batch_membership(
    df: DataFrame, dictionary: DataFrame, words: str, row_id: list[str], dict_col: str = "word"
) -> DataFrame:
    """One row per distinct word of an array column with its membership; empty lists give no rows."""
    exploded = df.select(*row_id, F.explode(F.array_distinct(words)).alias("word"))
    return flag_membership(exploded, dictionary, "word", "listed", dict_col)


def moderate(
    df: DataFrame,
    dictionary: DataFrame,
    text_col: str = "commentTxt",
    consignee_col: str = "info_consignee",
    dict_col: str = "word",
) -> DataFrame:
    """First check: the moderation record of each comment."""
    token = last_token(text_col)
    flagged = flag_membership(df, dictionary, token, "__hit", dict_col)
    hit = F.col("__hit")
    return flagged.select(
        "user_id",
        F.col(consignee_col).alias("consignee"),
        "ts_ms",
        "ds",
        F.col(text_col).alias("msg"),
        hit.cast("int").alias("is_violation"),
        F.when(hit, "P0").otherwise("").alias("violation_grade"),
        F.when(hit, token).otherwise("").alias("violation_msg"),
    )


def second_check(df: DataFrame, dictionary: DataFrame, dict_col: str = "word", fold: bool = False) -> DataFrame:
    """Second check of comments without a P0 finding: grade P1 with all words found (static input).

    ``is_violation`` stays 0: P1 findings are hints, not violations. Equal comments are searched once; with
    ``fold`` case and full-width forms make no difference.
    Streams run it by micro-batch (:func:`buyerlens.plans.comments.run_moderation`).
    """
    if not isinstance(dictionary, DataFrame):
        raise TypeError("the second check needs a dictionary frame; an empty one finds nothing")
    df = settle(df)  # read for the search and for the result; the first check is done once
    clean = df.filter(F.col("is_violation") == 0)
    found = finds_by_digest(clean, "msg", dictionary, dict_col, fold).select(
        F.col("__id").alias("__digest"), F.array_join("found", ", ").alias("__found")
    )
    digest = F.when(F.col("is_violation") == 0, F.sha2("msg", 256))
    joined = df.join(found, digest == F.col("__digest"), "left")
    hit = F.col("__found").isNotNull()
    return joined.select(
        *[c for c in df.columns if c not in ("violation_grade", "violation_msg")],
        F.when(hit, "P1").otherwise(F.col("violation_grade")).alias("violation_grade"),
        F.coalesce("__found", "violation_msg").alias("violation_msg"),
    )


def violations(df: DataFrame) -> DataFrame:
    """Violation records for the analytic store."""
    return df.filter(F.col("is_violation") == 1).select(
        "consignee", "violation_grade", "violation_msg"
    )


def load_dictionary(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Word list to dictionary: trimmed, blanks dropped, distinct."""
    word = F.trim(F.col(line_col), F.lit(" \t\r\n"))
    return lines.select(word.alias("word")).filter(F.col("word") != "").distinct()


def indexed_dictionary(dictionary: DataFrame, dict_col: str = "word") -> DataFrame:
    """Words with consecutive numbers from 0, and their count ``__n_words``.

    Words are numbered within 4096 hash ranges, so no single task orders the whole dictionary.
    """
    words = (
        dictionary.select(F.col(dict_col).alias("word"))
        .distinct()
        .withColumn("__range", F.substring(F.md5(F.col("word").cast("binary")), 1, 3))
    )
    sizes = words.groupBy("__range").agg(F.count(F.lit(1)).alias("__c"))
    # One row per range: at most 4096.
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("__range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = sizes.select(
        "__range",
        F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__base"),
        F.sum("__c").over(whole).alias("__n_words"),
    )
    rank = F.row_number().over(W.partitionBy("__range").orderBy("word"))
    return (
        words.withColumn("__r", rank)
        .join(offsets, "__range")
        .select((F.col("__base") + F.col("__r") - 1).alias("word_no"), "word", "__n_words")
    )


def _draw(row_id: list[str], seed: int, what: str) -> Column:
    """Repeatable draw in [0, 2^32) from the row's id: survives task retries, unlike a generator."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in row_id], F.lit(f"{seed}:{what}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def inject_words(
    df: DataFrame,
    dictionary: DataFrame,
    text_col: str,
    row_id: list[str],
    rate: float = 0.2,
    seed: int = 0,
    dict_col: str = "word",
) -> DataFrame:
    """Append ``,`` and a random listed word to a share of the texts (test data for moderation)."""
    chosen = _draw(row_id, seed, "pick") < F.lit(int(rate * 2**32))
    words = indexed_dictionary(dictionary, dict_col)
    n_words = words.agg(F.max("__n_words")).scalar()
    number = F.when(chosen, F.pmod(_draw(row_id, seed, "word"), n_words))
    joined = df.withColumn("__no", number).join(
        words.select("word_no", F.col("word").alias("__w")), F.col("__no") == F.col("word_no"), "left"
    )
    text = F.col(text_col)
    injected = F.when(F.col("__w").isNotNull(), F.concat(text, F.lit(","), F.col("__w"))).otherwise(text)
    return joined.select(*[injected.alias(c) if c == text_col else F.col(c) for c in df.columns])
