"""Text expressions for the comment stream."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BAD_REVIEW = "差评"  # fixed value: dictionary name of a negative comment
PROMPT = "为商品「%s」写一条电商%s，20字以内。%s"
BAD_REVIEW_TONE = "语气可以强烈，但不得辱骂。"


def last_token(text: Column | str) -> Column:
    """Last non-empty tail of a comma list: trailing commas do not count as tokens."""
    text = F.col(text) if isinstance(text, str) else text
    return F.substring_index(F.rtrim(text, F.lit(",")), ",", -1)


def comment_prompt(
    kind: Column | str,
    product: Column | str,
    template: str = PROMPT,
    bad_tone: str = BAD_REVIEW_TONE,
    tone: str = "",
) -> Column:
    """Request text for a comment generator; bad reviews get a harsher tone."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    product = F.col(product) if isinstance(product, str) else product
    wording = F.when(kind == BAD_REVIEW, F.lit(bad_tone)).otherwise(F.lit(tone))
    return F.format_string(
        template, F.coalesce(product, F.lit("")), F.coalesce(kind, F.lit("")), wording
    )


def key_text(*cols: Column | str) -> Column:
    """Composite key as text, parts joined by ``_``."""
    return F.concat_ws("_", *cols)
