"""Age-band scores and the inferred shopper age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from buyerlens.functions.scores import BANDS, SCORE_TYPE, TIE_ORDER, score_entry, score_name


def score(df: DataFrame, labels: dict[str, str], rows: list[tuple] | None = None) -> DataFrame:
    """Add the six score columns of each dimension; ``labels`` maps dimension -> label column.

    A generator holds the looked-up entries: as plain columns each of the six scores would repeat
    the lookup and whatever expression the label is made of.
    """
    entries = F.struct(*[score_entry(d, label, rows).alias(f"__{d}") for d, label in labels.items()])
    found = df.select("*", F.inline(F.array(entries)))
    return found.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            F.col(f"__{d}")[f"s{i}"].alias(score_name(d, band))
            for d in labels
            for i, band in enumerate(BANDS)
        ],
    )


def total_scores(df: DataFrame, dims: list[str], fix_50_plus: bool = False) -> DataFrame:
    """Add one column per age band: the sum of the dimensions' scores, missing ones counted as 0.

    Device and search write their oldest band as ``*_50``, which the sum of the ``50以上`` band does
    not read; that is the established result. ``fix_50_plus`` adds them.
    """
    sums = []
    for band in BANDS:
        total = F.lit(0)
        for dim in dims:
            name = score_name(dim, band)
            if name != f"{dim}_{band}" and not fix_50_plus:
                continue
            if name in df.columns:
                total = total + F.coalesce(F.col(f"`{name}`"), F.lit(0))
        sums.append(total.cast(SCORE_TYPE).alias(band))
    return df.select("*", *sums)


def top_band(df: DataFrame, out: str = "shop_age") -> DataFrame:
    """Band with the largest sum; equal sums follow the fixed preference order."""
    return df.withColumn(out, _best_band())


def _best_band() -> Column:
    ranked = [
        F.struct(F.col(f"`{b}`").alias("s"), F.lit(-i).alias("t"), F.lit(b).alias("band"))
        for i, b in enumerate(TIE_ORDER)
    ]
    return F.greatest(*ranked)["band"]
