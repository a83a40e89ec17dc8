"""Age-band score tables. The tables are data: pass other rows to use other weights or labels."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SCORE_TYPE = "decimal(6,3)"

# The six age bands, and the order in which equal sums are preferred.
BANDS = ["18_24", "25_29", "30_34", "35_39", "40_49", "50以上"]
TIE_ORDER = ["50以上", "30_34", "18_24", "25_29", "35_39", "40_49"]

# Weight of each dimension.
WEIGHTS = {
    "device": "0.1",
    "search": "0.15",
    "tm": "0.2",
    "category": "0.3",
    "price": "0.15",
    "time": "0.1",
}

# Dimension, labels sharing a row, factors for the six bands.
FACTORS = [
    ("device", ("iOS",), ["0.7", "0.6", "0.5", "0.4", "0.3", "0.2"]),
    ("device", ("Android",), ["0.8", "0.7", "0.6", "0.5", "0.4", "0.3"]),
    ("search", ("时尚与潮流",), ["0.9", "0.7", "0.5", "0.3", "0.2", "0.1"]),
    ("search", ("性价比",), ["0.2", "0.4", "0.6", "0.7", "0.8", "0.8"]),
    ("search", ("健康与养生", "家庭与育儿"), ["0.1", "0.2", "0.4", "0.6", "0.8", "0.7"]),
    ("search", ("科技与数码",), ["0.8", "0.6", "0.4", "0.3", "0.2", "0.1"]),
    ("search", ("学习与发展",), ["0.4", "0.5", "0.6", "0.7", "0.8", "0.7"]),
    ("tm", ("索芙特", "小米", "Redmi", "CAREMiLLE", "TCL", "联想", "金沙河"), ["0.9", "0.7", "0.5", "0.3", "0.2", "0.1"]),
    ("tm", ("苹果", "长粒香", "香奈儿"), ["0.1", "0.3", "0.5", "0.7", "0.8", "0.9"]),
    ("category", ("潮流服饰",), ["0.9", "0.8", "0.6", "0.4", "0.2", "0.1"]),
    ("category", ("家具用品",), ["0.2", "0.4", "0.6", "0.8", "0.9", "0.7"]),
    ("category", ("健康食品",), ["0.1", "0.2", "0.4", "0.6", "0.8", "0.9"]),
    ("price", ("低价商品",), ["0.8", "0.6", "0.4", "0.3", "0.2", "0.1"]),
    ("price", ("中价商品",), ["0.2", "0.4", "0.6", "0.7", "0.8", "0.7"]),
    ("price", ("高价商品",), ["0.1", "0.2", "0.3", "0.4", "0.5", "0.6"]),
    ("time", ("凌晨",), ["0.2", "0.1", "0.1", "0.1", "0.1", "0.1"]),
    ("time", ("早晨",), ["0.1", "0.1", "0.1", "0.1", "0.2", "0.3"]),
    ("time", ("上午",), ["0.2", "0.2", "0.2", "0.2", "0.3", "0.4"]),
    ("time", ("中午",), ["0.4", "0.4", "0.4", "0.4", "0.4", "0.3"]),
    ("time", ("下午",), ["0.4", "0.5", "0.5", "0.5", "0.5", "0.4"]),
    ("time", ("晚上",), ["0.8", "0.7", "0.6", "0.5", "0.4", "0.3"]),
    ("time", ("夜间",), ["0.9", "0.7", "0.5", "0.3", "0.2", "0.1"]),
]

# Dimensions whose oldest band is written as ``<dim>_50`` and so never reaches the ``50以上`` sum.
SHORT_OLDEST_BAND = {"device", "search"}


def score_rows(factors=FACTORS, weights=WEIGHTS) -> list[tuple]:
    """(dimension, label, six scores), each score rounded half up to three places."""
    rows = []
    for dim, labels, values in factors:
        weight = Decimal(weights[dim])
        scores = [
            (Decimal(v) * weight).quantize(Decimal("0.001"), ROUND_HALF_UP) for v in values
        ]
        rows += [(dim, label, *scores) for label in labels]
    return rows


def score_frame(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The score table as a DataFrame (dimension, label, band, score)."""
    rows = score_rows() if rows is None else rows
    flat = [(r[0], r[1], band, r[2 + i]) for r in rows for i, band in enumerate(BANDS)]
    return spark.createDataFrame(flat, f"dimension string, label string, band string, score {SCORE_TYPE}")


def score_name(dim: str, band: str) -> str:
    return f"{dim}_50" if dim in SHORT_OLDEST_BAND and band == BANDS[-1] else f"{dim}_{band}"


def score_entry(dim: str, label: Column | str, rows: list[tuple] | None = None) -> Column:
    """Struct (s0..s5) of the six scores of a label; all zero for a label the table does not list.

    The dimension's part of the table is one map literal, so a label is looked up once.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = [r for r in (score_rows() if rows is None else rows) if r[0] == dim]
    none = _scores_sql([0] * len(BANDS))
    if not rows:
        return F.expr(none)
    entries = ", ".join(f"{_quoted(r[1])}, {_scores_sql(r[2:])}" for r in rows)
    return F.coalesce(F.try_element_at(F.expr(f"map({entries})"), label), F.expr(none))


def _scores_sql(values) -> str:
    parts = ", ".join(f"'s{i}', CAST({v} AS {SCORE_TYPE})" for i, v in enumerate(values))
    return f"named_struct({parts})"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
