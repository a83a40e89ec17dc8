"""Dimension tables and lookups.

No join here carries a broadcast hint: Spark broadcasts a dimension when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (checked again at run time) and otherwise uses a sort-merge
join, where the adaptive skew handling splits hot lookup keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    cols: list[str],
    default: str | None = None,
    how: str = "left",
) -> DataFrame:
    """Add ``cols`` of the dimension row with a matching key, ``default`` where there is none.

    The dimension must have one row per key (see :func:`one_per_key`).
    """
    key, dim_key = on
    side = dim.select(F.col(dim_key).alias("__dim_key"), *cols)
    joined = df.join(side, F.col(key) == F.col("__dim_key"), how)
    out = []
    for c in cols:
        col = F.col(c) if default is None else F.coalesce(F.col(c), F.lit(default))
        out.append(col.alias(c))
    return joined.select(*[c for c in df.columns if c not in cols], *out)


def one_per_key(dim: DataFrame, key: str, cols: list[str], order: str, last: bool) -> DataFrame:
    """One row per key of a dimension: the first or last in ``order``."""
    pick = F.max_by if last else F.min_by
    return dim.groupBy(key).agg(pick(F.struct(*cols), order).alias("v")).select(key, "v.*")


def last_sku(skus: DataFrame) -> DataFrame:
    """One row per sku: the last in ``seq`` if the table has such a column, else the greatest in
    (price, brand, category), nulls first.
    """
    cols = ["sku_price", "tm_name", "order_category"]
    order = F.struct(*(["seq"] if "seq" in skus.columns else []), *cols)
    picked = skus.groupBy("sku_id").agg(F.max(order).alias("v"))
    return picked.select("sku_id", *[F.col("v")[c].alias(c) for c in ["tm_name", "sku_price", "order_category"]])


def category_dim(c1: DataFrame, c2: DataFrame, c3: DataFrame) -> DataFrame:
    """Third-level categories with the names of all three levels."""
    l1 = c1.select(F.col("id").alias("__id1"), F.col("name").alias("b1name"))
    l2 = c2.select(
        F.col("id").alias("__id2"), F.col("name").alias("b2name"), F.col("category1_id").alias("__up1")
    )
    l3 = c3.select("id", F.col("name").alias("b3name"), F.col("category2_id").alias("__up2"))
    return (
        l3.join(l2, F.col("__up2") == F.col("__id2"))
        .join(l1, F.col("__up1") == F.col("__id1"))
        .select("id", "b3name", "b2name", "b1name")
    )


def sku_dim(
    sku: DataFrame,
    c3: DataFrame,
    c2: DataFrame,
    c1: DataFrame,
    compare: DataFrame,
    trademark: DataFrame,
) -> DataFrame:
    """sku_id, tm_name, sku_price and order_category for every sku, missing parts null."""
    chain = (
        (c3, "id", "category2_id", "category3_id"),
        (c2, "id", "category1_id", "category2_id"),
        (c1, "id", None, "category1_id"),
    )
    out = sku.select(
        F.col("id").alias("sku_id"), F.col("price").alias("sku_price"), "category3_id", "tm_id"
    )
    for dim, key, up, ref in chain:
        side = dim.select(F.col(key).alias("__k"), *([up] if up else [F.col(key).alias("__c1")]))
        out = out.join(side, F.col(ref) == F.col("__k"), "left").drop("__k")
    cmp_side = compare.select(F.col("id").alias("__k"), "order_category")
    out = out.join(cmp_side, F.col("__c1") == F.col("__k"), "left").drop("__k")
    tm_side = trademark.select(F.col("id").alias("__k"), "tm_name")
    out = out.join(tm_side, F.col("tm_id") == F.col("__k"), "left")
    return out.select("sku_id", "tm_name", "sku_price", "order_category")


def search_category(
    df: DataFrame, categories: DataFrame, compare: DataFrame, term_col: str = "search_item"
) -> DataFrame:
    """Search term -> first-level category -> search category (``unknown`` without a match).

    A term naming several third-level categories takes the last by id; a first-level category listed
    several times in the comparison table takes the first by id.
    """
    by_term = one_per_key(categories, "b3name", ["b1name"], "id", last=True)
    by_b1 = one_per_key(compare, "category_name", ["search_category"], "id", last=False)
    # Join the two small tables with each other first: the big side is joined once.
    terms = by_term.join(by_b1, F.col("b1name") == F.col("category_name"), "left").select(
        "b3name", F.col("b1name").alias("b1_category"), "search_category"
    )
    found = lookup(df, terms, (term_col, "b3name"), ["b1_category", "search_category"])
    return found.withColumn("search_category", F.coalesce("search_category", F.lit("unknown")))
