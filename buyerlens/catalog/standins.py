"""The given tables dressed as the records the operators expect.

Derived columns are plain arithmetic on keys, so that the checking SQL can state them too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from buyerlens.operators.lookups import category_dim, sku_dim
from buyerlens.plans.portrait import Dimensions

BASE_MS = 1_704_067_200_000  # 2024-01-01 UTC, when the events begin
SPAN_S = 2_592_000  # thirty days in seconds

SEARCH_NAMES = {
    "AFRICA": "时尚与潮流",
    "AMERICA": "性价比",
    "ASIA": "科技与数码",
    "EUROPE": "学习与发展",
}
ORDER_CATEGORIES = {
    "AFRICA": "潮流服饰",
    "AMERICA": "家具用品",
    "ASIA": "健康食品",
}
BRANDS = ["小米", "苹果", "TCL", "香奈儿", "Other"]


_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Table times carry no zone; they are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _TABLES[key]


def millis(col: str) -> Column:
    return F.unix_millis(F.col(col).cast("timestamp"))


def tidy(df: DataFrame) -> DataFrame:
    """Plain result types: BIGINT, DOUBLE, STRING."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        col = F.col(f"`{f.name}`")
        if kind in ("integer", "short", "byte", "boolean"):
            col = col.cast("bigint")
        elif kind in ("decimal", "float"):
            col = col.cast("double")
        elif kind == "array":
            col = F.array_join(col, "|")
        out.append(col.alias(f.name))
    return df.select(*out)


def named(values: dict[str, str], key: Column) -> Column:
    chain = F
    for k, v in values.items():
        chain = chain.when(key == k, F.lit(v))
    return chain


# -- page log ----------------------------------------------------------------------------------


def event_k() -> Column:
    return F.expr("CAST(get_json_object(props, '$.k') AS BIGINT)")


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page views: signups without uid, errors with an empty one, clicks as searches."""
    ev = table(spark, sf_dir, "events").withColumn("k", event_k())
    return ev.selectExpr(
        """named_struct(
            'ar', CAST(user_id % 9 AS STRING),
            'uid', CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL
                   ELSE CAST(user_id AS STRING) END,
            'os', CASE k % 4 WHEN 2 THEN 'iOS 16.1' WHEN 3 THEN 'Harmony 4' ELSE 'Android 13.0' END,
            'ch', event_type,
            'is_new', '0',
            'md', concat('model ', k % 5),
            'mid', CAST(event_id AS STRING),
            'vc', 'v2.1',
            'ba', concat('brand', k % 7),
            'sid', CAST(event_id AS STRING)) AS common""",
        """named_struct(
            'page_id', event_type,
            'last_page_id', 'home',
            'during_time', CAST(value * 100 AS BIGINT),
            'item', concat('NATION_', user_id % 30),
            'item_type', IF(event_type = 'click', 'keyword', 'sku_id'),
            'from_pos_seq', 0,
            'from_pos_id', 0) AS page""",
        "unix_millis(CAST(ts AS TIMESTAMP)) AS ts",
    )


# -- change records ----------------------------------------------------------------------------

ORDER_MS = f"({BASE_MS} + pmod({{key}} * 7919, {SPAN_S}) * 1000)"
USER_MS = f"({BASE_MS} + pmod(c_custkey * 104729, {SPAN_S}) * 1000)"


def order_ms(key: str) -> Column:
    return F.expr(ORDER_MS.format(key=key))


def envelope(
    df: DataFrame, name: str, after: str, ts: str, op: str = "c", before: str | None = None
) -> DataFrame:
    """Change records as JSON text."""
    images = f"'after', {after}" if before is None else f"'before', {before}, 'after', {after}"
    # As a generator each text is made once: filters on a plain expression would make it again.
    return df.selectExpr(
        f"""explode(array(to_json(named_struct({images},
            'source', named_struct('db', 'shop', 'table', '{name}', 'server_id', 1),
            'op', '{op}', 'ts_ms', {ts})))) AS value"""
    )


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = """named_struct(
        'id', c_custkey,
        'login_name', lower(c_name),
        'nick_name', 'nick',
        'name', c_name,
        'phone_num', concat('555-', c_custkey),
        'email', concat(c_custkey, '@example.org'),
        'user_level', CAST(c_custkey % 3 + 1 AS STRING),
        'gender', CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END,
        'birthday', IF(c_custkey % 11 <> 0, CAST(c_custkey * 37 % 20000 AS INT), NULL))"""
    return envelope(table(spark, sf_dir, "customer"), "user_info", after, USER_MS)


def sup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Body data recorded up to eight days before or after the user record."""
    after = f"""named_struct(
        'id', c_custkey,
        'uid', c_custkey,
        'height', CAST(c_custkey % 60 + 140 AS STRING),
        'unit_height', 'cm',
        'weight', CAST(c_custkey % 50 + 40 AS STRING),
        'unit_weight', 'kg',
        'create_ts', {USER_MS})"""
    ts = f"{USER_MS} + (c_custkey % 17 - 8) * 86400000"
    return envelope(table(spark, sf_dir, "customer"), "user_info_sup_msg", after, ts)


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One creation per order, an update two seconds later for every third, copies of every fifth."""
    o = table(spark, sf_dir, "orders")
    ts = ORDER_MS.format(key="o_orderkey")

    def image(status: str) -> str:
        return f"""named_struct(
            'id', o_orderkey,
            'user_id', o_custkey,
            'consignee', concat('Customer ', o_custkey),
            'trade_body', o_orderpriority,
            'order_status', '{status}',
            'total_amount', o_totalprice,
            'create_time', {ts})"""

    third = o.filter("o_orderkey % 3 = 0")
    return (
        envelope(o, "order_info", image("1001"), ts)
        .unionAll(envelope(third, "order_info", image("1002"), f"{ts} + 2000", "u", image("1001")))
        .unionAll(envelope(o.filter("o_orderkey % 5 = 0"), "order_info", image("1001"), ts))
    )


def detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines recorded up to six seconds before or after their order."""
    after = """named_struct(
        'id', CAST(l_linenumber AS BIGINT),
        'order_id', l_orderkey,
        'sku_id', l_partkey,
        'sku_num', 1,
        'order_price', l_extendedprice)"""
    ts = ORDER_MS.format(key="l_orderkey") + " + (CAST(l_linenumber AS BIGINT) - 4) * 2000"
    return envelope(table(spark, sf_dir, "lineitem"), "order_detail", after, ts)


def comment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comment on every order, up to 90 seconds off; every seventh is a delete."""
    ts = ORDER_MS.format(key="o_orderkey")
    image = f"""IF(o_orderkey % 7 <> 0, named_struct(
        'id', o_orderkey + 7,
        'user_id', o_custkey,
        'sku_id', o_orderkey % 50,
        'spu_id', o_orderkey % 10,
        'order_id', o_orderkey,
        'nick_name', 'nick',
        'appraise', CAST(1200 + o_orderkey % 7 AS STRING),
        'comment_txt', 'text',
        'create_time', {ts}), NULL)"""
    orders = table(spark, sf_dir, "orders")
    return envelope(orders, "comment_info", image, f"{ts} + (o_orderkey % 5 - 2) * 45000")


#: Change records by source table.
TOPICS = {
    "user_info": user_records,
    "user_info_sup_msg": sup_records,
    "order_info": order_records,
    "order_detail": detail_records,
    "comment_info": comment_records,
}


# -- dimensions --------------------------------------------------------------------------------


def levels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three category levels: region (1), nation as (2) and again, one to one, as (3)."""
    nation = table(spark, sf_dir, "nation")
    c1 = table(spark, sf_dir, "region").selectExpr("r_regionkey AS id", "r_name AS name")
    c2 = nation.selectExpr(
        "n_nationkey AS id", "concat('group ', n_name) AS name", "n_regionkey AS category1_id"
    )
    c3 = nation.selectExpr("n_nationkey AS id", "n_name AS name", "n_nationkey AS category2_id")
    return c1, c2, c3


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_dim(*levels(spark, sf_dir))


def search_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region to search category, the fifth unlisted; a second row per region must lose."""
    region = table(spark, sf_dir, "region")
    one = region.select(
        F.col("r_regionkey").alias("id"),
        F.col("r_name").alias("category_name"),
        named(SEARCH_NAMES, F.col("r_name")).alias("search_category"),
    ).filter(F.col("search_category").isNotNull())
    return one.unionAll(one.select(F.col("id") + 100, "category_name", F.lit("健康与养生")))


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as skus: three quarters with a category, four fifths with a listed brand."""
    c1, c2, c3 = levels(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    sku = part.selectExpr(
        "p_partkey AS id", "p_partkey * 13 % 1500 AS price", "p_size AS category3_id", "p_brand AS tm_id"
    )
    compare = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"),
        named(ORDER_CATEGORIES, F.col("r_name")).alias("order_category"),
    )
    number = F.substring_index("p_brand", "#", -1).cast("int")
    name = F.element_at(F.array(*[F.lit(b) for b in BRANDS]), number % len(BRANDS) + 1)
    trademark = (
        part.select(F.col("p_brand").alias("id"), name.alias("tm_name"))
        .distinct()
        .filter(F.col("tm_name") != "Other")
    )
    return sku_dim(sku, c3, c2, c1, compare, trademark)


def repeated_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third sku a second time, ten cheaper or dearer and with another brand."""
    one = skus(spark, sf_dir)
    key = F.col("sku_id")
    again = one.filter(key % 3 == 0).select(
        "sku_id",
        F.lit("TCL").alias("tm_name"),
        (F.col("sku_price") + F.when(key % 2 == 0, 10).otherwise(-10)).alias("sku_price"),
        "order_category",
    )
    return one.unionByName(again)


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return Dimensions(
        repeated_skus(spark, sf_dir), categories(spark, sf_dir), search_compare(spark, sf_dir)
    )


# -- words and comments ------------------------------------------------------------------------


def tail_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary lines: the last comma token of every document, unlisted forms of it for most."""
    from buyerlens.functions.text import last_token

    docs = table(spark, sf_dir, "documents").select("doc_id", last_token("text").alias("token"))
    unlisted = F.when((F.col("doc_id") % 4 == 0) | (F.col("token") == ""), "").otherwise("~")
    return docs.select(F.concat("token", unlisted).alias("value"))


def bench_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary lines: every word of Latin letters, one-letter ones too, of every benchmark text."""
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    return table(spark, sf_dir, "benchmark").select(F.explode(words).alias("value"))


def doc_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as comment facts; every fourth twice, as a repeated delivery."""
    docs = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 97).alias("user_id"),
        F.col("source").alias("info_consignee"),
        (F.lit(BASE_MS) + F.col("doc_id") * 60_000).alias("ts_ms"),
        F.lit("20240101").alias("ds"),
        F.col("doc_id").alias("order_id"),
        F.col("doc_id").alias("id"),
        F.col("text").alias("commentTxt"),
    )
    return docs.unionAll(docs.filter(F.col("order_id") % 4 == 0))
