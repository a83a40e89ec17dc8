"""Change records and page logs: parsing, routing, flattening and projections."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from buyerlens import schemas
from buyerlens.functions import bands, calendar
from buyerlens.session import settle

NO_OP = "no op"  # default operation name where a record carries none


def parse_records(df: DataFrame, schema: str, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parse JSON text; returns (parsed rows, texts that are not valid JSON objects of the schema).

    Null values (tombstones) belong to neither output. Nothing fails on a bad row.
    """
    parsed = _parsed(df, schema, value_col)
    ok = F.col("__bad").isNull()
    return parsed.filter(ok).drop("value", "__bad"), parsed.filter(~ok).select("value")


def _parsed(df: DataFrame, schema: str, value_col: str) -> DataFrame:
    # As a generator the parser runs once per text; as a plain expression every filter on a parsed
    # field would be pushed below it with its own copy of the parser.
    record = F.from_json(
        F.col(value_col),
        f"{schema}, __bad STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"},
    )
    texts = df.filter(F.col(value_col).isNotNull())
    return texts.select(F.col(value_col).alias("value"), *_arrival(df), F.inline(F.array(record)))


def _arrival(df: DataFrame) -> list[str]:
    """The position of a record in its topic travels with it where the source gives one."""
    return ["arrival"] if "arrival" in df.columns else []


def route(df: DataFrame, table: str, table_col: str = "source.table") -> DataFrame:
    """Rows of one source table."""
    return df.filter(F.col(table_col) == table)


def parse_cdc(
    df: DataFrame, tables: dict[str, str] | None = None, value_col: str = "value"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Split a change topic into one typed frame per table, plus the rejected texts.

    Each frame has before, after, source, op and ts_ms. A cheap substring test drops most records of
    other tables before any JSON parsing; it keeps every record with an escape sequence, so it
    never loses one. If the input has a ``table`` column, as a topic landed by ``write_routed`` has,
    each frame reads its own partition only. A field of the wrong type is null; a broken text is
    rejected.
    """
    tables = schemas.CDC_TABLES if tables is None else tables
    out = {}
    for table, image in tables.items():
        value = F.col(value_col)
        if "table" in df.columns:
            maybe = df.filter(F.col("table") == table)
        else:
            maybe = df.filter(value.contains(f'"{table}"') | value.contains("\\u"))
        parsed = _parsed(maybe, schemas.envelope(image), value_col)
        out[table] = route(parsed, table).drop("value", "__bad")
    parsed = _parsed(df, schemas.RAW_ENVELOPE, value_col)
    rejects = F.col("__bad").isNotNull() | F.col("source.table").isNull()
    return out, parsed.filter(rejects).select("value")


def parse_cdc_once(
    df: DataFrame, tables: dict[str, str] | None = None, value_col: str = "value"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """:func:`parse_cdc` from one scan and one JSON parse of the topic, for static input that no consumer has landed.

    Records are parsed to a variant, and those of the wanted tables and the rejects are written to the shared folder,
    one partition a table; each typed frame reads its own. Rejects are texts that are no JSON or name no table.
    A field of the wrong type is null, but text that spells a value of the field's type counts as that value.
    """
    tables = schemas.CDC_TABLES if tables is None else tables
    parsed = df.filter(F.col(value_col).isNotNull()).select(
        F.col(value_col).alias("value"), *_arrival(df), F.inline(F.array(F.struct(F.try_parse_json(value_col).alias("record"))))
    )
    name = F.try_variant_get("record", "$.source.table", "string")
    rows = parsed.withColumn("table", F.nullif(name, F.lit("")))
    rejected = F.col("table").isNull()
    rows = rows.filter(rejected | F.col("table").isin(*tables))
    # A record that was parsed needs no text, and a reject nothing else.
    text = F.when(rejected, F.col("value"))
    landed = settle(rows.select(text.alias("value"), *_arrival(df), "record", "table"), "table")
    out = {}
    for table, image in tables.items():
        typed = F.try_variant_get("record", "$", f"struct<{_typed(schemas.envelope(image))}>")
        out[table] = route(landed, table, "table").select(*_arrival(df), F.inline(F.array(typed)))
    return out, landed.filter(rejected).select("value")


def _typed(fields: str) -> str:
    """A DDL list of fields as it stands inside a struct type."""
    return StructType.fromDDL(fields).simpleString().removeprefix("struct<").removesuffix(">")


def flatten_image(df: DataFrame, fallback_before: bool = False) -> DataFrame:
    """Fields of the after-image beside ``ts_ms``.

    With ``fallback_before`` deletes use the before-image, a record without any image keeps its
    row, and ``op`` is added (a default text where it is missing).
    """
    if not fallback_before:
        return df.filter(F.col("after").isNotNull()).select("after.*", "ts_ms", *_arrival(df))
    filled = reduce(
        or_, [F.col(f"after.{f}").isNotNull() for f in df.schema["after"].dataType.names]
    )
    image = df.select(
        F.when(filled, F.col("after")).otherwise(F.col("before")).alias("i"),
        F.coalesce("op", F.lit(NO_OP)).alias("op"),
        "ts_ms",
        *_arrival(df),
    )
    return image.select("i.*", "op", "ts_ms", *_arrival(df))


def has_text(name: str) -> Column:
    """True where a key is neither null nor empty."""
    c = F.col(name).cast("string")
    return c.isNotNull() & (c != "")


def base_labels(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Base labels of a user_info frame, with age, decade and zodiac sign where a birthday is known."""
    born = calendar.birthday("after.birthday")
    return (
        users.filter(F.col("after").isNotNull())
        .select(
            F.col("after.id").cast("string").alias("uid"),
            F.col("after.name").alias("uname"),
            "after.user_level",
            "after.login_name",
            "after.phone_num",
            "after.email",
            F.coalesce("after.gender", F.lit("home")).alias("gender"),
            born.cast("string").alias("birthday"),
            "ts_ms",
            calendar.age(born, as_of).alias("age"),
            calendar.decade(born).alias("decade"),
            calendar.zodiac(born).alias("zodiac_sign"),
        )
        .filter(has_text("uid"))
    )


def body_labels(sups: DataFrame) -> DataFrame:
    """Height and weight labels of a user_info_sup_msg frame."""
    return (
        sups.filter(F.col("after").isNotNull())
        .select(
            F.col("after.uid").cast("string").alias("uid"),
            "after.unit_height",
            "after.create_ts",
            "after.weight",
            "after.unit_weight",
            "after.height",
            "ts_ms",
        )
        .filter(has_text("uid"))
    )


def order_heads(orders: DataFrame) -> DataFrame:
    """order_id, order_time, user_id and ts_ms of flattened orders."""
    return orders.filter(has_text("id")).select(
        F.col("id").alias("order_id"), F.col("create_time").alias("order_time"), "user_id", "ts_ms", *_arrival(orders)
    )


def order_lines(details: DataFrame) -> DataFrame:
    """order_id, sku_id, order_price and time of an order_detail frame."""
    return (
        details.filter(F.col("after").isNotNull())
        .select("after.order_id", "after.sku_id", "after.order_price", "ts_ms")
        .filter(has_text("order_id"))
    )


def comment_facts(comments: DataFrame) -> DataFrame:
    """Flat comment records; ``dic_name`` is filled by a dictionary lookup on ``appraise``."""
    return comments.filter(F.col("after").isNotNull()).select(
        "ts_ms",
        F.col("source.db").alias("db"),
        F.col("source.table").alias("table"),
        F.col("source.server_id").cast("string").alias("server_id"),
        "after.appraise",
        F.col("after.comment_txt").alias("commentTxt"),
        "op",
        "after.nick_name",
        "after.create_time",
        "after.user_id",
        "after.sku_id",
        "after.id",
        "after.spu_id",
        "after.order_id",
    )


def project_page_log(df: DataFrame) -> DataFrame:
    """Device and search part of a page view: uid (``-1`` if absent), ts, device fields, search term.

    Fields that change with every view (session, machine, new-user flag) are left out, and rows
    without a ``common`` part or with an empty uid are dropped.
    """
    keyword = F.when(F.col("page.item_type") == "keyword", F.col("page.item"))
    return (
        df.filter(F.col("common").isNotNull())
        .select(
            F.coalesce("common.uid", F.lit("-1")).alias("uid"),
            F.coalesce("ts", F.lit(0)).cast("bigint").alias("ts"),
            "common.ar",
            bands.os_family("common.os").alias("os"),
            "common.ch",
            "common.md",
            "common.vc",
            "common.ba",
            keyword.alias("search_item"),
        )
        .filter(F.col("uid") != "")
    )


def to_json_value(df: DataFrame, *cols: str) -> DataFrame:
    """One JSON text per row in column ``value``."""
    # As a generator each text is made once: filters on a plain expression would make it again.
    return df.select(F.explode(F.array(F.to_json(F.struct(*(cols or df.columns))))).alias("value"))


def to_csv_line(df: DataFrame, *cols: str) -> DataFrame:
    """One comma-joined line per row; a missing field is written as ``null``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (cols or df.columns)]
    return df.select(F.concat_ws(",", *parts).alias("value"))
