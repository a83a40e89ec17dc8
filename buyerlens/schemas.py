"""Declared schemas for change records, page logs, dimensions and outputs."""

from __future__ import annotations

SOURCE = (
    "source STRUCT<db: STRING, `table`: STRING, server_id: BIGINT, connector: STRING, "
    "ts_ms: BIGINT, file: STRING, pos: BIGINT, `row`: INT>"
)


def envelope(image: str) -> str:
    """Schema of a change record whose row images have the given fields."""
    return f"before STRUCT<{image}>, after STRUCT<{image}>, {SOURCE}, op STRING, ts_ms BIGINT"


# Images left as text: enough to route a record or to find out that it is broken.
RAW_ENVELOPE = f"before STRING, after STRING, {SOURCE}, op STRING, ts_ms BIGINT"

USER_INFO = (
    "id BIGINT, login_name STRING, nick_name STRING, name STRING, phone_num STRING, email STRING, "
    "user_level STRING, gender STRING, birthday INT, create_time BIGINT"
)
USER_INFO_SUP = (
    "id BIGINT, uid BIGINT, gender STRING, height STRING, unit_height STRING, weight STRING, "
    "unit_weight STRING, flag STRING, create_ts BIGINT"
)
ORDER_INFO = (
    "id BIGINT, user_id BIGINT, consignee STRING, consignee_tel STRING, trade_body STRING, "
    "out_trade_no STRING, payment_way STRING, order_status STRING, province_id INT, "
    "total_amount DOUBLE, original_total_amount DOUBLE, coupon_reduce_amount DOUBLE, "
    "activity_reduce_amount DOUBLE, create_time BIGINT, operate_time BIGINT, refundable_time BIGINT"
)
ORDER_DETAIL = (
    "id BIGINT, order_id BIGINT, sku_id BIGINT, sku_name STRING, sku_num INT, order_price DOUBLE, "
    "split_total_amount DOUBLE, split_activity_amount DOUBLE, split_coupon_amount DOUBLE, "
    "create_time BIGINT"
)
COMMENT_INFO = (
    "id BIGINT, user_id BIGINT, sku_id BIGINT, spu_id BIGINT, order_id BIGINT, nick_name STRING, "
    "appraise STRING, comment_txt STRING, create_time BIGINT"
)

CDC_TABLES = {
    "user_info": USER_INFO,
    "user_info_sup_msg": USER_INFO_SUP,
    "order_info": ORDER_INFO,
    "order_detail": ORDER_DETAIL,
    "comment_info": COMMENT_INFO,
}

PAGE_LOG = (
    "common STRUCT<ar: STRING, uid: STRING, os: STRING, ch: STRING, is_new: STRING, md: STRING, "
    "mid: STRING, vc: STRING, ba: STRING, sid: STRING>, "
    "page STRUCT<page_id: STRING, last_page_id: STRING, during_time: BIGINT, item: STRING, "
    "item_type: STRING, from_pos_seq: INT, from_pos_id: INT>, "
    "ts BIGINT"
)

MODERATED = (
    "user_id BIGINT, consignee STRING, ts_ms BIGINT, ds STRING, msg STRING, "
    "is_violation INT, violation_grade STRING, violation_msg STRING"
)

# Fixed output order of the flat portrait file.
PORTRAIT_COLUMNS = [
    "user_id", "uname", "shop_age", "user_level", "phone_num", "login_name", "email", "gender",
    "age", "birthday", "zodiac_sign", "decade", "height", "unit_height", "weight", "unit_weight",
]
