"""Invented change records and page views with the edge cases the portrait must handle."""

from __future__ import annotations

import json

T0 = 1_746_757_085_000  # 2025-05-09 10:18:05 in Shanghai
DAY = 86_400_000


def change(table, after, ts, op="c", before=None):
    body = {"op": op, "after": after, "source": {"db": "shop", "table": table, "server_id": 1}, "ts_ms": ts}
    if before is not None:
        body["before"] = before
    return json.dumps(body, ensure_ascii=False)


def user(uid, ts, birthday=10600, gender="M"):
    return change(
        "user_info",
        {"id": uid, "login_name": f"login{uid}", "name": f"Name {uid}", "phone_num": f"555-{uid}",
         "email": f"{uid}@example.org", "user_level": "1", "gender": gender, "birthday": birthday},
        ts,
    )


def sup(uid, ts):
    return change(
        "user_info_sup_msg",
        {"id": uid, "uid": uid, "height": "170", "unit_height": "cm", "weight": "60",
         "unit_weight": "kg", "create_ts": ts},
        ts,
    )


def order(oid, uid, ts, created=None, op="c"):
    after = {"id": oid, "user_id": uid, "consignee": f"Name {uid}", "trade_body": f"Product {oid}",
             "create_time": T0 if created is None else created, "total_amount": 10.0}
    return change("order_info", after, ts, op)


def detail(oid, sku, ts):
    return change("order_detail", {"id": sku, "order_id": oid, "sku_id": sku, "order_price": 9.5}, ts)


def comment(cid, oid, uid, code, ts):
    return change(
        "comment_info",
        {"id": cid, "order_id": oid, "user_id": uid, "appraise": code, "comment_txt": "x", "sku_id": 1},
        ts,
    )


def view(uid, ts, os="iOS 16.1", term=None, page="home", **common):
    body = {
        "common": {"ar": "1", "uid": uid, "os": os, "ch": "store", "is_new": "0", "md": "model",
                   "mid": "m", "vc": "v1", "ba": "brand", "sid": "s", **common},
        "page": {"page_id": page, "item": term, "item_type": "keyword" if term else "sku_id"},
        "ts": ts,
    }
    if uid is None:
        del body["common"]["uid"]
    return json.dumps(body, ensure_ascii=False)


def topic():
    out = []
    for uid in range(1, 9):
        out += [user(uid, T0 + uid * 1000, 10600 + uid * 400, None if uid % 3 == 0 else "F")]
        out += [sup(uid, T0 + (uid - 4) * 2 * DAY)]
    for oid in range(100, 160):
        uid, ts = oid % 8 + 1, T0 + (oid - 100) * 60_000
        out += [order(oid, uid, ts, T0 + oid * 3_600_000)]
        if oid % 3 == 0:
            out += [order(oid, uid, ts + 1500, T0 + oid * 3_600_000, "u")] * 2
        out += [detail(oid, oid % 7, ts + d) for d in (-5001, -5000, 0, 4999, 6501)]
    out += [
        user(20, T0, None),
        change("user_info", None, T0, "d"),
        change("user_info", {}, T0),
        order(300, None, T0),
        "not json", "", '{"op": "c"}', '{"truncated": {"source": ',
    ]
    return out


def pages():
    out = []
    for uid in range(1, 9):
        for i in range(6):
            ts = T0 + uid * 1000 + i * 50_000
            os = "Android 13" if (uid + i) % 3 else "iOS 16.1"
            out.append(view(str(uid), ts, os, f"term{uid % 3}" if i >= 2 else None))
            if i % 2:
                out.append(view(str(uid), ts, os, f"term{uid % 3}" if i >= 2 else None, "cart"))
        if uid % 4 == 0:
            out.append(view(str(uid), T0 + 200_000, "Harmony 4", "other"))
    out += [view(None, T0), view("", T0), '{"page": {}, "ts": 1}', "{broken"]
    return out


SKUS = [(i, ["小米", "苹果", None, "TCL"][i % 4], 300 * i, ["潮流服饰", "健康食品", None][i % 3]) for i in range(6)]
CATEGORIES = [(1, "term0", "m", "Clothes"), (2, "term1", "m", "Phones"), (3, "term1", "m", "Food")]
COMPARE = [(1, "Clothes", "时尚与潮流"), (2, "Food", "健康与养生"), (3, "Food", "性价比")]


def dimensions(spark):
    from buyerlens.plans.portrait import Dimensions

    return Dimensions(
        spark.createDataFrame(SKUS, "sku_id bigint, tm_name string, sku_price int, order_category string"),
        spark.createDataFrame(CATEGORIES, "id int, b3name string, b2name string, b1name string"),
        spark.createDataFrame(COMPARE, "id int, category_name string, search_category string"),
    )


def texts(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def write_lines(path, lines, files=1):
    path.mkdir(parents=True, exist_ok=True)
    for i in range(files):
        part = lines[i::files]
        (path / f"part-{i:03d}.txt").write_text("\n".join(part) + "\n", encoding="utf-8")
    return str(path)
