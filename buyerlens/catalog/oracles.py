"""ANSI SQL for every registered query, on the same tables."""

from __future__ import annotations

from buyerlens.catalog.queries import AS_OF, SCORE_LABELS
from buyerlens.catalog.standins import (
    BASE_MS,
    BRANDS,
    ORDER_CATEGORIES,
    ORDER_MS,
    SEARCH_NAMES,
    SPAN_S,
)
from buyerlens.functions.bands import PRICE_BANDS
from buyerlens.functions.scores import BANDS, TIE_ORDER, score_name, score_rows
from buyerlens.functions.text import BAD_REVIEW, BAD_REVIEW_TONE
from buyerlens.operators.labels import ORDER_DIMS
from buyerlens.plans.portrait import SCORE_DIMS
from buyerlens.schemas import PORTRAIT_COLUMNS

DAY = 86_400_000

# -- shared pieces -----------------------------------------------------------------------------

VIEWS = """
views AS (
    SELECT DISTINCT
        CASE WHEN event_type = 'signup' THEN '-1' ELSE CAST(user_id AS VARCHAR) END AS uid,
        (epoch_us(ts) // 1000) AS ts,
        CAST(user_id % 9 AS VARCHAR) AS ar,
        CASE k % 4 WHEN 2 THEN 'iOS' WHEN 3 THEN 'Harmony' ELSE 'Android' END AS os,
        event_type AS ch,
        'model ' || (k % 5) AS md,
        'v2.1' AS vc,
        'brand' || (k % 7) AS ba,
        CASE WHEN event_type = 'click' THEN 'NATION_' || (user_id % 30) END AS search_item
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
    WHERE event_type <> 'error')"""


def order_ms(key: str) -> str:
    return f"({BASE_MS} + ({key} * 7919) % {SPAN_S} * 1000)"


USER_MS = f"({BASE_MS} + (c_custkey * 104729) % {SPAN_S} * 1000)"


def case_map(values: dict[str, str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def pick(values: list[str], by: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], CAST({by} % {len(values)} + 1 AS INTEGER))"


def hour_of(ms: str) -> str:
    return f"(CAST(floor(({ms} + 28800000) / 3600000) AS BIGINT) % 24)"


def hour_band(hour: str) -> str:
    return f"""CASE WHEN {hour} BETWEEN 0 AND 5 THEN '凌晨' WHEN {hour} BETWEEN 6 AND 8 THEN '早晨'
        WHEN {hour} BETWEEN 9 AND 11 THEN '上午' WHEN {hour} BETWEEN 12 AND 13 THEN '中午'
        WHEN {hour} BETWEEN 14 AND 17 THEN '下午' WHEN {hour} BETWEEN 18 AND 21 THEN '晚上'
        ELSE '夜间' END"""


def price_band(price: str, low: int, high: int) -> str:
    cheap, middle, dear = PRICE_BANDS
    return f"""CASE WHEN {price} < {low} THEN '{cheap}'
        WHEN {price} BETWEEN {low} AND {high} THEN '{middle}' ELSE '{dear}' END"""


def zodiac(d: str) -> str:
    md = f"(month({d}) * 100 + day({d}))"
    signs = [
        (120, 218, "水瓶座"), (219, 320, "双鱼座"), (321, 419, "白羊座"), (420, 520, "金牛座"),
        (521, 621, "双子座"), (622, 722, "巨蟹座"), (723, 822, "狮子座"), (823, 922, "处女座"),
        (923, 1023, "天秤座"), (1024, 1122, "天蝎座"), (1123, 1221, "射手座"),
    ]
    whens = " ".join(f"WHEN {md} BETWEEN {a} AND {b} THEN '{s}'" for a, b, s in signs)
    return f"CASE WHEN {d} IS NOT NULL THEN CASE {whens} ELSE '摩羯座' END END"


def age(d: str) -> str:
    return f"""(year(DATE '{AS_OF}') - year({d})
        - CASE WHEN strftime(DATE '{AS_OF}', '%m%d') < strftime({d}, '%m%d') THEN 1 ELSE 0 END)"""


def born(days: str) -> str:
    return f"(DATE '1970-01-01' + CAST({days} AS INTEGER))"


SCORES = "scores(dim, label, s1, s2, s3, s4, s5, s6) AS (VALUES " + ", ".join(
    f"('{r[0]}', '{r[1]}', " + ", ".join(f"{v}::DECIMAL(6,3)" for v in r[2:]) + ")" for r in score_rows()
) + ")"


def score_select(dim: str) -> str:
    return ", ".join(
        f"""CAST(coalesce({dim}_t.s{i + 1}, 0) AS DOUBLE) AS "{score_name(dim, band)}" """
        for i, band in enumerate(BANDS)
    )


def score_join(dim: str, label: str) -> str:
    return f" LEFT JOIN scores AS {dim}_t ON {dim}_t.dim = '{dim}' AND {dim}_t.label = {label}"


def band_sums(fixed: bool = False) -> str:
    out = []
    for i, band in enumerate(BANDS):
        dims = [d for d in SCORE_DIMS if fixed or i < 5 or d not in ("device", "search")]
        total = " + ".join(f"coalesce({d}_t.s{i + 1}, 0)" for d in dims)
        out.append(f'{total} AS "{band}"')
    return ", ".join(out)


def best_band() -> str:
    top = "greatest(" + ", ".join(f'"{b}"' for b in BANDS) + ")"
    return "CASE " + " ".join(f"""WHEN "{b}" = {top} THEN '{b}'""" for b in TIE_ORDER) + " END"


CATEGORIES = """
categories AS (
    SELECT n_nationkey AS id, n_name AS b3name, 'group ' || n_name AS b2name, r_name AS b1name
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""

SEARCH = f"""
terms AS (
    SELECT b3name, b1name AS b1_category, {case_map(SEARCH_NAMES, 'b1name')} AS search_category
    FROM categories)"""

SKUS = f"""
skus AS (
    SELECT p_partkey AS sku_id,
        nullif({pick(BRANDS, "CAST(split_part(p_brand, '#', 2) AS BIGINT)")}, 'Other') AS tm_name,
        p_partkey * 13 % 1500 AS sku_price,
        {case_map(ORDER_CATEGORIES, 'r_name')} AS order_category
    FROM part LEFT JOIN nation ON p_size = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

# A third of the skus twice; of equal keys the last by price counts.
LAST_SKUS = f"""{SKUS},
last_skus AS (
    SELECT sku_id, tm_name, sku_price, order_category FROM (
        SELECT * FROM skus
        UNION ALL
        SELECT sku_id, 'TCL', sku_price + CASE WHEN sku_id % 2 = 0 THEN 10 ELSE -10 END, order_category
        FROM skus WHERE sku_id % 3 = 0)
    QUALIFY row_number() OVER (PARTITION BY sku_id ORDER BY sku_price DESC) = 1)"""

SNAPSHOTS = f"""{VIEWS},
numbered AS (
    SELECT uid, ts, os, search_item, ts - ts % 120000 AS w FROM views),
ends AS (
    SELECT uid, w, max(ts) AS ts FROM numbered GROUP BY uid, w),
snapshots AS (
    SELECT e.uid, e.ts, count(*) AS pv,
        CASE WHEN bool_or(n.os = 'iOS') THEN 'iOS' WHEN bool_or(n.os = 'Android') THEN 'Android'
            ELSE min(n.os) END AS judge_os,
        CASE WHEN count(DISTINCT n.search_item) = 1 THEN min(n.search_item) END AS search_item
    FROM ends e JOIN numbered n ON n.uid = e.uid AND n.w <= e.w
    GROUP BY e.uid, e.ts)"""

DEVICES = f"""{SNAPSHOTS}, {CATEGORIES}, {SEARCH},
found AS (
    SELECT uid, ts, judge_os, search_item, coalesce(search_category, 'unknown') AS search_category
    FROM snapshots LEFT JOIN terms ON search_item = b3name)"""

LINES = """
labelled AS (
    SELECT o_custkey, (epoch_us(o_orderdate) // 1000) AS ts, o_orderkey, l_linenumber, l_partkey,
        p_brand AS tm_name, p_type AS order_category, o_orderstatus AS order_price,
        o_orderpriority AS order_time
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)"""


def leaders(source: str, key: str, order: str) -> str:
    """Running leader per dimension: smallest (-count, label) reached so far, as text."""
    counts = ", ".join(
        f"count(*) OVER (PARTITION BY {key}, {d} ORDER BY seq) AS n_{d}" for d in ORDER_DIMS
    )
    best = ", ".join(
        f"""min(printf('%09d', 999999999 - n_{d}) || coalesce('1' || {d}, '0')) OVER (
            PARTITION BY {key} ORDER BY seq) AS b_{d}"""
        for d in ORDER_DIMS
    )
    labels = ", ".join(
        f"CASE WHEN b_{d}[10] = '1' THEN b_{d}[11:] END AS {d}" for d in ORDER_DIMS
    )
    same = " AND ".join(
        f"{d} IS NOT DISTINCT FROM lag({d}) OVER (PARTITION BY {key} ORDER BY seq)"
        for d in ORDER_DIMS
    )
    return f"""
placed AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS seq FROM {source}),
counted AS (SELECT *, {counts} FROM placed),
ranked AS (SELECT *, {best} FROM counted),
led AS (SELECT * EXCLUDE ({', '.join(ORDER_DIMS)}), {labels} FROM ranked),
changed AS (SELECT *, seq > 1 AND {same} AS same FROM led)"""


PROFILE = f"""
base AS (
    SELECT c_custkey, {USER_MS} AS ts_ms, {USER_MS} + (c_custkey % 17 - 8) * {DAY} AS sup_ms,
        CASE WHEN c_custkey % 11 <> 0 THEN {born('c_custkey * 37 % 20000')} END AS born, c_name
    FROM customer),
profile AS (
    SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS uname,
        CAST(c_custkey % 3 + 1 AS VARCHAR) AS user_level, lower(c_name) AS login_name,
        '555-' || c_custkey AS phone_num, c_custkey || '@example.org' AS email,
        CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'home' END AS gender,
        CAST(born AS VARCHAR) AS birthday, ts_ms, {age('born')} AS age,
        CAST(floor(year(born) / 10) * 10 AS BIGINT) AS decade, {zodiac('born')} AS zodiac_sign,
        CAST(c_custkey % 60 + 140 AS VARCHAR) AS height, 'cm' AS unit_height,
        CAST(c_custkey % 50 + 40 AS VARCHAR) AS weight, 'kg' AS unit_weight, sup_ms
    FROM base)"""

ORDER_LABELS = f"""{LAST_SKUS},
versions AS (
    SELECT o_orderkey, o_custkey, {order_ms('o_orderkey')} AS created, {order_ms('o_orderkey')} AS ts
    FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, {order_ms('o_orderkey')}, {order_ms('o_orderkey')} + 2000
    FROM orders WHERE o_orderkey % 3 = 0),
joined AS (
    SELECT CAST(o_custkey AS VARCHAR) AS user_id, ts, o_orderkey AS order_id, sku_id,
        tm_name, order_category, {price_band('sku_price', 500, 1000)} AS order_price,
        {hour_band(hour_of('created'))} AS order_time
    FROM versions
    JOIN lineitem ON o_orderkey = l_orderkey
        AND {order_ms('l_orderkey')} + (l_linenumber - 4) * 2000 BETWEEN ts - 5000 AND ts + 5000
    JOIN last_skus ON l_partkey = sku_id),
{leaders('joined', 'user_id', 'ts, order_id, sku_id')},
orders_scored AS (
    SELECT user_id, ts, tm_name, order_category, order_price, order_time FROM changed WHERE NOT same)"""

PORTRAIT = f"""WITH {SCORES}, {DEVICES}, {ORDER_LABELS}, {PROFILE},
pairs AS (
    SELECT o.user_id, greatest(o.ts, d.ts) AS t, {band_sums()}
    FROM orders_scored o
    JOIN found d ON d.uid = o.user_id AND d.ts BETWEEN o.ts - {DAY} AND o.ts + {DAY}
    {score_join('time', 'o.order_time')}{score_join('price', 'o.order_price')}
    {score_join('category', 'o.order_category')}{score_join('tm', 'o.tm_name')}
    {score_join('device', 'd.judge_os')}{score_join('search', 'd.search_category')}),
aged AS (SELECT user_id, t, {best_band()} AS shop_age FROM pairs),
portrait AS (
    SELECT DISTINCT user_id, shop_age, p.* EXCLUDE (uid, ts_ms, sup_ms)
    FROM aged JOIN profile p ON uid = user_id AND ts_ms BETWEEN t - {DAY} AND t + {DAY}
    WHERE abs(sup_ms - ts_ms) <= 7 * {DAY})"""

MODERATION = r"""
tails AS (
    SELECT doc_id, list_last(string_split(rtrim(text, ','), ',')) AS token FROM documents),
heads AS (
    SELECT DISTINCT CASE WHEN doc_id % 4 = 0 THEN token ELSE token || '~' END AS token
    FROM tails WHERE token <> '')"""

BENCH_WORDS = r"""
listed AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM benchmark)"""

PATTERN = "(SELECT string_agg(word, '|' ORDER BY length(word) DESC, word) FROM listed)"

MODERATED = f"""WITH {MODERATION}, {BENCH_WORDS},
moderated AS (
    SELECT doc_id % 97 AS user_id, source AS consignee, {BASE_MS} + doc_id * 60000 AS ts_ms,
        '20240101' AS ds, text,
        CASE WHEN h.token IS NULL THEN 0 ELSE 1 END AS is_violation, t.token,
        regexp_extract_all(text, {PATTERN}) AS found
    FROM documents JOIN tails t USING (doc_id) LEFT JOIN heads h ON h.token = t.token),
graded AS (
    SELECT user_id, consignee, ts_ms, ds, md5(text) AS msg, CAST(is_violation AS BIGINT) AS is_violation,
        CASE WHEN is_violation = 1 THEN 'P0' WHEN len(found) > 0 THEN 'P1' ELSE '' END
            AS violation_grade,
        CASE WHEN is_violation = 1 THEN token WHEN len(found) > 0 THEN array_to_string(found, ', ')
            ELSE '' END AS violation_msg
    FROM moderated)"""

EVENT_LABELS = f"""
event_labels AS (
    SELECT event_id, {hour_band(hour_of('(epoch_us(ts) // 1000)'))} AS order_time,
        {price_band('value', 100, 300)} AS order_price,
        {pick(["潮流服饰", "家具用品", "健康食品", "none"], 'k')} AS order_category,
        {pick(BRANDS, 'user_id')} AS tm_name,
        {pick(["iOS", "Android", "Harmony"], 'event_id')} AS os,
        {pick([*SEARCH_NAMES.values(), "健康与养生", "unknown"], '(k + user_id)')} AS search_category
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

ALL_JOINS = "".join(score_join(d, f"e.{label}") for d, label in SCORE_LABELS.items())


def _bands_query(fixed: bool) -> str:
    cols = ", ".join(f'CAST("{b}" AS DOUBLE) AS "{b}"' for b in BANDS)
    return f"""WITH {SCORES}, {EVENT_LABELS},
        sums AS (SELECT event_id, {band_sums(fixed)} FROM event_labels e {ALL_JOINS})
        SELECT event_id, {cols}, {best_band()} AS shop_age FROM sums"""


def _draw(what: str) -> str:
    return f"""CAST('0x' || substr(md5(conv_id || ':' || turn || ':7:{what}'), 1, 8) AS BIGINT)"""


# -- queries -----------------------------------------------------------------------------------

ORACLES = {
    "route_filter": """SELECT o_orderkey, o_custkey, o_totalprice, (epoch_us(o_orderdate) // 1000) AS ts_ms
        FROM orders WHERE o_orderstatus = 'F'""",
    "page_projection": f"""WITH {VIEWS.replace('SELECT DISTINCT', 'SELECT')} SELECT * FROM views""",
    "json_round_trip": """SELECT CAST(event_id AS VARCHAR) AS mid,
            CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN NULL
                ELSE CAST(user_id AS VARCHAR) END AS uid,
            CASE k % 4 WHEN 2 THEN 'iOS 16.1' WHEN 3 THEN 'Harmony 4' ELSE 'Android 13.0' END AS os,
            'NATION_' || (user_id % 30) AS item, CAST(trunc(value * 100) AS BIGINT) AS during_time,
            (epoch_us(ts) // 1000) AS ts
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""",
    "json_rejects": """SELECT '#' || props AS value, count(*) AS n
        FROM events WHERE event_id % 7 = 0 GROUP BY props""",
    "cdc_flatten": f"""WITH v AS (
            SELECT *, '1001' AS st, 0 AS late FROM orders
            UNION ALL SELECT *, '1002', 2000 FROM orders WHERE o_orderkey % 3 = 0
            UNION ALL SELECT *, '1001', 0 FROM orders WHERE o_orderkey % 5 = 0)
        SELECT o_orderkey AS id, o_custkey AS user_id, 'Customer ' || o_custkey AS consignee,
            st AS order_status, o_totalprice AS total_amount, {order_ms('o_orderkey')} AS create_time,
            {order_ms('o_orderkey')} + late AS ts_ms FROM v""",
    "cdc_image_fallback": f"""SELECT
            CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0 THEN o_orderkey END AS id,
            CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0 THEN o_custkey END AS user_id,
            CASE WHEN o_orderkey % 5 = 0 THEN 'no op' ELSE 'd' END AS op,
            {order_ms('o_orderkey')} AS ts_ms FROM orders""",
    "base_labels": f"""WITH {PROFILE} SELECT uid, uname, user_level, login_name, phone_num, email, gender,
            birthday, ts_ms, age, decade, zodiac_sign FROM profile""",
    "age_decade_zodiac": f"""SELECT c_custkey, CAST(d AS VARCHAR) AS birthday, {age('d')} AS age,
            CAST(floor(year(d) / 10) * 10 AS BIGINT) AS decade, {zodiac('d')} AS zodiac_sign
        FROM (SELECT c_custkey, {born('c_custkey * 37 % 20000')} AS d FROM customer)""",
    "day_partition": """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS ds FROM events""",
    "hour_band": f"""SELECT event_id, hour(ts + INTERVAL 8 HOUR) AS hour,
            {hour_band('hour(ts + INTERVAL 8 HOUR)')} AS order_time FROM events""",
    "price_band": f"""SELECT p_partkey, {price_band('p_retailprice', 930, 960)} AS order_price FROM part""",
    "exact_dedup": """SELECT DISTINCT user_id, event_type,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "key_time_dedup": """SELECT l_orderkey, (epoch_us(l_shipdate) // 1000) AS ship_ms,
            CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_shipdate
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "keep_if_newer": """SELECT o_custkey, o_orderkey, o_orderstatus, (epoch_us(o_orderdate) // 1000) AS ts_ms
        FROM orders QUALIFY coalesce(o_orderdate > max(o_orderdate) OVER (PARTITION BY o_custkey
            ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)""",
    "latest_state": """SELECT o_custkey, o_orderkey, o_orderstatus, (epoch_us(o_orderdate) // 1000) AS ts_ms
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "keyed_merge": """SELECT CAST(o_custkey AS VARCHAR) AS o_custkey,
            CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
            CAST((epoch_us(o_orderdate) // 1000) AS VARCHAR) AS ts_ms
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, 1 - o_orderkey % 2, o_orderkey) = 1""",
    "keyed_upserts": """SELECT CAST(o_custkey AS VARCHAR) AS o_custkey,
            CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
            CAST((epoch_us(o_orderdate) // 1000) AS VARCHAR) AS ts_ms
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
            ORDER BY o_orderdate DESC, 1 - o_orderkey % 2, o_orderkey) = 1""",
    "dim_as_of": """WITH v AS (
            SELECT o_custkey % 50 AS dic_code, epoch_us(o_orderdate) // 1000 AS valid_from, max(o_orderpriority) AS dic_name
            FROM orders GROUP BY ALL),
        l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 9 <> 0 THEN l_suppkey % 60 END AS code,
                epoch_us(l_shipdate) // 1000 AS ts FROM lineitem)
        SELECT l_orderkey, l_linenumber, code, ts, coalesce(dic_name, 'N/A') AS dic_name
        FROM l ASOF LEFT JOIN v ON l.code = v.dic_code AND l.ts >= v.valid_from""",
    "user_activity_sets": f"""WITH {VIEWS} SELECT uid, count(*) AS pv, max(ts) AS ts, """
    + ", ".join(
        f"coalesce(string_agg(DISTINCT {c}, ',' ORDER BY {c}), '') AS {c}"
        for c in ("os", "ch", "md", "ba", "search_item")
    )
    + " FROM views GROUP BY uid",
    "user_activity_bounded": f"""WITH {VIEWS} SELECT uid, """
    + ", ".join(
        f"""coalesce(array_to_string(list_sort(list(DISTINCT {c}) FILTER ({c} IS NOT NULL))[1:2], ','), '') AS {c},
            CAST(count(DISTINCT {c}) > 2 AS BIGINT) AS {c}_more, count(DISTINCT {c}) AS {c}_distinct"""
        for c in ("os", "ch", "md", "ba", "search_item")
    )
    + " FROM views GROUP BY uid",
    "tumbling_last": """SELECT user_id, (epoch_us(ts) // 1000) AS ts, event_id, event_type,
            (epoch_us(ts) // 1000) - (epoch_us(ts) // 1000) % 120000 AS window_start
        FROM events QUALIFY row_number() OVER (PARTITION BY user_id, (epoch_us(ts) // 1000) // 120000
            ORDER BY (epoch_us(ts) // 1000) DESC, event_id DESC) = 1""",
    "activity_snapshots": f"WITH {SNAPSHOTS} SELECT * FROM snapshots",
    "device_search_scores": f"""WITH {SCORES}, {DEVICES}
        SELECT uid, ts, judge_os, f.search_category, {score_select('device')}, {score_select('search')}
        FROM found f {score_join('device', 'judge_os')}{score_join('search', 'f.search_category')}""",
    "interval_join_seconds": """SELECT v.event_id AS v_id, v.user_id AS v_user, (epoch_us(v.ts) // 1000) AS v_ms,
            p.event_id AS p_id, p.user_id AS p_user, (epoch_us(p.ts) // 1000) + 300000 AS p_ms
        FROM events v JOIN events p ON v.user_id = p.user_id
            AND (epoch_us(p.ts) // 1000) BETWEEN (epoch_us(v.ts) // 1000) - 600000 AND (epoch_us(v.ts) // 1000)""",
    "interval_join_days": """SELECT o_orderkey, (epoch_us(o_orderdate) // 1000) AS o_ms, l_orderkey,
            CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, (epoch_us(l_shipdate) // 1000) AS l_ms
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey
            AND l_shipdate BETWEEN o_orderdate - INTERVAL 7 DAY AND o_orderdate + INTERVAL 7 DAY""",
    "interval_join_prefixed": """SELECT c.event_id AS id, c.user_id AS "user", (epoch_us(c.ts) // 1000) AS ms,
            e.event_id AS info_id, e.user_id AS info_user, (epoch_us(e.ts) // 1000) + 7200000 AS info_ms
        FROM events c JOIN events e ON c.user_id = e.user_id
            AND abs((epoch_us(e.ts) // 1000) + 7200000 - (epoch_us(c.ts) // 1000)) <= 3600000""",
    "dim_lookup_default": """SELECT c_custkey,
            CAST(c_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 100 ELSE 0 END AS BIGINT) AS c_nationkey,
            CASE WHEN c_custkey % 5 <> 0 THEN n_name ELSE 'N/A' END AS dic_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dim_chain_inner": """SELECT s_suppkey AS id, s_name AS b3name, 'group ' || n_name AS b2name,
            r_name AS b1name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 7 <> 0""",
    "dim_chain_left": f"WITH {SKUS} SELECT * FROM skus",
    "term_category_lookup": f"""WITH {VIEWS.replace('SELECT DISTINCT', 'SELECT')}, {CATEGORIES}, {SEARCH}
        SELECT uid, ts, search_item, b1_category, coalesce(search_category, 'unknown') AS search_category
        FROM views LEFT JOIN terms ON search_item = b3name""",
    "sku_value_bands": f"""WITH {LAST_SKUS}
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, tm_name,
            order_category, {price_band('sku_price', 500, 1000)} AS order_price,
            {hour_band(hour_of(order_ms('l_orderkey')))} AS order_time
        FROM lineitem JOIN last_skus ON l_partkey = sku_id WHERE sku_id % 7 <> 0""",
    "label_mode": f"""WITH {LINES}, """
    + ", ".join(
        f"""m_{d} AS (SELECT o_custkey, {d} FROM labelled GROUP BY o_custkey, {d}
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, {d}) = 1)"""
        for d in ORDER_DIMS
    )
    + f" SELECT o_custkey, {', '.join(ORDER_DIMS)} FROM m_tm_name"
    + "".join(f" JOIN m_{d} USING (o_custkey)" for d in ORDER_DIMS[1:]),
    "label_changes": f"""WITH {LINES},
        {leaders('labelled', 'o_custkey', 'ts, o_orderkey, l_linenumber, l_partkey')}
        SELECT o_custkey, ts, o_orderkey, {', '.join(ORDER_DIMS)} FROM changed WHERE NOT same""",
    "emit_on_change": """SELECT user_id, (epoch_us(ts) // 1000) AS ts, event_id, event_type FROM events
        QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id
            ORDER BY (epoch_us(ts) // 1000), event_id)""",
    "score_table": f"""WITH {SCORES}, {EVENT_LABELS}
        SELECT event_id, {', '.join(score_select(d) for d in SCORE_LABELS)}
        FROM event_labels e {ALL_JOINS}""",
    "age_band_argmax": _bands_query(False),
    "age_band_argmax_fixed": _bands_query(True),
    "dictionary_load": f"""WITH {MODERATION}
        SELECT DISTINCT trim(token, ' ' || chr(9) || chr(10) || chr(13)) AS word FROM heads
        WHERE trim(token, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
    "word_membership": f"""WITH {BENCH_WORDS}
        SELECT DISTINCT conv_id, turn, w AS word,
            CAST(w IN (SELECT word FROM listed) AND w <> '' AS BIGINT) AS listed
        FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w FROM conversations)""",
    "last_token_flag": f"""WITH {MODERATION}
        SELECT doc_id, tails.token, CASE WHEN heads.token IS NULL THEN 0::BIGINT ELSE 1::BIGINT END
            AS is_violation
        FROM tails LEFT JOIN heads ON heads.token = tails.token""",
    "find_all_words": f"""WITH {BENCH_WORDS}
        SELECT doc_id, array_to_string(found, '|') AS found
        FROM (SELECT doc_id, regexp_extract_all(text, {PATTERN}) AS found FROM documents)
        WHERE len(found) > 0""",
    "moderation_result": f"{MODERATED} SELECT * FROM graded",
    "violations_only": f"""{MODERATED} SELECT consignee, violation_grade, violation_msg FROM graded
        WHERE is_violation = 1""",
    "violation_feed": f"""{MODERATED} SELECT CAST(to_json(struct_pack(consignee := consignee,
            violation_grade := violation_grade, violation_msg := violation_msg)) AS VARCHAR) AS value
        FROM graded WHERE is_violation = 1""",
    "seeded_injection": f"""WITH {BENCH_WORDS},
        numbered AS (SELECT word, row_number() OVER (ORDER BY substr(md5(word), 1, 3), word) - 1 AS no
            FROM listed)
        SELECT conv_id, turn, CASE WHEN {_draw('pick')} < {int(0.2 * 2**32)}
            THEN text || ',' || word ELSE text END AS text
        FROM conversations JOIN numbered
            ON no = {_draw('word')} % (SELECT count(*) FROM listed)""",
    "text_generation": f"""SELECT conv_id, turn, '为商品「' || conv_id || '」写一条电商' ||
            CASE WHEN role = 'user' THEN '{BAD_REVIEW}，20字以内。{BAD_REVIEW_TONE}'
            ELSE '好评，20字以内。' END AS prompt FROM conversations""",
    "comment_facts": f"""WITH c AS (
            SELECT *, {order_ms('o_orderkey')} AS made,
                {order_ms('o_orderkey')} + (o_orderkey % 5 - 2) * 45000 AS ts FROM orders
            WHERE o_orderkey % 7 <> 0),
        v AS (
            SELECT o_orderkey AS k, '1001' AS st, 'c' AS op, {order_ms('o_orderkey')} AS t FROM orders
            UNION ALL SELECT o_orderkey, '1002', 'u', {order_ms('o_orderkey')} + 2000 FROM orders
            WHERE o_orderkey % 3 = 0
            UNION ALL SELECT o_orderkey, '1001', 'c', {order_ms('o_orderkey')} FROM orders
            WHERE o_orderkey % 5 = 0),
        j AS (
            SELECT *, CASE WHEN o_orderkey % 7 = 2 THEN '{BAD_REVIEW}' WHEN o_orderkey % 7 > 4 THEN 'N/A'
                ELSE (SELECT r_name FROM region WHERE r_regionkey = o_orderkey % 7) END AS dic_name
            FROM c JOIN v ON o_orderkey = k AND t BETWEEN ts - 60000 AND ts + 60000)
        SELECT o_orderkey + 7 AS id, o_orderkey AS order_id, o_custkey AS user_id,
            CAST(1200 + o_orderkey % 7 AS VARCHAR) AS appraise, dic_name,
            '为商品「' || o_orderpriority || '」写一条电商' || dic_name || '，20字以内。' ||
                CASE WHEN dic_name = '{BAD_REVIEW}' THEN '{BAD_REVIEW_TONE}' ELSE '' END AS commentTxt,
            'comment_info' AS "table", 'c' AS op, ts AS ts_ms,
            strftime(make_timestamp(ts * 1000) + INTERVAL 8 HOUR, '%Y%m%d') AS ds,
            'Customer ' || o_custkey AS info_consignee, o_orderpriority AS info_trade_body,
            st AS info_order_status, j.op AS info_op, t AS info_ts_ms FROM j""",
    "base_profile": f"""WITH {PROFILE} SELECT * EXCLUDE (sup_ms) FROM profile
        WHERE abs(sup_ms - ts_ms) <= 7 * {DAY}""",
    "order_scores": f"""WITH {SCORES}, {ORDER_LABELS}
        SELECT o.*, {', '.join(score_select(d) for d in ('tm', 'category', 'price', 'time'))}
        FROM orders_scored o {score_join('tm', 'tm_name')}{score_join('category', 'order_category')}
        {score_join('price', 'order_price')}{score_join('time', 'order_time')}""",
    "portrait_full": f"{PORTRAIT} SELECT * FROM portrait",
    "csv_export": f"""{PORTRAIT} SELECT concat_ws(',', """
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in PORTRAIT_COLUMNS)
    + ") AS value FROM portrait",
}
ORACLES["cdc_flatten_once"] = ORACLES["cdc_flatten"]
# Events name no table, so every text of them that is not null is a reject.
ORACLES["cdc_rejects_once"] = """SELECT value, count(*) AS n
    FROM (SELECT CASE WHEN event_id % 7 = 0 THEN '#' || props WHEN event_id % 10 <> 0 THEN props END AS value FROM events)
    WHERE value IS NOT NULL GROUP BY value"""
ORACLES["text_generation_bounded"] = """SELECT conv_id, turn, length(p) || ' chars: ' || p AS answer
    FROM (SELECT *, role || ': ' || substr(text, 1, 12) AS p FROM conversations)"""
ORACLES["find_words_joined"] = ORACLES["find_all_words"]
ORACLES["find_words_folded"] = f"""WITH listed AS (
        SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS word FROM benchmark)
    SELECT doc_id, array_to_string(found, '|') AS found
    FROM (SELECT doc_id, regexp_extract_all(text, {PATTERN}, 0, 'i') AS found FROM documents)
    WHERE len(found) > 0"""
ORACLES["text_generation_udf"] = """SELECT conv_id, turn, length(text) || ' chars: ' || text AS text
    FROM conversations"""
