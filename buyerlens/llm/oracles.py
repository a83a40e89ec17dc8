"""SQL that must give the same rows as the registered queries, where SQL can say it."""

from __future__ import annotations

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d JOIN (SELECT DISTINCT n FROM iw) s ON len(d.w) >= s.n)
),
m AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN iw USING (win, n)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id
),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def _kind(k: int, kind: str, pattern: str, need: str, score: str, near: str) -> str:
    """Spans of one kind: matches and the gaps between them give the places."""
    return f"""
SELECT doc_id, {k} AS k, '{kind}' AS kind, m, s, s + length(m) AS e, t, {score} AS base, '{near}' AS near, '{need}' AS edge
FROM (
  SELECT doc_id, t, ms[i] AS m,
    CAST(coalesce(list_sum(list_transform(gs[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT doc_id, t, ms, gs, unnest(range(1, len(ms) + 1)) AS i
        FROM (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM d))
)"""


_LUHN = """
list_sum(list_transform(range(1, length(n) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(n), i, 1) AS INT)
       WHEN CAST(substr(reverse(n), i, 1) AS INT) > 4 THEN 2 * CAST(substr(reverse(n), i, 1) AS INT) - 9
       ELSE 2 * CAST(substr(reverse(n), i, 1) AS INT) END)) % 10 = 0"""

_MOD97 = """
list_reduce(list_concat([0], list_transform(string_split(substr(p, 5) || substr(p, 1, 4), ''), lambda c:
  CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE TRY_CAST(c AS INT) END)),
  lambda a, x: (a * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97) = 1"""

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join([
    _kind(1, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "", "0.9", "mail|contact|write"),
    _kind(2, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "", "0.8", "address|host|server|login"),
    _kind(3, "card", r"[0-9](?:[\x20-]?[0-9])+", "", "0.8", "card|credit|visa|payment|debit"),
    _kind(4, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "", "0.7", "phone|call|tel|mobile|fax"),
    _kind(6, "national", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}", "[0-9+.-]", "0.3", "phone|call|tel|mobile|fax"),
    _kind(7, "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "[0-9-]", "0.3", "ssn|social"),
])}),
zones AS ({_kind(5, "iban", r"[A-Z0-9]+(?:\x20[A-Z0-9]+)*", "[A-Za-z0-9]", "0.7", "iban|account|bank|konto|compte|cuenta")}),
starts AS (
  SELECT * REPLACE (CAST(s + i - 1 + coalesce(list_sum(list_transform(ws[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s),
    string_split(regexp_extract(array_to_string(ws[i:], ' '),
      '^[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?'), ' ') AS gs
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT *, string_split(m, ' ') AS ws FROM zones))
  WHERE regexp_matches(ws[i], '^[A-Z]{{2}}[0-9]{{2}}')
),
accounts AS (
  SELECT doc_id, k, kind, m, s, s + length(m) AS e, t, base, near, edge
  FROM (SELECT * REPLACE (array_to_string(gs[1:j], ' ') AS m)
        FROM (SELECT *, unnest(range(1, len(gs) + 1)) AS j FROM starts))
),
read AS (
  SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS n, replace(m, ' ', '') AS p,
    translate(substr(t, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0)) || ' ' || substr(t, e + 1, 40),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS around,
    CASE WHEN s > 0 THEN substr(t, s, 1) ELSE '' END AS b, substr(t, e + 1, 1) AS a
  FROM (SELECT * FROM found UNION ALL SELECT * FROM accounts)
),
sure AS (
  SELECT doc_id, k, kind, s, e FROM read WHERE CASE kind
    WHEN 'ip' THEN len(list_filter(string_split(m, '.'),
      lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(ltrim(x, '0') AS INT), 0) > 255)) = 0
    WHEN 'card' THEN CASE WHEN length(n) BETWEEN 13 AND 19 THEN {_LUHN} ELSE false END
    WHEN 'phone' THEN length(n) BETWEEN 9 AND 15
    WHEN 'iban' THEN CASE WHEN length(p) BETWEEN 15 AND 34 THEN {_MOD97} ELSE false END
    WHEN 'ssn' THEN NOT regexp_matches(m, '^000|-00-|-0000')
    ELSE true END
  AND (k <= 4 OR (
    NOT regexp_matches(b, edge) AND NOT regexp_matches(a, edge)
    AND round(base + CASE WHEN regexp_matches(around, near) THEN 0.4 ELSE 0 END
      - CASE WHEN regexp_matches(around, 'order|version|invoice|isbn|serial|part no') THEN 0.4 ELSE 0 END, 2) >= 0.5))
),
apart AS (
  SELECT doc_id, 5 AS k, 'iban' AS kind, x.s AS s, x.e AS e
  FROM (SELECT doc_id, unnest(list_reduce(l, lambda a, b: CASE WHEN b[1].s >= a[len(a)].e THEN list_concat(a, b) ELSE a END)) AS x
        FROM (SELECT doc_id, list([{{'s': s, 'e': e}}] ORDER BY s, e DESC) AS l FROM sure WHERE k = 5 GROUP BY doc_id))
),
per AS (
  SELECT doc_id, count(*) FILTER (k = 1) AS n_email, count(*) FILTER (k = 2) AS n_ip, count(*) FILTER (k = 3) AS n_card,
    count(*) FILTER (k = 4) AS n_phone,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k <= 4) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans
  FROM (SELECT doc_id, k, kind, s, e FROM sure WHERE k <> 5 UNION ALL SELECT * FROM apart) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
  coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP11 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_FOLD}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) USING (lang, source)
  LEFT JOIN v USING (lang)
),
p AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 1)) // (n + v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
),
q AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (sum(c) + 1)) // (any_value(n) + any_value(v)) AS q
  FROM c JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY lang) USING (lang) GROUP BY lang, term
),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q
),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS n FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(n AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR n <= 200
"""

OP12 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS sha, coalesce(html, '') AS payload FROM pages
),
f AS (SELECT payload, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY payload HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload)
"""

OP13 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_FOLD}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (
  SELECT c.lang, c.k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:k], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
),
scored AS (
  SELECT cuts.lang, cuts.k, cuts.phrase, a, l.f AS l, r.f AS r,
    (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l.f AS HUGEINT) * r.f) AS score, cut
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = x JOIN f r ON r.lang = cuts.lang AND r.phrase = y
),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS cover
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
  GROUP BY ALL
),
kept AS (
  SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < 50 * a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n,
  CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1,
    "op3_pii": OP3,
    "op8_top_k": OP8,
    "op11_divergence": OP11,
    "op12_warc": OP12,
    "op13_collocations": OP13,
}
