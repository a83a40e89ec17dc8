"""Personal data, found with column expressions only.

Regular expressions propose spans. Checks confirm them: parts of an address, digit counts, the Luhn sum of
cards, the remainder modulo 97 of account numbers. Words nearby raise or lower a span's score, and spans
below ``least`` are dropped.

Base kinds (email, ip, card, phone) start above any threshold's reach: once their check holds they stay,
whatever stands nearby. The kinds added here are

    iban       two letters, two check digits, 11 to 30 letters or digits in groups of up to four; the
               check modulo 97 must hold. The pattern takes short words behind a number as further groups,
               and its own letters may begin a number as well, so every start is tried and every end before
               a blank: the longest that holds counts
    national   a telephone number without country code, 3-3-4 digits; needs a word such as "call" nearby
    ssn        3-2-4 digits with no part all zeros; needs a word such as "social" nearby

Spans are in code points, end exclusive. The gaps between matches come from splitting the text at the same
pattern, which gives each match its place.

The patterns match what plain repetition would, but never try a position twice: repetitions that cannot
be given back are possessive, and a match starts where a run of its letters starts or the last match
ended. So time is linear in the text. Null texts are empty and have no spans; repeated rows are handled
each by itself; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from buyerlens.llm.common import ascii_lower

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national", "ssn")

_USER = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_USER}])|\G)[{_USER}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?",
    "national": r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
#: Signs that must not stand right before or after a span of an added kind.
EDGES = {"iban": "[A-Za-z0-9]", "national": "[0-9+.-]", "ssn": "[0-9-]"}
#: What a text must hold for its kind to be looked for at all.
NEEDS = {"email": "@", "phone": "+"}
SCORES = {"email": 0.9, "ip": 0.8, "card": 0.8, "phone": 0.7, "iban": 0.7, "national": 0.3, "ssn": 0.3}
#: Words that raise the score by RAISE if they stand within NEAR characters of the span, in lower case.
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "address|host|server|login",
    "card": "card|credit|visa|payment|debit",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "national": "phone|call|tel|mobile|fax",
    "ssn": "ssn|social",
}
#: Words that lower it by as much: numbers of other things.
AGAINST = "order|version|invoice|isbn|serial|part no"
RAISE, NEAR, LEAST = 0.4, 40, 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits ends in zero."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: _doubled(F.coalesce(c.try_cast("int"), F.lit(0)), i))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _doubled(x: Column, i: Column) -> Column:
    return F.when(i % 2 == 0, x).when(x > 4, x * 2 - 9).otherwise(x * 2)


def mod97(account: Column) -> Column:
    """Whether an account number without blanks leaves one modulo 97, its first four signs moved to the end."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    digits = F.transform(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.coalesce(c.try_cast("int"), F.lit(0))),
    )
    return F.aggregate(digits, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97) == 1


def confirmed(kind: str, match: Column) -> Column:
    """The check of a proposed span."""
    if kind == "ip":
        return F.forall(
            F.split(match, r"\."),
            lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3)
            & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255),
        )
    if kind == "card":
        digits = _digits(match)
        # The sum is worked out for numbers of the right length only.
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "iban":
        plain = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(False)
    if kind == "ssn":
        return ~F.rlike(match, F.lit("^000|-00-|-0000"))
    return F.lit(True)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


#: Where an account number may start; its pattern follows as a look-ahead.
_ACCOUNT = "(?<![A-Za-z0-9])(?="


def _ends(match: Column) -> Column:
    """The match and its beginnings before a blank, the longest first."""
    words = F.split(match, " ")
    return F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(words, 1, k), " "))


def _spans_of(kind: str, text: Column, least: float) -> Column:
    """Spans of one kind, ascending."""
    none = F.array().cast(_SPAN)
    pattern = PATTERNS[kind]

    def placed(matches: Column) -> Column:
        # Places cost a second pass; it is spared where no match is confirmed.
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        ends = F.aggregate(
            F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), F.transform(matches, F.length).alias("len")),
            F.array().cast("array<int>"),
            lambda a, p: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + p["gap"] + p["len"])),
        )
        return _once(ends, lambda e: F.zip_with(matches, e, lambda m, end: F.when(confirmed(kind, m), _span(m, end))))

    def _span(m: Column, end: Column) -> Column:
        start = end - F.length(m)
        low = F.greatest(start - NEAR, F.lit(0))
        around = ascii_lower(F.concat_ws(" ", F.substring(text, low + 1, start - low), F.substring(text, end + 1, F.lit(NEAR))))
        score = (
            F.lit(SCORES[kind])
            + F.when(F.rlike(around, F.lit(CONTEXT[kind])), RAISE).otherwise(0.0)
            - F.when(F.rlike(around, F.lit(AGAINST)), RAISE).otherwise(0.0)
        )
        score = F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 2)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))

    def kept(spans: Column) -> Column:
        if kind in BASE_KINDS:
            return F.filter(spans, lambda s: s.isNotNull())
        edge = F.lit(EDGES[kind])
        before = lambda s: F.when(s["start"] > 0, F.substring(text, s["start"], F.lit(1))).otherwise("")
        return F.filter(
            spans,
            lambda s: s.isNotNull()
            & (s["score"] >= least)
            & ~F.rlike(before(s), edge)
            & ~F.rlike(F.substring(text, s["end"] + 1, F.lit(1)), edge),
        )

    def accounts(matches: Column) -> Column:
        # The longest match of every start; a sign is put before the text so that no part is left out at its start.
        sizes = F.transform(F.split(F.concat(F.lit(" "), text), rf"{_ACCOUNT}{pattern})", -1), F.length)
        starts = F.aggregate(
            F.slice(sizes, 1, F.size(matches)),
            F.array().cast("array<int>"),
            lambda a, n: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(-1)) + n)),
        )
        ends = lambda m, start: F.transform(
            F.filter(_ends(m), lambda p: confirmed(kind, p)), lambda p: _span(p, start + F.length(p))
        )
        spans = kept(F.flatten(_once(starts, lambda s: F.zip_with(matches, s, ends))))
        return F.aggregate(
            spans,
            none,
            lambda a, s: F.when(s["start"] >= F.coalesce(F.try_element_at(a, F.lit(-1))["end"], F.lit(0)), F.concat(a, F.array(s))).otherwise(a),
        )

    if kind == "iban":
        found = _once(
            F.regexp_extract_all(text, F.lit(rf"{_ACCOUNT}({pattern}))"), F.lit(1)),
            lambda m: F.when(F.exists(m, lambda x: F.exists(_ends(x), lambda p: confirmed(kind, p))), accounts(m)).otherwise(none),
        )
        return F.coalesce(found, none).cast(_SPAN)
    found = _once(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.when(F.exists(m, lambda x: confirmed(kind, x)), kept(placed(m))).otherwise(none),
    )
    found = F.coalesce(found, none).cast(_SPAN)
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none) if kind in NEEDS else found


def with_spans(docs: DataFrame, text: str = "text", out: str = "spans", least: float = LEAST) -> DataFrame:
    """``docs`` with all spans of each whole text, by kind as listed in ``KINDS``, then by start."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.withColumn(out, _once(body, lambda t: F.concat(*[_spans_of(k, t, least) for k in KINDS])))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(docs: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans become one.

    A null text stays null.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = with_spans(docs.select(whole.alias("doc"), F.col(f"`{text}`").cast("string").alias("body")), "body", "spans", least)
    by_start = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")))
    )
    body = F.col("body")
    # Left to right: the text so far, and the end of the last span.
    state = F.aggregate(
        by_start,
        F.struct(F.lit("").alias("done"), F.lit(0).alias("at")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                F.concat(
                    a["done"], F.substring(body, a["at"] + 1, s["start"] - a["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")
                ).alias("done"),
                (-s["back"]).alias("at"),
            ),
        ).otherwise(F.struct(a["done"].alias("done"), F.greatest(a["at"], -s["back"]).alias("at"))),
        lambda a: F.concat(a["done"], F.substring(body, a["at"] + 1, F.length(body) - a["at"])),
    )
    clean = F.when(F.size("spans") > 0, state).otherwise(body)
    return rows.select(*[(clean if c == text else F.col("doc").getField(c)).alias(c) for c in docs.columns])
