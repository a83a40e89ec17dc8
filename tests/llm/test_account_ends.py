"""Account numbers with words, or other account numbers, right behind them."""

import pytest

from buyerlens.llm import pii

CASES = [
    ("IBAN ES91 2100 0418 4502 0005 1332 BIC CAIXESBBXXX", ["ES91 2100 0418 4502 0005 1332"]),
    ("IBAN ES9121000418450200051332 EUR", ["ES9121000418450200051332"]),
    ("account BE68 5390 0754 7034 A nice one", ["BE68 5390 0754 7034"]),
    ("account BE68 5390 0754 7034 Anne", ["BE68 5390 0754 7034"]),
    ("IBAN ES9121000418450200051332 BE68539007547034 2024", ["ES9121000418450200051332", "BE68539007547034"]),
    ("ES9121000418450200051332 BE68 5390 0754 7034 IBAN", ["ES9121000418450200051332", "BE68 5390 0754 7034"]),
    ("bank REF AB12 3456 BE68 5390 0754 7034 EUR", ["BE68 5390 0754 7034"]),
    ("中🙂 IBAN DE89 3704 0044 0532 0130 00 EUR, xBE68539007547034", ["DE89 3704 0044 0532 0130 00"]),
    ("IBAN BE68 5390 0754 7035 A or BE68539007547034x", []),
]


@pytest.mark.parametrize("column", ["text", "spans"])
def test_shorter_ends_are_tried(spark, column):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], f"doc_id long, {column} string")
    for r in pii.with_spans(docs, column, "found").collect():
        text, want = CASES[r.doc_id]
        assert [text[s.start : s.end] for s in r.found if s.kind == "iban"] == want
    clean = {r.doc_id: r[column] for r in pii.redacted(docs, column).collect()}
    assert clean[0] == "IBAN <IBAN> BIC CAIXESBBXXX" and clean[2] == "account <IBAN> A nice one"
