import random

import pytest
from pyspark.sql import functions as F

from buyerlens.operators import enrich, moderation, wordsearch
from buyerlens.plans import comments
from conftest import rows


def words_frame(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def brute(text, words):
    """Leftmost, then longest, not overlapping."""
    out, i = [], 0
    while i < len(text):
        hit = max((w for w in words if text.startswith(w, i)), key=len, default=None)
        if hit is None:
            i += 1
        else:
            out.append(hit)
            i += len(hit)
    return out


def texts_and_words(seed):
    rnd = random.Random(seed)
    letters = "ab坏é\U0001f600"
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 6))) for _ in range(12)}
    texts = ["".join(rnd.choice(letters + " ,\n") for _ in range(rnd.choice([0, 1, 30, 700]))) for _ in range(25)]
    return texts, sorted(words)


@pytest.mark.parametrize("seed,bits", [(1, 23), (2, 6)])
def test_finding_words_equals_brute_force(spark, seed, bits, monkeypatch):
    monkeypatch.setattr(wordsearch, "FILTER_BITS", bits)
    monkeypatch.setattr(wordsearch, "PACK", 500)  # many packs
    texts, words = texts_and_words(seed)
    words += ["a", "坏"]  # one-letter words meet every spot of their letter
    df = spark.createDataFrame([*enumerate(texts), (99, None)], "id int, msg string")
    want = [(i, f) for i, t in enumerate(texts) if (f := brute(t, words))]
    df = df.unionAll(df.filter("id = 3"))  # a row that comes twice is found twice
    want += [w for w in want if w[0] == 3]
    got = wordsearch.find_words(df, "id", "msg", words_frame(spark, [*words, words[0], "", None]))
    assert [(r.id, r.found) for r in got.orderBy("id").collect()] == sorted(want)
    assert want


def test_filter_errors_are_tried_shorter(monkeypatch):
    # With a filter of two slots nearly every n-gram passes, and only the words count.
    monkeypatch.setattr(wordsearch, "_PACK_BITS", 1)
    texts, words = texts_and_words(5)
    assert wordsearch.finds(texts, set(words)) == [brute(t, words) for t in texts]


def test_folding_keeps_places_and_spelling(spark):
    texts = ["ＢＡＤ word", "a bAd　Word!", "bad\u3000word", "İbad", None, ""]
    df = spark.createDataFrame([*enumerate(texts)], "id int, msg string")
    words = words_frame(spark, ["Bad", "ｗord", "bad word"])
    got = {r.id: r.found for r in wordsearch.find_words(df, "id", "msg", words, fold=True).collect()}
    assert got == {0: ["ＢＡＤ word"], 1: ["bAd　Word"], 2: ["bad\u3000word"], 3: ["bad"]}
    plain = {r.id: r.found for r in wordsearch.find_words(df, "id", "msg", words).collect()}
    assert plain == {}


def test_large_dictionary_finds_the_same(spark):
    # More words than were ever shipped as a list; a few of them occur.
    many = spark.range(250_000).select(F.concat(F.lit("word"), F.col("id").cast("string")).alias("word"))
    df = spark.createDataFrame([(1, "xword7word249999 word"), (2, "none"), (3, "word12word123")], "id int, msg string")
    got = {r.id: r.found for r in wordsearch.find_words(df, "id", "msg", many).collect()}
    assert got == {1: ["word7", "word249999"], 3: ["word12", "word123"]}


def test_search_without_words(spark):
    df = spark.createDataFrame([(1, "x")], "id int, msg string")
    assert wordsearch.find_words(df, "id", "msg", words_frame(spark, [""])).collect() == []


def test_words_with_pattern_signs(spark):
    words = ["a.b", "(x", "\\E", "$1|"]
    df = spark.createDataFrame([(1, "aab a.b (x \\E $1| $1")], "id int, msg string")
    assert wordsearch.find_words(df, "id", "msg", words_frame(spark, words)).first().found == ["a.b", "(x", "\\E", "$1|"]


def test_membership(spark):
    df = spark.createDataFrame([("x",), ("y",), ("",), (None,)], "w string")
    got = moderation.flag_membership(df, words_frame(spark, ["x", "x", "", None]), "w", "hit")
    assert rows(got) == [(None, False), ("", False), ("x", True), ("y", False)]


def test_batch_membership(spark):
    df = spark.createDataFrame([(1, ["x", "z", "x"]), (2, [])], "id int, ws array<string>")
    got = moderation.batch_membership(df, words_frame(spark, ["x"]), "ws", ["id"])
    assert rows(got) == [(1, "x", True), (1, "z", False)]


def test_dictionary_load(spark):
    lines = spark.createDataFrame([(" a ",), ("a",), ("",), ("  \t",), (None,), ("b c",)], "value string")
    assert rows(moderation.load_dictionary(lines)) == [("a",), ("b c",)]


def facts(spark):
    data = [
        (1, 1, "fine,bad", "Ann", 10), (1, 1, "fine,bad", "Ann", 10), (2, 1, "a bad one, a worse one", "Bo", 11),
        (3, 1, "bad,fine", "Cy", 12), (4, 1, "", "Di", 13), (5, 1, ",,,", "Ed", 14), (6, 1, "ok", "Flo", 15),
        (1, 1, "again,worse,,", "Ann", 99),
    ]
    return spark.createDataFrame(
        [(o, u, x, n, t, "20250509") for o, u, x, n, t in data],
        "order_id long, user_id long, commentTxt string, info_consignee string, ts_ms long, ds string",
    )


def test_moderation_grades(spark):
    got = comments.moderated(facts(spark), words_frame(spark, ["bad", "worse"]), words_frame(spark, ["bad", "worse"]))
    by = {r.ts_ms: (r.is_violation, r.violation_grade, r.violation_msg) for r in got.collect()}
    assert by == {
        10: (1, "P0", "bad"), 11: (0, "P1", "bad, worse"), 12: (0, "P1", "bad"), 13: (0, "", ""),
        14: (0, "", ""), 15: (0, "", ""), 99: (1, "P0", "worse"),
    }
    assert got.count() == 7
    assert rows(moderation.violations(got)) == [("Ann", "P0", "bad"), ("Ann", "P0", "worse")]
    # Only P0 findings reach the violation feed.
    assert len(comments.violation_feed(got).collect()) == 2


def test_second_check_needs_a_dictionary(spark):
    first = moderation.moderate(facts(spark).dropDuplicates(["ts_ms"]), words_frame(spark, ["bad"]))
    with pytest.raises(TypeError):
        moderation.second_check(first, None)
    assert moderation.second_check(first, words_frame(spark, [])).filter("violation_grade = 'P1'").count() == 0


def test_moderation_stream_and_feed_restart(spark, tmp_path):
    words = words_frame(spark, ["bad", "worse"])
    want = rows(comments.moderated(facts(spark), words, words))
    source, out, feed = (str(tmp_path / n) for n in ("in", "out", "feed"))
    name = tmp_path.name
    for part in ("ts_ms < 12", "ts_ms >= 12"):  # the second start goes on where the first ended
        facts(spark).filter(part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(facts(spark).schema).parquet(source)
        comments.run_moderation(stream, words, words, out, f"{name}-m").awaitTermination()
        comments.run_violation_feed(spark, out, feed, f"{name}-f").awaitTermination()
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 2
    assert rows(got.drop("batch_id")) == want
    lines = sorted(r.value for r in spark.read.text(feed).collect())
    assert lines == sorted(r.value for r in comments.violation_feed(comments.moderated(facts(spark), words, words)).collect())


def test_dictionary_numbers(spark):
    words = [f"w{i}" for i in range(300)]
    got = moderation.indexed_dictionary(words_frame(spark, words)).collect()
    assert sorted(r.word_no for r in got) == list(range(300))
    assert {r["__n_words"] for r in got} == {300}


def test_injection(spark):
    words = [f"w{i}" for i in range(10)]
    df = spark.range(5000).select("id", F.lit("text").alias("commentTxt"))
    def run(seed):
        return moderation.inject_words(df, words_frame(spark, words), "commentTxt", ["id"], 0.2, seed)

    got = [r.commentTxt for r in run(1).orderBy("id").collect()]
    hit = [t for t in got if t != "text"]
    assert 800 < len(hit) < 1200 and set(hit) == {f"text,{w}" for w in words}
    assert got == [r.commentTxt for r in run(1).orderBy("id").collect()]
    assert got != [r.commentTxt for r in run(2).orderBy("id").collect()]
    assert rows(moderation.inject_words(df, words_frame(spark, []), "commentTxt", ["id"])) == rows(df)


def test_generator(spark):
    df = spark.createDataFrame([("差评", "Lamp"), ("N/A", None)], "dic_name string, info_trade_body string")
    got = enrich.enrich_text(df, "commentTxt", generator=lambda prompts: [f"<{len(p) > 0}>" for p in prompts])
    assert {r.commentTxt for r in got.collect()} == {"<True>"}
    plain = enrich.enrich_text(df, "commentTxt")
    assert all("电商" in r.commentTxt for r in plain.collect())


def test_texts_cross_the_network_twice(spark):
    """Copies are dropped where packs are made, and the first check is not worked out again for the result."""
    df = spark.createDataFrame([("a b",), ("a b",), ("x",), (None,)], "msg string")
    plan = wordsearch.finds_by_digest(df, "msg", words_frame(spark, ["a"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [__id" not in plan and "FlatMapGroupsInArrow" not in plan
    checked = moderation.second_check(comments.first_check(facts(spark), words_frame(spark, ["a"])), words_frame(spark, ["a"]))
    assert "Window" not in checked._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("bits", [1, 20])
def test_finds_as_arrow(monkeypatch, bits):
    """Long words by their first signs, signs of several bytes, words and n-grams that share a slot."""
    monkeypatch.setattr(wordsearch, "_PACK_BITS", bits)
    words = {"a", "abcde", "abcdefgh", "abcdx", "ß", "差评差评差评", "𝔘a"}
    texts = ["abcdefgabcdefgh", "", "abcd", "e差评差评差评差评ß𝔘a𝔘", "abcdxabcde"]
    found, counts = wordsearch._found(texts, words, False)
    assert found.to_pylist() == [w for t in texts for w in brute(t, words)]
    assert counts.tolist() == [len(brute(t, words)) for t in texts]


def test_folding_by_arrays(spark):
    """Texts are folded as dictionaries are, signs beyond 16 bits included."""
    text = "".join(map(chr, [*range(1, 0x250), *range(0x3000, 0x3010), *range(0xFF00, 0xFFFE), 0x1F600, 0x10FFFF]))
    assert wordsearch._fold(text) == spark.createDataFrame([(text,)], "t string").select(wordsearch.folded("t")).first()[0]
    assert wordsearch._fold("") == ""
