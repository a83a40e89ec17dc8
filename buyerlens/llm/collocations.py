"""Phrases whose words keep company, from a weighted graph of word sequences.

Texts are cut into pieces. The graph of a piece has a node for each run of two words and an edge for each run
of three (in general ``longest`` - 1 and ``longest``): the edge joins the two overlapping nodes, its weight
counts it. Only edges and the ends of pieces are counted in the texts; every shorter phrase follows from
them, since an occurrence of a node either goes on along an edge or ends a piece:

    f(node) = weights of the edges that leave it + pieces that end with it

and in the same way for shorter phrases, down to words. These flows are linear in the graph, so each task takes
them from the graph of its own texts, and one shuffle by phrase adds up edges and flows of all tasks; no node
has its edges in one place, so a word or pair in a third of all texts is no hot key.

Edges that occur often enough then form the frequent graph. Runs of nodes with one edge in and one out are
compacted to paths (``paths``): every edge finds the first edge of its run by doubling its reach, ``ROUNDS``
times; every 32nd node on average, by hash, ends a run, and what lies deeper in an uncut run or a
ring stays a path of its own. A passage that many documents share is thus a few rows, and each shorter phrase
inside is looked at once, with the heaviest edge that covers it.

Numbers are exact: counts below 10^16, scores in decimals of 38 digits. A language is a group; null is
``und``. Null texts are empty; repeated rows count each; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from buyerlens.llm.common import text_or_empty, written
from buyerlens.llm.perfect_hash import key_hashes
from buyerlens.llm.word_arrays import byte_set, slices, words_of

GROUP = 2 << 20  # bytes of text whose graph a task holds at a time
ROWS = 1 << 18  # rows given on at a time
BUCKETS = 8  # for each partition of a shuffle
HELD = 32 << 20  # bytes of phrases that a task sums at a time
ROUNDS = 6  # a run is followed over 2^6 edges
CUT = 32
#: What divides pieces, and what else divides words.
PIECE_ENDS = byte_set(b".,;:!?\n\x0b\x0c\r")
WORD = ~(PIECE_ENDS | byte_set(b" \t"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _flows(texts: pa.Array, longest: int) -> tuple[int, pa.Array, np.ndarray, np.ndarray]:
    """Number of words, phrases, their counts and hashes: edges and flows of the graph of some texts."""
    words = words_of(texts, WORD, PIECE_ENDS)
    n, v = len(words.ids), len(words.vocab)
    if not n:
        return 0, words.vocab, words.ids, words.ids.astype(np.uint64)
    # Words from each place to the end of its piece.
    starts = np.append(np.flatnonzero(words.first), n)
    room = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)
    at, run, size = np.arange(n), words.ids, v
    text, hashes = [words.vocab], [_mixed(key_hashes(words.vocab))]
    made, ends, flow = {}, {}, np.bincount(run, minlength=v)
    for k in range(2, longest + 1):
        keep = room[at] >= k
        ends[k - 1] = np.bincount(run[~keep], minlength=size)  # runs that end their piece
        at = at[keep]
        found, run, flow = np.unique(run[keep] * v + words.ids[at + k - 1], return_inverse=True, return_counts=True)
        before, last = made[k] = found // v, found % v
        size = len(found)
        text.append(pc.binary_join_element_wise(text[-1].take(pa.array(before)), words.vocab.take(pa.array(last)), " "))
        hashes.append(_mixed(hashes[-1][before] + hashes[0][last]))
    flows = [flow]
    for k in range(longest - 1, 0, -1):
        onward = np.bincount(made[k + 1][0], flows[-1], len(ends[k])) if len(flows[-1]) else 0
        flows.append(ends[k] + np.asarray(onward, np.int64))
    return n, pa.chunked_array(text).combine_chunks(), np.concatenate(flows[::-1]), np.concatenate(hashes)


def _packed(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(bucket, lang, phrases, counts, n): the graphs of some texts each, their phrases packed by bucket of their hash.

    ``phrases`` are lines, ``counts`` 32-bit numbers, ``n`` the number of words, in one row of each graph.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for code, name in enumerate(langs.dictionary.to_pylist()):
                mine = batch.column(1).filter(pc.equal(langs.indices, code))
                for start, count in slices(mine, GROUP):
                    n, phrases, counts, hashes = _flows(mine.slice(start, count), longest)
                    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
                    order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
                    bucket, counts = bucket[order], counts[order].astype("<u4")
                    lines = pc.binary_join_element_wise(phrases.take(pa.array(order)), "", "\n").cast(pa.large_binary())
                    ends = np.frombuffer(lines.buffers()[1], np.int64, len(lines) + 1, lines.offset * 8)
                    data = lines.buffers()[2]
                    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket)).tolist()
                    pairs = list(zip(cuts, cuts[1:], strict=False))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket[cuts[:-1]]),
                            pa.repeat(name, len(pairs)),
                            pa.array([data[ends[a] : ends[b]].to_pybytes() for a, b in pairs], pa.binary()),
                            pa.array([counts[a:b].tobytes() for a, b in pairs], pa.binary()),
                            pa.array([n, *[0] * (len(pairs) - 1)][: len(pairs)], pa.int64()),
                        ],
                        names=["bucket", "lang", "phrases", "counts", "n"],
                    )

    return texts.mapInArrow(run, "bucket int, lang string, phrases binary, counts binary, n long")


def _summed(phrases: list[bytes], counts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Distinct lines and their summed counts."""
    raw = np.frombuffer(b"".join(phrases), np.uint8)
    ends = np.flatnonzero(raw == 10)
    places = np.concatenate([[0], ends - np.arange(len(ends))])
    lines = pa.Array.from_buffers(
        pa.large_string(), len(ends), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw[raw != 10])]
    ).dictionary_encode()
    each = np.frombuffer(b"".join(counts), "<u4") if counts else np.empty(0)
    sums = np.bincount(lines.indices.to_numpy(), each, len(lines.dictionary))
    return lines.dictionary.cast(pa.string()), sums.astype(np.int64)


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 1, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, k, phrase, f): phrases of 1 to ``longest`` words that occur ``least`` times or more in a language.

    A row with k = 0 and an empty phrase holds the number of all words of the language, whatever ``least`` is.

    Phrases move in packets, one for each graph and bucket; a bucket's packets of one language are summed by
    arrays. A worker holds ``HELD`` bytes of them: of a larger bucket it gives sums as they are, and the last
    sum, over rows, is the same for both.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), text_or_empty(f"`{text}`").alias("text")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packets = _packed(rows, longest, parts * max(1, min(BUCKETS, 4096 // parts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, phrases, counts, size, whole = None, [], [], 0, True
        words: dict[str, int] = {}

        def given() -> Iterator[pa.RecordBatch]:
            found, f = _summed(phrases, counts)
            if whole:
                found, f = found.filter(pa.array(f >= least)), f[f >= least]
            for i in range(0, len(f), ROWS):
                part = found.slice(i, ROWS)
                yield pa.RecordBatch.from_arrays([pa.repeat(key[1], len(part)), part, pa.array(f[i : i + ROWS])], names=["lang", "phrase", "f"])

        for batch in batches:
            for i in range(batch.num_rows):
                bucket, name, lines, each, n = (batch.column(c)[i].as_py() for c in range(5))
                words[name] = words.get(name, 0) + n
                if key != (bucket, name):
                    if phrases:
                        yield from given()
                    key, phrases, counts, size, whole = (bucket, name), [], [], 0, True
                elif size > HELD:
                    whole = False
                    yield from given()
                    phrases, counts, size = [], [], 0
                phrases.append(lines)
                counts.append(each)
                size += len(lines)
        if phrases:
            yield from given()
        n = len(words)
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array([""] * n, pa.string()), pa.array(list(words.values()), pa.int64())], names=["lang", "phrase", "f"])

    sums = packets.repartition(parts, "bucket").sortWithinPartitions("bucket", "lang").mapInArrow(run, "lang string, phrase string, f long")
    found = sums.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    k = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("k")
    return found.select("lang", k, "phrase", "f").filter((F.col("f") >= least) | (F.col("k") == 0))


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ")


def _run(words: Column, start, n) -> Column:
    """n words from a place (from 1) as a phrase."""
    return F.array_join(F.slice(words, start, n), " ")


def paths(edges: DataFrame, longest: int = 3) -> DataFrame:
    """(lang, words, weights): edges ``(lang, phrase, f)`` of ``longest`` words compacted to unary paths.

    A path of m words holds the m - longest + 1 weights of its edges; each edge is in one path.
    """
    words = _words(F.col("phrase"))
    edges = edges.select("lang", "phrase", "f", _run(words, 1, longest - 1).alias("tail"), _run(words, 2, longest - 1).alias("head"))
    edges = written(edges, "graph-edges")
    # The one edge into a node, if one edge alone leaves it.
    into = edges.groupBy("lang", F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("n_in"), F.min("phrase").alias("before"))
    out = edges.groupBy("lang", F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("n_out"))
    inner = (
        into.filter("n_in = 1")
        .join(out.filter("n_out = 1"), ["lang", "node"])
        .filter((F.pmod(F.xxhash64("node"), F.lit(CUT)) != 0) & F.col("node").isNotNull())
        .select("lang", F.col("node").alias("tail"), "before")
    )
    # up: an earlier edge of the run, steps before this one; null for the first edge of a run.
    reach = edges.join(inner, ["lang", "tail"], "left").select(
        "lang", "phrase", F.col("before").alias("up"), F.when(F.col("before").isNotNull(), 1).otherwise(0).alias("steps")
    )
    reach = written(reach, "graph-reach")
    for _ in range(ROUNDS):
        far = reach.select("lang", F.col("phrase").alias("up"), F.col("up").alias("further"), F.col("steps").alias("more"))
        moved = reach.filter("up IS NOT NULL").join(far, ["lang", "up"])
        # An edge that points to the first of its run has arrived and stays.
        moved = moved.select(
            "lang", "phrase", F.coalesce("further", "up").alias("up"), (F.col("steps") + F.col("more")).alias("steps")
        )
        reach = written(reach.filter("up IS NULL").unionByName(moved), "graph-reach")
    first = reach.filter("up IS NULL").select("lang", F.col("phrase").alias("up"), F.lit(True).alias("arrived"))
    placed = (
        reach.join(first, ["lang", "up"], "left")
        .select(
            "lang",
            "phrase",
            F.when(F.col("arrived"), F.col("up")).otherwise(F.col("phrase")).alias("path"),
            F.when(F.col("arrived"), F.col("steps")).otherwise(0).alias("steps"),
        )
        .join(edges.select("lang", "phrase", "f"), ["lang", "phrase"])
    )
    # At most 2^ROUNDS + 1 edges meet here.
    joined = placed.groupBy("lang", "path").agg(F.sort_array(F.collect_list(F.struct("steps", "phrase", "f"))).alias("run"))
    last = F.transform("run", lambda e: F.element_at(_words(e["phrase"]), -1))
    return joined.select(
        "lang",
        F.concat(_words(F.col("path")), F.slice(last, 2, F.size("run"))).alias("words"),
        F.transform("run", lambda e: e["f"]).alias("weights"),
    )


def _covers(compact: DataFrame, phrases: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, cover): the most frequent longer candidate around each phrase of two words or more."""
    out = None
    for k in range(2, longest):
        # Edges that hold the k words from place i begin at i + k - longest .. i.
        spots = compact.select(
            "lang", "words", "weights", F.explode(F.sequence(F.lit(1), F.size("words") - k + 1)).alias("i")
        )
        low = F.greatest(F.lit(1), F.col("i") + (k - longest))
        high = F.least(F.size("weights"), F.col("i"))
        found = spots.select(
            "lang", _run(F.col("words"), F.col("i"), k).alias("phrase"), F.array_max(F.slice("weights", low, high - low + 1)).alias("cover")
        )
        out = found if out is None else out.unionByName(found)
        for j in range(k + 1, longest):  # candidates that are longer, yet no edges
            inside = F.array(*[_run(_words(F.col("phrase")), i, k) for i in range(1, j - k + 2)])
            more = phrases.filter(F.col("k") == j).select("lang", F.explode(inside).alias("phrase"), F.col("f").alias("cover"))
            out = out.unionByName(more)
    return out.groupBy("lang", "phrase").agg(F.max("cover").alias("cover"))


def scored(phrases: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """(lang, k, phrase, a, l, r, score) of each phrase of two words or more: its worst cut.

    ``phrases`` is what ``phrase_counts`` gives for ``least``. A part occurs at least as often as the whole, so
    its count is there.
    """
    wanted = phrases.filter((F.col("k") >= 2) & (F.col("f") >= least))
    words = _words(F.col("phrase"))
    cuts = wanted.select(
        "lang", "k", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    ).select(
        "lang", "k", "phrase", "a", "cut", _run(F.col("w"), 1, F.col("cut")).alias("x"), _run(F.col("w"), F.col("cut") + 1, F.col("k")).alias("y")
    )
    parts = phrases.filter(F.col("k").between(1, longest - 1))
    left = parts.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r"))
    big = lambda c: F.col(c).cast("decimal(16,0)")
    rows = cuts.join(left, ["lang", "x"]).join(right, ["lang", "y"])
    rows = rows.withColumns({"top": big("a") * big("a") * F.lit(1000000).cast("decimal(7,0)"), "low": big("l") * big("r")})
    rows = rows.withColumn("score", F.expr("top div low"))
    worst = rows.groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
    return worst.select("lang", "k", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))


def collocations(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    share: int = 50,
    top: int | None = 2000,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the phrases of 2 to ``longest`` words.

    A phrase that occurs a >= ``least`` times scores floor(10^6 a^2 / (l r)) at its worst cut into parts that occur
    l and r times (ties: the first cut). One that a longer candidate covers in ``share`` percent of its
    occurrences or more is dropped. ``top`` ranks are kept for each language (all, if None); ranks go by score,
    count and phrase. n is the number of words of the language.
    """
    phrases = written(phrase_counts(docs, longest, least, lang, text), "phrases")
    compact = paths(phrases.filter((F.col("k") == longest) & (F.col("f") >= least)), longest)
    rows = scored(phrases, longest, least)
    if longest > 2:
        covers = _covers(compact, phrases, longest)
        rows = rows.join(covers, ["lang", "phrase"], "left").filter(
            F.col("cover").isNull() | (100 * F.col("cover") < share * F.col("a"))
        )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        rows = rows.filter(F.col("rank") <= top)
    total = phrases.filter("k = 0").select("lang", F.col("f").alias("n"))
    return rows.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
