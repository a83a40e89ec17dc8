"""Language-model scores: prediction by partial matching over bytes, and a word-count baseline.

The model is a byte-context trie of depth six (contexts of five to no bytes), trained on the whole training
part. Blending is PPM with escape method C and symbol exclusion: in a context seen n times with u different
symbols a symbol seen c times has probability c / (n + u), and u / (n + u) escapes to the context one byte
shorter, where the symbols of the longer one no longer count. Below the empty context the remaining byte
values are equally likely. A text ends with an end mark, byte 255, which UTF-8 never uses, and five
of them stand before it. Contexts run on over white space.

Every byte of a text is a gram: its context and itself, six bytes. Grams are counted over the training part,
summed within a task first, the trie is summed from the distinct grams, each distinct gram is scored once,
and texts add up the scores of their grams. Trie, gram and word tables grow with the corpus and stay tables;
only their most frequent rows are shipped to the workers (``GRAMS`` and ``PIECES`` rows at most), and all
others are joined, so frequent grams cause no skew and rare ones need no memory. Both ways give the same
numbers.

A-Z are lowered first. Null texts are empty (one token, the end); an empty training part gives a uniform
model and zero counts; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from buyerlens.llm.common import text_or_empty, written
from buyerlens.llm.number_table import Table

ORDER = 5
GRAMS = 1 << 19
PIECES = 1 << 18
PIECE_BYTES = 64  # longer words are not shipped
TEXTS = 1024  # texts worked on at a time
BYTES = 1 << 19  # bytes whose grams are worked on at a time
HELD = 1 << 18  # distinct grams a task sums before it gives them on
_PAD = b"\xff" * ORDER


def _counted(texts: DataFrame) -> DataFrame:
    """(piece, w, n): occurrences of each word in training and in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):  # a worker holds the words of so many texts
                found: tuple[Counter[bytes], Counter[bytes]] = (Counter(), Counter())
                rows = batch.slice(at, TEXTS)
                for t, x in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    found[bool(x)].update(t.encode().lower().split())
                for learn in (True, False):
                    n = pa.array(found[learn].values(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(list(found[learn]), pa.binary()).cast(pa.string()),
                            n if learn else pa.array(np.zeros(len(n), np.int64)),
                            n,
                        ],
                        names=["piece", "w", "n"],
                    )

    rows = texts.mapInArrow(run, "piece string, w long, n long")
    return rows.groupBy("piece").agg(F.sum("w").alias("w"), F.sum("n").alias("n"))


def parts_of(texts: list[bytes], limit: int = BYTES) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """Groups of (number of the text, five bytes before, part) of at most so many bytes; ends included."""
    group: list[tuple[int, bytes, bytes]] = []
    size = 0
    for i, t in enumerate(texts):
        whole = _PAD + t + b"\xff"
        for at in range(ORDER, len(whole), limit):
            part = whole[at : at + limit]
            if group and size + len(part) > limit:
                yield group
                group, size = [], 0
            group.append((i, whole[at - ORDER : at], part))
            size += len(part)
    if group:
        yield group


def gram_keys(group: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Six-byte keys (context and symbol) of all bytes of the parts, and the texts they belong to."""
    sizes = np.fromiter((len(p) for _, _, p in group), np.int64, len(group))
    data = np.frombuffer(b"".join(before + p for _, before, p in group), np.uint8)
    at = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(group) + 1) * ORDER, sizes)
    keys = data[at].astype(np.int64)
    for k in range(1, ORDER + 1):
        keys |= data[at - k].astype(np.int64) << (8 * k)
    return keys, np.repeat(np.fromiter((i for i, _, _ in group), np.int64, len(group)), sizes)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)


def _grams(texts: DataFrame) -> DataFrame:
    """(key, c): how often training has each context and symbol; zero if only other texts have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        keys, counts, new = [none], [none], 0
        give = lambda k, c: pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["key", "c"])
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                rows = batch.slice(at, TEXTS)
                for learn in (True, False):
                    pairs = zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)
                    for group in parts_of([t.encode().lower() for t, x in pairs if bool(x) == learn]):
                        found, n = np.unique(gram_keys(group)[0], return_counts=True)
                        keys.append(found)
                        counts.append(n if learn else np.zeros(len(found), np.int64))
                        new += len(found)
                        if new > HELD:
                            k, c = _summed(keys, counts)
                            keys, counts, new = [k], [c], 0
                            if len(k) > HELD:
                                yield give(k, c)
                                keys, counts = [none], [none]
        yield give(*_summed(keys, counts))

    return texts.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


def _context(order: int, ctx: str = "ctx") -> Column:
    return F.col(ctx).bitwiseAND((1 << 8 * order) - 1)


def gram_scores(grams: DataFrame) -> DataFrame:
    """(key, c, lp): log10 probability of each symbol in its context of five bytes."""
    split = grams.select("key", "c", F.shiftright("key", 8).alias("ctx"), F.col("key").bitwiseAND(255).alias("sym"))
    counts = {ORDER: written(split.filter("c > 0").select("ctx", "sym", "c"), "trie-counts")}
    for j in range(ORDER - 1, -1, -1):
        counts[j] = written(
            counts[j + 1].groupBy(_context(j).alias("ctx"), "sym").agg(F.sum("c").alias("c")), "trie-counts"
        )
    stats = {0: counts[0].groupBy("ctx").agg(F.sum("c").alias("n"), F.count("c").alias("u"), F.lit(0).cast("long").alias("e"))}
    for j in range(1, ORDER + 1):
        # e: how often the next shorter context was followed by symbols that this one has seen.
        own = counts[j].select("ctx", "sym", "c", _context(j - 1).alias("y"))
        low = counts[j - 1].select(F.col("ctx").alias("y"), "sym", F.col("c").alias("low"))
        stats[j] = own.join(_small(low, j - 1), ["y", "sym"]).groupBy("ctx").agg(
            F.sum("c").alias("n"), F.count("c").alias("u"), F.sum("low").alias("e")
        )
    stats = {j: written(s, "trie-stats") for j, s in stats.items()}
    seen = (
        split.filter("c > 0")
        .join(stats[ORDER], "ctx")
        .select("key", "c", F.log10(F.col("c") / (F.col("n") + F.col("u"))).alias("lp"))
    )
    zero = F.lit(0).cast("long")
    walk = split.filter("c = 0").select(
        "key", "ctx", "sym", F.lit(0.0).alias("lp"), F.lit(False).alias("done"), zero.alias("ux"), zero.alias("ex")
    )
    for j in range(ORDER, -1, -1):
        s = stats[j].select(F.col("ctx").alias("y"), "n", "u", "e")
        k = counts[j].select(F.col("ctx").alias("y"), "sym", "c")
        walk = (
            walk.withColumn("y", _context(j))
            .join(_small(s, j - 1), "y", "left")
            .join(_small(k, j), ["y", "sym"], "left")
            .withColumn("n2", F.coalesce("n", zero) - F.col("ex"))
            .withColumn("u2", F.coalesce("u", zero) - F.col("ux"))
            .select(
                "key",
                "ctx",
                "sym",
                F.when(F.col("done"), F.col("lp"))
                .when(F.col("c").isNotNull(), F.col("lp") + F.log10(F.col("c") / (F.col("n2") + F.col("u2"))))
                .when(F.col("n2") > 0, F.col("lp") + F.log10(F.col("u2") / (F.col("n2") + F.col("u2"))))
                .otherwise(F.col("lp"))  # nothing left in this context: the escape is certain
                .alias("lp"),
                (F.col("done") | F.col("c").isNotNull()).alias("done"),
                F.coalesce("u", zero).alias("ux"),
                F.coalesce("e", zero).alias("ex"),
            )
        )
    rest = F.when(F.col("done"), 0.0).otherwise(F.log10(256 - F.col("ux")))
    return seen.union(walk.select("key", zero.alias("c"), (F.col("lp") - rest).alias("lp")))


def _small(df: DataFrame, order: int) -> DataFrame:
    """Tables over contexts and symbols of at most 65,536 values are sent whole: that is their bound."""
    return F.broadcast(df) if order <= 1 else df


def least_count(df: DataFrame, col: str, limit: int) -> int:
    """The smallest count such that at most ``limit`` rows reach it (of the levels looked at)."""
    level = F.floor(F.log2(F.col(col).cast("double")) * 8).cast("int")
    sizes = df.filter(F.col(col) > 0).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("k"), F.min(col).alias("least"))
    least, total = 1 << 62, 0
    for row in sorted(sizes.collect(), key=lambda r: -r["level"]):  # a few hundred levels at most
        total += row["k"]
        if total > limit:
            break
        least = row["least"]
    return least


def _looked_up(keys: np.ndarray, known: Table, lps: np.ndarray) -> np.ndarray:
    if not len(lps):
        return np.full(len(keys), np.nan)
    at = known.get(keys)
    return np.where(at >= 0, lps[at], np.nan)


def score_documents(
    docs: DataFrame,
    training: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    grams: int = GRAMS,
    pieces: int = PIECES,
) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Tokens are the words and one end. ``base_score`` adds log10((c + 1) / (N + V + 1)) over tokens, ``score``
    is the trie's log10 probability of the text. ``training`` tells the rows to learn from.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("text"), training.alias("train"))
    table = written(_counted(rows.select("text", "train")), "lm-words")
    scores = written(gram_scores(written(_grams(rows.select("text", "train")), "lm-grams")), "lm-gram-scores")
    ends = rows.agg(F.count_if("train")).head()[0]
    n_words, v_words = table.filter("w > 0").agg(F.coalesce(F.sum("w"), F.lit(0)), F.count(F.lit(1))).head()
    n_all, v_all = n_words + ends, v_words + (ends > 0)
    least = least_count(table, "n", pieces)
    frequent = (F.col("n") >= least) & (F.octet_length("piece") <= PIECE_BYTES)
    head = table.filter(frequent).select("piece", "w").toArrow()
    weights = head["w"].to_numpy()
    places = {p.encode(): i for i, p in enumerate(head["piece"].to_pylist())}
    least_gram = least_count(scores, "c", grams)
    top = scores.filter(F.col("c") >= least_gram).select("key", "lp").toArrow()
    known_grams = Table(top["key"].to_numpy(), np.arange(len(top)))
    shipped = spark.sparkContext.broadcast((places, np.log10(weights + 1.0), weights > 0, known_grams, top["lp"].to_numpy()))
    end_log = float(np.log10(ends + 1))

    def score_texts(texts: list[bytes]) -> pa.Array:
        places, logs, is_known, known, lps = shipped.value
        out: tuple[list, ...] = ([], [], [], [], [])
        for t in texts:
            words = Counter(t.split())
            here = [(places[p], n) for p, n in words.items() if p in places]
            rare = [(p, n) for p, n in words.items() if p not in places]
            i, n = np.array(here, np.int64).reshape(-1, 2).T
            out[0].append(sum(words.values()) + 1)
            out[1].append(int(n @ is_known[i]) + (ends > 0))
            out[2].append(float(n @ logs[i]) + end_log)
            out[3].append([p for p, _ in rare])
            out[4].append([n for _, n in rare])
        score = np.zeros(len(texts))
        gone: list[np.ndarray] = [np.empty(0, np.int64)]
        owners, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for group in parts_of(texts):
            keys, owner = gram_keys(group)
            lp = _looked_up(keys, known, lps)
            miss = np.isnan(lp)
            score += np.bincount(owner, np.where(miss, 0.0, lp), len(texts))
            keys, owner = keys[miss], owner[miss]
            by = np.lexsort((keys, owner))
            keys, owner = keys[by], owner[by]
            first = np.flatnonzero(np.diff(keys, prepend=-1) | np.diff(owner, prepend=-1))
            gone.append(keys[first])
            owners.append(owner[first])
            times.append(np.diff(np.append(first, len(keys))))
        ends_at = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate(owners), minlength=len(texts)))]).astype(np.int32)
        lists = lambda v: pa.ListArray.from_arrays(pa.array(ends_at), pa.array(np.concatenate(v)))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
        arrays[3] = arrays[3].cast(pa.list_(pa.string()))
        names = ["n_tokens", "known", "logs", "pieces", "counts", "score", "keys", "times"]
        return pa.StructArray.from_arrays([*arrays, pa.array(score), lists(gone), lists(times)], names=names)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):  # scores of so many texts are held at a time
                part = batch.slice(at, TEXTS)
                s = score_texts([t.encode().lower() for t in part.column(3).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:3], s], names=["doc_id", "train", "row", "s"])

    numbered = rows.select("doc_id", "train", F.monotonically_increasing_id().alias("row"), "text")
    marked = numbered.mapInArrow(
        scored,
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, train boolean, row long, s struct<n_tokens: long, known: long, "
        "logs: double, pieces: array<string>, counts: array<long>, score: double, keys: array<long>, times: array<long>>",
    )
    marked = written(marked, "lm-scored")
    rare = marked.select("row", F.explode(F.arrays_zip("s.pieces", "s.counts")).alias("x"))
    rare = rare.select("row", F.col("x.pieces").alias("piece"), F.col("x.counts").alias("k"))
    known = F.col("w") > 0
    added = (
        rare.join(table.filter(~frequent).select("piece", "w"), "piece")
        .groupBy("row")
        .agg(
            F.sum(F.when(known, F.col("k")).otherwise(0)).alias("known"),
            F.sum(F.when(known, F.col("k") * F.log10(F.col("w") + 1)).otherwise(0.0)).alias("logs"),
        )
    )
    grams_left = marked.select("row", F.explode(F.arrays_zip("s.keys", "s.times")).alias("x"))
    grams_left = grams_left.select("row", F.col("x.keys").alias("key"), F.col("x.times").alias("k"))
    more = (
        grams_left.join(scores.filter(F.col("c") < least_gram).select("key", "lp"), "key")
        .groupBy("row")
        .agg(F.sum(F.col("k") * F.col("lp")).alias("score"))
    )
    total = float(np.log10(n_all + v_all + 1))
    both = lambda c, none: F.col(f"s.{c}") + F.coalesce(c, none)
    return marked.join(added, "row", "left").join(more, "row", "left").select(
        "doc_id",
        "train",
        F.col("s.n_tokens").alias("n_tokens"),
        both("known", F.lit(0)).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (both("logs", F.lit(0.0)) - F.col("s.n_tokens") * F.lit(total)).alias("base_score"),
        both("score", F.lit(0.0)).alias("score"),
    )
