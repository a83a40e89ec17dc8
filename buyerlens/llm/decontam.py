"""Benchmark decontamination by a prefix-filtered join of word shingles.

An item's windows (ten consecutive words, or the whole of a shorter item) are sought in documents. As a
set join: a window is the set of its shingles (four words, or all words of a shorter window), and a
document can contain it only if it holds every one of them, the rarest included. So

1. the shingles of the windows are counted over all documents, which gives the order by rarity;
2. each window keeps one necessary prefix token, its rarest shingle and the place of it in the window;
3. positions of documents with such a shingle are joined to the windows on the shingle's hash. The place
   must leave room for the window in the document on both sides (the length and positional bounds);
4. the words around the position are compared with the window's words, so a hash clash does no harm.

Documents are searched with a filter of fixed size over shingle hashes (false finds fall out in the join),
and only positions that pass are moved, with the few words around them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.functions import arrow_udf

from buyerlens.llm.common import ascii_lower, per_batch, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 4
FILTER_BITS = (16, 27)  # smallest and largest size of the shingle filter, as powers of two

#: A-Z to a-z, separators to spaces: every byte of a longer UTF-8 character belongs to a word.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of a folded text.

    The hash is a polynomial over the word's bytes, taken from running sums over the whole text.
    """
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    # Powers by position in the word, so that equal words hash alike wherever they stand.
    place = np.arange(len(data)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    longest = int((ends - starts).max())
    powers = np.cumprod(np.full(longest + 1, BASE, np.uint64), dtype=np.uint64)
    values = np.where(inside[1:-1], (data.astype(np.uint64) + np.uint64(1)) * powers[np.minimum(place, longest)], np.uint64(0))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return starts, ends, _mix(sums[ends] - sums[starts])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out = _mix(out * BASE + words[i : i + n])
    return out


def fold_text(text: str) -> bytes:
    return text.encode().translate(FOLD)


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words) and the items that hold each (window_id, item_id)."""
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    rows = items.select(F.col(item_id).cast("string").alias("item_id"), words.alias("w")).filter(F.size("w") > 0)
    first = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1))))
    rows = rows.select("item_id", "w", first.alias("i")).select(
        "item_id", F.array_join(F.slice("w", F.col("i"), window), " ").alias("words")
    )
    rows = rows.select("item_id", "words", F.sha2("words", 256).alias("window_id")).distinct()
    rows = written(rows, "item-windows")
    return rows.select("window_id", "words").distinct(), rows.select("window_id", "item_id")


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(window_id, words, n, k, h, at): every shingle of every window."""

    def run(columns: list[pa.Array]) -> dict:
        out: dict[str, list] = {"window_id": [], "words": [], "n": [], "k": [], "h": [], "at": []}
        for wid, words in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True):
            hashes = word_hashes(words.encode())[2]
            k = min(shingle, len(hashes))
            found = shingle_hashes(hashes, k).view(np.int64).tolist()
            for name, values in zip(out, ([wid], [words], [len(hashes)], [k]), strict=False):
                out[name] += values * len(found)
            out["h"] += found
            out["at"] += range(len(found))
        return out

    return per_batch(windows, run, "window_id string, words string, n int, k int, h long, at int")


class HashFilter:
    """A bit table over hashes: whatever is in it is found, a little else as well."""

    def __init__(self, df: DataFrame, col: str):
        n = df.agg(F.approx_count_distinct(col)).head()[0]
        low, high = FILTER_BITS
        self.bits = min(high, max(low, int(64 * n).bit_length()))  # 16 MB at most, whatever n is
        slot = F.shiftrightunsigned(col, 64 - self.bits)
        rows = (
            df.select(
                F.shiftright(slot, 6).alias("i"),
                F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int")).alias("b"),
            )
            .groupBy("i")
            .agg(F.bit_or("b").alias("b"))
            .select("i", "b")
            .toArrow()
        )
        words = np.zeros(1 << (self.bits - 6), np.uint64)
        words[rows["i"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
        self.words = words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(64 - self.bits)
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def _sizes(shingles: DataFrame, shingle: int) -> list[int]:
    found = {r[0] for r in shingles.select("k").distinct().collect()}  # at most ``shingle`` values
    return sorted(found & set(range(1, shingle + 1)))


def _counts(texts: DataFrame, sizes: list[int], kept) -> DataFrame:
    """Occurrences in all documents of shingles that pass the filter."""

    def run(columns: list[pa.Array]) -> dict:
        found = [np.empty(0, np.uint64)]
        for text in columns[0].to_pylist():
            words = word_hashes(fold_text(text or ""))[2]
            for k in sizes:
                h = shingle_hashes(words, k)
                found.append(h[kept.value.has(h)])
        h, n = np.unique(np.concatenate(found), return_counts=True)
        return {"h": h.view(np.int64), "n": n}

    return per_batch(texts, run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _candidates_udf(sizes: list[int], kept, window: int):
    """Per text its word count and the positions whose shingles pass the filter.

    ``around`` are the words from ``before`` words ahead of the position to the end of the longest
    window that can begin there.
    """

    @arrow_udf("n_words long, h array<long>, pos array<long>, before array<int>, around array<string>")
    def run(texts: pa.Array) -> pa.Array:
        out: dict[str, list] = {n: [] for n in ("n_words", "h", "pos", "before", "around")}
        for text in map(pa.StringScalar.as_py, texts):
            raw = fold_text(text or "")
            starts, ends, words = word_hashes(raw)
            hits: dict[str, list] = {n: [] for n in ("h", "pos", "before", "around")}
            for k in sizes:
                h = shingle_hashes(words, k)
                for p in np.flatnonzero(kept.value.has(h)).tolist():
                    low, high = max(0, p - (window - k)), min(len(words), p + window)
                    hits["h"].append(int(h[p : p + 1].view(np.int64)[0]))
                    hits["pos"].append(p)
                    hits["before"].append(p - low)
                    hits["around"].append(b" ".join(raw[starts[low] : ends[high - 1]].split()).decode())
            out["n_words"].append(len(words))
            for name, values in hits.items():
                out[name].append(values)
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())]
        return pa.StructArray.from_arrays(
            [pa.array(v, type=t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out)
        )

    return run


def find_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    keep_docs: bool = False,
    unnamed: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids) for every row of ``docs``.

    A word is hit if it lies in an occurrence of a window. Null texts and texts without words have no
    words and no hits; items without words have no windows, and those with a null id only with
    ``unnamed``: they then count for ``n_hit``, all together as one for ``n_items``, and are not listed.
    Repeated rows are reported each; equal windows of several items count for all of them. With
    ``keep_docs`` the result has the input's columns in a struct ``doc`` as well.
    """
    spark = docs.sparkSession
    named = items if unnamed else items.filter(F.col(item_id).isNotNull())
    windows, owners = item_windows(named, item_id, item_text, window)
    shingles = written(window_shingles(windows, shingle), "window-shingles")
    sizes = _sizes(shingles, shingle)

    body = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    every = spark.sparkContext.broadcast(HashFilter(shingles, "h"))
    counts = written(_counts(body, sizes, every), "shingle-counts")
    rarest = W.partitionBy("window_id").orderBy(F.coalesce("n_docs", F.lit(0)), "h", "at")
    prefix = (
        shingles.join(counts.withColumnRenamed("n", "n_docs"), "h", "left")
        .withColumn("r", F.row_number().over(rarest))
        .filter("r = 1")
        # A shingle no document holds: neither does any document hold the window.
        .filter("n_docs > 0")
        .select("window_id", F.col("words").alias("window"), "n", "h", "at")
    )
    prefix = written(prefix, "window-prefixes")

    # Written once with a row number: every later step names rows by it.
    columns = [F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")]
    if keep_docs:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    needed = spark.sparkContext.broadcast(HashFilter(prefix, "h"))
    hits_udf = _candidates_udf(sizes, needed, window)
    rows = docs.select(*columns).withColumn("found", hits_udf("text")).drop("text")
    rows = written(rows, "candidates")

    one = rows.select("row", F.col("found.n_words").alias("n_words"), F.explode(F.arrays_zip("found.h", "found.pos", "found.before", "found.around")).alias("c"))
    one = one.select("row", "n_words", "c.h", "c.pos", "c.before", "c.around")
    start = F.col("pos") - F.col("at")
    words_there = F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("at") + 1, F.col("n")), " ")
    hits = (
        one.join(prefix, "h")
        .filter((start >= 0) & (start + F.col("n") <= F.col("n_words")) & (F.col("before") >= F.col("at")))
        .filter(words_there == F.col("window"))
        .select("row", "window_id", start.alias("start"), (start + F.col("n")).alias("end"))
        .distinct()
    )
    hits = written(hits, "hits")
    covered = _covered(hits)
    held = (
        hits.select("row", "window_id")
        .distinct()
        .join(owners, "window_id")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max(F.col("item_id").isNull().cast("int")).alias("no_id"))
    )
    result = rows.join(covered.join(held, "row"), "row", "left")
    return result.select(
        F.col("id").alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        (F.size(F.coalesce("items", F.array().cast("array<string>"))) + F.coalesce("no_id", F.lit(0))).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        *(["doc"] if keep_docs else []),
    )


def _covered(hits: DataFrame) -> DataFrame:
    """Words in the union of the hit ranges of each row."""
    w = W.partitionBy("row").orderBy("start", "end")
    seen = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("seen", F.lit(0))))
    return (
        hits.select("row", "start", "end")
        .distinct()
        .withColumn("seen", seen)
        .groupBy("row")
        .agg(F.sum(new).cast("long").alias("n_hit"))
    )
