"""Search for all listed words in texts, with a dictionary of any size.

Each distinct text is searched once. Distinct texts lie in packs of about ``PACK`` characters, made where their
copies were dropped. A pack
first names the distinct n-grams of its texts that pass a filter of fixed size; these are joined to the
dictionary, so that the pack gets back the listed words among them, and is searched for those. So what crosses
the network per pack is its distinct n-grams, not its finds, whatever the dictionary's size and however common
its words are. Packs grow in number with the input, and a pack's words are bounded by its texts.

Texts are searched by arrays: all n-grams of one length in a pack are hashed together by running sums, and n-grams
of one slot are compared sign by sign, so hashes decide nothing. Only the step from a find to the next is a loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from buyerlens.session import settle

#: Size of the filter of n-grams, whatever the size of the dictionary: 2^23 bits, one megabyte.
FILTER_BITS = 23
#: Characters of the texts that are searched together; a longer text is one pack's work.
PACK = 1 << 20
#: Of longer words the first so many signs are looked for, and the whole only where these are.
HEAD = 4
_PACK_BITS = 20  # slots for the n-grams and words of one pack
_BLOCK = 1 << 14  # places hashed at a time
_ROUNDS = 8  # of telling n-grams in one slot apart by arrays

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers can be divided by
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WIDE = "　" + "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
_NARROW = " " + "".join(map(chr, range(0x21, 0x7F))).lower()
_FOLD = np.arange(1 << 16, dtype=np.uint32)
_FOLD[[*map(ord, _UPPER + _WIDE)]] = [*map(ord, _UPPER.lower() + _NARROW)]


def folded(text: Column | str) -> Column:
    """Latin capitals as small letters and full-width signs as plain ones; every sign keeps its place."""
    return F.translate(text, _UPPER + _WIDE, _UPPER.lower() + _NARROW)


class Grams:
    """Hashes of the n-grams of a text, for any n: a polynomial of the code points, by running sums."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.points = points.astype(np.uint32)
        self.size = len(points)
        powers = np.cumprod(np.full(self.size, _STEP), dtype=np.uint64)
        self.sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum((points + np.uint64(1)) * powers, dtype=np.uint64, out=self.sums[1:])
        self.inverse = np.cumprod(np.full(self.size, _BACK), dtype=np.uint64)

    def hashes(self, n: int, stops: np.ndarray | None = None, within: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places that have an n-gram, some thousands at a time, and its hash: all places or those ``within``.

        ``stops`` gives the end of each place's text, which an n-gram may not pass.
        """
        size = max(self.size - n + 1, 0)
        for a in range(0, size if within is None else len(within), _BLOCK):  # worked on in the processor's cache
            if within is None:
                b = min(a + _BLOCK, size)
                places = np.arange(a, b)
                h = self.sums[a + n : b + n] - self.sums[a:b]
                h *= self.inverse[a:b]
            else:
                places = within[a : a + _BLOCK]
                places = places[places + n <= stops[places]]
                h = self.sums[places + n] - self.sums[places]
                h *= self.inverse[places]
            h += np.uint64(n)
            h ^= h >> np.uint64(32)
            h *= _MIX
            h ^= h >> np.uint64(32)
            h *= _MIX
            yield places, h

    def slots(self, n: int, bits: int) -> np.ndarray:
        """Slot of the n-gram at each place that has one: so many bits of its hash."""
        return np.concatenate([np.zeros(0, np.uint64), *[h >> np.uint64(64 - bits) for _, h in self.hashes(n)]])


class WordFilter:
    """Lengths of the words, and bit tables of ``FILTER_BITS`` bits over their hashes and those of long words' heads."""

    def __init__(self, words: DataFrame, col: str):
        bits = self.bits = FILTER_BITS

        @F.arrow_udf("long")
        def slot(batch: pa.Array) -> pa.Array:
            return pa.array([int(Grams(w).slots(len(w), bits)[0]) for w in batch.to_pylist()], pa.int64())

        head = F.when(F.length(col) > HEAD, F.substring(col, 1, HEAD))
        heads = words.select(head.alias("__head")).filter(F.col("__head").isNotNull()).distinct()
        self.lengths = sorted(r[0] for r in words.select(F.length(col)).distinct().collect())
        self.table = self._bits(words.select(slot(col).alias("slot")))
        self.heads = self._bits(heads.select(slot("__head").alias("slot")))

    @staticmethod
    def _bits(slots: DataFrame) -> np.ndarray:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))
        rows = slots.groupBy(F.shiftright("slot", 6).alias("i")).agg(F.bit_or(bit).alias("b")).toArrow()
        table = np.zeros(1 << max(FILTER_BITS - 6, 0), np.uint64)  # whatever the dictionary's size
        table[rows["i"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
        return table

    def holds(self, hashes: np.ndarray, heads: bool = False) -> np.ndarray:
        """Whether n-grams with these hashes may be listed, or may be the first signs of longer words."""
        slots = (hashes >> np.uint64(64 - self.bits)).view(np.int64)
        words = (self.heads if heads else self.table)[slots >> 6].view(np.int64)
        words >>= slots & 63
        words &= 1
        return words > 0


def _laid(texts: list[str], fold: bool) -> tuple[str, str, np.ndarray, np.ndarray]:
    """All texts in a row, the same as it is searched, where each text ends, and that end for each place."""
    whole = "".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    return whole, _fold(whole) if fold else whole, ends, np.repeat(ends, sizes)


def _fold(text: str) -> str:
    """What :func:`folded` makes of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = np.minimum(points, np.uint32(len(_FOLD) - 1))
    return np.where(points < len(_FOLD), _FOLD[low], points).tobytes().decode("utf-32-le", "surrogatepass")


def _alike(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """Whether the n signs of ``a`` from each place of ``at`` are those of ``b`` from the place in ``to``."""
    same = a[at] == b[to]
    for i in range(1, n):
        same &= a[at + i] == b[to + i]
    return same


def _candidates(texts: list[str], table: WordFilter, fold: bool) -> set[str]:
    """Distinct n-grams of the texts that may be listed.

    Places of one slot are compared with one of them; those that hold another n-gram are gone over again.
    """
    _, seen, _, stops = _laid(texts, fold)
    grams = Grams(seen)
    one = np.zeros(1 << _PACK_BITS, np.int32)
    out: set[str] = set()
    begun = None
    for n in table.lengths:
        if n > HEAD and begun is None:
            hits = [at[table.holds(h, heads=True)] for at, h in grams.hashes(HEAD)]
            begun = np.concatenate([np.zeros(0, np.int64), *hits])
        places, slots = [], []
        for at, hashes in grams.hashes(n, stops, begun):
            hit = np.flatnonzero(table.holds(hashes))
            hit = hit[at[hit] + n <= stops[at[hit]]]
            places.append(at[hit].astype(np.int32))
            slots.append((hashes[hit] >> np.uint64(64 - _PACK_BITS)).astype(np.int32))
        places, slots = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (places, slots))
        for _ in range(_ROUNDS):
            one[slots] = places
            first = one[slots]
            out.update([seen[a : a + n] for a in places[first == places].tolist()])
            other = ~_alike(grams.points, places, grams.points, first, n)
            places, slots = places[other], slots[other]
            if not len(places):
                break
        out.update([seen[a : a + n] for a in places.tolist()])
    return out


def _longest(grams: Grams, stops: np.ndarray, words: set[str]) -> np.ndarray:
    """Length of the longest word that begins at each place, 0 where none does."""
    longest = np.zeros(grams.size, np.int32)
    by_length: dict[int, list[str]] = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    begun = None
    for n in sorted(by_length):
        if n > HEAD and begun is None:
            heads = list({w[:HEAD] for w in words if len(w) > HEAD})
            known = np.zeros(1 << _PACK_BITS, bool)
            known[Grams("".join(heads)).slots(HEAD, _PACK_BITS)[::HEAD].astype(np.int64)] = True
            hits = [at[known[(h >> np.uint64(64 - _PACK_BITS)).view(np.int64)]] for at, h in grams.hashes(HEAD)]
            begun = np.concatenate([np.zeros(0, np.int64), *hits])
        listed = Grams("".join(by_length[n]))
        bits = min(_PACK_BITS, (1024 * len(by_length[n])).bit_length())
        starts, own = np.arange(0, listed.size, n, dtype=np.int32), listed.slots(n, bits)[::n].astype(np.int64)
        tables = []
        while len(starts):  # words that share a slot are in different tables
            table = np.full(1 << bits, -1, np.int32)
            table[own] = starts
            tables.append(table)
            left = table[own] != starts
            starts, own = starts[left], own[left]
        for places, hashes in grams.hashes(n, stops, begun):
            hashes >>= np.uint64(64 - bits)
            for table in tables:
                word = table[hashes.view(np.int64)]
                hit = np.flatnonzero(word >= 0)
                at, word = places[hit], word[hit]
                longest[at[(at + n <= stops[at]) & _alike(grams.points, at, listed.points, word, n)]] = n
    return longest


def _found(texts: list[str], words: set[str], fold: bool) -> tuple[pa.Array, np.ndarray]:
    """Finds of all texts in a row, as they are spelled, and how many each text has."""
    whole, seen, ends, stops = _laid(texts, fold)
    longest = _longest(Grams(seen), stops, words)
    mask = longest > 0
    starts = np.flatnonzero(mask)
    # The find that may follow each: the first that begins where it ends or later.
    before = np.zeros(len(longest) + 1, np.int64)
    np.cumsum(mask, out=before[1:])
    following = before[starts + longest[starts]].tolist()
    taken, i, last = bytearray(len(following)), 0, len(following)
    while i < last:
        taken[i] = 1
        i = following[i]
    starts = starts[np.frombuffer(taken, bool)]
    stop = starts + longest[starts]
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    data = np.frombuffer(whole.encode("utf-8"), np.uint8)
    if len(data) != len(whole):
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each sign begins
        starts, stop = at[starts], at[stop]
    # Finds don't overlap, so their bytes in a row are the text's without those between.
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts] += 1
    edges[stop] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).view(bool)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stop - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), buffers).cast(pa.string()), counts


def finds(texts: list[str], words: set[str], fold: bool = False) -> list[list[str]]:
    """Finds of each text, as they are spelled in it: left to right, longest first, not overlapping."""
    found, counts = _found(texts, words, fold)
    return pa.ListArray.from_arrays(pa.array([0, *np.cumsum(counts).tolist()], pa.int32()), found).to_pylist()


def finds_by_digest(
    df: DataFrame, text_col: str, dictionary: DataFrame, dict_col: str = "word", fold: bool = False
) -> DataFrame:
    """``__id`` (SHA-256 of the text) and ``found`` of each distinct text with a listed word (static input).

    Null and empty texts and words find nothing. Writes the distinct texts, laid in packs, with the n-grams of each
    pack to the shared folder; the filter and the list of word lengths are made by small jobs when this is called.
    """
    words = dictionary.select((folded(dict_col) if fold else F.col(dict_col)).alias("__gram"))
    words = words.filter(F.col("__gram") != "").distinct()
    table = WordFilter(words, "__gram")

    def pack(ids: list[str], texts: list[str]) -> pa.RecordBatch:
        # Packs are named by their first text; the n-grams stand beside it.
        name = int(ids[0][:15], 16)
        grams = [sorted(_candidates(texts, table, fold)), *[None] * (len(ids) - 1)]
        columns = [pa.array([name] * len(ids), pa.int64()), ids, texts, pa.array(grams, pa.list_(pa.string()))]
        return pa.record_batch(columns, ["__pack", "__id", "__text", "__grams"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch["__id"].to_pylist(), batch["__text"].to_pylist(), strict=True):
                ids.append(i)
                texts.append(text)
                size += len(text)
                if size >= PACK:
                    yield pack(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield pack(ids, texts)

    def search(pack: pa.Table, listed: pa.Table) -> pa.Table:
        ids, texts = pack["__id"], pack["__text"].to_pylist()
        found, counts = _found(texts, set(listed["__gram"].to_pylist()), fold)
        kept = counts > 0
        offsets = pa.array([0, *np.cumsum(counts[kept]).tolist()], pa.int32())
        return pa.table({"__id": ids.filter(pa.array(kept)), "found": pa.ListArray.from_arrays(offsets, found)})

    texts = df.select(F.sha2(text_col, 256).alias("__id"), F.col(text_col).alias("__text"))
    texts = texts.filter(F.col("__text") != "").dropDuplicates(["__id"])
    packs = settle(texts.mapInArrow(packed, "__pack long, __id string, __text string, __grams array<string>"))
    named = packs.filter(F.col("__grams").isNotNull()).select("__pack", F.explode("__grams").alias("__gram"))
    listed = named.join(words, "__gram").select(F.col("__pack").alias("__of"), "__gram")
    texts = packs.select("__pack", "__id", "__text")
    return texts.groupBy("__pack").cogroup(listed.groupBy("__of")).applyInArrow(search, "__id string, found array<string>")


def find_words(
    df: DataFrame, row_id: str, text_col: str, dictionary: DataFrame, dict_col: str = "word", fold: bool = False
) -> DataFrame:
    """All listed words in each text: left to right, longest first, not overlapping (static input).

    Gives ``row_id`` and ``found`` of the rows whose text holds any. With ``fold`` case and full-width forms make
    no difference; finds keep the spelling of the text. See :func:`finds_by_digest`.
    """
    found = finds_by_digest(df, text_col, dictionary, dict_col, fold)
    return df.select(row_id, F.sha2(text_col, 256).alias("__id")).join(found, "__id").select(row_id, "found")
