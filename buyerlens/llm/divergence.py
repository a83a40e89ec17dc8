"""How far the term frequencies of each source of a language lie from the other sources and the language.

Pass one counts in how many documents each term of a language occurs, exactly, and keeps the terms with
``least`` or more. Pass two counts occurrences by (language, source): the kept terms are numbered by minimal
perfect hashes, one for each shard of a language's terms, which are built by the executors and broadcast; a
task looks up its distinct words, the stored keys tell unkept words apart, and dense arrays of slots, one for
each group met, take the counts. What is broadcast is bounded: the ``shipped`` most widespread terms of at most
``TERM_BYTES`` bytes. If more are kept, the rest are counted under their own names: each task sums them by
group, and they are joined with the kept terms. Both ways give the same counts.

Probabilities and divergences are integers (see ``audit``), exact at any size: Spark's decimals where a
product may pass 64 bits. Sums over all terms of a pair of sources come from blocks of terms, each a matrix
of sources and terms of about ``CELLS`` numbers, so neither many terms nor many sources meet in one task.

Null text, language and source are empty strings; repeated rows are documents of their own; other columns are
ignored; a language without kept terms has pairs of value 0 and no term rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import IntegerType

from buyerlens.llm.common import written
from buyerlens.llm.lm import least_count
from buyerlens.llm.perfect_hash import PerfectHash, key_hashes
from buyerlens.llm.word_arrays import byte_set, slices, words_of

SHIPPED = 1 << 20  # terms broadcast at most
TERM_BYTES = 64  # longer terms are not broadcast
SHARDS = 16
GROUP = 16 << 20  # bytes of text worked on at a time
HELD = 64 << 20  # bytes of slots a task holds
CELLS = 1 << 20
REST = 1 << 40  # numbers of terms that are not broadcast begin here
ROWS = 1 << 18
#: Fixed: letters A-Z and a-z and all bytes of other characters.
TERM = byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


@arrow_udf(IntegerType())
def shard_of(terms: pa.Array) -> pa.Array:
    return pa.array((key_hashes(terms) % np.uint64(SHARDS)).astype(np.int32))


def _in_parts(arrays: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(arrays, names=names)
    for i in range(0, whole.num_rows, ROWS):
        yield whole.slice(i, ROWS)


def document_frequencies(rows: DataFrame) -> DataFrame:
    """(lang, term, df): in how many rows each term of a language occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for code, name in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column(2).filter(pc.equal(langs.indices, code))
                for at, count in slices(texts, GROUP):
                    words = words_of(texts.slice(at, count), TERM)
                    v = len(words.vocab)
                    if v:
                        once = np.unique(words.row * v + words.ids) % v
                        df = pa.array(np.bincount(once, minlength=v))
                        yield from _in_parts([pa.repeat(name, v), words.vocab, df], ["lang", "term", "df"])

    found = rows.mapInArrow(run, "lang string, term string, df long")
    return found.groupBy("lang", "term").agg(F.sum("df").alias("df"))


def _built(group: pa.Table) -> pa.Table:
    keys = group["term"].combine_chunks().cast(pa.string())
    keys = keys.take(pc.sort_indices(keys))
    h = PerfectHash.build(keys)
    one = lambda v, kind: pa.array([v], kind)
    return pa.table(
        {
            "lang": one(group["lang"][0].as_py(), pa.string()),
            "shard": one(group["shard"][0].as_py(), pa.int32()),
            "n": one(len(keys), pa.int64()),
            "sizes": one(h.sizes, pa.list_(pa.int64())),
            "bits": one(h.bits, pa.binary()),
            "terms": one(h.keys.to_pylist(), pa.list_(pa.string())),
        }
    )


def hash_shards(terms: DataFrame) -> DataFrame:
    """(lang, shard, base, n, sizes, bits, terms): the perfect hash of each shard; its slots begin at ``base``."""
    built = terms.withColumn("shard", shard_of("term")).groupBy("lang", "shard").applyInArrow(
        _built, "lang string, shard int, n long, sizes array<long>, bits binary, terms array<string>"
    )
    before = F.sum("n").over(W.partitionBy("lang").orderBy("shard")) - F.col("n")
    return written(built.withColumn("base", before), "hash-shards")


class Slots:
    """The numbers of a language's broadcast terms."""

    def __init__(self, shards: list[tuple]):
        self.shards = {shard: (base, PerfectHash(sizes, bits, keys)) for shard, base, sizes, bits, keys in shards}
        self.size = sum(len(h.keys) for _, h in self.shards.values())

    def of(self, terms: pa.Array) -> np.ndarray:
        """The number of each term, -1 for those that are not among them."""
        hashes = key_hashes(terms)
        out = np.full(len(terms), -1, np.int64)
        shard = (hashes % np.uint64(SHARDS)).astype(np.int64)
        for s, (base, h) in self.shards.items():
            mine = np.flatnonzero(shard == s)
            found = h.slots(terms.take(pa.array(mine)), hashes[mine])
            out[mine] = np.where(found >= 0, found + base, -1)
        return out


def group_counts(rows: DataFrame, shards: DataFrame, complete: bool) -> DataFrame:
    """(lang, source, slot, term, c): occurrences by group. Terms without a slot, given unless the slots are
    ``complete``, have their name instead."""
    # Bounded by the terms that are shipped.
    kept = shards.select("lang", "shard", "base", "sizes", "bits", "terms").toArrow()
    shared = rows.sparkSession.sparkContext.broadcast(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "slot", "term", "c"]
        by_lang: dict[str, list] = {}
        for x in shared.value.to_batches():
            for i in range(x.num_rows):
                row = [x.column(k)[i].as_py() for k in range(5)]
                by_lang.setdefault(row[0], []).append((*row[1:], x.column(5)[i].values))
        ready: dict[str, Slots] = {}
        dense: dict[tuple[str, str], np.ndarray] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in dense.items():
                at = np.flatnonzero(counts)
                n = len(at)
                none = pa.nulls(n, pa.string())
                yield from _in_parts([pa.repeat(lang, n), pa.repeat(source, n), pa.array(at), none, pa.array(counts[at])], names)
            dense.clear()

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                if lang not in ready:
                    ready[lang] = Slots(by_lang.get(lang, []))
                slots = ready[lang]
                mine = batch.filter(pc.equal(langs.indices, code))
                mine = mine.take(pc.sort_indices(mine.column(1)))
                sources, texts = mine.column(1), mine.column(2)
                for at, count in slices(texts, GROUP):
                    words = words_of(texts.slice(at, count), TERM)
                    if not len(words.vocab):
                        continue
                    number = slots.of(words.vocab)
                    part = sources.slice(at, count).dictionary_encode()
                    group = part.indices.to_numpy()[words.row]
                    cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        source = part.dictionary[int(group[a])].as_py()
                        ids, times = np.unique(words.ids[a:b], return_counts=True)
                        known = number[ids] >= 0
                        if known.any():
                            counts = dense.get((lang, source))
                            if counts is None:
                                if dense and sum(x.nbytes for x in dense.values()) + 8 * slots.size > HELD:
                                    yield from flushed()
                                counts = dense[lang, source] = np.zeros(slots.size, np.int64)
                            counts[number[ids[known]]] += times[known]
                        if not complete and not known.all():
                            other = words.vocab.take(pa.array(ids[~known]))
                            n = len(other)
                            none = pa.nulls(n, pa.int64())
                            yield from _in_parts([pa.repeat(lang, n), pa.repeat(source, n), none, other, pa.array(times[~known])], names)
        yield from flushed()

    found = rows.mapInArrow(run, "lang string, source string, slot long, term string, c long")
    if complete:
        return found.groupBy("lang", "source", "slot").agg(F.sum("c").alias("c")).withColumn("term", F.lit(None).cast("string"))
    return found.groupBy("lang", "source", "slot", "term").agg(F.sum("c").alias("c"))


def counts_of(rows: DataFrame, least: int, shipped: int) -> DataFrame:
    """(lang, source, slot, term, c): occurrences of the kept terms in each group, and their numbers."""
    terms = written(document_frequencies(rows).filter(F.col("df") >= least), "audit-terms")
    short = F.octet_length("term") <= TERM_BYTES
    reach = least_count(terms, "df", shipped)
    head = short & (F.col("df") >= reach)
    rest = terms.filter(~head)
    complete = rest.isEmpty()
    shards = hash_shards(terms.filter(head).select("lang", "term"))
    counts = written(group_counts(rows, shards, complete), "audit-counts")
    named = shards.select("lang", "base", F.posexplode("terms").alias("at", "term"))
    named = named.select("lang", (F.col("base") + F.col("at")).alias("slot"), "term")
    out = counts.filter("slot IS NOT NULL").drop("term").join(named, ["lang", "slot"])
    out = out.select("lang", "source", "slot", "term", "c")
    if not complete:
        bucket = F.pmod(F.xxhash64("term"), F.lit(1024))
        place = F.row_number().over(W.partitionBy("lang", "bucket").orderBy("term"))
        numbered = rest.withColumn("bucket", bucket).select(
            "lang", "term", (F.col("bucket") * F.lit(REST) + F.lit(REST) + place).alias("slot")
        )
        others = counts.filter("slot IS NULL").drop("slot").join(numbered, ["lang", "term"])
        out = out.unionByName(others.select("lang", "source", "slot", "term", "c"))
    return written(out, "audit-group-counts")


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (n + v)) as a 64-bit number."""
    top = (count.cast("decimal(18,0)") + F.lit(1).cast("decimal(1,0)")) * F.lit(1000000000).cast("decimal(10,0)")
    spread = n.cast("decimal(18,0)") + v.cast("decimal(18,0)")
    return F.call_function("div", top, spread) + 1


def _pair_sums(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Sums over a block of terms for each ordered pair of the language's sources."""
    sources = group["source"].combine_chunks().dictionary_encode()
    s = sources.indices.to_numpy().astype(np.int64)
    p = group["p"].to_numpy()
    none = group["slot"].is_null().to_numpy()  # the share of an absent term
    n = len(sources.dictionary)
    terms, column = np.unique(group["slot"].drop_null().to_numpy(), return_inverse=True)
    shares = np.empty((n, len(terms)), np.int64)
    shares[s[none]] = p[none, None]
    shares[s[~none], column] = p[~none]
    own, item, value = [], [], []
    for i in range(n):
        apart = shares[i] - shares
        own.append(np.full(n, i))
        item.append(np.arange(n))
        value.append((apart * apart // shares).sum(axis=1))
    own, item, value = map(np.concatenate, (own, item, value))
    other = own != item
    pick = lambda x: sources.dictionary.take(pa.array(x[other])).cast(pa.string())
    lang = pa.repeat(key[0].as_py(), int(other.sum()))
    return pa.table({"lang": lang, "source": pick(own), "item": pick(item), "value": pa.array(value[other])})


def audit(
    docs: DataFrame, least: int = 3, top: int = 200, shipped: int = SHIPPED, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """lang, source, part, item, value and rank for each source of each language.

    With V kept terms in the language, N their occurrences in a group (or the language) and count those of
    one term, p = 1 + floor(10^9 (count + 1) / (N + V)); p lies floor((p - q)^2 / q) from q. Part ``pair`` has each
    other source, with the sum over all kept terms; part ``term`` the ``top`` terms that the source has more often
    than its language, by their distance from it. Ranks go by value, then item.
    """
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    counts = counts_of(rows, least, shipped)
    totals = counts.groupBy("lang", "slot", "term").agg(F.sum("c").alias("c"))
    langs = totals.groupBy("lang").agg(F.sum("c").alias("n_lang"), F.count(F.lit(1)).alias("v"))
    groups = (
        rows.select("lang", "source")
        .distinct()
        .join(counts.groupBy("lang", "source").agg(F.sum("c").alias("n")), ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), "n_lang", F.coalesce("v", F.lit(0)).alias("v"))
    )
    groups = groups.withColumn("n_sources", F.count(F.lit(1)).over(W.partitionBy("lang")))
    # Terms of a block: a power of two, so that numbers of both kinds fall into blocks by division.
    power = F.floor(F.log2(F.greatest(F.lit(2.0), CELLS / F.col("n_sources")))).cast("int")
    groups = written(groups.withColumn("width", F.call_function("shiftleft", F.lit(1).cast("long"), power)), "audit-groups")
    known = counts.join(groups.filter("v > 0").select("lang", "source", "n", "v", "n_lang", "width"), ["lang", "source"])
    known = written(
        known.withColumn("p", _share(F.col("c"), F.col("n"), F.col("v"))).withColumn("block", F.expr("slot div width")), "audit-shares"
    )

    blocks = known.select("lang", "block").distinct()
    absent = groups.filter("v > 0").withColumn("p", _share(F.lit(0), F.col("n"), F.col("v")))
    absent = blocks.join(absent, "lang").select("lang", "block", "source", F.lit(None).cast("long").alias("slot"), "p")
    cells = known.select("lang", "block", "source", "slot", "p").unionByName(absent)
    sums = cells.groupBy("lang", "block").applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = groups.filter("v = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    pairs = pairs.unionByName(bare.withColumn("value", F.lit(0).cast("long")))

    whole = totals.join(langs, "lang").select("lang", "slot", _share(F.col("c"), F.col("n_lang"), F.col("v")).alias("q"))
    terms = (
        known.join(whole, ["lang", "slot"])
        .filter("p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    )
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").filter(F.col("rank") <= top))
