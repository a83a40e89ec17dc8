"""SimHash fingerprints, their links within a Hamming radius, and the groups these links form.

Links come from multi-index hashing. A 64-bit fingerprint is cut into segments; two fingerprints within
the radius agree, up to a small Hamming ball, in at least one of them. So each fingerprint looks up every
value of the ball around each of its segments in a table of segment values, and full distances are
verified. Of two values the larger one looks up the smaller one, which halves the look-ups.

A bucket of the table may hold very many fingerprints (a third of all rows may be near copies of one
document), and looking up such a bucket would make all pairs. Fingerprints that touch a bucket of more
than ``BUCKET`` members are linked in another exact way, linear in their number. Two fingerprints at
distance d <= r have a common meet (the bits set in both), reached from one by clearing i and from the
other by clearing j bits, i + j = d. Each emits all its meets with up to r cleared bits. At one meet, a
fingerprint that equals it (i = 0) is linked to all others, and if there is none, one with i = 1 is linked
to all with 1 <= i <= r - 1. These distances are at most r, and every link of a pair implies that the pair
is connected at its meet: this needs r <= 3, which is checked. For larger radii all buckets are looked up.

Fingerprints are distinct here: documents with equal fingerprints are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from buyerlens.llm.common import text_or_empty, written
from buyerlens.llm.components import components

SEED = 42
BUCKET = 64  # members of a bucket that is looked up pair by pair
STEP = 1 << 15  # shingles whose bits are counted at a time
TASK_FPS = 200  # fingerprints whose meets, 43,745 of one at most, a task makes


def fingerprint(text: str, shingle: int = 3) -> int:
    """Majority bits of the XXH64 values of all word shingles of a text, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), STEP):
        pairs = zip(starts[at : at + STEP], ends[at : at + STEP], strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<i8")[0])


def fingerprint_udf(shingle: int):
    @arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in map(pa.StringScalar.as_py, texts)], pa.int64())

    return run


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of each whole text; null texts have no words."""
    return docs.withColumn(out, fingerprint_udf(shingle)(text_or_empty(text)))


def segment_plan(radius: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, bits, ball radius) of each segment that must be looked up.

    If the first radius % segments + 1 segments all differ by more than radius // segments bits and the
    rest by at least that many, the whole distance exceeds the radius.
    """
    small, full = divmod(radius, segments)
    plan, shift = [], 0
    for i in range(segments):
        bits = 64 // segments + (i < 64 % segments)
        ball = small if i <= full else small - 1
        if ball >= 0:
            plan.append((shift, bits, ball))
        shift += bits
    return plan


def _value(fp: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND((1 << bits) - 1)


def _key(segment: int, value: Column) -> Column:
    return F.xxhash64(F.lit(segment), value)


def links(fps: DataFrame, radius: int = 3, segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) that connect all distinct fingerprints ``fp`` within the radius.

    ``fps`` holds each fingerprint once. In small buckets every linked pair is given, in large ones
    enough of them to connect the same fingerprints.
    """
    plan = segment_plan(radius, segments)
    # The segment's number and value are one 64-bit key; distances are verified, so clashes do no harm.
    table = fps.select(
        "fp",
        F.explode(F.array(*[_key(i, _value(F.col("fp"), s, n)) for i, (s, n, _) in enumerate(plan)])).alias("key"),
    )
    probes = None
    for i, (shift, bits, ball) in enumerate(plan):
        masks = [sum(1 << b for b in c) for k in range(ball + 1) for c in combinations(range(bits), k)]
        value = _value(F.col("fp"), shift, bits)
        part = (
            fps.select("fp", value.alias("v"), F.explode(F.lit(masks).cast("array<long>")).alias("mask"))
            .withColumn("w", F.col("v").bitwiseXOR(F.col("mask")))
            .filter((F.col("mask") == 0) | (F.col("w") < F.col("v")))
            .select("fp", _key(i, F.col("w")).alias("key"))
        )
        probes = part if probes is None else probes.union(part)
    crowd, dense = None, table
    if radius <= 3:
        hot = written(
            table.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).select("key"), "hot"
        )
        crowd = written(probes.join(hot, "key", "left_semi").select("fp").distinct(), "crowd")
        dense = table.join(hot, "key", "left_anti")
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= radius
    found = (
        probes.alias("p")
        .join(dense.alias("t"), F.col("p.key") == F.col("t.key"))
        .filter((F.col("p.fp") != F.col("t.fp")) & near)
        .select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b"))
    )
    return found if crowd is None else found.union(meet_links(crowd, radius))


@lru_cache(maxsize=256)
def _choices(n: int, radius: int) -> np.ndarray:
    """Which of n bits to clear, as rows of bit numbers padded with n."""
    rows = [c for k in range(radius + 1) for c in combinations(range(n), k)]
    out = np.full((len(rows), radius), n, np.int64)
    for i, c in enumerate(rows):
        out[i, : len(c)] = c
    return out


def meet_links(fps: DataFrame, radius: int) -> DataFrame:
    """Pairs that connect the fingerprints within the radius (at most 3), linear in their number."""
    schema = pa.schema([("meet", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_pylist():
                value = np.array([fp], np.int64).view(np.uint64)[0]
                bits = [np.uint64(1 << i) for i in range(64) if int(value) >> i & 1]
                masks = np.array([*bits, 0], np.uint64)[_choices(len(bits), radius)].sum(axis=1, dtype=np.uint64)
                meets = (value ^ masks).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(meets), pa.array(np.full(len(meets), fp, np.int64))], schema=schema
                )

    # The planner takes the rows for as few bytes as the fingerprints they come from, so they must not meet in a
    # join, which would send them all to the driver. The window also sorts them once, by meet.
    tasks = max(1, -(-fps.count() // TASK_FPS))
    rows = fps.select("fp").repartition(tasks, "fp").mapInArrow(run, "meet long, fp long")
    cleared = F.bit_count(F.col("meet").bitwiseXOR(F.col("fp")))
    # A meet has at most as many rows as there are fingerprints within the radius of it: a constant.
    at_meet = Window.partitionBy("meet")
    centres = {
        "same": F.min(F.when(cleared == 0, F.col("fp"))).over(at_meet),
        "one": F.min(F.when(cleared == 1, F.col("fp"))).over(at_meet),
    }
    reach = F.when(F.col("same").isNull(), radius - 1).otherwise(radius)
    return (
        rows.withColumns(centres)
        .filter(cleared <= reach)
        .select(F.col("fp").alias("a"), F.coalesce("same", "one").alias("b"))
        .filter("a != b")
        .distinct()
    )


def groups(rows: DataFrame, doc_id: str = "doc_id", radius: int = 3, segments: int = 2) -> DataFrame:
    """(fp, root, component_id) for each fingerprint in ``rows`` (columns fp and ``doc_id``).

    ``root`` tells groups apart; ``component_id`` is the smallest document id reachable over links, null
    if all ids of the group are null.
    """
    nodes = written(rows.groupBy("fp").agg(F.min(doc_id).alias("least")), "fingerprints")
    roots = components(links(nodes.select("fp"), radius, segments))
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    linked = written(linked, "linked")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(linked.join(least, "root").select("fp", "root", "component_id"), "groups")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, segments: int = 2
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of ``docs``.

    Null and wordless texts have fingerprint zero, linked like any other. Repeated rows give repeated
    results, rows with a null id belong to a group but never name it, an empty table gives no rows.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = written(with_fingerprint(plain, shingle).select("doc_id", "fp"), "documents-fp")
    found = groups(rows, "doc_id", radius, segments)
    return rows.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, segments: int = 2
) -> DataFrame:
    """The rows of ``docs`` without all but one of each group: the smallest id stays, nulls last."""
    # Copied once with a row number, so that rows can be named even where ids repeat or are null.
    copy = written(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
            F.col(f"`{doc_id}`").cast("long").alias("id"),
            fingerprint_udf(shingle)(text_or_empty(text)).alias("fp"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "documents-fp",
    )
    found = groups(copy.select(F.col("id").alias("doc_id"), "fp"), "doc_id", radius, segments)
    best = (
        copy.select("id", "fp", "row")
        .join(found, "fp")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "row")).alias("best"))
        .select(F.col("best.row").alias("row"))
    )
    return copy.join(best, "row", "left_semi").select("doc.*")
