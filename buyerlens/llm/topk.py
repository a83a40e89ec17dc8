"""Exact top-k search by a bit-sliced index.

Vectors become integers, floor(scale * x). The index holds blocks of rows; in a block, each attribute is
stored as bitmaps, one for each binary digit of (value - least value), one bit per row. For a query the
inner products of all rows of a block are added up at once: the attribute's bitmaps enter the sum once for
each binary digit of the query's weight (inverted where the weight is negative, which a constant makes
good), and carry-save adders reduce the bitmaps of each place to one. The sum's own bitmaps then select
the k largest from the most significant place downward; rows that agree in all places are ties, and the
smallest ids of them fill the rest. Nothing is approximate.

Blocks are joined to blocks of queries by block number, so a task holds one of each. Work is queries times
rows, as the question asks.

Vectors that are null or hold null or non-finite components take no part, nor do null ids. Only vectors of
the query's own length are compared. A row never meets rows of its own id. Repeated rows stay candidates
and queries of their own. Integers beyond ``LARGEST`` on either side count as that bound. Ranks go by exact
products of any size; a score that 64 bits don't hold is given as their largest or smallest number. Ids that are
no numbers end the job with Spark's cast error; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from buyerlens.llm.common import _arrow_schema, written

BLOCK = 32_768  # rows of an index block
QUERIES = 32  # queries of a query block
LARGEST = 1 << 52
LOW_BITS = 62  # a score moves as two numbers: these bits, and what stands above them

INDEX = "part long, seq long, dim int, n int, ids binary, lows binary, widths binary, slices binary"
CHUNK = "dim int, n int, qs binary, qids binary, values binary"


def whole_numbers(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, dim, v) of the vectors that take part."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
        .select("vec_id", F.size("v").alias("dim"), F.transform("v", whole).alias("v"))
    )


def _batch(schema: pa.Schema, row: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)


def _runs(batches: Iterator[pa.RecordBatch], most: int):
    """Columns of up to ``most`` rows of one dimension, from rows sorted by dimension."""
    held: list[tuple] = []
    count = 0

    def taken():
        return [np.concatenate([h[i] for h in held]) for i in range(len(held[0]))]

    for b in batches:
        dims = b.column("dim").to_numpy()
        at = 0
        while at < len(dims):
            if held and held[0][-1].shape[1] != dims[at]:
                yield taken()
                held, count = [], 0
            stop = at + int(np.searchsorted(dims[at:], dims[at], side="right"))
            stop = min(stop, at + most - count)
            part = b.slice(at, stop - at)
            values = part.column("v").flatten().to_numpy().reshape(len(part), -1)
            others = tuple(part.column(i).to_numpy() for i in range(part.num_columns - 2))
            held.append((*others, values))
            count += len(part)
            at = stop
            if count == most:
                yield taken()
                held, count = [], 0
    if held:
        yield taken()


def build_index(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """Index blocks of (vec_id, dim, v) rows, each ascending by vec_id."""
    schema = _arrow_schema(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, (part, ids, values) in enumerate(_runs(batches, block)):
            n, dim = values.shape
            lows = values.min(axis=0) if dim else np.zeros(0, np.int64)
            shifted = (values - lows).astype(np.uint64)
            widths = np.array([int(shifted[:, d].max()).bit_length() for d in range(dim)], np.int64)
            words = -(-n // 64)
            rows = []
            for d in range(dim):
                for b in range(widths[d]):
                    bits = np.zeros(words * 64, np.uint8)
                    bits[:n] = shifted[:, d] >> np.uint64(b) & np.uint64(1)
                    rows.append(np.packbits(bits, bitorder="little"))
            slices = np.concatenate(rows).tobytes() if rows else b""
            row = [int(part[0]), seq, dim, n, ids.astype(np.int64).tobytes(), lows.tobytes(), widths.tobytes(), slices]
            yield _batch(schema, row)

    rows = vectors.sortWithinPartitions("dim", "vec_id").select(
        F.spark_partition_id().cast("long").alias("part"), "vec_id", "dim", "v"
    )
    return rows.mapInArrow(run, INDEX)


def _query_blocks(queries: DataFrame, size: int) -> DataFrame:
    schema = _arrow_schema(CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, ids, values in _runs(batches, size):
            yield _batch(schema, [values.shape[1], len(q), q.tobytes(), ids.tobytes(), values.tobytes()])

    return queries.select("q", "vec_id", "dim", "v").sortWithinPartitions("dim", "q").mapInArrow(run, CHUNK)


class Block:
    """One index block, ready to be searched."""

    def __init__(self, dim: int, n: int, ids: bytes, lows: bytes, widths: bytes, slices: bytes):
        self.n = n
        self.ids = np.frombuffer(ids, np.int64)
        self.lows = np.frombuffer(lows, np.int64)
        self.widths = np.frombuffer(widths, np.int64)
        words = -(-n // 64)
        plain = np.frombuffer(slices, np.uint64).reshape(-1, words)
        self.maps = np.concatenate([plain, ~plain])  # a slice and, half the table further, its inverse
        self.half = len(plain)
        self.begin = np.concatenate([[0], np.cumsum(self.widths)])
        all_rows = np.zeros(words * 64, np.uint8)
        all_rows[:n] = 1
        self.valid = np.packbits(all_rows, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the inner products less a constant, least significant first; and the constant."""
        places: dict[int, list] = {}
        constant = 0
        for d, q in enumerate(query.tolist()):
            low, width = int(self.lows[d]), int(self.widths[d])
            constant += q * low
            shift = 0
            if q < 0:
                constant -= -q * ((1 << width) - 1)
                shift, q = self.half, -q
            at = int(self.begin[d]) + shift
            i = 0
            while q >> i:
                if q >> i & 1:
                    for b in range(width):
                        places.setdefault(i + b, []).append(at + b)
                i += 1
        out: list[np.ndarray] = []
        carried = np.empty((0, self.maps.shape[1]), np.uint64)
        place, last = 0, max(places, default=-1)
        while place <= last or len(carried):
            rows = np.concatenate([self.maps[places.get(place, [])], carried])
            carries = [np.empty((0, rows.shape[1]), np.uint64)]
            while len(rows) > 1:
                if len(rows) == 2:  # half adder
                    carries.append(rows[:1] & rows[1:])
                    rows = rows[:1] ^ rows[1:]
                    break
                m = len(rows) // 3
                a, b, c = rows[:m], rows[m : 2 * m], rows[2 * m : 3 * m]
                ab = a ^ b
                carries.append((a & b) | (c & ab))
                rows = np.concatenate([ab ^ c, rows[3 * m :]])
            out.append(rows[0] if len(rows) else np.zeros_like(self.valid))
            carried = np.concatenate(carries)
            place += 1
        return out, constant

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of the k best rows whose id is not ``own``."""
        slices, constant = self.sums(query)
        rest = self.valid.copy()
        a, b = np.searchsorted(self.ids, [own, own + 1])
        for i in range(a, b):
            rest[i >> 6] &= ~(np.uint64(1) << np.uint64(i & 63))
        sure = np.zeros_like(rest)
        for s in reversed(slices):
            both = sure | (rest & s)
            n = int(np.bitwise_count(both).sum())
            if n > k:
                rest = rest & s
            else:
                sure, rest = both, rest & ~s
                if n == k:
                    break
        taken = _positions(sure)
        if len(taken) < k:  # ties in every place: ids ascend within the block
            taken = np.concatenate([taken, _positions(rest)[: k - len(taken)]])
        word, bit = taken >> 6, (taken & 63).astype(np.uint64)
        scores = [constant] * len(taken)
        for place, s in enumerate(slices):
            for i, x in enumerate((s[word] >> bit & np.uint64(1)).tolist()):
                scores[i] += x << place
        return self.ids[taken], scores


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block: int = BLOCK,
    queries: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query, ties to the smaller vec_id.

    ``is_query`` is a condition on the column vec_id.
    """
    rows = written(whole_numbers(vectors, id_col, vec_col, scale), "vectors")
    index = written(build_index(rows, block), "index")
    # Numbers without gaps; one row per block of rows here, not the blocks themselves.
    numbers = written(
        index.select("part", "seq", (F.row_number().over(W.orderBy("part", "seq")) - 1).alias("block")), "index-numbers"
    )
    count = numbers.count()
    if not count:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = rows.filter(is_query).withColumn("q", F.monotonically_increasing_id())
    asked = written(_query_blocks(asked, queries), "queries")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    pairs = asked.select("block", *[F.col(c).alias(f"q_{c}") for c in asked.columns if c != "block"]).join(
        index.join(numbers, ["part", "seq"]), "block"
    )
    found = pairs.select(
        "q_dim", "q_qs", "q_qids", "q_values", "dim", "n", "ids", "lows", "widths", "slices"
    ).mapInArrow(_searched(k), "q long, query_id long, vec_id long, high long, low long")
    order = W.partitionBy("q").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    score = (
        F.when(F.col("high") > 1, (1 << 63) - 1)
        .when(F.col("high") < -2, F.lit(-(1 << 63) + 1) - 1)
        .otherwise(F.col("high") * (1 << LOW_BITS) + F.col("low"))
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
    )


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, None
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for i in range(b.num_rows):
                q_dim, qs, qids, values, dim, n, ids, lows, widths, slices = (c[i].as_py() for c in b.columns)
                if q_dim != dim:
                    continue
                if last != (ids, lows):
                    last, block = (ids, lows), Block(dim, n, ids, lows, widths, slices)
                asked = np.frombuffer(values, np.int64).reshape(-1, dim)
                for q, own, v in zip(np.frombuffer(qs, np.int64).tolist(), np.frombuffer(qids, np.int64).tolist(), asked, strict=True):
                    vec_ids, scores = block.best(v, own, k)
                    out[0].extend([q] * len(scores))
                    out[1].extend([own] * len(scores))
                    out[2].extend(vec_ids.tolist())
                    out[3].extend(s >> LOW_BITS for s in scores)
                    out[4].extend(s & (1 << LOW_BITS) - 1 for s in scores)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["q", "query_id", "vec_id", "high", "low"])

    return run
