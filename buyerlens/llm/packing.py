"""Token-id files: fixed-width bit packing in blocks, written in ascending document order.

Each id takes the fewest bits that hold the vocabulary (16 for 50,257 ids), low bit first, without gaps
between ids. A file row is one block:

    part, block    where the block stands: files are ordered by part, blocks by number within it
    first          ids of the part before this block
    doc_ids        the documents of the block, ascending
    offsets        where each document starts, in ids from the block's start; one more entry ends the last
    width          bits of an id
    packed         the ids of all documents of the block

so document k of a block is found without reading its neighbours (``unpack(packed, width, offsets[k],
count)``), and a block or a whole file unpacks by array arithmetic. Blocks are rows of Parquet files: the
commit protocol of Spark's writer keeps half-written files of a lost executor out.

Null texts are empty texts (the end id alone), a null doc_id sorts first, rows with equal doc_ids follow
one another ordered by their content, and an empty table makes a readable file set without blocks.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from buyerlens.llm.bpe_words import encode_texts
from buyerlens.llm.common import new_path, per_batch, text_or_empty

BLOCK_IDS = 1 << 18  # a block closes with the document that reaches this many ids
SLICE = 32 << 20  # bytes of text whose distinct words are encoded at a time
STEP = 1 << 16  # ids that are spread into single bits at a time


def width_of(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as a string of ``width``-bit numbers, low bit first."""
    ids = np.asarray(ids, dtype=np.uint32)
    if width in (8, 16, 32):  # whole bytes: the same layout
        return ids.astype(f"<u{width // 8}").tobytes()
    shifts = np.arange(width, dtype=np.uint32)
    out = []
    for i in range(0, len(ids), STEP):  # a multiple of 8 ids fills whole bytes
        bits = (ids[i : i + STEP, None] >> shifts) & 1
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(packed: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start``; touches only the bytes that hold them."""
    if width in (8, 16, 32):
        return np.frombuffer(packed, f"<u{width // 8}", count, start * width // 8).astype(np.uint32)
    weights = (1 << np.arange(width, dtype=np.uint64)).astype(np.uint64)
    out = [np.empty(0, np.uint32)]
    for at in range(start, start + count, STEP):
        n = min(STEP, start + count - at)
        low, high = at * width, (at + n) * width
        raw = np.frombuffer(packed, np.uint8, -(-high // 8) - low // 8, low // 8)
        bits = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + n * width]
        out.append((bits.reshape(n, width) @ weights).astype(np.uint32))
    return np.concatenate(out)


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library; of a byte-level vocabulary distinct words are encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.size = self.tok.get_vocab_size()
        self.special = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        spec = json.loads(self.tok.to_str())
        split = spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        self.by_words = self._words if plain and spec["normalizer"] is None else None

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words of a split text are split no further, so many are encoded as one pre-split text."""
        whole = self.tok.encode(words.cast(pa.large_string()).to_pylist(), is_pretokenized=True, add_special_tokens=False)
        which = np.array(whole.word_ids, np.int64)
        return np.array(whole.ids, np.int32), np.bincount(which, minlength=len(words))

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), 256):
            out += [np.array(e.ids, np.int32) for e in self.tok.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        return encode_texts(texts, self.by_words, self._whole, self.special, SLICE)


@lru_cache(maxsize=2)
def encoder(name: str) -> LibraryEncoder:
    return LibraryEncoder(public_tokenizers.path(name))


def encoded(docs: DataFrame, tokenizer: str, end_id: int | None, width: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_tokens and packed ids of each text, the end id included."""
    def run(columns: list[pa.Array]) -> dict:
        ids, sizes = encoder(tokenizer).encode(columns[1])
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
        ends = np.cumsum(sizes).tolist()
        if width % 8:
            packed = [pack(ids[a:b], width) for a, b in zip([0, *ends], ends, strict=False)]
        else:  # whole bytes: the ids of all texts are packed at once
            data, n = pack(ids, width), width // 8
            packed = [data[a * n : b * n] for a, b in zip([0, *ends], ends, strict=False)]
        return {"doc_id": columns[0], "n_tokens": sizes, "packed": packed}

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return per_batch(rows, run, "doc_id long, n_tokens long, packed binary")


def write_files(
    docs: DataFrame,
    path: str,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int | None = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every text and write the block files below ``path``.

    Texts are encoded where they lie; only packed ids move, to ranges of doc_id.
    """
    width = width_of(encoder(tokenizer).size)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of doc_id hold about as many documents each; they come from the ids alone, so texts are
    # encoded once and packed ids move once.
    shares = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx(F.col(doc_id).cast("long"), shares or [0.5], 10 * parts)).head()[0]
    bounds = sorted(set(bounds or []))
    rows = encoded(docs, tokenizer, end_id, width, doc_id, text)
    part = F.coalesce(range_of(bounds)(F.col("doc_id")), F.lit(0))
    placed = (
        rows.withColumn("part", part)
        .repartitionById(len(bounds) + 1, F.col("part").cast("int"))
        .withColumn("tie", F.xxhash64("packed"))
        .sortWithinPartitions("part", "doc_id", "tie")
        .select("part", "doc_id", "n_tokens", "packed")
    )
    placed.mapInArrow(
        _blocks(width),
        "part long, block long, first long, doc_ids array<long>, offsets array<long>, width int, packed binary",
    ).write.option("compression", "zstd").parquet(path)


def range_of(bounds: list[int]):
    """Number of bounds that are at most the id, by bisection in column expressions."""

    def find(col, low: int, high: int):
        if low == high:
            return F.lit(low).cast("long")
        mid = (low + high) // 2
        return F.when(col >= bounds[mid], find(col, mid + 1, high)).otherwise(find(col, low, mid))

    return lambda col: F.when(col.isNotNull(), find(col, 0, len(bounds)))


def _blocks(width: int):
    schema = pa.schema(
        [
            ("part", pa.int64()),
            ("block", pa.int64()),
            ("first", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("offsets", pa.list_(pa.int64())),
            ("width", pa.int32()),
            ("packed", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = 0, 0, 0
        doc_ids: list = []
        ids: list[bytes] = []
        counts: list[int] = []
        size = 0

        def closed():
            offsets = np.concatenate([[0], np.cumsum(counts)]).tolist()
            whole = pack(np.concatenate([unpack(x, width, 0, n) for x, n in zip(ids, counts, strict=True)]), width) if width % 8 else b"".join(ids)
            row = [[part], [block], [first], [doc_ids], [offsets], [width], [whole]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(row, schema, strict=True)], schema=schema
            )

        for batch in batches:
            for part, doc, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_ids.append(doc)
                ids.append(packed)
                counts.append(n)
                size += n
                if size >= BLOCK_IDS:
                    yield closed()
                    block, first, size, doc_ids, ids, counts = block + 1, first + size, 0, [], [], []
        if doc_ids:
            yield closed()

    return run


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document as the files hold it: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it in all files.
    """
    blocks = spark.read.parquet(path)
    ends = blocks.groupBy("part").agg(F.sum(F.element_at("offsets", -1)).alias("n"))
    # One row per file, so a handful for one task.
    before = ends.select(
        "part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before")
    )

    def run(columns: list[pa.Array]) -> dict:
        before, first, doc_ids, offsets, widths, packed = columns
        out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
        for i in range(len(first)):
            base = before[i].as_py() + first[i].as_py()
            at = offsets[i].as_py()
            ids = unpack(packed[i].as_buffer(), widths[i].as_py(), 0, at[-1]).astype("<u4")
            out["doc_id"] += doc_ids[i].as_py()
            out["start"] += [base + a for a in at[:-1]]
            out["n_tokens"] += [b - a for a, b in zip(at, at[1:], strict=False)]
            out["ids_crc32"] += [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:], strict=False)]
        return out

    # One row per file: the number of files is the bound of what is broadcast.
    rows = blocks.join(F.broadcast(before), "part").select("before", "first", "doc_ids", "offsets", "width", "packed")
    return per_batch(rows, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the files of ``docs`` and return what they hold, read back."""
    spark = docs.sparkSession
    path = path or new_path(spark, "token-files")
    write_files(docs, path, **options)
    return read_files(spark, path)
