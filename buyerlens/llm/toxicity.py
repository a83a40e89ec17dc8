"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence has probability p = sigmoid(b + the weights of its words' features), a document is toxic if any
of its sentences is: 1 - product of (1 - p) over its sentences (noisy-or). Weights are trained from
document labels only, by the gradient of the documents' log loss, and then tell which sentences offend.

Features of a word are the word in lower case and its first three to six letters. Sentences end at a line
end or at a word that ends with a full stop, question or exclamation mark.

The model is fitted on a bounded sample of whole labelled documents, ``SAMPLE`` rows and ``SAMPLE_BYTES`` bytes of
text of each label at most, by hash of the id and the text, weighted back to the labels' true numbers. So what the
driver gathers to train is bounded in bytes, too. Its features are the ``VOCABULARY`` that separate the sample's
labels best. Scoring covers every document and every sentence.

Null and empty texts are one empty sentence. Very long texts are scored whole; a labelled one beyond
``SAMPLE_BYTES`` is not learned from. Rows of ``docs`` that repeat an id and a text are learned from once, and
scored each. A document labelled more than once counts by its greatest label; null labels are left out. Other
columns are not read, whatever their names. If the sample lacks a label, every score is one half of the way
there: 0 if nothing is toxic, 0.5 if nothing is known, and 1 if everything is.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from buyerlens.llm.common import _arrow_schema, per_batch, text_or_empty, written

SAMPLE = 10_000  # labelled rows of each label
SAMPLE_BYTES = 24 << 20  # bytes of their texts of each label
PARTS = 4096  # parts by hash, of which as many are taken as fit
CHUNK = 1 << 20  # features that a step of the training handles together
VOCABULARY = 4096
STEPS = 300
PENALTY = 1e-5
OFFENDS = 0.5
MEMO = 400_000
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?][\"')\]»”’]*$")
_MARK = 1e6  # added to the weight of a word that ends a sentence


def features(piece: str) -> list[str]:
    """Features of the words in one piece between spaces."""
    out = []
    for w in _WORD.findall(piece.lower()):
        out.append("=" + w)
        out += ["^" + w[:k] for k in (3, 4, 5, 6) if len(w) >= k]
    return out


def ends_sentence(piece: str) -> bool:
    return bool(_END.search(piece))


def pieces_of(text: str) -> tuple[list[str], np.ndarray]:
    """Pieces between spaces of all lines in a row, and which of them end a line."""
    lines = text.split("\n")
    if len(lines) == 1:
        pieces = text.split(" ")
        closes = np.zeros(len(pieces), bool)
    else:
        cut = [line.split(" ") for line in lines]
        pieces = [p for c in cut for p in c]
        closes = np.zeros(len(pieces), bool)
        closes[np.cumsum([len(c) for c in cut]) - 1] = True
    closes[-1] = True
    return pieces, closes


@dataclass
class Model:
    bias: float
    weights: dict[str, float]
    flat: float | None = None  # the score of everything, if there was nothing to learn
    memo: dict[str, float] = field(default_factory=dict)

    def _weigh(self, piece: str) -> float:
        value = sum(self.weights.get(f, 0.0) for f in features(piece))
        return value + _MARK if ends_sentence(piece) else value

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability of the document, and (start, end, probability) of the sentences that offend."""
        if self.flat is not None:
            return self.flat, []
        pieces, closes = pieces_of(text)
        memo = self.memo
        values = list(map(memo.get, pieces))
        if None in values:
            if len(memo) > MEMO:
                memo.clear()
            for i, v in enumerate(values):
                if v is None:
                    values[i] = self._weigh(pieces[i])
                    if len(pieces[i]) < 64:
                        memo[pieces[i]] = values[i]
        v = np.array(values)
        marked = v > _MARK / 2
        ends = np.flatnonzero(marked | closes)
        sums = np.diff(np.concatenate([[0.0], np.cumsum(v - _MARK * marked)[ends]]))
        # log(1 - p) = -log(1 + exp(logit))
        quiet = -np.logaddexp(0.0, self.bias + sums)
        total = float(-np.expm1(quiet.sum()))
        loud = np.flatnonzero(-np.expm1(quiet) >= OFFENDS)
        if not len(loud):
            return total, []
        stops = np.cumsum([len(p) + 1 for p in pieces]) - 1
        starts = np.concatenate([[0], stops[ends[:-1]] + 1])
        return total, [(int(starts[k]), int(stops[ends[k]]), float(-np.expm1(quiet[k]))) for k in loud]


def sample_labels(labels: DataFrame, label: str, doc_id: str, size: int = SAMPLE) -> DataFrame:
    """(doc_id, y, w): about ``size`` rows of each label at most, w tells how many rows each stands for."""
    one = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    one = one.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["count"] for r in one.filter("y in (0, 1)").groupBy("y").count().collect()}
    share = {y: min(1.0, size / n) for y, n in counts.items()}
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1_000_000)) / 1e6
    rate = F.when(F.col("y") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0)))
    return one.filter(F.col("y").isin(0, 1) & (part < rate)).withColumn("w", F.try_divide(F.lit(1.0), rate))


def _vocabulary(sample: DataFrame, size: int) -> list[str]:
    """The features whose document frequencies differ most between the labels, in standard errors."""

    def run(columns: list[pa.Array]) -> dict:
        found = (Counter(), Counter())
        for text, y in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True):
            pieces, _ = pieces_of(text)
            found[y].update({f for p in set(pieces) for f in features(p)})
        both = list(found[0].keys() | found[1].keys())
        return {"feature": both, "n0": [found[0][f] for f in both], "n1": [found[1][f] for f in both]}

    n0, n1 = sample.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).head()
    seen = per_batch(sample.select("text", "y"), run, "feature string, n0 long, n1 long")
    seen = seen.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter("n0 + n1 >= 3")
    odds = F.log((F.col("n1") + 0.5) / (n1 - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (n0 - F.col("n0") + 0.5))
    spread = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = seen.select("feature", F.abs(odds / spread).alias("z")).filter("z > 2").orderBy(F.desc("z"), "feature").limit(size)
    return [r["feature"] for r in best.collect()]


def _bags(sample: DataFrame, vocabulary: list[str]) -> pa.Table:
    """Per document the vocabulary features of each sentence: flat numbers and counts per sentence."""
    place = {f: i for i, f in enumerate(vocabulary)}
    schema = "y int, w double, ids array<int>, sizes array<int>"
    kinds = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids_all, sizes_all = [], []
            for text in b.column(0).to_pylist():
                ids, sizes, n = [], [], 0
                pieces, closes = pieces_of(text)
                for p, close in zip(pieces, closes.tolist(), strict=True):
                    own = [place[f] for f in features(p) if f in place]
                    ids += own
                    n += len(own)
                    if close or ends_sentence(p):
                        sizes.append(n)
                        n = 0
                ids_all.append(ids)
                sizes_all.append(sizes)
            yield pa.RecordBatch.from_arrays(
                [b.column(1).cast(pa.int32()), b.column(2), pa.array(ids_all, kinds[2].type), pa.array(sizes_all, kinds[3].type)],
                schema=kinds,
            )

    return sample.select("text", "y", "w").mapInArrow(run, schema).toArrow()


@dataclass
class _Chunk:
    """Some documents, their sentences that hold features, and these features."""

    y: np.ndarray
    w: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray  # features of each sentence
    home: np.ndarray  # document of each sentence
    empty: np.ndarray  # sentences of each document without features; they are all alike


def _chunks(bags: pa.Table) -> list[_Chunk]:
    bags = bags.combine_chunks()
    y, w = bags["y"].to_numpy().astype(float), bags["w"].to_numpy()
    sizes, ids = bags["sizes"].combine_chunks(), bags["ids"].combine_chunks()
    sentences, features_to = sizes.offsets.to_numpy(), ids.offsets.to_numpy()
    per_sentence, flat = sizes.flatten().to_numpy(), ids.flatten().to_numpy()
    base, first = sentences[0], features_to[0]
    out, a = [], 0
    while a < len(y):
        b = max(a + 1, int(np.searchsorted(features_to, features_to[a] + CHUNK, "right")) - 1)
        own = per_sentence[sentences[a] - base : sentences[b] - base]
        doc = np.repeat(np.arange(b - a), np.diff(sentences[a : b + 1]))
        full = np.flatnonzero(own)
        empty = np.diff(sentences[a : b + 1]) - np.bincount(doc[full], minlength=b - a)
        out.append(_Chunk(y[a:b], w[a:b] / w.sum(), flat[features_to[a] - first : features_to[b] - first], own[full], doc[full], empty))
        a = b
    return out


def train(bags: pa.Table, n: int, steps: int = STEPS, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """Bias and feature weights by Adam on the weighted log loss of noisy-or documents, chunk by chunk."""
    chunks = _chunks(bags)
    theta = np.zeros(n + 1)
    theta[-1] = -5.0
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        grad = np.zeros(n + 1)
        p0 = 1 / (1 + np.exp(-theta[-1]))
        for c in chunks:
            owner = np.repeat(np.arange(len(c.sizes)), c.sizes)
            logit = theta[-1] + np.bincount(owner, theta[c.ids], minlength=len(c.sizes))
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            quiet = np.bincount(c.home, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(c.y)) + c.empty * np.log1p(-p0)
            none = np.exp(quiet)  # probability that no sentence offends
            # d loss / d quiet: for toxic documents w * none / (1 - none), for others -w.
            slope = np.where(c.y > 0, c.w * none / np.maximum(1 - none, 1e-9), -c.w)
            # d quiet / d logit = -p
            pull = -slope[c.home] * p
            grad[:n] += np.bincount(c.ids, pull[owner], minlength=n)
            grad[n] += pull.sum() - (slope * c.empty).sum() * p0
        grad[:n] += penalty * theta[:n]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return float(theta[-1]), theta[:n]


def _within(sample: DataFrame, size: int) -> DataFrame:
    """Whole documents of ``sample`` (text, y, w) of at most ``size`` bytes of each label; ``w`` makes up for the rest."""
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id", "text"), F.lit(PARTS)).cast("int")
    parted = sample.withColumn("part", part)
    sizes = parted.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b"))
    taken, used, rows, left = [], Counter(), Counter(), Counter()
    for r in sizes.orderBy("y", "part").collect():  # two labels of PARTS rows
        rows[r["y"]] += r["n"]
        if used[r["y"]] + r["b"] <= size:
            used[r["y"]] += r["b"]
            left[r["y"]] += r["n"]
            taken.append((r["y"], r["part"]))
    if rows == left:
        return sample.select("text", "y", "w")
    kept = sample.sparkSession.createDataFrame([(y, p, rows[y] / left[y]) for y, p in taken], "y int, part int, more double")
    return parted.join(F.broadcast(kept), ["y", "part"]).select("text", "y", (F.col("w") * F.col("more")).alias("w"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> Model:
    """Model from a bounded sample of ``labels`` and the texts of ``docs`` they belong to."""
    chosen = written(sample_labels(labels, label, doc_id), "sample-labels")
    # Bounded by SAMPLE rows of each label, so it is sent to the texts.
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("text"))
    sample = written(rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y", "w").distinct(), "sample")
    sample = _within(sample, SAMPLE_BYTES)
    have = {r["y"] for r in sample.select("y").distinct().collect()}
    if have != {0, 1}:
        return Model(0.0, {}, flat=0.5 if not have else float(have == {1}))
    vocabulary = _vocabulary(sample, VOCABULARY)
    bias, weights = train(_bags(sample, vocabulary), len(vocabulary))
    return Model(bias, {f: float(x) for f, x in zip(vocabulary, weights, strict=True) if abs(x) > 1e-6})


def score_udf(model: Model, spark):
    """score and spans of a whole text; spans are start:end of the sentences that offend."""
    shipped = spark.sparkContext.broadcast(model)

    @arrow_udf("score double, spans array<string>")
    def run(texts: pa.Array) -> pa.Array:
        m = shipped.value
        found = [m.score(t) for t in map(pa.StringScalar.as_py, texts)]
        spans = [[f"{a}:{b}" for a, b, _ in s] for _, s in found]
        return pa.StructArray.from_arrays(
            [pa.array([x for x, _ in found], pa.float64()), pa.array(spans, pa.list_(pa.string()))], names=["score", "spans"]
        )

    return run


def score_documents(
    docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, train, score and spans for every row of ``docs``; labels are learned from rows of ``training``."""
    model = fit(docs.filter(training), labels, label, doc_id, text)
    scored = score_udf(model, docs.sparkSession)(text_or_empty(text))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), training.alias("train"), scored.alias("s"))
    return rows.select("doc_id", "train", F.col("s.score").alias("score"), F.col("s.spans").alias("spans"))
