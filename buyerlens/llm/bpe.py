"""Byte-level BPE by a deterministic automaton over tokens, with arcs that carry token labels.

The automaton begins as one state with a loop for each byte. For each merge (u, v) -> w in order, a
gadget is added: states with an arc u get an arc w, whose target is the target of v, and the target of u
is replaced by a copy without the arc v. Afterwards a path from the start state spells a token sequence
if and only if BPE would produce it, and each text has exactly one path. (Berglund, Martens and van der
Merwe, "Constructing a BPE tokenization DFA", 2024.)

All arcs with one label lead to one state, so a state is named by its label, and a copy stores only the arc it
lost. The gadgets compile to three tables: the bytes that labels spell (a trie), the arcs that copies lost, and of
which labels each label was made. Whether a state has an arc is read from the last two: the copies of the state
are met down the right parts of its label, the gadgets that made the arc down the left parts of the arc's label.

Pre-split words are encoded many at once: step by step through their bytes, all words that an arc has brought
to this place read the labels that begin here from the trie and keep those whose arc their state has. Since each
beginning of a word has one path, a place has one state, and the path is read back from the end. Decoding
emits the labels.

Null texts are empty texts and give no ids. Other columns pass through untouched, whatever their names;
``out`` names the new column and replaces one that has that name. Very long texts are encoded whole; a worker
holds the distinct words of a few megabytes of text, or of one text if that is longer.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from buyerlens.llm.bpe_words import encode_texts, gathered
from buyerlens.llm.common import text_or_empty
from buyerlens.llm.number_table import Table

NEVER = 1 << 30
LONG = 256  # bytes; longer words are walked one by one
TEXTS = 2048  # texts decoded at a time


def byte_letters() -> dict[str, int]:
    """The printable letters by which vocabulary files write bytes."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + k): b for k, b in enumerate(other)}


class Automaton:
    """Tokenization automaton of a merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]):
        letters = byte_letters()
        self.special = special
        self.labels: dict[int, bytes] = {
            i: bytes(letters[c] for c in s) for s, i in vocab.items() if i not in special.values()
        }
        self.labels |= {i: s.encode() for s, i in special.items()}
        size = max(self.labels) + 1
        self.made = [0] * size  # when the label's gadget was added; 0 for bytes
        self.left = [-1] * size
        self.right = [-1] * size
        self.lost: dict[int, int] = {}  # state and label -> when the state's copy lost the arc
        self.next: dict[int, int] = {}  # trie: node and byte -> node
        self.token: list[int] = [-1]  # trie node -> label
        for i, label in self.labels.items():
            if len(label) == 1:
                self._spell(i)
        for when, (u, v) in enumerate(merges, 1):
            self._gadget(vocab[u], vocab[v], vocab[u + v], when)
        # The compiled tables.
        self.arc_lost, self.trie = Table.of(self.lost), Table.of(self.next)
        self.tokens = np.array(self.token)
        self.made_at, self.left_part, self.right_part = np.array(self.made), np.array(self.left), np.array(self.right)
        self.sizes = np.array([len(self.labels.get(i, b"")) for i in range(size)])

    def _gadget(self, u: int, v: int, w: int, when: int) -> None:
        if not self.arc(u, v):
            return  # no path has u before v, so the merge changes nothing
        self.left[w], self.right[w], self.made[w] = u, v, when
        self.lost[u << 20 | v] = when
        self._spell(w)

    def _spell(self, label: int) -> None:
        node = 0
        for b in self.labels[label]:
            key = node << 8 | b
            if key not in self.next:
                self.next[key] = len(self.token)
                self.token.append(-1)
            node = self.next[key]
        self.token[node] = label

    def arc(self, state: int, label: int) -> bool:
        """Whether the target of label ``state`` has an arc ``label``."""
        x, before = state, NEVER
        while x >= 0:
            y, until = label, NEVER
            while y >= 0:
                gone = self.lost.get(x << 20 | y)
                # Lost before this copy was taken, and before the next longer arc was made from it.
                if gone is not None and gone < before and gone <= until:
                    return False
                until = self.made[y]
                y = self.left[y]
            before = self.made[x]
            x = self.right[x]
        return True

    def arcs(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """``arc`` of many pairs."""
        ok = np.ones(len(states), bool)
        at, x, before = np.arange(len(states)), states, np.full(len(states), NEVER)
        while len(at):
            inner, y, until = np.arange(len(at)), labels[at], np.full(len(at), NEVER)
            while len(inner):
                gone = self.arc_lost.get(x[inner] << 20 | y)
                no = (gone >= 0) & (gone < before[inner]) & (gone <= until)
                ok[at[inner[no]]] = False
                until, y = self.made_at[y], self.left_part[y]
                on = ~no & (y >= 0)
                inner, y, until = inner[on], y[on], until[on]
            before, x = self.made_at[x], self.right_part[x]
            on = ok[at] & (x >= 0)
            at, x, before = at[on], x[on], before[on]
        return ok

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Labels of the paths that spell the words, in a row, and how many each has."""
        words = words.cast(pa.large_binary())
        offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        starts, sizes = offsets[:-1], np.diff(offsets)
        long = np.flatnonzero(sizes > LONG)
        alone = {int(i): self.word(data[starts[i] : starts[i] + sizes[i]].tobytes()) for i in long}
        short = np.where(sizes > LONG, 0, sizes)
        base = np.cumsum(short + 1) - short - 1  # where the word's places begin
        state = np.full(int((short + 1).sum()), -1)
        active = np.flatnonzero(short > 0)
        for p in range(int(short.max(initial=0))):
            active = active[short[active] > p]
            here = active if p == 0 else active[state[base[active] + p] >= 0]
            node, k = np.zeros(len(here), np.int64), p
            who, what, end = [], [], []
            while len(here):
                node = self.trie.get(node << 8 | data[starts[here] + k])
                k += 1
                label = np.where(node >= 0, self.tokens[node], -1)
                found = label >= 0
                who.append(here[found])
                what.append(label[found])
                end.append(base[here[found]] + k)
                on = (node >= 0) & (short[here] > k)
                here, node = here[on], node[on]
            if who:
                w, label, place = np.concatenate(who), np.concatenate(what), np.concatenate(end)
                if p:
                    ok = self.arcs(state[base[w] + p], label)
                    label, place = label[ok], place[ok]
                state[place] = label
        counts = np.zeros(len(words), np.int64)
        steps = []
        place, w = base + short, np.flatnonzero(short > 0)
        while len(w):
            label = state[place[w]]
            steps.append((w, label))
            counts[w] += 1
            place[w] -= self.sizes[label]
            w = w[place[w] > base[w]]
        counts[long] = [len(alone[int(i)]) for i in long]
        ends = np.cumsum(counts)
        ids = np.empty(int(counts.sum()), np.int32)
        for back, (w, label) in enumerate(steps, 1):
            ids[ends[w] - back] = label
        for i, path in alone.items():
            ids[ends[i] - len(path) : ends[i]] = path
        return ids, counts

    def word(self, word: bytes) -> list[int]:
        """Labels of the path that spells one word.

        The longest arc is tried first. A path that reaches a position is the only one that does, so a
        position from which no arc leads on is never tried again, and time is linear in the word.
        """
        n = len(word)
        step, token = self.next.get, self.token
        out: list[int] = []
        ends = [0]
        dead: set[int] = set()
        while ends[-1] < n:
            at = ends[-1]
            node, found = 0, []
            for i in range(at, n):
                node = step(node << 8 | word[i])
                if node is None:
                    break
                if token[node] >= 0:
                    found.append((token[node], i + 1))
            for label, end in reversed(found):
                if end not in dead and (not out or self.arc(out[-1], label)):
                    out.append(label)
                    ends.append(end)
                    break
            else:
                dead.add(at)
                ends.pop()
                out.pop()
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


class Codec:
    """Pre-splitting around the automaton."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"] | special, merges, special)
        self.letters = byte_letters()
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.strings = tuple(special)
        size = max(self.automaton.labels) + 1
        labels = [self.automaton.labels.get(i, b"") for i in range(size)]
        self.label_bytes = np.frombuffer(b"".join(labels), np.uint8)
        self.label_sizes = np.array([len(x) for x in labels])
        self.label_starts = np.cumsum(self.label_sizes) - self.label_sizes

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts that the library splits into words."""
        words, parts = [], []  # parts: (text, number of words or the special label below 0)
        for t, text in enumerate(texts):
            for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
                if k % 2:
                    parts.append((t, ~self.automaton.special[part]))
                elif part:
                    split = self.splitter.pre_tokenize_str(part)
                    words += [bytes(map(self.letters.__getitem__, w)) for w, _ in split]
                    parts.append((t, len(split)))
        known = pa.array(words, pa.large_binary()).dictionary_encode()
        ids, sizes = self.automaton.words(known.dictionary)
        which = known.indices.to_numpy()
        flat = gathered(ids, (np.cumsum(sizes) - sizes)[which], sizes[which])
        ends = np.concatenate([[0], np.cumsum(sizes[which])])
        out: list[list[np.ndarray]] = [[np.empty(0, np.int32)] for _ in texts]
        at = 0
        for t, n in parts:
            out[t].append(np.array([~n], np.int32) if n < 0 else flat[ends[at] : ends[at + n]])
            at += max(n, 0)
        return [np.concatenate(x) for x in out]

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text."""
        flat, sizes = encode_texts(texts, self.automaton.words, self._whole, self.strings)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))

    def decode(self, rows: pa.Array) -> pa.Array:
        """Labels of each row's ids, as text; broken characters are replaced."""
        out: list[str | None] = []
        for i in range(0, len(rows), TEXTS):
            part = rows.slice(i, TEXTS)
            ids = part.flatten().to_numpy(zero_copy_only=False)
            sizes = self.label_sizes[ids]
            raw = gathered(self.label_bytes, self.label_starts[ids], sizes).tobytes()
            counts = np.nan_to_num(pc.list_value_length(part).to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)].tolist()
            none = part.is_null().to_pylist()
            out += [None if x else raw[a:b].decode("utf-8", "replace") for x, a, b in zip(none, [0, *ends], ends, strict=False)]
        return pa.array(out, pa.string())


@lru_cache(maxsize=2)
def codec(name: str) -> Codec:
    return Codec(public_tokenizers.path(name))


def encode_udf(tokenizer: str):
    @arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return codec(tokenizer).encode(texts)

    return encode


def decode_udf(tokenizer: str):
    @arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        return codec(tokenizer).decode(ids)

    return decode


def with_ids(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each whole text."""
    return docs.withColumn(out, encode_udf(tokenizer)(text_or_empty(text)))


def with_text(rows: DataFrame, tokenizer: str = "byte_bpe_50k.json", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text that their ids spell; null ids give null."""
    return rows.withColumn(out, decode_udf(tokenizer)(F.col(ids)))
