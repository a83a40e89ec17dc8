"""Splitting texts into the words that byte-level BPE encodes independently, many texts at once.

The splitting pattern of byte-level vocabularies makes words of letters, of digits and of other signs, each with a
space before it, and of white space. In texts of characters whose class is beyond doubt (``SURE``) words are
found by array arithmetic over the bytes; their distinct words are encoded once for each few megabytes of text,
and nothing is kept from one call to the next. Any other text, and one that holds a special string, takes the
caller's way for whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 8 << 20  # bytes of text worked on at a time
#: Characters whose class is the same in all Unicode versions.
SURE = r"\A[\n -~À-ÖØ-öø-ſ]*\z"
WHITE, LETTER, DIGIT, OTHER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[[10, 32]] = WHITE
KIND[48:58] = DIGIT
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[start : start + length] in a row."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return values[:0]
    return values[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]


def word_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Whether a word begins at each byte of some texts, which begin at ``begins``."""
    n = len(data)
    kind = KIND[data]
    fresh = np.ones(n, bool)
    fresh[1:] = kind[1:] != kind[:-1]
    edge = np.zeros(n + 1, bool)
    edge[begins] = edge[n] = True
    fresh |= edge[:n]
    starts = fresh.copy()
    runs = np.flatnonzero(fresh)
    ends = np.append(runs[1:], n)
    inner = ~edge[ends]  # runs that do not end their text
    # Before a word, white space leaves its last character: a space joins the word, a line end stands alone.
    last = ends[(kind[runs] == WHITE) & inner] - 1
    starts[last] = True
    starts[last[data[last] == 32] + 1] = False
    # A lone apostrophe without a space takes the letters of a contraction.
    lone = runs[inner & (ends - runs == 1) & (data[runs] == 39)]
    lone = lone[starts[lone] & (kind[lone + 1] == LETTER)]
    a = data[lone + 1]
    far = np.minimum(lone + 2, n - 1)
    b = np.where((lone + 2 < n) & ~fresh[far], data[far], 0)
    size = np.where(np.isin(a, list(b"stmd")), 1, 0)
    for pair in (b"re", b"ve", b"ll"):
        size[(a == pair[0]) & (b == pair[1])] = 2
    lone, size = lone[size > 0], size[size > 0]
    starts[lone + 1] = False
    after = lone + 1 + size
    after = after[after < n]
    starts[after[~fresh[after]]] = True
    return starts


def encode_texts(
    texts: pa.Array,
    distinct: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]] | None,
    whole: Callable[[list[str]], list[np.ndarray]],
    special: tuple[str, ...] = (),
    limit: int = SLICE,
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and how many each has.

    ``distinct`` gives the ids of many words in a row and how many each has; without it all texts go to ``whole``.
    Words are told apart within ``limit`` bytes of text.
    """
    flats, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        part = texts.slice(at, end - at)
        at = end
        odd = pc.invert(pc.match_substring_regex(part, SURE))
        for s in special:
            odd = pc.or_(odd, pc.match_substring(part, s))
        odd = odd.to_numpy(zero_copy_only=False) if distinct else np.ones(len(part), bool)
        flat, sizes = _plain(part if not odd.any() else part.filter(pa.array(~odd)), distinct)
        if odd.any():
            rest = whole(part.filter(pa.array(odd)).to_pylist())
            each = np.zeros(len(part), np.int64)
            each[~odd], each[odd] = sizes, list(map(len, rest))
            merged = np.empty(each.sum(), np.int32)
            mine = np.repeat(odd, each)
            merged[~mine] = flat
            merged[mine] = np.concatenate(rest)
            flat, sizes = merged, each
        flats.append(flat)
        counts.append(sizes)
    return np.concatenate(flats), np.concatenate(counts)


def _plain(texts: pa.Array, distinct) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts whose words the arrays find."""
    if not len(texts):
        return np.empty(0, np.int32), np.empty(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    starts = np.flatnonzero(word_starts(data, offsets[:-1][np.diff(offsets) > 0])) if len(data) else np.empty(0, np.int64)
    bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)]).dictionary_encode()
    ids, sizes = distinct(words.dictionary)
    which = words.indices.to_numpy()
    each = sizes[which]
    flat = gathered(ids, (np.cumsum(sizes) - sizes)[which], each)
    ends = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(starts, offsets)]
    return flat, np.diff(ends)
