"""Words of many texts at once, as numbers of a vocabulary, by array arithmetic over their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(chars: bytes) -> np.ndarray:
    """Which of the 256 byte values are in ``chars``."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


@dataclass
class Words:
    """The words of some texts in their order."""

    vocab: pa.Array  # distinct words, A-Z lowered
    ids: np.ndarray  # number of each word in ``vocab``
    row: np.ndarray  # text it stands in
    first: np.ndarray  # whether it begins a piece of its text


def words_of(texts: pa.Array, word: np.ndarray, cut: np.ndarray | None = None) -> Words:
    """Runs of ``word`` bytes in each text; bytes of ``cut`` (never word bytes) divide texts into pieces."""
    texts = texts.cast(pa.large_string())
    buffers = texts.buffers()
    ends = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw = np.frombuffer(buffers[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = word[raw]
    edge = np.zeros(len(raw) + 1, bool)  # a text begins here
    edge[ends] = True
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(fresh)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    sizes = np.flatnonzero(last) + 1 - starts
    places = np.concatenate([[0], np.cumsum(sizes)])
    flat = pa.Array.from_buffers(
        pa.large_string(), len(sizes), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(LOWER[raw[inside]])]
    ).dictionary_encode()
    row = np.searchsorted(ends, starts, "right") - 1
    first = np.ones(len(starts), bool)
    first[1:] = row[1:] != row[:-1]
    if cut is not None and len(starts):
        piece = np.cumsum(cut[raw])[starts]
        first[1:] |= piece[1:] != piece[:-1]
    return Words(flat.dictionary.cast(pa.string()), flat.indices.to_numpy().astype(np.int64), row, first)


def slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(first, count) of runs of texts that hold about ``limit`` bytes; a longer text is a run of its own."""
    offsets = np.frombuffer(texts.cast(pa.large_string()).buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end - at
        at = end
