"""Minimal perfect hashes over byte strings, with the strings stored for verification.

Levels of bit fields: a key whose place in a level's field no other key shares takes that place; the others
go on to the next level, with another hash. The number of set bits before a key's place, over all levels, is its
slot, so n keys have the slots 0 .. n - 1. Keys that no level parts (equal 64-bit hashes) are listed after the last.
Look-ups of keys that are not stored are told apart by comparing the stored string of the slot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from buyerlens.llm.bpe_words import gathered

LEVELS = 24
SPREAD = 1.7  # bits of a level for each key that is left


def key_hashes(keys: pa.Array) -> np.ndarray:
    """XXH3 of each string."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, keys.cast(pa.binary()).to_pylist()), np.uint64, len(keys))


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """Another even spread of the hashes over ``size`` places for each level."""
    x = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, and where each string starts and how long it is."""
    strings = strings.cast(pa.large_binary())
    ends = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, strings.offset * 8)
    return np.frombuffer(strings.buffers()[2] or b"", np.uint8), ends[:-1], np.diff(ends)


class PerfectHash:
    def __init__(self, sizes: list[int], bits: bytes, keys: pa.Array):
        self.sizes, self.bits, self.keys = sizes, bits, keys
        fields = np.unpackbits(np.frombuffer(bits, np.uint8), count=sum(sizes), bitorder="little")
        ends = np.cumsum(sizes)
        self.fields = [fields[e - s : e].astype(bool) for s, e in zip(sizes, ends, strict=True)]
        ranks = np.cumsum(fields, dtype=np.uint32)
        self.ranks = [ranks[e - s : e] for s, e in zip(sizes, ends, strict=True)]
        self.placed = int(ranks[-1]) if len(ranks) else 0
        self.listed = {k: self.placed + i for i, k in enumerate(keys.slice(self.placed).cast(pa.binary()).to_pylist())}
        self.stored = _bytes_of(keys)

    @classmethod
    def build(cls, keys: pa.Array) -> PerfectHash:
        """Of distinct strings."""
        hashes = key_hashes(keys)
        left = np.arange(len(keys))
        sizes, fields, order = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, int(len(left) * SPREAD))
            at = _places(hashes[left], level, size)
            alone = np.bincount(at, minlength=size) == 1
            here = alone[at]
            order.append(left[here][np.argsort(at[here])])
            left = left[~here]
            sizes.append(size)
            fields.append(alone)
        bits = np.packbits(np.concatenate(fields), bitorder="little").tobytes() if fields else b""
        order = np.concatenate([*order, left]) if order else left
        return cls(sizes, bits, keys.take(pa.array(order)))

    def slots(self, strings: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The slot of each string, -1 for those not stored."""
        found = np.full(len(strings), -1, np.int64)
        left = np.arange(len(strings))
        for level, size in enumerate(self.sizes):
            at = _places(hashes[left], level, size)
            here = self.fields[level][at]
            found[left[here]] = self.ranks[level][at[here]].astype(np.int64) - 1
            left = left[~here]
        data, starts, sizes = _bytes_of(strings)
        kept, kept_starts, kept_sizes = self.stored
        try_ = np.flatnonzero(found >= 0)
        same = sizes[try_] == kept_sizes[found[try_]]
        found[try_[~same]] = -1
        try_ = try_[same]
        lengths = sizes[try_]
        differ = gathered(data, starts[try_], lengths) != gathered(kept, kept_starts[found[try_]], lengths)
        found[np.repeat(try_, lengths)[differ]] = -1
        if self.listed:
            for i in np.flatnonzero(found < 0):
                found[i] = self.listed.get(strings[int(i)].as_py().encode(), -1)
        return found
