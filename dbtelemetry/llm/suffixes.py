"""Words of a chunk of texts as Arrow arrays, and suffix arrays over them.

Everything works on one chunk (a few megabytes of text) inside a task.
Texts are laid end to end, each closed by a symbol of its own, so that no
common prefix of two suffixes runs past the end of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_class(inside: str) -> np.ndarray:
    """256 flags from ranges such as ``"09az"``; bytes of non-ASCII letters always belong."""
    flags = np.zeros(256, bool)
    flags[128:] = True
    for a, b in zip(inside[::2], inside[1::2], strict=True):
        flags[ord(a):ord(b) + 1] = True
    return flags


#: All but ASCII white space; letters and digits (upper case is folded first).
PRINTED = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
ALPHANUMERIC = byte_class("09azAZ")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def split(texts: pa.Array, inside: np.ndarray, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words (runs of ``inside`` bytes) of all texts, in order, and each text's first word (one more entry at the end)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    raw = texts.buffers()
    at = np.frombuffer(raw[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], np.uint8)[at[0]:at[-1]] if raw[2] is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(texts) + 1, np.int64)
    kind = inside[data]
    before, after = np.empty_like(kind), np.empty_like(kind)
    before[0], before[1:] = False, kind[:-1]
    after[-1], after[:-1] = False, kind[1:]
    edges = at[(at > 0) & (at < len(data))]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(kind & ~before), np.flatnonzero(kind & ~after) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    kept = data[kind]
    if lower:
        kept = _LOWER[kept]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return words, np.searchsorted(starts, at).astype(np.int64)


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Every word's number, and the distinct words in the order of their numbers."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def closed(symbols: np.ndarray, bounds: np.ndarray, closers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts with a closing one after each text, and each text's first place (one more at the end)."""
    sizes = np.diff(bounds)
    first = np.append(0, np.cumsum(sizes + 1))
    out = np.empty(first[-1], np.int64)
    ends = first[1:] - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner], out[ends] = symbols[bounds[0]:bounds[-1]], closers
    return out, first


class Suffixes:
    """Suffix array by prefix doubling; every round sorts only suffixes that are still tied.

    ``order`` holds the sorted suffixes, ``place`` its inverse. With
    ``keep``, the ranks by the first 2**k symbols stay, for those suffixes
    that share them with another: they tell common prefixes of any two.
    """

    def __init__(self, symbols: np.ndarray, keep: bool = False):
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable").astype(np.int64)
        place = np.empty(n, np.int64)
        at, key = np.arange(n), symbols[order]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        step = 1
        while len(at):
            fresh = np.append(True, key[1:] != key[:-1])
            i = order[at]
            place[i] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
            tied = ~(fresh & np.append(fresh[1:], True))
            at, i = at[tied], i[tied]
            if not len(at):
                break
            if keep:
                self.levels.append((i.astype(np.int32), place[i].astype(np.int32)))
            # A tied suffix has ``step`` symbols without a closing one: i + step exists.
            key = place[i] * n + place[i + step]
            by = np.argsort(key)
            order[at], key = i[by], key[by]
            step *= 2
        self.order, self.place = order, place

    def _level(self, k: int) -> np.ndarray:
        full = np.full(self.n, -1, np.int32)
        full[self.levels[k][0]] = self.levels[k][1]
        return full

    def common_prefix(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of symbols that the suffixes x and y (x <> y) have in common at their start."""
        out = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            full = self._level(k)
            a = full[x + out]
            out += ((a >= 0) & (a == full[y + out])).astype(np.int64) << k
        return out

    def common_before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of symbols just before x and just before y (x < y) that are alike."""
        out = np.zeros(len(x), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            full = self._level(k)
            a, b = x - out - (1 << k), y - out - (1 << k)
            left = full[np.maximum(a, 0)]
            out += ((a >= 0) & (left >= 0) & (left == full[np.maximum(b, 0)])).astype(np.int64) << k
        return out


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For each entry above the least value the nearest earlier one that is smaller, by pointer jumps; the first has the least."""
    p = np.maximum(np.arange(-1, len(values) - 1), 0)
    active = np.flatnonzero((values > values[0]) & (values[p] >= values))
    while len(active):
        p[active] = p[p[active]]
        active = active[values[p[active]] >= values[active]]
    return p


def smaller_after(values: np.ndarray) -> np.ndarray:
    """As ``smaller_before``, towards the end; the last has the least."""
    return len(values) - 1 - smaller_before(values[::-1])[::-1]
