"""Digits of suffixes, in numpy: content anchors and the digests of byte ranges below them.

A suffix counts through its first ``length`` bytes, its window. Its anchor is the leftmost place of the
least 16-byte hash among its first ``REACH`` places, so equal windows have their anchors at the same
offset, and neighbouring suffixes mostly share one. Suffixes of one anchor form a run, a block that has
the bytes from the anchor on in common.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from rookery.llm.rows import mixed

GRAM = 16
REACH = 256
_PLACE = np.uint64(24)
_PLACES = np.uint64((1 << 24) - 1)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _LEFT
    x += b * _RIGHT
    x ^= x >> np.uint64(29)
    return x


@dataclass
class Hashes:
    """Hash of the 2**k bytes from each place on, for the sizes that digests are made of."""

    by_size: dict[int, np.ndarray]

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        """Hash of ``length`` bytes from each start on, ``length`` from 16 to 512."""
        size = min(1 << (length.bit_length() - 1), max(self.by_size))
        whole = self.by_size[size]
        return _joined(mixed(whole[start]), whole[start + (length - size)])


def hashes(raw: np.ndarray, most: int) -> Hashes:
    level, size = _BYTES[raw], 1
    kept = {}
    while size * 2 <= most and len(level) > size:
        level = _joined(level[:-size], level[size:])
        size *= 2
        if size >= GRAM:
            kept[size] = level
    return Hashes(kept)


def _anchors(grams: np.ndarray, reach: int) -> np.ndarray:
    """For each place, the leftmost place of the least hash among the ``reach`` places from it on."""
    least = (mixed(grams) & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
    return (least & _PLACES).astype(np.int64)


def reach_of(length: int) -> int:
    return min(REACH, (length - GRAM) // 2 + 1)


# Windows of one anchor are cut into ranges of so many offsets in the second pass.
RANGE = 16


@dataclass
class Ranges:
    """Blocks of neighbouring suffixes from ``start`` on, ``back`` bytes before their anchor.

    ``digits`` are the byte ranges that every suffix of the block holds, from the first one on, each by
    64 bits of digest; ``whole`` digests all bytes of the block's windows and where they lie around the
    anchor. A different digit means that no suffix is equal, equal digits and ``whole`` that the
    suffixes are pairwise equal. A block of one suffix has all of its window in its digits.
    """

    row: np.ndarray
    start: np.ndarray
    count: np.ndarray
    back: np.ndarray
    digits: list[np.ndarray]
    whole: np.ndarray


_NONE = np.empty(0, np.int64)
EMPTY = Ranges(_NONE, _NONE, _NONE, _NONE, [_NONE.view(np.uint64)] * 2, _NONE.view(np.uint64))


def _digits(h: Hashes, start: np.ndarray, length: int, n: int) -> list[np.ndarray]:
    """``length`` bytes from each start on as ``n`` digits of nearly equal width."""
    edges = [length * i // n for i in range(n + 1)]
    return [mixed(h.of(start + a, b - a)) for a, b in zip(edges, edges[1:])]


def _whole(h: Hashes, start: np.ndarray, count: np.ndarray, back: np.ndarray, length: int) -> np.ndarray:
    place = (back.astype(np.uint64) << np.uint64(32)) + count.astype(np.uint64)
    return mixed(_joined(h.of(start, length), h.of(start + count - 1, length)) + place)


def runs(raw: np.ndarray, at: np.ndarray, length: int) -> Ranges:
    """First pass: one row per run of suffixes with the same anchor, in the texts ``at`` cuts out."""
    sizes = np.diff(at)
    long_rows = np.flatnonzero(sizes >= length)
    if not len(long_rows):
        return EMPTY
    reach = reach_of(length)
    h = hashes(raw, length)
    anchor = _anchors(h.by_size[GRAM], reach)[: len(raw) - length + 1]
    # Window starts: all places of a text but its last length - 1.
    step = np.zeros(len(raw) + 2, np.int64)
    step[at[long_rows]] += 1
    np.add.at(step, at[long_rows + 1] - length + 1, -1)
    valid = np.cumsum(step)[: len(anchor)] > 0
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new &= valid
    new[at[long_rows]] = True
    start = np.flatnonzero(new)
    count = np.add.reduceat(valid.astype(np.int64), start)
    back = anchor[start] - start
    digits = _digits(h, anchor[start], length - reach + 1, 2)
    row = np.searchsorted(at, start, side="right") - 1
    return Ranges(row, start, count, back, digits, _whole(h, start, count, back, length))


def ranges(raw: np.ndarray, start: np.ndarray, count: np.ndarray, back: np.ndarray, length: int) -> Ranges:
    """Second pass: the given rows of one text, cut where the offset passes a multiple of ``RANGE``."""
    low = (back - count + 1) // RANGE
    pieces = back // RANGE - low + 1
    row = np.repeat(np.arange(len(start)), pieces)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    block = back[row] // RANGE - nth
    anchor = start[row] + back[row]
    high = np.minimum(back[row], block * RANGE + RANGE - 1)
    least = np.maximum(back[row] - count[row] + 1, block * RANGE)
    begin, n = anchor - high, high - least + 1
    h = hashes(raw, length)
    digits = _digits(h, anchor - block * RANGE, length - RANGE + 1, 2)
    digits[0] = mixed(digits[0] + block.astype(np.uint64))
    return Ranges(row, begin, n, high, digits, _whole(h, begin, n, high, length))


# Passes over the window of a single suffix.
DIGITS = 4


def suffixes(raw: np.ndarray, start: np.ndarray, count: np.ndarray, length: int) -> Ranges:
    """Third pass: every single suffix of the given rows of one text."""
    row = np.repeat(np.arange(len(start)), count)
    begin = start[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    one = np.ones(len(row), np.int64)
    digits = _digits(hashes(raw, length), begin, length, DIGITS)
    return Ranges(row, begin, one, 0 * one, digits, digits[-1])
