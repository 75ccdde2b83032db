"""Anchors of byte strings: places that equal windows choose alike."""

from __future__ import annotations

import numpy as np

GRAM = 32  # bytes of the strings that are hashed
_PLACE_BITS = 20  # low bits of a hash that are replaced by the place
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each place, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    h *= np.uint64(_MULTIPLIERS[0])
    width = 1
    for m in _MULTIPLIERS:
        left, right = h[:-width], h[width:]
        h = left * np.uint64(m)
        h += right
        h ^= h >> np.uint64(31)
        width *= 2
    return h


def _window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest value of each ``size`` neighbours, by doubling."""
    width, found = 1, values
    while 2 * width <= size:
        found = np.minimum(found[:-width], found[width:])
        width *= 2
    rest = size - width
    return np.minimum(found[: len(found) - rest], found[rest:]) if rest else found


def anchors(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of window starts with one anchor: first start, length, anchor, hash.

    ``data`` holds several texts that begin at ``offsets``; no window crosses from one
    into the next. The anchor of a window is the leftmost place with the smallest
    hash among those whose GRAM bytes lie inside it, so it depends on the window's
    bytes alone and equal windows have it at the same distance. Texts shorter than
    ``window`` have no runs.
    """
    span = window - GRAM + 1
    runs = []
    step = (1 << _PLACE_BITS) - span  # places are counted within a step, so they fit the low bits
    ends = offsets[1:]
    for start in range(0, max(0, len(data) - window + 1), step):
        part = data[start : start + step + window - 1]
        hashes = gram_hashes(part)
        place = np.arange(len(hashes), dtype=np.uint64)
        mixed = (hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place
        chosen = (_window_min(mixed, span) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        for end in ends[(ends > start) & (ends < start + len(chosen) + window - 1)].tolist():
            chosen[max(0, end - start - window + 1) : max(0, end - start)] = -1
        first = np.flatnonzero(np.diff(chosen, prepend=-2))
        length = np.diff(first, append=len(chosen))
        inside = chosen[first] >= 0
        first, length = first[inside], length[inside]
        runs.append((first + start, length, chosen[first] + start, hashes[chosen[first]]))
    if not runs:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*runs))
