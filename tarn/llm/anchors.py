"""Anchors: content-determined places that equal strings of a given length share."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(41)
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = [np.uint64(int(x) | 1) for x in _rng.integers(1 << 62, 1 << 63, 16, dtype=np.uint64)]


def anchor_length(match: int) -> int:
    """Bytes of an anchor for matches of ``match`` bytes: the largest power of two up to a third of it."""
    return 1 << max(0, (match // 3).bit_length() - 1)


def anchor_hashes(data: np.ndarray, anchor: int) -> np.ndarray:
    """The hash of the ``anchor`` bytes from each place on, by doubling."""
    h, width, step = _BYTES[data], 1, 0
    while width < anchor:
        x = h[:-width] * _STEPS[step]
        x ^= x >> np.uint64(31)
        x += h[width:]
        h, width, step = x, 2 * width, step + 1
    h *= _STEPS[step]
    return h ^ (h >> np.uint64(29))


def sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = choose(values[:-reach], values[reach:])
        reach *= 2
    return choose(values[: len(values) - (width - reach)], values[width - reach :]) if width > reach else values


def segments(data: np.ndarray, starts: np.ndarray, match: int):
    """Runs of windows of ``match`` bytes with the same smallest anchor, in strings that stand one after the other.

    ``starts`` holds where each string starts, and the end of the last; all
    are ``match`` bytes long at least. Returns the anchors' hashes, first and
    last + 1 window of each run, the anchors' first places in it and whether
    they stand there more than once. Equal windows have equal smallest
    anchors, at the same distance.
    """
    anchor = anchor_length(match)
    h = anchor_hashes(data, anchor)
    reach = match - anchor + 1
    least = sliding(h, reach, np.minimum)
    step = np.zeros(len(data) + 1, np.int8)
    step[starts[:-1]] = 1
    step[starts[1:] - match + 1] -= 1
    inside = np.cumsum(step[: len(least)], dtype=np.int8) > 0  # windows that lie in one string
    same = (least[1:] == least[:-1]) & inside[1:] & inside[:-1]
    first = np.flatnonzero(inside & ~np.concatenate([[False], same]))
    last = np.flatnonzero(inside & ~np.concatenate([same, [False]])) + 1
    value = least[first]
    edge = np.zeros(reach - 1, np.uint64)
    covering = sliding(np.concatenate([edge, np.where(inside, least, np.uint64(0)), edge]), reach, np.maximum)
    at = np.flatnonzero(covering == h)  # anchors that are smallest in some window
    order = np.argsort(h[at], kind="stable")
    at = at[order]
    found = h[at]
    new = np.concatenate([[True], found[1:] != found[:-1]])
    group = np.cumsum(new) - 1
    own = np.searchsorted(found[new], value)
    k = np.searchsorted(group * len(data) + at, own * len(data) + first)
    after = np.minimum(k + 1, len(at) - 1)
    many = (after > k) & (group[after] == own) & (at[after] < last - 1 + reach)
    return value, first, last, at[k], many
