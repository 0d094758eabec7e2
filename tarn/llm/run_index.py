"""A run-length index: the Burrows-Wheeler transform as runs, with suffixes sampled at their ends.

If the suffixes at two neighbouring ranks are preceded by the same symbol,
the match of the one before is longer by one at the place before. So matches
with the neighbour above need to be compared at run heads only, and those with
the neighbour below at run tails; all others follow while the text is
streamed, each one less than the match at the place before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Symbols (of nine bits) that the first sort takes together.
FIRST = 7


def suffix_array(symbols: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order; every border is smaller than all symbols, and than borders after it."""
    n = len(symbols)
    padded = np.concatenate([np.where(border, 0, symbols.astype(np.int64) + 1), np.zeros(FIRST, np.int64)])
    key, ended = np.zeros(n, np.int64), np.zeros(n, bool)
    over = np.concatenate([border, np.zeros(FIRST, bool)])
    for k in range(FIRST):
        ended |= over[k : k + n]
        key = key << 9 | np.where(ended, 0, padded[k : k + n])
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], (key[order[1:]] != key[order[:-1]]) | ended[order[1:]]])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    open_ = ~(new & np.append(new[1:], True))
    places, width = order[open_], FIRST
    while len(places):
        key = rank[places] * n + rank[places + width]
        by = np.argsort(key, kind="stable")
        places, key = places[by], key[by]
        base = rank[places]
        index = np.arange(len(places))
        first = np.concatenate([[True], base[1:] != base[:-1]])
        slot = base + index - np.maximum.accumulate(np.where(first, index, 0))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[places] = slot[np.maximum.accumulate(np.where(new, index, 0))]
        places = places[~(new & np.append(new[1:], True))]
        width *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes


def common_lengths(words: np.ndarray, left: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols match from places i and j on, up to the next border. words: eight bytes from each place on."""
    most = np.minimum(left[i], left[j])
    length = np.zeros(len(i), np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        x = words[i[active] + length[active]] ^ words[j[active] + length[active]]
        low = x & (~x + np.uint64(1))
        same = np.where(x == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) // 8)
        length[active] = np.minimum(length[active] + same, most[active])
        active = active[(x == 0) & (length[active] < most[active])]
    return length


@dataclass
class RunIndex:
    symbols: np.ndarray  # of each run of the transform
    lengths: np.ndarray
    heads: np.ndarray  # sampled suffixes: places at run heads, in text order
    above: np.ndarray  # and how far they match the suffix above
    tails: np.ndarray
    below: np.ndarray
    size: int


def build(parts: list[bytes]) -> tuple[RunIndex, np.ndarray]:
    """The index of some byte strings, and how many bytes each place has to its string's end."""
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    border = np.zeros(len(text), bool)
    border[ends] = True
    left = np.repeat(ends, [len(p) + 1 for p in parts]) - np.arange(len(text))
    suffixes = suffix_array(text, border)
    before = np.where(border[suffixes - 1], -1, text[suffixes - 1].astype(np.int64))
    change = (before[1:] != before[:-1]) | (before[1:] < 0)  # strings start apart
    head, tail = np.append(True, change), np.append(change, True)
    packed = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(packed, 8)[: len(text)].copy().view("<u8").ravel()
    at = np.flatnonzero(head)
    up, down = suffixes[at[1:] - 1], suffixes[at[1:]]
    match = common_lengths(words, left, up, down)  # the border between two runs: a tail and a head
    by_head, by_tail = np.argsort(suffixes[at]), np.argsort(suffixes[tail])
    index = RunIndex(before[at], np.diff(np.append(at, len(text))), suffixes[at][by_head], np.append(0, match)[by_head], suffixes[tail][by_tail], np.append(match, 0)[by_tail], len(text))
    return index, left


def statistics(index: RunIndex) -> np.ndarray:
    """For each place how long the match with any other place is, streamed from the samples."""
    place = np.arange(index.size)
    longest = np.zeros(index.size, np.int64)
    for samples, match in ((index.heads, index.above), (index.tails, index.below)):
        last = np.searchsorted(samples, place, "right") - 1
        longest = np.maximum(longest, match[last] - (place - samples[last]))
    return longest


def repeated_spans(parts: list[bytes], match: int) -> list[list[tuple[int, int]]]:
    """For each string the maximal spans covered by ``match`` bytes that also start elsewhere in the strings."""
    index, left = build(parts)
    starts = np.flatnonzero((statistics(index) >= match) & (left >= match))
    spans: list[list[tuple[int, int]]] = [[] for _ in parts]
    if len(starts):
        first = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        owner = np.searchsorted(first, starts, "right") - 1
        cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] > starts[:-1] + match)]))
        for i, j in zip(cut, np.append(cut[1:], len(starts))):  # noqa: B905
            o = owner[i]
            spans[o].append((int(starts[i] - first[o]), int(starts[j - 1] - first[o]) + match))
    return spans
