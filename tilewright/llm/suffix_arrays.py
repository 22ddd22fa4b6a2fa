"""Suffix arrays of many short shards at once, by induced sorting, and their common prefixes.

The shards of a batch stand side by side as the columns of one matrix. Every scan of the
induced sorting takes the same step in all shards together, so that numpy works on whole rows
while each shard's own sort stays the linear algorithm: classify the suffixes, sort the
leftmost smaller substrings (recursively, where their names repeat), and induce the array
from them, first the larger suffixes from the left, then the smaller ones from the right.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next one, and which are leftmost of such a run."""
    n, lanes = text.shape
    row = np.arange(n)[:, None]
    differs = np.full((n, lanes), n, np.int32)
    differs[:-1] = np.where(text[:-1] != text[1:], row[:-1], n)
    nearest = np.minimum.accumulate(differs[::-1], axis=0)[::-1]
    inside = row < length[None]
    at = np.minimum(nearest, n - 2) if n > 1 else np.zeros_like(nearest)
    small = np.zeros((n, lanes), bool)
    if n > 1:
        small = np.take_along_axis(text, at, 0) < np.take_along_axis(text, at + 1, 0)
    small[row == length[None] - 1] = True
    small &= inside
    left = small.copy()
    left[0] = False
    left[1:] &= ~small[:-1]
    return small, left


def _induce(text, length, small, order, lane_of, ends, starts):
    """The array (positions by rank) from the leftmost smaller suffixes in the given order, lane after lane."""
    n, lanes = text.shape
    array = np.full((n, lanes), n, np.int32)  # n: empty
    char = text[order, lane_of]
    # the given suffixes fill their buckets' ends, in their order
    key = lane_of.astype(np.int64) * (ends.shape[0] + 1) + char
    by = np.argsort(key, kind="stable")
    sorted_key = key[by]
    group_end = np.searchsorted(sorted_key, sorted_key, side="right")
    array[ends[char[by], lane_of[by]] - (group_end - np.arange(len(by))), lane_of[by]] = order[by]
    before = np.full((2, n + 1, lanes), -1, np.int32)
    before[0, 1:n] = np.where(small[: n - 1], -1, text[: n - 1])
    before[1, 1:n] = np.where(small[: n - 1], text[: n - 1], -1)
    before[0, 1:n][(np.arange(1, n)[:, None] >= length[None])] = -1
    before[1, 1:n][(np.arange(1, n)[:, None] >= length[None])] = -1
    flat, column = array.reshape(-1), np.arange(lanes)
    for kind, bucket, steps, move in ((0, starts.copy(), range(n), 1), (1, ends.copy(), range(n - 1, -1, -1), -1)):
        previous, place = before[kind].reshape(-1), bucket.reshape(-1)
        for i in steps:
            s = array[i]
            c = previous[s * lanes + column]
            some = np.flatnonzero(c >= 0)
            if not len(some):
                continue
            slot = c[some] * lanes + some
            to = place[slot]
            if kind:
                to = to - 1
                place[slot] = to
            else:
                place[slot] = to + 1
            flat[to * lanes + some] = s[some] - 1
    return array


def suffix_arrays(text: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Column-wise arrays of text (rows: positions), whose shards end in their only 0 at length - 1.

    Rows of the result beyond a shard's length hold the number of rows.
    """
    text = text.astype(np.int32)
    n, lanes = text.shape
    length = length.astype(np.int32)
    small, left = _types(text, length)
    inside = np.arange(n)[:, None] < length[None]
    size = int(text.max(initial=0)) + 1
    counts = np.zeros((size, lanes), np.int32)
    row, lane = np.nonzero(inside)
    np.add.at(counts, (text[row, lane], lane), 1)
    ends = np.cumsum(counts, axis=0, dtype=np.int32)
    starts = ends - counts

    lane_of, order = np.nonzero(left.T)  # lane after lane, by position
    array = _induce(text, length, small, order, lane_of, ends, starts)
    # name the leftmost smaller substrings in their sorted order
    marked = np.zeros((n + 1, lanes), bool)
    marked[:n] = left
    is_left = marked[array, np.arange(lanes)[None]]
    lane_sorted, rank = np.nonzero(is_left.T)
    position = array[rank, lane_sorted]
    following = np.full((n + 1, lanes), n, np.int32)
    following[:n] = np.where(left, np.arange(n)[:, None], n)
    following = np.minimum.accumulate(following[::-1], axis=0)[::-1]  # at or after
    span = np.where(following[np.minimum(position + 1, n), lane_sorted] == n, 0, following[np.minimum(position + 1, n), lane_sorted] - position)
    new = np.ones(len(position), bool)
    same = np.flatnonzero((lane_sorted[1:] == lane_sorted[:-1]) & (span[1:] == span[:-1]) & (span[1:] > 0)) + 1
    depth = 0
    active = same
    while len(active):
        a, b, w = position[active], position[active - 1], lane_sorted[active]
        equal = text[a + depth, w] == text[b + depth, w]
        done = equal & (span[active] == depth)
        new[active[done]] = False
        active = active[equal & ~done]
        depth += 1
    first = np.ones(len(position), bool)
    first[1:] = lane_sorted[1:] != lane_sorted[:-1]
    name = np.cumsum(new) - 1
    name = name - np.maximum.accumulate(np.where(first, name, 0))
    per_lane = np.bincount(lane_of, minlength=lanes)
    begin = np.cumsum(per_lane) - per_lane
    distinct = np.zeros(lanes, np.int64)
    np.maximum.at(distinct, lane_sorted, name + 1)
    repeats = distinct < per_lane
    if not repeats.any():
        return _induce(text, length, small, position, lane_sorted, ends, starts)
    # shards with repeated names: sort the strings of names
    names = np.zeros((n, lanes), np.int32)
    names[position, lane_sorted] = name
    which = np.flatnonzero(repeats)
    reduced = np.zeros((int(per_lane[which].max()), len(which)), np.int32)
    index = np.full(lanes, -1)
    index[which] = np.arange(len(which))
    nth = np.arange(len(order)) - begin[lane_of]
    chosen = repeats[lane_of]
    reduced[nth[chosen], index[lane_of[chosen]]] = names[order[chosen], lane_of[chosen]]
    below = suffix_arrays(reduced, per_lane[which])
    sorted_positions = position.copy()
    again = repeats[lane_sorted]
    w = lane_sorted[again]
    nth_sorted = (np.arange(len(position)) - begin[lane_sorted])[again]
    sorted_positions[again] = order[begin[w] + below[nth_sorted, index[w]]]
    return _induce(text, length, small, sorted_positions, lane_sorted, ends, starts)


def common_prefixes(text: np.ndarray, length: np.ndarray, array: np.ndarray) -> np.ndarray:
    """By text position: the common prefix of each suffix with the one before it in the array.

    A position whose left neighbours agree inherits its predecessor's value less one; only the
    others (the irreducible ones) are compared, four symbols (below 2**16) at a time.
    """
    n, lanes = text.shape
    column = np.arange(lanes)[None]
    inside = np.arange(n)[:, None] < length[None]
    before = np.full((n + 1, lanes), -1, np.int64)
    before[array[1:], column] = np.where(inside[1:], array[:-1], -1)
    before = before[:n]
    has = (before >= 0) & inside
    width = n + 4
    raw = np.zeros((lanes, width + 4), np.uint64)
    raw[:, :n] = text.T
    words = np.zeros((lanes, width), np.uint64)
    for j in range(4):
        words |= raw[:, j : j + width] << np.uint64(16 * j)
    words = words.reshape(-1)
    previous_symbol = np.full((n, lanes), -1, np.int32)
    previous_symbol[1:] = text[:-1]
    of_before = np.where(before > 0, np.take_along_axis(text, np.maximum(before - 1, 0), 0), -2)
    irreducible = has & (previous_symbol != of_before)
    row, lane = np.nonzero(irreducible)
    other = before[row, lane]
    value = np.zeros(len(row), np.int64)
    active = np.arange(len(row))
    while len(active):
        a = np.minimum(row[active] + value[active], n) + lane[active] * width
        b = np.minimum(other[active] + value[active], n) + lane[active] * width
        x = words[a] ^ words[b]
        low = x & (~x + np.uint64(1))
        step = np.where(x == 0, 4, np.bitwise_count(low - np.uint64(1)) // 16)
        value[active] += step
        active = active[x == 0]
    out = np.zeros((n, lanes), np.int64)
    at = np.where(irreducible, np.arange(n)[:, None], -1)
    at = np.maximum.accumulate(at, axis=0)
    found = np.zeros((n, lanes), np.int64)
    found[row, lane] = value
    base = np.take_along_axis(found, np.maximum(at, 0), 0)
    out = np.where(has & (at >= 0), base - (np.arange(n)[:, None] - at), 0)
    return np.maximum(out, 0)
