"""Suffix arrays by two-stage sorting, for texts of bounded size.

Suffixes smaller than their successor are sorted directly; every other suffix follows from its
successor, as a scan over the buckets (suffixes with the same first byte) in rising order meets the
successors in sorted order. Comparison stops after DEPTH bytes, which is all that repeats of that
length need: suffixes with a longer common prefix are neighbours in any order.
"""

from __future__ import annotations

import numpy as np

DEPTH = 100
PAD = 112


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number, so that numbers sort like bytes."""
    return np.ndarray(shape=(len(data) - 7,), dtype=">u8", buffer=data.data, strides=(1,))


def direct_sort(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``places`` in the order of the DEPTH bytes from each on; ties are refined eight bytes at a time."""
    order = places[np.argsort(words[places].astype(np.uint64), kind="stable")]
    at = np.arange(len(order))
    group = np.zeros(len(order), dtype=np.int64)
    for step in range(0, DEPTH, 8):
        if not len(at):
            break
        value = words[order[at] + step].astype(np.uint64)
        if step:
            sort = np.lexsort((value, group))
            order[at] = order[at][sort]
            value, group = value[sort], group[sort]
        new = np.concatenate(([True], (value[1:] != value[:-1]) | (group[1:] != group[:-1])))
        group = np.cumsum(new)
        size = np.bincount(group)
        tied = size[group] > 1
        at, group = at[tied], group[tied]
    return order


def suffix_order(data: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in ``wanted`` (a mask) in the order of the DEPTH bytes from each on.

    ``data`` holds bytes above 0, ends each text with a 0 and is padded with PAD zeros. Beyond the
    wanted places those up to the next directly sorted one are carried along, as induction needs them.
    """
    n = len(data) - PAD
    this, following = data[:n], data[1 : n + 1]
    # Smaller than its successor: the next different byte is larger. Runs take the type of their end.
    differs = np.flatnonzero(this != following)
    if not len(differs):
        return np.flatnonzero(wanted[:n])
    end = differs[np.minimum(np.searchsorted(differs, np.arange(n)), len(differs) - 1)]
    small = data[end] < data[end + 1]
    small |= this == 0
    # A large place belongs to the set if it is wanted, or carries a wanted one: then all from the
    # wanted place on up to the next small one are needed.
    starts = np.flatnonzero(small)
    run = np.searchsorted(starts, np.arange(n))
    first_wanted = np.full(len(starts) + 1, n, dtype=np.int64)
    hits = np.flatnonzero(wanted[:n])
    np.minimum.at(first_wanted, run[hits], hits)
    needed = np.arange(n) >= first_wanted[run]
    words = words_at(data)
    direct = direct_sort(words, np.flatnonzero(needed & small))
    induced = needed & ~small

    first = data[direct]
    borders = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    found = []
    for byte in range(256):
        layers = list(waiting[byte])
        layer = np.concatenate(layers) if layers else np.zeros(0, dtype=np.int64)
        layers = [layer]
        while len(layer):
            before = layer - 1
            before = before[before >= 0]
            layer = before[induced[before] & (data[before] == byte)]
            layers.append(layer)
        bucket = np.concatenate([*layers, direct[borders[byte] : borders[byte + 1]]])
        if not len(bucket):
            continue
        found.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[induced[before] & (data[before] > byte)]
        chars = data[before]
        order = np.argsort(chars, kind="stable")
        before, chars = before[order], chars[order]
        cuts = np.flatnonzero(np.diff(chars)) + 1
        for part in np.split(before, cuts) if len(before) else []:
            waiting[int(data[part[0]])].append(part)
    order = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    return order[wanted[order]]


def long_repeats(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each suffix of ``order`` shares DEPTH bytes or more with the one ahead of it."""
    if not len(order):
        return np.zeros(0, dtype=bool)
    words = words_at(data)
    same = np.zeros(len(order), dtype=bool)
    at = np.arange(1, len(order))
    for step in [*range(0, DEPTH - 7, 8), DEPTH - 8]:
        at = at[words[order[at] + step] == words[order[at - 1] + step]]
    same[at] = True
    return same
