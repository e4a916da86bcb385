"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai common prefixes.

Both are generic over the alphabet: the first keys may hold one symbol (a word's
number) or several (eight bytes in one integer).
"""

from __future__ import annotations

import numpy as np

from .text import eight_bytes


def suffix_array(keys: np.ndarray, unit: int, depth: int, opened: dict[int, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` symbols at least, and each place's group number.

    ``keys[i]`` orders the suffixes by their first ``unit`` symbols.  As by Larsson and
    Sadakane, a suffix's group number is its group's first place in the array; each pass
    doubles the sorted length by sorting, inside the groups that are not single yet, by
    the group number of the suffix that begins where the sorted part ends.

    ``opened`` receives, for every sorted length on the way, the slots where a new group begins.
    """
    n = len(keys)
    order = np.argsort(keys)
    sorted_keys = keys[order]
    opens = np.ones(n, bool)
    opens[1:] = sorted_keys[1:] != sorted_keys[:-1]
    group = np.empty(n, np.int64)
    group[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    length = unit
    if opened is not None:
        opened[unit] = opens.copy()
    while length < depth and n:
        single = opens.copy()
        single[:-1] &= opens[1:]
        slots = np.flatnonzero(~single)
        if not len(slots):
            break
        place = order[slots]
        after = place + length
        follow = np.where(after < n, group[np.minimum(after, n - 1)] + 1, 0)
        pair = (group[place] << 32) | follow
        by = np.argsort(pair)
        place, pair = place[by], pair[by]
        order[slots] = place
        now = np.ones(len(slots), bool)
        now[1:] = pair[1:] != pair[:-1]
        opens[slots] = now
        group[place] = slots[np.maximum.accumulate(np.where(now, np.arange(len(slots)), 0))]
        length *= 2
        if opened is not None:
            opened[length] = opens.copy()
    return order, group


def common_prefixes(raw: np.ndarray, order: np.ndarray, cap: int, walk: int = 64,
                    wanted: np.ndarray | None = None) -> np.ndarray:
    """Common prefix, up to ``cap`` bytes, of each sorted suffix with the one before it (first: 0).

    Kasai's rule, that the next suffix shares at least one byte less, run along many
    walks of ``walk`` places over the text at once.  Suffixes that share ``cap`` bytes may
    stand in any order; the rule says nothing after them and the comparison starts anew.
    ``wanted`` (by place in ``order``) leaves the other places at 0 uncompared.
    """
    n = len(raw)
    eight = np.concatenate([eight_bytes(raw), np.zeros(cap + 8, np.uint64)])
    before = np.full(n, -1, np.int64)
    if wanted is None:
        before[order[1:]] = order[:-1]
    else:
        slots = np.flatnonzero(wanted[1:]) + 1
        before[order[slots]] = order[slots - 1]
    shared = np.zeros(n, np.int64)
    begins = np.arange(0, n, walk)
    last = np.zeros(len(begins), np.int64)
    for r in range(min(walk, n)):
        here = begins + r
        if here[-1] >= n:
            begins, here, last = begins[:-1], here[:-1], last[:-1]
        other = before[here]
        got = np.where((last >= cap) | (other < 0), 0, np.maximum(last - 1, 0))
        live = np.flatnonzero(other >= 0)
        while len(live):
            at = got[live]
            differ = eight[here[live] + at] ^ eight[other[live] + at]
            same = differ == 0
            part = np.full(len(live), 8, np.int64)
            if not same.all():
                odd = differ[~same]
                part[~same] = sum((odd < np.uint64(1 << bits)).astype(np.int64) for bits in range(8, 64, 8))
            got[live] = at + part
            live = live[same & (got[live] < cap)]
        room = n - np.maximum(here, other)
        last = np.minimum(np.minimum(got, cap), np.where(other < 0, 0, room))
        shared[here] = last
    return shared[order]
