"""Suffix arrays by linear grouping construction, many short texts at once.

Every suffix belongs to the group of its longest Lyndon prefix. Phase one
handles the groups of a text from the highest to the lowest: each suffix of
the group points to the nearest earlier suffix of a lower group, and the
suffixes pointed at move up, out of their group, ordered by how often they are
pointed at. Phase two walks the growing suffix array and places, for each
entry, the chain of such pointers that starts one position before it, each at
the front of its group. Nothing is renamed and there is no recursion.

The texts ("lanes") do not interact, so step t handles the t-th highest group
of every lane in one pass of numpy operations.
"""

from __future__ import annotations

import numpy as np


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Concatenated ranges [start, start + size)."""
    total = int(size.sum())
    out = np.ones(total, np.int64)
    if not total:
        return out
    keep = size > 0
    start, size = start[keep], size[keep]
    out[0] = start[0]
    at = np.cumsum(size)[:-1]
    out[at] = start[1:] - start[:-1] - size[:-1] + 1
    return np.cumsum(out)


def suffix_arrays(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Suffix array of each text of non-negative symbols."""
    lens = np.asarray([len(t) + 1 for t in texts], np.int64)
    n = int(lens.sum())
    first = np.cumsum(lens) - lens + 1  # position 0 is a guard below every group
    sym = np.zeros(n + 1, np.int64)
    for f, t in zip(first, texts):
        sym[f:f + len(t)] = np.asarray(t, np.int64) + 1  # each lane ends with its least symbol, 0
    lane = np.concatenate([[-1], np.repeat(np.arange(len(texts)), lens)])
    lane_first = np.concatenate([[0], np.repeat(first, lens)])

    sa = np.lexsort((sym, lane))  # by first symbol; slots of a lane are its positions' numbers
    pos = np.empty(n + 1, np.int64)
    pos[sa] = np.arange(n + 1)
    s, k = sym[sa], lane[sa]
    head = np.concatenate([[True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])])
    start = np.flatnonzero(head)
    end = np.zeros(n + 2, np.int64)  # by group start: one past the group's last slot
    end[start] = np.concatenate([start[1:], [n + 1]])
    group = np.empty(n + 1, np.int64)  # by position: the start of its group
    group[sa] = np.repeat(start, end[start] - start)
    prev = np.zeros(n + 1, np.int64)
    moving = np.zeros(n + 1, bool)

    top, bottom = first + lens, first
    while True:
        live = top > bottom
        if not live.any():
            break
        top, bottom = top[live], bottom[live]
        low = group[sa[top - 1]]
        size = top - low
        x = sa[_spans(low, size)]
        own = np.repeat(low, size)
        top = low
        j = x - 1
        while (up := group[j] > own).any():
            j = np.where(up, prev[j], j)
        prev[x] = j
        while (same := group[j] == own).any():
            j = np.where(same, prev[j], j)
        prev[x] = j
        j = np.sort(j[j >= lane_first[x]])
        if not len(j):
            continue
        cut = np.flatnonzero(np.concatenate([[True], j[1:] != j[:-1]]))
        p, times = j[cut], np.diff(np.concatenate([cut, [len(j)]]))
        order = np.lexsort((times, group[p]))
        p, times = p[order], times[order]
        old = group[p]
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        block = np.flatnonzero(new_old)
        moved = np.diff(np.concatenate([block, [len(p)]]))
        rest = end[old[block]] - moved
        target = _spans(rest, moved)
        moving[p] = True
        there = sa[target]
        there = there[~moving[there]]
        moving[p] = False
        free = pos[p]
        free = free[free < np.repeat(rest, moved)]
        sa[free], pos[there] = there, free
        sa[target], pos[p] = p, target
        end[old[block]] = rest
        run = np.flatnonzero(new_old | np.concatenate([[True], times[1:] != times[:-1]]))
        width = np.diff(np.concatenate([run, [len(p)]]))
        end[target[run]] = target[run] + width
        group[p] = np.repeat(target[run], width)

    slot = np.arange(n + 2)
    out = np.zeros(n + 1, np.int64)
    placed = np.zeros(n + 1, bool)
    last = first + lens - 1
    out[first], placed[last] = last, True  # the least suffix of a lane is its end mark
    slot[first] += 1
    at, stop = first, first + lens
    while len(at):
        x = out[at] - 1
        x = x[x >= lane_first[out[at]]]
        while len(x):
            x = x[~placed[x]]
            g = group[x]
            out[slot[g]] = x
            slot[g] += 1
            placed[x] = True
            nxt = prev[x]
            x = nxt[nxt >= lane_first[x]]
        at = at + 1
        go = at < stop
        at, stop = at[go], stop[go]
    return [out[f + 1:f + m] - f for f, m in zip(first, lens)]
