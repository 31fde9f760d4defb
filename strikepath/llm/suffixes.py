"""Orders of the suffixes of many short strings by linear grouping.

Strings come in blocks; only strings of one block are compared. A suffix's
Lyndon prefix is its longest prefix that is smaller than all its own proper
suffixes. Suffixes with one Lyndon prefix form a group, and groups are in the
order of their prefixes.

1. Suffixes are grouped by first byte. Groups are processed from the highest
   down. Each member points to the nearest position to its left in a lower
   group (the previous smaller); its Lyndon prefix is then followed by the
   group's. Within their own group, those pointed at move to new groups at its
   upper end, more occurrences higher, so every group found later is lower than
   the one being processed, and no suffix is ever renamed or sorted again.
2. From the lowest group up, each group's members are put in their final order:
   what follows a Lyndon prefix is a smaller suffix, whose place is known. More
   repeats of the prefix are higher, then the place of what follows decides.

All blocks take each step together as array operations; a block with fewer
groups drops out earlier. A string's end is lower than every byte.
"""

from __future__ import annotations

import numpy as np


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start .. start + count - 1, one range after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1], dtype=np.int32) + np.repeat(starts - ends + counts, counts).astype(np.int32, copy=False)


def _starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.empty(len(values), bool)
    new[:1] = True
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new.nonzero()[0]


def _lengths(starts: np.ndarray, end: int) -> np.ndarray:
    """From each start to the next, and from the last to the end."""
    out = np.empty(len(starts), starts.dtype)
    np.subtract(starts[1:], starts[:-1], out=out[:-1])
    out[-1] = end - starts[-1]
    return out


def suffix_order(text: np.ndarray, string_starts: np.ndarray, block_starts: np.ndarray) -> np.ndarray:
    """Positions of ``text`` block by block, each block's in the order of their suffixes within their strings.

    ``string_starts`` and ``block_starts`` are ascending positions; every block
    starts a string. Equal suffixes of different strings are in any order.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    # Positions take four bytes, as blocks are few megabytes.
    string_starts, block_starts = string_starts.astype(np.int32), block_starts.astype(np.int32)
    first = np.repeat(np.arange(len(block_starts), dtype=np.int32), np.diff(block_starts, append=n)) * 256 + text
    order = np.argsort(first, kind="stable").astype(np.int32)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n)
    heads = np.flatnonzero(np.diff(first[order], prepend=-1)).astype(np.int32)
    sizes = np.zeros(n, np.int32)
    sizes[heads] = np.diff(heads, append=n)
    group = np.empty(n, np.int32)
    group[order] = np.repeat(heads, sizes[heads])
    # Where nothing is to the left, a position points to n, which is never done.
    left = np.arange(-1, n - 1, dtype=np.int32)
    left[string_starts] = n
    length = np.ones(n, np.int32)
    done = np.zeros(n + 1, bool)
    pointed = np.zeros(n, bool)

    floor = block_starts
    top = np.append(floor[1:], np.int32(n))
    while True:
        live = top > floor
        if not live.all():
            floor, top = floor[live], top[live]
            if not len(top):
                break
        start = group[order[top - 1]]
        members = order[_spread(start, top - start)]
        top = start
        done[members] = True
        to = left[members]
        again = np.flatnonzero(done[to])
        while len(again):
            to[again] = left[to[again]]
            again = again[done[to[again]]]
        left[members] = to
        real = to < n
        to, size = to[real], length[members[real]]
        if not len(to):
            continue
        # Positions pointed at, by their group, then by how often; one position is pointed at from one group only.
        by = to.argsort()
        to, size = to[by], size[by]
        one = _starts(to)
        often = _lengths(one, len(to))
        to, size = to[one], size[one]
        length[to] += (often * size).astype(np.int32)
        home = group[to]
        both = (home.astype(np.int64) << 32) | often
        by = both.argsort()
        to, home, both = to[by], home[by], both[by]
        run = _starts(home)
        many = _lengths(run, len(to))
        owner = home[run]
        upper = owner + sizes[owner] - many
        slots = _spread(upper, many)
        # Those in the way change places with those that leave lower places.
        pointed[to] = True
        held = order[slots]
        moved = held[~pointed[held]]
        if len(moved):
            was = place[to]
            free = was[was < np.repeat(upper, many)]
            order[free], place[moved] = moved, free
        order[slots], place[to] = to, slots
        pointed[to] = False
        sizes[owner] -= many.astype(np.int32)
        new = _starts(both)
        more = _lengths(new, len(to))
        head = slots[new]
        sizes[head] = more
        group[to] = np.repeat(head, more)

    return _emit(order, place, group, sizes, length, string_starts, block_starts)


def _emit(order, place, group, sizes, length, string_starts, block_starts) -> np.ndarray:
    """The final order within groups that hold several suffixes, from the lowest group of every block up."""
    n = len(order)
    ends = np.repeat(np.append(string_starts[1:], n), np.diff(string_starts, append=n))
    # What follows the repeats of the Lyndon prefix, and their number; n is the end of a string.
    follows = np.arange(n) + length
    follows[follows >= ends] = n
    repeats = np.ones(n, np.int64)
    group = np.append(group, -1)
    open_ = np.flatnonzero(group[follows] == group[:n])
    beyond = follows.copy()
    while len(open_):
        repeats[open_] += 1
        beyond[open_] = follows[beyond[open_]]
        open_ = open_[group[beyond[open_]] == group[open_]]
    place = np.append(place, -1)
    heads = np.flatnonzero(group[order] == np.arange(n))
    heads = heads[sizes[heads] > 1]
    lanes = np.searchsorted(block_starts, heads, side="right")
    # Each block's k-th open group takes part in step k.
    firsts = np.flatnonzero(np.diff(lanes, prepend=-1))
    step = np.arange(len(heads)) - np.repeat(firsts, np.diff(firsts, append=len(lanes)))
    by = np.argsort(step, kind="stable")
    heads = heads[by]
    bounds = np.flatnonzero(np.diff(step[by], prepend=-1, append=-1))
    # Group, repeats and place in one number where they fit.
    bits = int(n + 1).bit_length()
    high = bits + int(repeats.max()).bit_length()
    fits = high + int(len(heads) + 1).bit_length() < 63
    for a, b in zip(bounds, bounds[1:]):
        own = heads[a:b]
        slots = _spread(own, sizes[own])
        members = order[slots]
        after = place[beyond[members]]
        if fits:
            rank = (np.repeat(np.arange(b - a, dtype=np.int64), sizes[own]) << high) | (repeats[members] << bits) | (after + 1)
            members = members[rank.argsort()]
        else:
            members = members[np.lexsort((after, repeats[members], group[members]))]
        order[slots] = members
        place[members] = slots
    return order
