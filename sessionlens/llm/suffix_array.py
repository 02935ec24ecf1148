"""Suffix sorting by linear grouping: Lyndon-prefix groups in descending order, then each group's order from its successors.

The longest Lyndon prefix of the suffix at i ends where the next smaller suffix starts, and suffixes sort first by that
prefix. The first phase finds the groups of equal Lyndon prefixes. It starts from groups by first symbol and takes groups
from the greatest to the smallest; the group it takes is final. Each of its members is appended to the nearest position to
its left that is in a smaller group (its previous smaller suffix; finished positions are jumped over by their own pointers).
Positions of one group that had k members appended form a new group just above the old one, the more the higher.

The second phase needs no further comparison and no names: within a group, suffixes follow the order of what comes after
their common prefix, and that suffix is a smaller one. So the suffixes are taken in ascending order, and each one sends the
positions whose Lyndon prefix ends at it to the next free place of their groups.

Long texts of bytes are parsed first (prefix-free parsing), so that linear grouping, which is a loop in Python, sorts phrases:
`byte_suffix_array`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Of the 8-byte strings, one in 2 to this ends a phrase.
PHRASE_BITS = 4
#: Texts with longer phrases (long runs without such a string) are sorted symbol by symbol.
LONGEST = 512


def suffix_array(text: Sequence[int]) -> list[int]:
    """Start positions of the suffixes of text in ascending order; a suffix that ends sorts before one that goes on."""
    n = len(text)
    group_of, order, length, size = lyndon_groups(text)
    # Places: groups in ascending order, as many as they have members.
    place, at = [0] * len(length), 0
    for g in order:
        place[g] = at
        at += size[g]
    # ending[s]: the positions whose Lyndon prefix ends before s, as a chain.
    ending, chain = [-1] * (n + 1), [-1] * n
    for i, g in enumerate(group_of):
        s = i + length[g]
        chain[i] = ending[s]
        ending[s] = i
    out = [0] * n
    s, taken = n, 0
    while True:
        i = ending[s]
        while i >= 0:
            g = group_of[i]
            out[place[g]] = i
            place[g] += 1
            i = chain[i]
        if taken == n:
            return out
        s = out[taken]
        taken += 1


def lyndon_groups(text: Sequence[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """The group of each position, the groups in ascending order, and each group's Lyndon prefix length and number of members."""
    n = len(text)
    symbols = sorted(set(text))
    number = {c: g for g, c in enumerate(symbols)}
    group_of = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group_of):
        members[g].append(i)
    size = [len(m) for m in members]
    length = [1] * len(symbols)
    below, above = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    smaller = [-1] * n  # of finished positions: the nearest position to the left in a smaller group
    finished = bytearray(n + 1)  # the last one stands for position -1, where every search ends
    g = len(symbols) - 1
    ascending: list[int] = []
    while g >= 0:
        own = members[g]
        if len(own) != size[g]:  # some have moved on to other groups
            own = [i for i in own if group_of[i] == g]
        for i in own:
            finished[i] = 1
        if len(own) == 1:  # most groups, in the end
            i = own[0]
            p = i - 1
            while finished[p]:
                p = smaller[p]
            smaller[i] = p
            moves = [(group_of[p], 1, [p])] if p >= 0 else []
        elif len(own) == 2:  # most groups of a text that stands twice
            i, j = own
            p = i - 1
            while finished[p]:
                p = smaller[p]
            smaller[i] = p
            q = j - 1
            while finished[q]:
                q = smaller[q]
            smaller[j] = q  # never left of p
            if p == q:
                moves = [(group_of[p], 2, [p])] if p >= 0 else []
            elif p < 0:
                moves = [(group_of[q], 1, [q])]
            elif (h := group_of[p]) == (up := group_of[q]):
                moves = [(h, 1, [p, q])]
            else:
                moves = [(h, 1, [p]), (up, 1, [q])]
        else:
            count: dict[int, int] = {}
            for i in own:
                p = i - 1
                while finished[p]:
                    p = smaller[p]
                smaller[i] = p
                count[p] = count.get(p, 0) + 1
            count.pop(-1, None)
            moved: dict[tuple[int, int], list[int]] = {}
            for p, k in count.items():
                key = (group_of[p], k)
                if key in moved:
                    moved[key].append(p)
                else:
                    moved[key] = [p]
            # Greater counts go higher, so they are put above the old group last to first.
            moves = [(h, k, sorted(positions)) for (h, k), positions in (sorted(moved.items(), reverse=True) if len(moved) > 1 else moved.items())]
        for h, k, positions in moves:
            if len(positions) == size[h]:  # nobody stays behind: the group keeps its place
                length[h] += k * length[g]
                continue
            new = len(size)
            for p in positions:
                group_of[p] = new
            members.append(positions)
            size.append(len(positions))
            length.append(length[h] + k * length[g])
            size[h] -= len(positions)
            up = above[h]
            below.append(h)
            above.append(up)
            above[h] = new
            below[up] = new
        ascending.append(g)
        g = below[g]
    ascending.reverse()
    return group_of, ascending, length, size


def byte_suffix_array(text: np.ndarray) -> np.ndarray:
    """suffix_array of a text whose smallest symbol is also its last one (a separator).

    A phrase ends at each separator and wherever the next 8 symbols hash to a chosen value. The piece of a position goes from it to
    the next such end after it, with the 8 symbols there. No piece is the start of another one, as it would end there too; so
    suffixes follow the order of their pieces first, then that of the suffixes at the pieces' ends. Pieces are sorted 8
    symbols at a time, as far as they tie; the suffixes at the ends are those of the phrases' sequence, sorted by linear grouping.
    """
    n = len(text)
    number = np.zeros(int(text.max()) + 1, np.int64)
    number[text] = 1
    number = np.cumsum(number)
    if number[-1] > 255:
        return np.array(suffix_array(text.tolist()), np.int64)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = number[text]
    words = np.ndarray((n + 9,), ">u8", padded, strides=(1,)).astype(np.uint64)  # the 8 symbols from each position on
    ends = (words[:n] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PHRASE_BITS) == 0
    ends |= padded[:n] == 1
    phrase = np.flatnonzero(ends)
    after = np.cumsum(ends)  # the number of the first end after each position
    size = np.append(phrase, n)[after] + 8 - np.arange(n)
    if int(size.max()) > LONGEST:
        return np.array(suffix_array(text.tolist()), np.int64)
    # rank: how many positions have smaller pieces, as far as these are read.
    rank = np.zeros(n, np.int64)
    left, read = np.arange(n), 0
    while len(left):
        word, rest = words[np.minimum(left + read, n + 8)], size[left] - read
        cut = rest < 8
        word[cut] &= ~np.uint64(0) << (8 * (8 - rest[cut])).astype(np.uint64)
        own = rank[left]
        order = np.argsort(word)
        if read:  # by rank first: two sorts by one number are faster than one by two
            turn = np.empty(len(order), np.int64)
            turn[order] = np.arange(len(order))
            order = np.argsort(own * len(order) + turn)
        left, word, own, rest = left[order], word[order], own[order], rest[order]
        group = np.append(True, own[1:] != own[:-1])
        part = group | np.append(True, word[1:] != word[:-1])
        first = np.flatnonzero(part)
        number = np.cumsum(part) - 1
        rank[left] = own + first[number] - np.flatnonzero(group)[np.cumsum(group) - 1]
        tied = np.diff(np.append(first, len(left)))[number] > 1
        left = left[tied & (rest > 8)]
        read += 8
    _, parse = np.unique(rank[phrase], return_inverse=True)
    place = np.zeros(len(phrase) + 1, np.int64)
    place[suffix_array(parse.tolist())] = np.arange(1, len(phrase) + 1)
    return np.argsort(rank * (len(phrase) + 1) + place[after])
