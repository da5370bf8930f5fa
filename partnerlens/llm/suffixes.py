"""Suffix order by linear grouping.

Every suffix belongs to a group of suffixes with equal Lyndon prefix (the
longest prefix smaller than all its own suffixes); groups stand in
lexicographic order. Groups are refined from the highest to the lowest: each
suffix of a group points to the nearest suffix before it in a lower group,
and suffixes that get equally many pointers leave their group for a new one
just above it. After that the groups' order is right, and one pass from the
lowest suffix up fills them: once a suffix is placed, the suffixes that have
it as their next smaller one follow, found along the pointers. Nothing is
renamed and there is no recursion.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_order(text: Sequence[int]) -> list[int]:
    """The starts of all suffixes of text in lexicographic order (a proper prefix comes first)."""
    n = len(text)
    # Groups are stretches of `slots`, known by their first slot; at first one for each symbol.
    slots = sorted(range(n), key=text.__getitem__)
    where, group, size = [0] * n, [0] * n, [0] * n
    first, last = 0, -1
    for slot, s in enumerate(slots):
        if text[s] != last:
            first, last = slot, text[s]
        where[s], group[s] = slot, first
        size[first] += 1

    before = [-1] * n  # nearest suffix to the left in a lower group; -1: none
    end = n
    while end:
        low = group[slots[end - 1]]
        count: dict[int, int] = {}
        for s in sorted(slots[low:end]) if end - low > 1 else (slots[low],):
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[s] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        if len(count) == 1:  # most groups: one suffix moves to the top of its group
            sets = [list(count)]
        elif count:
            by_count: dict[int, list[int]] = {}
            for p, c in count.items():
                by_count.setdefault(c, []).append(p)
            sets = [by_count[c] for c in sorted(by_count, reverse=True)]
        else:
            sets = []
        for moving in sets:  # more pointers are larger; each set goes just above what is left of its group
            left: dict[int, int] = {}
            for p in moving:
                g = group[p]
                top = g + size[g] - 1
                size[g] -= 1
                left[g] = left.get(g, 0) + 1
                at, other = where[p], slots[top]
                slots[at], where[other] = other, at
                slots[top], where[p] = p, top
            for g, many in left.items():
                if size[g]:
                    new = g + size[g]
                    size[new] = many
                    for slot in range(new, new + many):
                        group[slots[slot]] = new
                else:  # the whole group has moved: it keeps its place
                    size[g] = many
        end = low

    # Fill the groups from below. What follows the text is smaller than all suffixes.
    order, free, placed = [0] * n, list(range(n)), bytearray(n)
    p = n - 1
    at = 0
    while True:
        while p >= 0 and not placed[p]:
            g = group[p]
            order[free[g]] = p
            free[g] += 1
            placed[p] = 1
            p = before[p]
        if at == n:
            return order
        p = order[at] - 1
        at += 1
