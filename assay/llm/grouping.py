"""Suffix arrays by linear grouping.

Baier's construction (Linear-time Suffix Sorting, CPM 2016) sorts suffixes in two phases. The first
groups them by their longest Lyndon prefix; the second puts each group in order. Neither sorts ranks
again on a shorter text, as recursive constructions do.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in order. Its last symbol must be 0 and occur only there."""
    groups, previous = _grouped(text)
    return _in_order(groups, previous)


def _grouped(text: Sequence[int]) -> tuple[list[int], list[int]]:
    """For each suffix: where its group starts, and the nearest earlier suffix of a lower group (-1).

    Groups begin as equal first symbols and are taken from the highest down. When a group is taken, its
    members' Lyndon prefixes are complete, and they lengthen those of the suffixes they point to:
    these leave their groups for new ones right above, the more members point to them the higher.
    """
    n = len(text)
    members = sorted(range(n), key=text.__getitem__)
    start, size, place = [0] * n, [0] * n, [0] * n
    first = 0
    for k, suffix in enumerate(members):
        if text[suffix] != text[members[first]]:
            first = k
        start[suffix] = first
        size[first] += 1
        place[suffix] = k
    previous = [-1] * n

    high = n
    while high > 1:
        low = start[members[high - 1]]
        if high - low == 1:  # a group of one, as most are in the end
            high = low
            suffix = members[low]
            p = suffix - 1
            while p >= 0 and start[p] >= low:
                p = previous[p]
            previous[suffix] = p
            if p >= 0:
                group = start[p]
                left = size[group] - 1
                if left:
                    at, end = place[p], group + left
                    other = members[end]
                    members[at], place[other] = other, at
                    members[end], place[p] = p, end
                    size[group], size[end], start[p] = left, 1, end
            continue
        pointing: dict[int, int] = {}
        for suffix in sorted(members[low:high]):
            p = suffix - 1
            while p >= 0 and start[p] >= low:  # earlier ones of this group are done already
                p = previous[p]
            previous[suffix] = p
            if p >= 0:
                pointing[p] = pointing.get(p, 0) + 1
        high = low
        by_count: dict[int, list[int]] = {}
        for p, count in pointing.items():
            by_count.setdefault(count, []).append(p)
        for count in sorted(by_count, reverse=True):
            leaving: dict[int, int] = {}
            for p in by_count[count]:  # to the end of its group
                group = start[p]
                left = size[group] = size[group] - 1
                leaving[group] = leaving.get(group, 0) + 1
                at, end = place[p], group + left
                other = members[end]
                members[at], place[other] = other, at
                members[end], place[p] = p, end
            for p in by_count[count]:
                start[p] += size[start[p]]
            for group, number in leaving.items():
                size[group + size[group]] = number
    return start, previous


def _in_order(start: list[int], previous: list[int]) -> list[int]:
    """Each suffix puts what it follows, and what that points to, in the next free place of its group.

    ``free`` counts the places of a group that are taken; a suffix with start -1 has its place.
    """
    n = len(start)
    order, free = [0] * n, list(range(n))
    order[0] = n - 1
    start[n - 1] = -1
    for k in range(n):
        p = order[k] - 1
        while p >= 0:
            group = start[p]
            if group < 0:
                break
            order[free[group]] = p
            free[group] += 1
            start[p] = -1
            p = previous[p]
    return order
