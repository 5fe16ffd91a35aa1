"""Linear suffix sorting by grouping, for integer texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Order of the suffixes of ``text``, whose last symbol is its unique smallest.

    Suffixes fall into groups by their first symbol. From the highest group down, each
    member points to the nearest suffix before it that lies in a lower group; what is pointed
    at moves to a new group right above its own, those with more pointers higher. Then a
    group holds the suffixes of one Lyndon prefix. A second pass places suffixes one by one:
    the one before a placed suffix, and what its pointers lead to, takes the next place of
    its group.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n
    group = [0] * n
    size = [0] * n
    start = 0
    for at, i in enumerate(order):
        if text[i] != text[order[start]]:
            start = at
        place[i], group[i] = at, start
        size[start] += 1
    pointer = [-1] * n
    end = n
    while end > 0:
        start = group[order[end - 1]]
        members = order[start:end]
        members.sort()
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = pointer[j]
            pointer[i] = j
        if len(members) == 1:
            j = pointer[members[0]]
            targets = {j: 1} if j >= 0 else {}
        else:
            targets = Counter(pointer[i] for i in members)
            targets.pop(-1, None)
        by_count: dict[int, list[int]] = {}
        for j, times in targets.items():
            by_count.setdefault(times, []).append(j)
        for times in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for j in by_count[times]:
                # The target swaps places with the last of its group that has not moved yet.
                own = group[j]
                taken = moved.get(own, 0)
                last = own + size[own] - 1 - taken
                other, at = order[last], place[j]
                order[at], place[other] = other, at
                order[last], place[j] = j, last
                moved[own] = taken + 1
            for own, taken in moved.items():
                left = size[own] - taken
                size[own] = left
                if left:
                    new = own + left
                    size[new] = taken
                    for at in range(new, new + taken):
                        group[order[at]] = new
                else:
                    size[own] = taken
        end = start
    out = [-1] * n
    free = list(range(n))
    placed = bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    free[group[n - 1]] += 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            own = group[j]
            at = free[own]
            free[own] = at + 1
            out[at], placed[j] = j, 1
            j = pointer[j]
    return out
