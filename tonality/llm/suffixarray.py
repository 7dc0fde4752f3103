"""Suffix array by linear grouping (Lyndon-prefix groups and previous-smaller pointers)."""

from __future__ import annotations


def suffix_array(symbols) -> list[int]:
    """Order of the suffixes of a sequence of integers >= 1, with an end smaller than every symbol (left out).

    First phase: suffixes are grouped by their first symbol and the groups are
    taken in descending order. Of each member, the previous-smaller pointer is the
    closest earlier suffix of a lower group; a suffix to which several members of
    the group point extends its Lyndon prefix by as many copies of the group's, so
    it moves behind its group's rest, the more copies the higher. Second phase: going
    through the growing order, each suffix's left neighbour and the chain of
    pointers from it take the next free places of their groups. No renaming, no
    recursion.
    """
    text = list(symbols)
    text.append(0)
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    slot = [0] * n       # place of a suffix in ``order``
    group = [0] * n      # first place of its group
    size = [0] * n       # by first place
    first = 0
    for k, i in enumerate(order):
        if k and text[i] != text[order[k - 1]]:
            first = k
        slot[i], group[i] = k, first
        size[first] += 1
    prev = [-2] * n      # -1: none, -2: not yet known

    end = n
    while end > 0:
        here = group[order[end - 1]]
        count: dict[int, int] = {}
        for i in order[here:end]:
            p = i - 1
            if prev[i] == -2:
                wait = [i]
                while p >= 0 and group[p] >= here:
                    if prev[p] != -2:
                        p = prev[p]
                    else:        # same group, its own pointer still unknown
                        wait.append(p)
                        p -= 1
                for x in wait:
                    prev[x] = p
            p = prev[i]
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        by: dict[int, dict[int, list[int]]] = {}
        for p, c in count.items():
            if size[group[p]] > 1:
                by.setdefault(c, {}).setdefault(group[p], []).append(p)
        for c in sorted(by, reverse=True):
            for g, movers in by[c].items():
                whole = size[g]
                start = g + whole - len(movers)
                if start == g:
                    continue     # the whole group moves: nothing is left behind
                to = g + whole
                for p in movers:
                    to -= 1
                    at, other = slot[p], order[to]
                    order[at], order[to] = other, p
                    slot[other], slot[p] = at, to
                    group[p] = start
                size[g], size[start] = whole - len(movers), len(movers)
        end = here

    out = [-1] * n
    free = list(range(n))    # by first place of a group: its next free place
    placed = [False] * n
    out[0], placed[n - 1] = n - 1, True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = prev[j]
    return out[1:]
