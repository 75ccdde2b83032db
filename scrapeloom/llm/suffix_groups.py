"""Suffix arrays by linear grouping, and the repeats that they show."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes in order.

    First phase: suffixes are grouped by the longest Lyndon word that they begin with.
    Groups start out as equal symbols and are taken from the highest down. A suffix of
    the group at hand points to the last one before it that lies in a lower group;
    passed suffixes are skipped by their own pointers. A suffix that is pointed to l
    times has its word prolonged by l copies of the group's word, so it leaves its
    group for a new one right above it; more copies come higher.

    Second phase: the suffixes of a group are ordered like the suffixes that follow
    their words. The order is emitted from the smallest suffix up: a suffix hands
    their next place to those whose word ends before it, which are found by walking
    the pointers. No ranks are assigned and no shorter string is solved.
    """
    n = len(symbols)
    if n == 0:
        return []
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    members = [by_symbol[c] for c in sorted(by_symbol)]
    group = [0] * n
    for g, positions in enumerate(members):
        for i in positions:
            group[i] = g
    size = [len(m) for m in members]
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    unset = -2
    pointer = [unset] * n
    downwards = []
    g = len(members) - 1
    while g >= 0:
        count = size[g]
        if count == 1:
            own = members[g]
            s = own[0] if len(own) == 1 else next(i for i in own if group[i] == g)
            p = s - 1
            while p >= 0 and pointer[p] != unset:
                p = pointer[p]
            pointer[s] = p
            members[g] = (s,)
            downwards.append(g)
            if p >= 0:
                h = group[p]
                if size[h] > 1:
                    size[h] -= 1
                    k = len(members)
                    group[p] = k
                    members.append((p,))
                    size.append(1)
                    up = above[h]
                    above.append(up)
                    below.append(h)
                    above[h] = k
                    below[up] = k
        elif count:
            own = members[g]
            if len(own) != count:
                own = [i for i in own if group[i] == g]
            own = members[g] = sorted(own)
            downwards.append(g)
            copies: dict[int, int] = {}
            for s in own:
                p = s - 1
                while p >= 0 and pointer[p] != unset:
                    p = pointer[p]
                pointer[s] = p
                if p >= 0:
                    copies[p] = copies.get(p, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for p, times in copies.items():
                if size[group[p]] > 1:
                    moves.setdefault((-times, group[p]), []).append(p)
            for _, h in sorted(moves) if len(moves) > 1 else moves:
                leaving = moves[_, h]
                if len(leaving) == size[h]:
                    continue  # the whole of what is left stays together
                size[h] -= len(leaving)
                k = len(members)
                for p in leaving:
                    group[p] = k
                members.append(leaving)
                size.append(len(leaving))
                up = above[h]
                above.append(up)
                below.append(h)
                above[h] = k
                below[up] = k
        g = below[g]
    place = [0] * len(members)
    start = 0
    for g in reversed(downwards):
        place[g] = start
        start += size[g]
    order = [0] * n
    at, end = n, -1  # the empty suffix comes first
    emitted = 0
    while True:
        s = at - 1
        while s > end:
            g = group[s]
            order[place[g]] = s
            place[g] += 1
            s = pointer[s]
        if emitted == n:
            return order
        at = order[emitted]
        end = pointer[at]
        emitted += 1


def repeated_starts(texts: list[bytes], window: int) -> list[list[int]]:
    """For each text, the starts of its ``window``-byte strings that start anywhere else.

    One suffix array over all texts, parted by symbols of their own: strings are equal
    when they are next to each other among the suffixes that are long enough.
    """
    symbols: list[int] = []
    owner: list[int] = []
    parts = len(texts)
    for i, text in enumerate(texts):
        symbols.extend([c + parts for c in text])
        symbols.append(i)
        owner.extend([i] * (len(text) + 1))
    begin, at = [], 0
    for text in texts:
        begin.append(at)
        at += len(text) + 1
    joined = b"\0".join(texts) + b"\0"
    last = [b + len(t) - window for b, t in zip(begin, texts)]
    found: list[set[int]] = [set() for _ in texts]
    before, string = -1, b""
    for s in suffix_array(symbols):
        i = owner[s]
        if s > last[i]:
            continue
        here = joined[s : s + window]
        if here == string:
            found[i].add(s - begin[i])
            found[owner[before]].add(before - begin[owner[before]])
        before, string = s, here
    return [sorted(f) for f in found]


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


def _reach(sides: list[bytes]) -> list[int]:
    """For each string the longest prefix that it shares with any other."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    shared = [0, *[_common(sides[i], sides[j]) for i, j in zip(order, order[1:])], 0]
    reach = [0] * len(sides)
    for k, i in enumerate(order):
        reach[i] = max(shared[k], shared[k + 1])
    return reach


def repeats_at_anchor(contexts: list[bytes], anchors: list[int], weights: list[int], window: int) -> list[list[tuple[int, int]]]:
    """Runs (first, length) of window starts that repeat, for distinct strings around one anchor.

    ``weights`` tells how often each string occurs; one that occurs twice repeats as a
    whole. Equal windows lie at the same distance from the anchor, so what a string
    shares with no other to the left or right of it cannot take part: the strings are
    cut back to what they share, and those that become equal are merged. The suffix
    array of what remains tells which windows are equal.
    """
    right = _reach([c[a:] for c, a in zip(contexts, anchors)])
    left = _reach([c[:a][::-1] for c, a in zip(contexts, anchors)])
    merged: dict[bytes, list[tuple[int, int]]] = {}
    for i, (c, a, w) in enumerate(zip(contexts, anchors, weights)):
        lo, hi = a - left[i], a + right[i]
        if hi - lo >= window:
            merged.setdefault(c[lo:hi], []).append((i, lo))
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    texts = list(merged)
    starts = repeated_starts(texts, window) if len(texts) > 1 else [[] for _ in texts]
    for text, hits in zip(texts, starts):
        users = merged[text]
        runs = [(0, len(text) - window + 1)] if len(users) > 1 else _runs(hits)
        for i, lo in users:
            found[i] = [(lo + first, length) for first, length in runs]
    for i, w in enumerate(weights):
        if w > 1:
            found[i] = [(0, len(contexts[i]) - window + 1)]
    return found


def _runs(places: list[int]) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for p in places:
        if runs and runs[-1][0] + runs[-1][1] == p:
            runs[-1][1] += 1
        else:
            runs.append([p, 1])
    return [(a, b) for a, b in runs]
