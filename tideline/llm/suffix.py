"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard: linear work in whole-array steps."""

from __future__ import annotations

import numpy as np


#: Reduced strings of at most this length end the recursion.
SHORT = 1 << 14


def _runs(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by small integer keys; then of each run of equal keys its key, first place and length."""
    order = np.argsort(keys.astype(np.uint8 if k <= 1 << 8 else np.uint16) if k <= 1 << 16 else keys, kind="stable")
    s = keys[order]
    edge = np.flatnonzero(s[1:] != s[:-1])
    first = np.zeros(len(edge) + 1, np.int64)
    first[1:] = edge + 1
    count = np.empty_like(first)
    count[:-1] = first[1:] - first[:-1]
    count[-1] = len(s) - first[-1]
    return order, s[first], first, count


def _induce(s: np.ndarray, small: np.ndarray, start: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Suffix array induced from leftmost-smaller suffixes in the given order.

    Larger-type suffixes are filled from the bucket heads in ascending order, then smaller-type ones from the tails in
    descending order. Several buckets are taken in one step as long as none of them receives a suffix from that step.
    """
    n, k = len(s), len(start) - 1
    line = np.arange(n)
    sa = np.full(n, -1, np.int64)
    back = lms[::-1]
    order, c, first, count = _runs(s[back], k)
    sa[np.repeat(start[c + 1] - 1 + first, count) - np.arange(len(back))] = back[order]

    head = start[:-1].copy()

    def push_up(items: np.ndarray) -> np.ndarray:
        """Preceding larger-type suffixes, in order."""
        p = items[items > 0] - 1
        return p[~small[p]]

    def put_up(p: np.ndarray) -> None:
        if len(p):
            order, c, first, count = _runs(s[p], k)
            sa[np.repeat(head[c] - first, count) + line[: len(p)]] = p[order]
            head[c] += count

    b, width = 0, 1
    while b < k:
        width = min(width, k - b)
        part = sa[start[b] : start[b + width]]
        p = push_up(part[part >= 0])
        low = int(s[p].min()) if len(p) else k
        if low >= b + width:
            put_up(p)
            b, width = b + width, width * 2
            continue
        if low > b:
            width = low - b
            continue
        # a suffix falls into bucket b itself: larger-type ones in rounds, then the leftmost-smaller ones
        done = start[b]
        while done < head[b]:
            items, done = sa[done : head[b]].copy(), head[b]
            put_up(push_up(items))
        part = sa[head[b] : start[b + 1]]
        put_up(push_up(part[part >= 0]))
        b, width = b + 1, 1

    tail = start[1:].copy()
    # smaller-type suffixes are found anew; only larger-type ones and the sentinel stand
    for_clear = np.flatnonzero(sa >= 0)
    for_clear = for_clear[small[sa[for_clear]]]
    sa[for_clear] = -1
    sa[0] = n - 1
    tail[0] = 0

    def push_down(items: np.ndarray) -> np.ndarray:
        p = items[items > 0] - 1
        return p[small[p]]

    def put_down(p: np.ndarray) -> None:
        if len(p):
            order, c, first, count = _runs(s[p], k)
            sa[np.repeat(tail[c] - 1 + first, count) - line[: len(p)]] = p[order]
            tail[c] -= count

    b, width = k, 1
    while b > 0:
        width = min(width, b)
        part = sa[start[b - width] : start[b]][::-1]
        p = push_down(part[part >= 0])
        high = int(s[p].max()) if len(p) else -1
        if high < b - width:
            put_down(p)
            b, width = b - width, width * 2
            continue
        if high < b - 1:
            width = b - 1 - high
            continue
        done = start[b]
        while done > tail[b - 1]:
            items, done = sa[tail[b - 1] : done][::-1].copy(), tail[b - 1]
            put_down(push_down(items))
        part = sa[start[b - 1] : tail[b - 1]][::-1]
        put_down(push_down(part[part >= 0]))
        b, width = b - 1, 1
    return sa


def _doubling(s: np.ndarray) -> np.ndarray:
    """Suffix array of a short string by doubling sorted prefixes: the end of the recursion."""
    n, rank, j = len(s), s.astype(np.int64), 1
    while True:
        key = rank * (n + 1 + int(rank.max()))
        key[: n - j] += rank[j:] + 1
        sa = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[sa] = np.concatenate(([0], np.cumsum(key[sa[1:]] != key[sa[:-1]])))
        if rank[sa[-1]] == n - 1:
            return sa
        j *= 2


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of integers 0..k-1 whose last one is a single 0."""
    n = len(s)
    if n <= SHORT:
        return _doubling(s)
    step = np.sign(np.diff(s))
    at = np.where(step != 0, np.arange(n - 1), n - 2)
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = np.append(step[at] > 0, True)
    starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1  # leftmost-smaller positions
    start = np.concatenate(([0], np.cumsum(np.bincount(s, minlength=k))))
    if len(starts) == 1:
        return _induce(s, small, start, starts)
    sa = _induce(s, small, start, starts)
    is_lms = np.zeros(n, bool)
    is_lms[starts] = True
    order = sa[is_lms[sa]]
    # names: neighbours in this order are equal if their substrings, up to the next leftmost-smaller one, are
    size = np.zeros(n, np.int64)
    size[starts] = np.append(np.diff(starts) + 1, 1)
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    live = np.flatnonzero(same)
    j = 0
    while len(live):
        live = live[size[a[live]] > j]
        bad = s[a[live] + j] != s[b[live] + j]
        same[live[bad]] = False
        live = live[~bad]
        j += 1
    names = np.concatenate(([0], np.cumsum(~same)))
    kinds = int(names[-1]) + 1
    if kinds < len(starts):
        name = np.zeros(n, np.int64)
        name[order] = names
        order = starts[suffix_array(name[starts], kinds)]
    return _induce(s, small, start, order)


def permuted_common_prefixes(raw: np.ndarray, sa: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each position its suffix's common prefix with its predecessor in the suffix array, at most left[position].

    Only irreducible ones (whose preceding letters differ) are compared, eight letters a step; the others follow from
    the position before them, one less each. raw: the letters as bytes, at least eight past the end.
    """
    n = len(sa)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    prior = np.where(before > 0, raw[np.maximum(before, 1) - 1], 0)
    # limits end texts, so a position whose limit or predecessor starts anew counts as irreducible too
    reducible = (i > 0) & (before > 0) & (np.append(0, raw[: n - 1]) == prior)
    reducible[1:] &= (left[1:] == left[:-1] - 1) & (left[np.maximum(before[1:], 1)] == left[np.maximum(before[1:], 1) - 1] - 1)
    reducible[0] = False
    at = np.flatnonzero(~reducible & (before >= 0))
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words |= raw[k : n + k].astype(np.uint64) << np.uint64(8 * k)
    found = np.zeros(n, np.int64)
    limit = np.minimum(left[at], left[before[at]])
    a, b, j = at, before[at], 0
    while len(a):
        go = limit > j
        a, b, limit = a[go], b[go], limit[go]
        x = words[a + j] ^ words[b + j]
        equal = x == 0
        stop = ~equal
        low = x[stop] & (~x[stop] + np.uint64(1))
        found[a[stop]] = np.minimum(limit[stop], j + np.log2(low.astype(np.float64)).astype(np.int64) // 8)
        found[a[equal]] = np.minimum(limit[equal], j + 8)
        a, b, limit = a[equal], b[equal], limit[equal]
        j += 8
    origin = np.maximum.accumulate(np.where(reducible, 0, i))
    return np.minimum(np.maximum(0, found[origin] - (i - origin)), left)


def repeated_starts(texts: list[bytes], length: int) -> np.ndarray:
    """Marks over the joined texts (each followed by one separator): does a `length`-byte string start here that also
    starts anywhere else in the texts? Strings never cross texts."""
    joined = b"\x00".join(texts) + b"\x00"  # separators get a value of their own below; zero bytes in texts stay apart
    raw = np.frombuffer(joined, np.uint8)
    n = len(raw)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    s = raw.astype(np.int64) + 2
    s[ends] = 1
    s = np.append(s, 0)
    used = np.unique(s)
    dense = np.zeros(258, np.int64)
    dense[used] = np.arange(len(used))
    sa = suffix_array(dense[s], len(used))
    left = np.append(np.repeat(ends, sizes + 1) - np.arange(n), 0)
    padded = np.concatenate((raw, np.zeros(9 + 8, np.uint8)))
    plcp = permuted_common_prefixes(padded, sa, left)
    hit = plcp >= length
    before = np.full(n + 1, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    marks = np.zeros(n + 1, bool)
    marks[hit] = True
    marks[before[np.flatnonzero(hit)]] = True
    return marks[:n]
