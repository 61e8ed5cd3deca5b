"""Suffix arrays by induced sorting, of many shards at a time.

A shard is a short string. Each step of the algorithm is done for all shards at once, as
one numpy operation on as many elements as there are shards, so a linear scan over the
shards costs as many numpy calls as the longest one has characters, whatever their number.

For each shard: suffixes are classified as smaller (S) or larger (L) than the next one; the
substrings between leftmost S positions are sorted by one round of inducing and named; where
names repeat, the shard's string of names is sorted the same way, recursively; the order of
the leftmost S suffixes then induces that of all L and all S suffixes, left to right and
right to left. Common prefixes are computed in text order (permuted), directly where the
characters before a suffix and its predecessor differ, and from the one before elsewhere.
"""

from __future__ import annotations

import numpy as np

_FIRST = 2  # two cells in front stand for "no suffix" and the end of a shard before the first


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``lengths[i]`` numbers each, one after the other."""
    total = int(lengths.sum())
    return np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(total)


def suffix_arrays(text: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The suffix arrays of the shards that lie one after the other in ``text``, each as
    positions in ``text``, in place of the shard. Shards come longest first; each ends with
    its only 0."""
    lengths = np.asarray(lengths, np.int64)
    t = np.concatenate([[0, 0], text]).astype(np.int64)
    base = _FIRST + np.concatenate([[0], np.cumsum(lengths)[:-1]])
    ends = base + lengths - 1
    size = len(t)

    # a suffix is S or L as its first differing neighbour character says
    differ = np.ones(size, bool)
    differ[:-1] = t[:-1] != t[1:]
    differ[ends] = differ[:_FIRST] = True
    smaller = np.ones(size, bool)
    smaller[:-1] = t[:-1] < t[1:]
    smaller[ends] = smaller[:_FIRST] = True
    place = np.where(differ, np.arange(size), size)
    is_s = smaller[np.minimum.accumulate(place[::-1])[::-1]]
    leftmost = np.zeros(size, bool)
    leftmost[1:] = is_s[1:] & ~is_s[:-1]
    leftmost[ends] = True
    is_l = ~is_s
    inducible_s = is_s.copy()
    inducible_s[ends] = inducible_s[:_FIRST] = False

    shard = np.repeat(np.arange(len(lengths)), lengths)
    alphabet = np.maximum.reduceat(t[_FIRST:], base - _FIRST) + 1
    bucket = np.zeros(size, np.int32)
    bucket[_FIRST:] = np.concatenate([[0], np.cumsum(alphabet)[:-1]])[shard] + t[_FIRST:]
    counts = np.bincount(bucket[_FIRST:], minlength=int(alphabet.sum()))
    heads = (_FIRST + np.concatenate([[0], np.cumsum(counts)[:-1]])).astype(np.int32)
    tails = heads + counts.astype(np.int32) - 1
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left").tolist()  # shards longer than i

    def induce(order: np.ndarray) -> np.ndarray:
        """All suffixes from the leftmost S ones, which ``order`` lists by bucket."""
        sa = np.ones(size, np.int32)
        b = bucket[order]
        last = np.concatenate([b[1:] != b[:-1], [True]])
        group_end = np.flatnonzero(last)[np.cumsum(np.concatenate([[0], last[:-1]]))]
        sa[tails[b] - (group_end - np.arange(len(b)))] = order
        head, at = heads.copy(), base.copy()
        for a in active:
            p = sa[at[:a]] - 1
            p = p[is_l[p]]
            c = bucket[p]
            to = head[c]
            sa[to] = p
            head[c] = to + 1
            at[:a] += 1
        tail, at = tails.copy(), ends.copy()
        for a in active:
            p = sa[at[:a]] - 1
            p = p[inducible_s[p]]
            c = bucket[p]
            to = tail[c]
            sa[to] = p
            tail[c] = to - 1
            at[:a] -= 1
        return sa

    found = np.flatnonzero(leftmost)
    sa = induce(found[np.argsort(bucket[found], kind="stable")])
    sorted_found = sa[leftmost[sa]]

    # name the substrings from one leftmost S position to the next; equal ones share a name
    span = np.zeros(size, np.int64)
    span[found[:-1]] = np.diff(found) + 1
    span[ends] = 1
    x, y = sorted_found[:-1], sorted_found[1:]
    owner = np.zeros(size, np.int64)
    owner[_FIRST:] = shard
    new = np.ones(len(sorted_found), bool)
    alike = np.flatnonzero((span[x] == span[y]) & (owner[x] == owner[y]))
    step = 0
    while len(alike):
        alike = alike[t[x[alike] + step] == t[y[alike] + step]]
        step += 1
        done = span[x[alike]] == step
        new[1 + alike[done]] = False
        alike = alike[~done]
    per_shard = np.bincount(owner[found], minlength=len(lengths))
    starts = np.concatenate([[0], np.cumsum(per_shard)[:-1]])
    name = np.cumsum(new) - 1
    names = np.zeros(size, np.int64)
    names[sorted_found] = name - name[starts][owner[sorted_found]]
    repeated = np.flatnonzero(np.add.reduceat(new, starts) < per_shard)
    order = sorted_found
    if len(repeated):
        repeated = repeated[np.argsort(-per_shard[repeated], kind="stable")]
        inner = ranges(starts[repeated], per_shard[repeated])
        order[inner] = found[inner][suffix_arrays(names[found[inner]], per_shard[repeated])]
    return induce(order)[_FIRST:] - _FIRST


def common_prefixes(text: np.ndarray, sa: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each position, the length of the prefix that its suffix shares with the one before
    it in its shard's suffix array (0 for the first)."""
    n = len(text)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    before[sa[starts]] = -1
    at = np.arange(n)
    first = np.zeros(n, bool)
    first[starts] = True
    left = np.concatenate([[-1], text[:-1]])
    fresh = (before < 0) | first | first[before] | (left != left[before])
    prefix = np.zeros(n, np.int64)
    p = np.flatnonzero(fresh & (before >= 0))
    q, step = before[p], 0
    while len(p):
        same = text[p + step] == text[q + step]
        prefix[p[~same]] = step
        p, q = p[same], q[same]
        step += 1
    source = np.maximum.accumulate(np.where(fresh, at, 0))
    return prefix[source] - (at - source)
