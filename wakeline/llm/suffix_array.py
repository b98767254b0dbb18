"""Two-stage suffix sorting of many short byte strings, to a fixed depth, and what repeats in them."""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor. t ends with its only smallest symbol."""
    n = len(t)
    less = np.empty(n, bool)
    less[:-1] = t[:-1] < t[1:]
    less[-1] = True
    # equal neighbours take the type of the next place where they differ
    same = np.flatnonzero(t[:-1] == t[1:])
    if len(same):
        differs = np.append(np.flatnonzero(t[:-1] != t[1:]), n - 1)
        less[same] = less[differs[np.searchsorted(differs, same)]]
    return less


def _packed(t: np.ndarray, bits: int, m: int) -> np.ndarray:
    """Of each place, the m symbols from there on as one number; zeros follow the end."""
    word = np.zeros(len(t), np.int64)
    for k in range(m):
        word <<= bits
        if k < len(t):
            word[: len(t) - k] |= t[k:]
    return word


def _sorted_directly(words: np.ndarray, at: np.ndarray, m: int, depth: int) -> np.ndarray:
    """The suffixes at these places in the order of their first depth symbols, a word at a time."""
    n = len(words)
    order = at[np.argsort(words[at], kind="stable")]
    done, lo, hi = m, np.zeros(1, np.int64), np.array([len(order)])
    key = words[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    while done < depth:
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(order))
        tied = np.flatnonzero(np.repeat(hi - lo > 1, hi - lo))
        if not len(tied):
            break
        group = (np.cumsum(new) - 1)[tied]
        place = order[tied] + done
        key = np.where(place < n, words[np.minimum(place, n - 1)], 0)
        by = np.lexsort((key, group))
        order[tied] = order[tied][by]
        key = key[by]  # groups stay where they were, as lexsort keeps them in order
        new[tied] = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        done += m
    return order


def suffix_array(t: np.ndarray, depth: int, words: np.ndarray, m: int) -> np.ndarray:
    """Places of t in the order of their suffixes' first depth symbols.

    Only suffixes smaller than their successors are sorted directly. The rest are induced: buckets are
    scanned from the smallest first symbol on, and the place before each sorted suffix goes to the end of
    the larger part of its own bucket.
    """
    small = _types(t)
    at = np.flatnonzero(small)
    direct = _sorted_directly(words, at, m, depth)
    top = int(t.max()) + 1
    ends = np.searchsorted(t[direct], np.arange(top + 1))  # direct is in the order of first symbols
    waiting: list[list[np.ndarray]] = [[] for _ in range(top)]
    out: list[np.ndarray] = []

    def induce(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return
        symbol = t[before]
        by = np.argsort(symbol, kind="stable")
        before, symbol = before[by], symbol[by]
        cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for part in np.split(before, cuts):
            waiting[t[part[0]]].append(part)

    for c in range(top):
        while waiting[c]:  # places before one another in a run of the same symbol come wave by wave
            wave = np.concatenate(waiting[c])
            waiting[c] = []
            out.append(wave)
            induce(wave)
        own = direct[ends[c] : ends[c + 1]]
        if len(own):
            out.append(own)
            induce(own)
    return np.concatenate(out)


def repeated_starts(pieces: list[bytes], length: int, times: np.ndarray | None = None) -> list[np.ndarray]:
    """For each piece, the starts of its strings of that length that also start elsewhere in the pieces.

    times: how often each piece is there (else once).
    """
    if not pieces:
        return []
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    first = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)]).astype(np.int64)
    used, symbols = np.unique(data, return_inverse=True)
    t = np.ones(int(sizes.sum()) + len(pieces) + 1, np.int64)  # 1 stands between pieces, 0 at the end
    inside = np.arange(len(data)) + np.repeat(np.arange(len(pieces)), sizes)
    t[inside] = symbols + 2
    t[-1] = 0
    bits = int(len(used) + 2).bit_length()
    m = min(62 // bits, length)
    words = _packed(t, bits, m)
    sa = suffix_array(t, length, words, m)
    left = np.zeros(len(t), np.int64)  # symbols up to the end of the piece
    left[inside] = np.repeat(first + sizes, sizes) - inside
    # adjacent common prefixes, as far as the length asked for: equal strings are runs of sa
    sa = sa[left[sa] >= length]
    a, b = sa[:-1], sa[1:]
    alive = np.arange(len(a))
    for at in [*range(0, length - m, m), length - m]:
        alive = alive[words[a[alive] + at] == words[b[alive] + at]]
    new = np.ones(len(sa), np.int64)
    new[alive + 1] = 0
    run = np.cumsum(new) - 1
    weight = np.zeros(len(t), np.int64)
    weight[inside] = 1 if times is None else np.repeat(np.minimum(times, 2), sizes)  # two will do, and sums stay small
    again = np.zeros(len(t), bool)
    again[sa] = np.bincount(run, weight[sa])[run] > 1 if len(sa) else False
    return [np.flatnonzero(again[f : f + n]) for f, n in zip(first.tolist(), sizes.tolist(), strict=True)]
