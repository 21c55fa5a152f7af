"""Two-stage suffix sorting with numpy.

A suffix that is smaller than its successor is sorted directly; the others follow from a scan of
the buckets of first bytes: the predecessor of each suffix in turn, if it is larger, takes the next
place of its own bucket. Only the order of the first ``depth`` bytes is settled.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, whose order is that of the bytes."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    n = len(text)
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + n]
    return out


def rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the empty suffix is the smallest."""
    n = len(text)
    following = np.concatenate([text[1:], np.zeros(1, np.uint8)])
    differs = np.flatnonzero(text != following)
    # Equal bytes take the answer of the next place where two bytes differ.
    at = np.searchsorted(differs, np.arange(n))
    end = at == len(differs)
    place = differs[np.minimum(at, max(0, len(differs) - 1))] if len(differs) else np.zeros(n, np.int64)
    return ~end & (text[place] < following[place])


def directly_sorted(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The places in the order of the bytes from there on, eight at a time."""
    last = len(words) - 1

    def word(p: np.ndarray, k: int) -> np.ndarray:
        at = p + 8 * k
        return np.where(at <= last, words[np.minimum(at, last)], 0)

    out = places[np.argsort(words[places], kind="stable")]
    open_, w = np.arange(len(out)), words[out]
    group = np.zeros(len(out), np.int64)
    for k in range(1, -(-depth // 8) + 1):
        # Only places that share all their bytes so far with another one go on.
        starts = np.r_[True, (group[1:] != group[:-1]) | (w[1:] != w[:-1])][: len(w)]
        alone = starts & np.r_[starts[1:], True][: len(w)]
        group = np.cumsum(starts)[~alone]
        open_ = open_[~alone]
        if not len(open_) or 8 * k >= depth:
            break
        w = word(out[open_], k)
        head = np.r_[True, group[1:] != group[:-1]]
        unlike = w != w[np.maximum.accumulate(np.where(head, np.arange(len(w)), 0))]
        torn = np.zeros(int(group[-1]) + 1, bool)
        torn[group[unlike]] = True
        move = torn[group]
        if move.any():
            order = np.lexsort((w[move], group[move]))
            out[open_[move]] = out[open_[move]][order]
            w[move] = w[move][order]
    return out


def suffix_order(text: np.ndarray, wanted: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The places marked ``wanted`` in the order of the suffixes that start there."""
    n = len(text)
    is_rising = rising(text)
    # The larger suffixes need their successors, up to the first that is sorted directly.
    needed = wanted.copy()
    falls = np.flatnonzero(wanted & ~is_rising & ~np.r_[wanted[1:], True])
    stops = np.flatnonzero(is_rising)
    until = np.searchsorted(stops, falls)
    until = np.where(until < len(stops), np.r_[stops, n][until], n - 1)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, falls, 1)
    np.add.at(change, until + 1, -1)
    needed |= np.cumsum(change)[:n] > 0

    direct = directly_sorted(np.flatnonzero(needed & is_rising), words, depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    buckets: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and needed[n - 1] and not is_rising[n - 1]:
        # The last suffix follows from the empty one, which comes before all others.
        buckets[text[n - 1]].append(np.array([n - 1]))

    def before(places: np.ndarray) -> np.ndarray:
        p = places[places > 0] - 1
        return p[needed[p] & ~is_rising[p]]

    def deal(places: np.ndarray) -> None:
        first = text[places]
        order = np.argsort(first, kind="stable")
        places, first = places[order], first[order]
        cuts = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else []
        for a, b in zip(cuts, [*cuts[1:], len(first)]):
            buckets[first[a]].append(places[a:b])

    out = []
    for byte in range(256):
        queue = np.concatenate(buckets[byte]) if buckets[byte] else np.zeros(0, np.int64)
        while len(queue):
            out.append(queue)
            p = before(queue)
            own = text[p] == byte
            deal(p[~own])
            queue = p[own]
        part = direct[bounds[byte] : bounds[byte + 1]]
        if len(part):
            out.append(part)
            deal(before(part))
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes, up to ``depth``, each place shares with the one before it in the order."""
    shared = np.zeros(len(order), np.int64)
    going = np.arange(1, len(order))
    last = len(words) - 1
    for k in range(-(-depth // 8)):
        if not len(going):
            break
        a, b = order[going] + 8 * k, order[going - 1] + 8 * k
        x = np.where(a <= last, words[np.minimum(a, last)], 0) ^ np.where(b <= last, words[np.minimum(b, last)], 0)
        partly = x != 0
        y, bytes_ = x[partly], np.zeros(int(partly.sum()), np.int64)
        for j in range(1, 8):
            bytes_ += (y >> np.uint64(64 - 8 * j)) == 0
        shared[going[partly]] = 8 * k + bytes_
        going = going[~partly]
        shared[going] = 8 * (k + 1)
    return np.minimum(shared, depth)
