"""Suffix arrays by induced sorting, and permuted common prefixes from them, in numpy."""

from __future__ import annotations

import numpy as np

DENSE = 100  # symbols per bucket from which whole buckets are worth handling at once


def suffix_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one is not, as the end is smaller than all."""
    step = np.sign(np.diff(text, append=-1).astype(np.int64))
    # A run of equal symbols has the type of its end.
    ends = np.where(step != 0, np.arange(len(text)), len(text))
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    return step[ends] > 0


def induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, given the leftmost smaller ones in order: larger ones from the left, smaller from the right.

    A bucket is handled in rounds, each a whole batch: what it puts into its own
    bucket is the next round, what it puts into others waits there in order.
    """
    starts = np.searchsorted(text[lms], np.arange(symbols + 1)) if len(lms) else np.zeros(symbols + 1, int)
    large: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    little: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    end = len(text) - 1
    large[text[end]].append(np.array([end]))  # comes from the empty suffix, before all others

    def spread(batch: np.ndarray, wanted: bool, into: list[list[np.ndarray]], own: int) -> np.ndarray:
        before = batch[batch > 0] - 1
        before = before[small[before] == wanted]
        heads = text[before]
        here = heads == own
        others, heads = before[~here], heads[~here]
        if len(others):
            order = np.argsort(heads, kind="stable")
            others, heads = others[order], heads[order]
            cuts = np.flatnonzero(np.diff(heads)) + 1
            for head, part in zip(heads[np.concatenate([[0], cuts])].tolist(), np.split(others, cuts), strict=True):
                into[head].append(part)
        return before[here]

    def rounds(batch: np.ndarray, wanted: bool, into: list[list[np.ndarray]], own: int) -> None:
        while len(batch := spread(batch, wanted, into, own)):
            into[own].append(batch)

    for symbol in range(symbols):
        if large[symbol]:
            rounds(np.concatenate(large[symbol]), False, large, symbol)
        if starts[symbol] < starts[symbol + 1]:
            spread(lms[starts[symbol] : starts[symbol + 1]], False, large, symbol)
    for symbol in range(symbols - 1, -1, -1):  # backwards: each bucket's last suffix comes first
        if little[symbol]:
            rounds(np.concatenate(little[symbol]), True, little, symbol)
        if large[symbol]:
            spread(np.concatenate(large[symbol])[::-1], True, little, symbol)
    parts = []
    for symbol in range(symbols):
        parts += large[symbol]
        if little[symbol]:
            parts.append(np.concatenate(little[symbol])[::-1])
    return np.concatenate(parts)


def induce_sparse(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The same one suffix at a time, for alphabets with few suffixes per symbol."""
    n = len(text)
    counts = np.bincount(text, minlength=symbols)
    tails, heads = np.cumsum(counts), np.cumsum(counts) - counts
    chars, is_small = text.tolist(), small.tolist()
    order = [-1] * n
    tail = tails.tolist()
    for i in reversed(lms.tolist()):
        tail[chars[i]] -= 1
        order[tail[chars[i]]] = i
    head = heads.tolist()
    order_head = head[chars[-1]]
    head[chars[-1]] += 1
    pending = n - 1  # comes from the empty suffix
    order[order_head] = pending
    for i in range(n):
        j = order[i] - 1
        if j >= 0 and not is_small[j]:
            c = chars[j]
            order[head[c]] = j
            head[c] += 1
    tail = tails.tolist()
    for i in range(n - 1, -1, -1):
        j = order[i] - 1
        if j >= 0 and is_small[j]:
            c = chars[j]
            tail[c] -= 1
            order[tail[c]] = j
    return np.array(order)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of the suffixes of a text of small numbers, in order. The end is smaller than every symbol."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    symbols = int(text.max()) + 1
    small = suffix_types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    work = induce if n >= DENSE * symbols else induce_sparse
    if not len(lms):
        return work(text, small, lms, symbols)
    guess = lms[np.argsort(text[lms], kind="stable")]
    order = work(text, small, guess, symbols)
    # The leftmost smaller substrings are in order now; equal ones get one name.
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ranked = order[is_lms[order]]
    place = np.empty(n, np.int64)
    place[lms] = np.arange(len(lms))
    stop = np.append(lms[1:], n - 1)
    length = stop - lms + 1
    at = place[ranked]
    same = (length[at][1:] == length[at][:-1]) & (at[1:] != len(lms) - 1) & (at[:-1] != len(lms) - 1)
    pairs = np.flatnonzero(same)
    if len(pairs):
        sizes = length[at[pairs]]
        first = np.cumsum(sizes) - sizes
        offset = np.arange(sizes.sum()) - np.repeat(first, sizes)
        a, b = np.repeat(ranked[pairs], sizes) + offset, np.repeat(ranked[pairs + 1], sizes) + offset
        same[pairs] = np.logical_and.reduceat(text[a] == text[b], first)
    names = np.concatenate([[0], np.cumsum(~same)])
    reduced = np.empty(len(lms), np.int64)
    reduced[at] = names
    if names[-1] + 1 < len(lms):
        ranked = lms[suffix_array(reduced)]
    return work(text, small, ranked, symbols)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Per position in the text, how many symbols its suffix shares with the one before it in order.

    Where the symbols to the left of both are equal, the value is one less than
    that of the position before, so only the others are compared.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    reducible = (at > 0) & (before > 0)
    reducible[reducible] = text[at[reducible] - 1] == text[before[reducible] - 1]
    # That must be the same pair moved by one, which holds if the pair to the left are neighbours in order too.
    reducible[1:] &= before[:-1] == before[1:] - 1
    values = np.zeros(n, np.int64)
    active = np.flatnonzero(~reducible & (before >= 0))
    step, padded = 8, np.concatenate([text, np.full(256, -1, text.dtype)])
    ends = np.arange(256)
    while len(active):
        a, b = active + values[active], before[active] + values[active]
        left, right = padded[a[:, None] + ends[:step]], padded[b[:, None] + ends[:step]]
        differ = (left != right) | (left < 0)
        some = differ.any(1)
        values[active] += np.where(some, differ.argmax(1), step)
        active, step = active[~some], min(step * 2, 256)
    source = np.maximum.accumulate(np.where(reducible, 0, at))
    return np.maximum(values[source] - (at - source), 0)


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` symbols from each position on also start at another one."""
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    after = np.zeros(len(text), np.int64)
    after[order[:-1]] = shared[order[1:]]
    return np.maximum(shared, after) >= length
