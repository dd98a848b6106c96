"""Suffix arrays by induced sorting, and permuted common prefixes, for one string in memory."""

from __future__ import annotations

import numpy as np

from rowgate.llm.text import ragged


def classify(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one. The last symbol is the smallest and stands there only."""
    n = len(text)
    edge = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    smaller = np.append(text[edge[:-1]] < text[edge[:-1] + 1], True)
    return np.repeat(smaller, np.diff(np.append(-1, edge)))[:n]


def _induce_by_bucket(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array from sorted leftmost-smaller positions: buckets in turn, whole runs of a bucket at a time."""
    size = np.bincount(text, minlength=symbols)
    large = np.bincount(text[~small], minlength=symbols)
    end = np.cumsum(size)
    begin = end - size
    out = np.full(len(text), -1, np.int64)
    first = text[lms]
    count = np.bincount(first, minlength=symbols)
    starts = end - count
    out[starts[first] + np.arange(len(lms)) - np.repeat(np.cumsum(count) - count, count)] = lms

    def push(sources: np.ndarray, at: np.ndarray, step: int, want_small: bool) -> None:
        before = sources - 1
        before = before[before >= 0]
        before = before[small[before] == want_small]
        if not len(before):
            return
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        some, lead, many = np.unique(symbol, return_index=True, return_counts=True)
        place = np.arange(len(before)) - np.repeat(lead, many)
        out[at[symbol] + step * place] = before
        at[some] += step * many

    head = begin.copy()
    for c in range(symbols):
        i = begin[c]
        while i < head[c]:
            stop = head[c]
            push(out[i:stop], head, 1, False)
            i = stop
        if count[c]:
            push(out[starts[c] : end[c]], head, 1, False)
    tail = end - 1
    for c in range(symbols - 1, -1, -1):
        i = end[c] - 1
        while i > tail[c]:
            stop = tail[c]
            push(out[stop + 1 : i + 1][::-1], tail, -1, True)
            i = stop
        if large[c]:
            push(out[begin[c] : begin[c] + large[c]][::-1], tail, -1, True)
    out[0] = len(text) - 1
    return out


def _induce_by_suffix(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The same for large alphabets, one suffix at a time."""
    size = np.bincount(text, minlength=symbols)
    end = np.cumsum(size)
    t, s = text.tolist(), small.tolist()
    out = [-1] * len(t)
    tail = end.tolist()
    for j in lms[::-1].tolist():
        tail[t[j]] -= 1
        out[tail[t[j]]] = j
    head = (end - size).tolist()
    for i in range(len(t)):
        j = out[i] - 1
        if j >= 0 and not s[j]:
            c = t[j]
            out[head[c]] = j
            head[c] += 1
    tail = end.tolist()
    for i in range(len(t) - 1, -1, -1):
        j = out[i] - 1
        if j >= 0 and s[j]:
            c = t[j]
            tail[c] -= 1
            out[tail[c]] = j
    out[0] = len(t) - 1
    return np.array(out, np.int64)


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Start of each suffix in sorted order. The last symbol must be 0 and stand nowhere else.

    Suffixes are classified as smaller or larger than the next. The substrings between leftmost-smaller places are
    sorted by inducing, named, and their string of names is sorted recursively; from that order all suffixes follow.
    """
    if len(text) == 1:
        return np.zeros(1, np.int64)
    induce = _induce_by_bucket if symbols <= 512 else _induce_by_suffix
    small = classify(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    by_symbol = lms[np.argsort(text[lms], kind="stable")]
    rough = induce(text, small, by_symbol, symbols)
    starts = np.zeros(len(text), bool)
    starts[lms] = True
    ordered = rough[starts[rough]]
    # Neighbours in this order get the same name if their substrings, up to the next such place, are equal.
    size = np.zeros(len(text), np.int64)
    size[lms] = np.append(np.diff(lms), 0) + 1
    a, b = ordered[:-1], ordered[1:]
    same = size[a] == size[b]
    spots = np.flatnonzero(same)
    if len(spots):
        lengths = size[a[spots]]
        equal = text[ragged(a[spots], lengths)] == text[ragged(b[spots], lengths)]
        same[spots] = np.logical_and.reduceat(equal, np.cumsum(lengths) - lengths)
    name = np.zeros(len(text), np.int64)
    name[ordered] = np.append(0, np.cumsum(~same))
    names = name[lms]
    different = int(names.max()) + 1
    if different == len(lms):
        order = np.argsort(names)
    else:
        order = suffix_array(names, different)
    return induce(text, small, lms[order], symbols)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """By place in ``text``: the common prefix of its suffix with the one before it in ``order`` (0 for the first).

    Where the symbols before the two suffixes are equal, the prefix is one shorter than at the place before; only at
    the other places symbols are compared.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    follows = (place > 0) & (before > 0)
    follows[follows] = text[place[follows] - 1] == text[before[follows] - 1]
    compare = np.flatnonzero(~follows & (before >= 0))
    padded = np.append(text, np.full(16, -1, text.dtype if text.dtype.kind == "i" else np.int64))
    prefix = np.zeros(n, np.int64)
    step = np.arange(16)
    for i in range(0, len(compare), 1 << 16):
        at = compare[i : i + (1 << 16)]
        done = 0
        while len(at):
            # Two different suffixes differ at the end of the text at the latest.
            equal = padded[at[:, None] + done + step] == padded[before[at][:, None] + done + step]
            many = np.where(equal.all(1), 16, equal.argmin(1))
            prefix[at] += many
            at = at[many == 16]
            done += 16
    start = np.where(follows, -1, place)
    start = np.maximum.accumulate(start)
    return np.maximum(prefix[start] - (place - start), 0)
