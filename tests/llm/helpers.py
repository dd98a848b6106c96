"""Brute-force versions of the operators, over lists of rows."""

import collections
import hashlib
import re

import numpy as np
import xxhash


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(count, linked):
    """The smallest number each of ``count`` nodes reaches; ``linked`` gives a boolean row for a range of nodes."""
    label = np.arange(count)
    while True:
        new = np.concatenate(
            [np.where(linked(a, min(a + 500, count)), label[None, :], count).min(1) for a in range(0, count, 500)]
        ) if count else label
        new = np.minimum(new, label)
        if (new == label).all():
            return label
        label = new


def removals(rows, length):
    docs = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(d[p : p + length] for _, d in docs for p in range(len(d) - length + 1))
    out = []
    for i, d in docs:
        cover = np.zeros(len(d) + 2, int)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover[: len(d)]) > 0
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(d) else 0
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((i, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def tiles(item, text, least):
    free_item, free_text, out = [1] * len(item), [1] * len(text), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and free_item[i + n] and free_text[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        out.append((i, j, n))
        free_item[i : i + n] = free_text[j : j + n] = [0] * n
