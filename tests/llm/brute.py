"""Plain-Python versions of the contracts, for small tables."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Awkward texts: (text,) of None, empty, white space, ties, repeats, other scripts, very long.
ODD = [None, "", "   \n\t ", "a", "A a A a", "one two three four five six seven eight nine ten " * 3, "x" * 50_000, "the end. " * 4_000, "é ñ 日本 語", "line\nline\nline\n\n", "#$% <|endoftext|> & | a  b   c \n d", "12 34 4111 1111 1111 1111 a@b.co +1 (212) 555-0100 10.0.0.1"]


class Union:
    def __init__(self, n):
        self.p = list(range(n))

    def find(self, x):
        while self.p[x] != x:
            self.p[x] = self.p[self.p[x]]
            x = self.p[x]
        return x

    def join(self, a, b):
        self.p[self.find(a)] = self.find(b)

    def lowest(self, ids):
        low = {}
        for i, v in enumerate(ids):
            r = self.find(i)
            low[r] = min(low.get(r, v), v)
        return [low[self.find(i)] for i in range(len(ids))]


def fingerprint(text, shingle=4, seed=42):
    w = WORD.findall((text or "").translate(UPPER))
    sh = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    cover = set()
    for k in range(len(w) - 7):
        if seen[tuple(w[k : k + 8])] > 1:
            cover.update(range(k, k + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover)


def near_vectors(ids, x, labels, least=0.98):
    x = np.array(x, float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    u, n = Union(len(ids)), np.zeros(len(ids), int)
    for i in range(len(ids)):
        for j in range(len(ids)):
            if i != j and labels[i] == labels[j] and x[i] @ x[j] >= least:
                n[i] += 1
                u.join(i, j)
    return n.tolist(), u.lowest(ids)
