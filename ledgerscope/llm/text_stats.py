"""Counts over whole texts, computed on Arrow buffers (numpy inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerscope.llm.common import owners, split_words, sums, utf8

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
WINDOW = 8

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_IS_PUNCT = np.isin(np.arange(256), list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
_IS_WHITE = np.isin(np.arange(256), list(WHITE))
_IS_START = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of whole numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_ids(codes: np.ndarray) -> np.ndarray:
    """Exact ids of all windows by doubling: equal ids, equal words."""
    ids, step = codes.astype(np.int64), 1
    while step < WINDOW:
        pair = ids[:-step] * (int(ids.max(initial=0)) + 1) + ids[step:]
        ids, step = np.unique(pair, return_inverse=True)[1].astype(np.int64), 2 * step
    return ids


def repeated_words(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Flags the words in a window of 8 that its own text holds twice or more."""
    n = len(codes)
    cover = np.zeros(n, bool)
    if n < WINDOW:
        return cover
    doc = owners(off)
    starts = np.flatnonzero(doc[: n - WINDOW + 1] == doc[WINDOW - 1 :])
    if not len(starts):
        return cover
    with np.errstate(over="ignore"):
        mixed, key = splitmix(codes), np.zeros(n - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            key = key * np.uint64(0xD6E8FEB86659FD93) + mixed[k : n - WINDOW + 1 + k]
        key = splitmix(key[starts]) + splitmix(doc[starts])
    order = np.argsort(key, kind="stable")
    key, at = key[order], starts[order]
    same = key[1:] == key[:-1]
    if not same.any():
        return cover
    a, b = at[:-1][same], at[1:][same]
    if (doc[a] != doc[b]).any() or any((codes[a + k] != codes[b + k]).any() for k in range(WINDOW)):
        ids = _window_ids(codes)[starts]  # two different windows with one hash: take exact ids
        order = np.lexsort((ids, doc[starts]))
        ids, at = ids[order], starts[order]
        same = (ids[1:] == ids[:-1]) & (doc[at[1:]] == doc[at[:-1]])
    hit = np.zeros(n + 1, np.int32)
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    hit[at[twice]] = 1
    ends = np.zeros(n + 1, np.int32)
    np.add.at(ends, at[twice] + WINDOW, 1)
    return np.cumsum(hit - ends)[:n] > 0


def stats(arr: pa.Array) -> dict[str, np.ndarray]:
    """Per text: counts of the contract's base rules and of the voting rules."""
    data, off = utf8(arr)
    words, woff = split_words(arr)
    coded = words.dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    out = {
        "n_words": np.diff(woff),
        "word_chars": sums((_IS_START & ~_IS_WHITE)[data].view(np.int8), off),
        "n_symbols": sums(_IS_SYMBOL[data].view(np.int8), off),
        "n_repeat_words": sums(repeated_words(codes, woff).view(np.int8), woff),
    }
    out["n_upper"] = sums(((data >= 65) & (data <= 90)).view(np.int8), off)
    out["n_lower"] = sums(((data >= 97) & (data <= 122)).view(np.int8), off)
    out["n_punct"] = sums(_IS_PUNCT[data].view(np.int8), off)
    lines, dups, closed = [], [], []
    for text in arr.to_pylist():
        full = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        lines.append(len(full))
        dups.append(len(full) - len(set(full)))
        closed.append(sum(x.rstrip(" \t\x0b\x0c\r").endswith((".", "!", "?", ":", ";", '"', "…", "。")) for x in full))
    out |= {"n_lines": np.array(lines, np.int64), "n_dup_lines": np.array(dups, np.int64), "n_closed_lines": np.array(closed, np.int64)}
    key = np.unique(owners(woff) * max(1, len(coded.dictionary)) + codes) // max(1, len(coded.dictionary))
    out["n_distinct_words"] = np.bincount(key, minlength=len(arr)).astype(np.int64)
    # words without a letter or digit, judged once for each different word
    wdata, wo = utf8(coded.dictionary)
    alnum = ((wdata >= 48) & (wdata <= 57)) | ((wdata >= 65) & (wdata <= 90)) | ((wdata >= 97) & (wdata <= 122)) | (wdata >= 128)
    bare = sums(alnum.view(np.int8), wo) == 0
    out["n_bare_words"] = sums(bare[codes].view(np.int8), woff)
    return out
