"""Token ids of whole texts by the tokenizers library, each different chunk encoded once.

The byte-level pattern of the vocabulary never joins a space to the characters
before it unless white space stands there. So a text without a space after white
space is cut before each space, and the ids of the chunks, laid end to end, are
the ids of the text. Chunks repeat, and a worker keeps the ids of those it has
met (some KEEP of them, 45 bytes each; then it starts anew). Texts of any other kind are
encoded as they are.
"""

from __future__ import annotations

import json
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from ledgerscope.llm.common import as_text, sums

KEEP, PIECES = 2_000_000, 350_000
#: White space of any kind (Unicode and the ASCII separators), then a space.
_UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    itself if printable in Latin-1, else the next one from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTES = _byte_letters()
_LOADED: dict[str, ChunkTokenizer] = {}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str | None = None) -> ChunkTokenizer:
    """This worker's tokenizer for a vocabulary file."""
    path = path or vocabulary_path()
    if path not in _LOADED:
        _LOADED[path] = ChunkTokenizer(path)
    return _LOADED[path]


def forget() -> None:
    _LOADED.clear()


class ChunkTokenizer:
    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        import public_tokenizers
        import regex

        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        self.pattern = regex.compile(public_tokenizers.PATTERN).findall
        plain = json.loads(Path(path).read_text())
        # pieces are taken by hand only for a byte-level vocabulary without a normalizer or prefix space
        byte_level = plain.get("normalizer") is None and (plain.get("pre_tokenizer") or {}) | {"trim_offsets": 0} == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": 0, "use_regex": True}
        self.simple = regex.compile(r"[\n\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u024f]*").fullmatch if byte_level else (lambda c: False)
        self._reset()

    def _reset(self) -> None:
        self.piece: dict[str, tuple[int, ...]] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.check = np.zeros(0, np.uint64)  # by place: second half of the chunk's hash
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        # first halves, sorted, with their places: the bulk, and what came lately
        self.bulk = (np.zeros(0, np.uint64), np.zeros(0, np.int32))
        self.late = (np.zeros(0, np.uint64), np.zeros(0, np.int32))

    def _by_pieces(self, chunks: list[str]) -> tuple[list[int], list[int]]:
        """Ids of chunks of plain characters, end to end, and how many each has: the
        vocabulary's own pattern, then the library's model on each piece not met before."""
        ids: list[int] = []
        sizes: list[int] = []
        if len(self.piece) > PIECES:
            self.piece.clear()
        split, known, kept, tokens = self.pattern, self.piece.get, self.piece, self.model.tokenize
        for chunk in chunks:
            before = len(ids)
            for piece in split(chunk):
                got = known(piece)
                if got is None:
                    got = kept[piece] = tuple([t.id for t in tokens(piece.encode().decode("latin-1").translate(_BYTES))])
                ids += got
            sizes.append(len(ids) - before)
        return ids, sizes

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> np.ndarray:
        """Encodes and keeps chunks not met before; their places."""
        if self.simple("".join(chunks)):
            ids, counts = self._by_pieces(chunks)
        else:
            new = [e.ids for e in self.lib.encode_batch_fast(chunks, add_special_tokens=False)]
            ids, counts = list(chain.from_iterable(new)), list(map(len, new))
        sizes, flat = np.array(counts, np.int32), np.array(ids, np.uint32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        places = np.arange(len(self.start), len(self.start) + len(sizes), dtype=np.int32)
        self.start = np.concatenate([self.start, self.used + np.cumsum(sizes, dtype=np.int64) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.check = np.concatenate([self.check, keys[:, 1]])
        self.used += len(flat)
        first = np.concatenate([self.late[0], keys[:, 0]])
        order = np.argsort(first, kind="stable")
        self.late = (first[order], np.concatenate([self.late[1], places])[order])
        if len(self.late[0]) > 10_000 + len(self.bulk[0]) // 4:
            first = np.concatenate([self.bulk[0], self.late[0]])
            order = np.argsort(first, kind="stable")
            self.bulk = (first[order], np.concatenate([self.bulk[1], self.late[1]])[order])
            self.late = (np.zeros(0, np.uint64), np.zeros(0, np.int32))
        return places

    def _places(self, words: list[bytes], head: bool) -> np.ndarray:
        """Places of different chunks (``head``: without a space before them);
        learns the new ones. Chunks are told apart by a 128-bit hash."""
        hash128 = xxhash.xxh3_128_digest
        keys = np.frombuffer(b"".join([hash128(w, head) for w in words]), ">u8").astype(np.uint64).reshape(-1, 2)
        out = np.full(len(words), -1, np.int64)
        for known, place in (self.bulk, self.late):
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[:, 0]), len(known) - 1)
                hit = (known[at] == keys[:, 0]) & (self.check[place[at]] == keys[:, 1])
                out[hit] = place[at[hit]]
        missing = np.flatnonzero(out < 0)
        if len(missing):
            space = "" if head else " "
            chunks = [space + words[i].decode() for i in missing]
            plain = np.array([self.simple(c) is not None for c in chunks]) if not self.simple("".join(chunks)) else np.ones(len(chunks), bool)
            for some in (plain, ~plain):
                if some.any():
                    out[missing[some]] = self._learn(keys[missing[some]], [c for c, x in zip(chunks, some.tolist(), strict=True) if x])
        return out

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """uint32 ids of all texts (null: empty) and each text's offsets."""
        arr = as_text(arr)
        if not len(arr):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        odd = np.asarray(pc.match_substring_regex(arr, _UNSAFE))
        special = np.asarray(pc.match_substring(arr, "<|"))  # may name a special token, which no chunk may split
        plain = ~(odd | special)
        if not plain.any():
            ids, sizes = self._whole(arr.to_pylist())
        else:
            if len(self.start) > KEEP:
                self._reset()
            kept = arr if plain.all() else arr.filter(pa.array(plain))
            lists = pc.split_pattern(kept, " ")
            off = np.asarray(lists.offsets, dtype=np.int64)
            values = lists.values.slice(off[0], off[-1] - off[0])
            off = off - off[0]
            coded = values.dictionary_encode()
            codes = np.asarray(coded.indices)
            words = coded.dictionary.cast(pa.large_binary()).to_pylist()
            later = np.ones(len(codes), bool)
            later[off[:-1]] = False
            need = np.zeros(len(words), bool)
            need[codes[later]] = True
            place = np.full(len(words), -1, np.int64)
            place[need] = self._places([words[i] for i in np.flatnonzero(need)], False)
            slots = place[codes]
            heads = np.unique(codes[off[:-1]])
            place[heads] = self._places([words[i] for i in heads], True)
            slots[off[:-1]] = place[codes[off[:-1]]]
            per = self.size[slots].astype(np.int64)
            ends = np.cumsum(per)
            ids = self.ids[np.repeat(self.start[slots] - ends + per, per) + np.arange(int(ends[-1]))]
            sizes = sums(per, off)
            if not plain.all():
                rest, more = self._whole(arr.filter(pa.array(~plain)).to_pylist())
                ids, sizes = _merged(plain, ids, sizes, rest, more)
        return ids, np.concatenate([[0], np.cumsum(sizes)])

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(e.ids, np.uint32) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *got]), np.array([len(g) for g in got], np.int64)


def _merged(plain: np.ndarray, a: np.ndarray, an: np.ndarray, b: np.ndarray, bn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of two groups of texts in the texts' own order."""
    sizes = np.zeros(len(plain), np.int64)
    sizes[plain], sizes[~plain] = an, bn
    ids = np.zeros(int(sizes.sum()), np.uint32)
    mine = np.repeat(plain, sizes)
    ids[mine], ids[~mine] = a, b
    return ids, sizes


def with_end(ids: np.ndarray, off: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text's."""
    n = len(off) - 1
    out = np.full(len(ids) + n, end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(off))] = ids
    return out, off + np.arange(n + 1)
