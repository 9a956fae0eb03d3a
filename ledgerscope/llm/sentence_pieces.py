"""SentencePiece BPE ids of whole texts and back, by vectorised merge rounds.

The text, led by a space, is cut wherever no piece of the model holds the two
neighbouring characters: nothing can merge across such a place (a letter before a
space, a line end). The words so made are flat numpy arrays of symbols, all words
of a slice at once. A round finds each word's smallest pair rank (segmented
minimum), merges the pair's occurrences in each word from the left, and compacts
the array; words without a pair leave. An occurrence after the first is merged in
the same round only if no merge to its left made a pair that comes before it, so
the merges are those of one-at-a-time merging: best score first, then leftmost.
Characters without a piece become their bytes' pieces.

Each different word is merged once; a worker keeps the ids of those it has met
(``KEEP`` words, ``KEEP_BYTES`` of them; then it starts anew). Rounds of a word
are as many as the different ranks it merges, so a word of more than ``LONG``
symbols (unbroken text of that length) is merged from a heap instead, pair by
pair in the same order, in time n log n.

Decoding is the library's own ``decode`` on each document's ids.

Defined cases: a null or empty text is the end id alone and decodes to an empty
text; repeated rows give equal rows; an empty table gives no rows; null ids are
kept; other columns are ignored, whatever their names. A model that the rounds
don't reproduce (another kind than BPE, a normalizer, no byte pieces) is refused.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import as_text, map_arrow, slices, table, utf8
from ledgerscope.llm.tokens import vocabulary_path, with_end

KEEP, KEEP_BYTES, LONG = 400_000, 24 << 20, 4096
#: Texts by which a model is held against the library before it is used.
PROBES = ["", " ", "  a   b ", "Some words, 12 of them.\n\nNew line\t▁x", "<s> <unk> <0x41> é日本 \U0001f600 ﬁ  ", "x" * 40 + " " * 40]
_NONE = np.iinfo(np.int32).max
_LOADED: dict[str, PieceEncoder] = {}


def model_path() -> str:
    return vocabulary_path("piece_bpe_32k.model")


def encoder(path: str | None = None) -> PieceEncoder:
    """This worker's encoder for a model file."""
    path = path or model_path()
    if path not in _LOADED:
        _LOADED[path] = PieceEncoder(path)
    return _LOADED[path]


class PieceEncoder:
    def __init__(self, path: str):
        import sentencepiece

        self.lib = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i).replace("▁", " "): i for i in plain}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        scores = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)  # equal scores, equal ranks
        symbols = dict(pieces)
        for p in pieces:
            for c in p:
                symbols.setdefault(c, len(symbols) + n)  # a character that is only part of pieces
        self.n_pieces, self.width = n, 2 * n + len(symbols)
        self.char = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        pairs = {}
        for p, i in pieces.items():
            for k in range(1, len(p)):
                if (a := symbols.get(p[:k])) is not None and (b := symbols.get(p[k:])) is not None:
                    pairs[a * self.width + b] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        inner = {(a, b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        self.inner = np.array(sorted(int(self.char[ord(a)]) * self.width + int(self.char[ord(b)]) for a, b in inner), np.int64)
        self.cuts = self._byte_cuts(inner)
        self._reset()
        for i in range(len(PROBES)):
            ids, _ = self.encode(pa.array(PROBES[i : i + 1]))
            if ids.tolist() != sp.encode(PROBES[i]):
                raise ValueError(f"{path} is no byte-fallback BPE model without a normalizer")

    @staticmethod
    def _byte_cuts(inner: set[tuple[str, str]]) -> np.ndarray:
        """Whether nothing merges across two neighbouring bytes, by first * 256 + second."""
        wide = {(a if a < "\x80" else "", b if b < "\x80" else "") for a, b in inner}
        cut = np.zeros((256, 256), bool)
        for a in range(256):
            for b in range(256):
                if (a < 128 or b < 128) and (b < 128 or b >= 192):  # not within a character
                    cut[a, b] = (chr(a) if a < 128 else "", chr(b) if b < 128 else "") not in wide
        return cut.ravel()

    def _reset(self) -> None:
        self.place: dict[bytes, int] = {}
        self.held = 0
        self.ids, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``_NONE`` if it isn't a piece) and the piece."""
        key = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        made = np.where(known, self.made[at], 0)
        return np.where(known, self.rank[made], _NONE), made

    def merged(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges and their places in ``sym``; ``word`` numbers each symbol's word."""
        out_sym, out_at = [], []
        at = np.arange(len(sym))
        while len(sym):
            rank, made = np.full(len(sym), _NONE), np.zeros(len(sym), np.int32)
            near = np.flatnonzero(word[1:] == word[:-1])
            rank[near], made[near] = self._pair(sym[near], sym[near + 1])
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            done = least == _NONE
            if done.any():
                out_sym.append(sym[done])
                out_at.append(at[done])
                live = ~done
                sym, word, at, rank, made, least = sym[live], word[live], at[live], rank[live], made[live], least[live]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == least)
            # of neighbouring occurrences the first, third... counted from where their row begins
            row = np.concatenate([[True], np.diff(hit) != 1])
            since = np.arange(len(hit)) - np.flatnonzero(row)[np.cumsum(row) - 1]
            hit = hit[since % 2 == 0]
            # pairs that a merge makes, with what stands left (maybe merged itself) and right of it then
            new = made[hit]
            left = np.where(hit > 0, sym[hit - 1], -1)
            joined = np.concatenate([[False], hit[1:] == hit[:-1] + 2])
            left[joined] = new[:-1][joined[1:]]
            left[(hit == 0) | (word[hit - 1] != word[hit])] = -1
            after = np.minimum(hit + 2, len(sym) - 1)
            right = np.where((hit + 2 < len(sym)) & (word[after] == word[hit]), sym[after], -1)
            sooner = np.minimum(self._pair(left, new)[0], self._pair(new, right)[0]) <= least[hit]
            if sooner.any():  # in that word, later occurrences wait for a round of their own
                run = np.cumsum(sooner) - sooner
                begin = np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])
                hit = hit[run == run[begin][np.cumsum(begin) - 1]]
            sym[hit] = made[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            sym, word, at = sym[keep], word[keep], at[keep]
        if not out_at:
            return sym, at
        at = np.concatenate(out_at)
        order = np.argsort(at)
        return np.concatenate(out_sym)[order], at[order]

    def heaped(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long word, a merge at a time."""
        rank, made = self._pair(sym[:-1], sym[1:])
        known = np.flatnonzero(rank != _NONE)
        heap = list(zip(rank[known].tolist(), known.tolist(), (known + 1).tolist(), made[known].tolist(), sym[known].tolist(), sym[known + 1].tolist(), strict=True))
        heapify(heap)
        pairs = dict(zip(self.keys.tolist(), self.made.tolist(), strict=True))
        s, n = sym.tolist(), len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            _, i, j, new, a, b = heappop(heap)
            if s[i] != a or after[i] != j or s[j] != b:
                continue  # one of the two has been merged since
            s[i], s[j] = new, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if s[k] >= 0 and (m := pairs.get(new * self.width + s[k])) is not None:
                    heappush(heap, (int(self.rank[m]), i, k, m, new, s[k]))
            h = before[i]
            if h >= 0 and s[h] >= 0 and (m := pairs.get(s[h] * self.width + new)) is not None:
                heappush(heap, (int(self.rank[m]), h, i, m, s[h], new))
        left = np.array([i for i in range(n) if s[i] is not None])
        return np.array([s[i] for i in left.tolist()], np.int32), left

    def _learn(self, words: list[bytes]) -> None:
        """Merges words not met before and keeps their ids."""
        text = b"".join(words).decode("utf-8", "surrogatepass")
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), lengths)
        sym = self.char[code]
        key = sym[:-1].astype(np.int64) * self.width + sym[1:]
        at = np.minimum(np.searchsorted(self.inner, key), len(self.inner) - 1)
        apart = (owner[1:] != owner[:-1]) | (self.inner[at] != key) | (sym[1:] < 0) | (sym[:-1] < 0)
        seg = np.concatenate([[0], np.cumsum(apart)]) if len(sym) else np.zeros(0, np.int64)
        long = np.bincount(seg, minlength=1) > LONG if len(sym) else np.zeros(1, bool)
        short = ~long[seg]
        where = np.flatnonzero(short)
        out, place = self.merged(sym[where].copy(), seg[where])
        parts, places = [out], [where[place]]
        for k in np.flatnonzero(long):
            lo, hi = np.searchsorted(seg, [k, k + 1])
            out, place = self.heaped(sym[lo:hi])
            parts.append(out)
            places.append(place + lo)
        place = np.concatenate(places)
        order = np.argsort(place, kind="stable")
        place, out = place[order], np.concatenate(parts)[order]
        # symbols that are no piece: the bytes of their character
        count = np.ones(len(out), np.int64)
        rest = np.flatnonzero((out < 0) | (out >= self.n_pieces))
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in code[place[rest]].tolist()]
        count[rest] = [len(r) for r in raw]
        begin = np.cumsum(count) - count
        ids = np.zeros(int(count.sum()), np.int32)
        whole = np.ones(len(out), bool)
        whole[rest] = False
        ids[begin[whole]] = out[whole]
        if raw:
            flat = np.frombuffer(b"".join(raw), np.uint8)
            n = count[rest]
            ids[np.repeat(begin[rest] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = self.byte_ids[flat]
        size = np.bincount(owner[place], weights=count, minlength=len(words)).astype(np.int64)
        self.place.update(zip(words, range(len(self.start), len(self.start) + len(words)), strict=True))
        self.held += sum(map(len, words))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def _words(self, arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words of the texts, one after the other, and each text's offsets."""
        kind = pa.large_string()
        text = pc.replace_substring(as_text(arr), "▁", " ")
        empty = pc.equal(pc.binary_length(text), 0)
        text = pc.if_else(empty, text, pc.binary_join_element_wise(pa.scalar(" ", kind), text, pa.scalar("", kind)))
        data, off = utf8(text)
        begins = np.zeros(len(data), bool)
        if len(data) > 1:
            begins[1:] = self.cuts[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        begins[off[:-1][off[1:] > off[:-1]]] = True
        at = np.flatnonzero(begins)
        ends = pa.py_buffer(np.append(at, len(data)).astype(np.int64))
        words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, ends, pa.py_buffer(np.ascontiguousarray(data))])
        return words, np.searchsorted(at, off)

    def encode(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, laid end to end, and each text's offsets."""
        words, off = self._words(arr)
        coded = words.dictionary_encode()
        different = coded.dictionary.to_pylist()
        if len(self.place) > KEEP or self.held > KEEP_BYTES:
            self._reset()
        if new := [w for w in different if w not in self.place]:
            self._learn(new)
        place = np.fromiter((self.place[w] for w in different), np.int64, len(different))[np.asarray(coded.indices, np.int64)]
        size = self.size[place]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.start[place] - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[off]


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, end: bool = True) -> DataFrame:
    """(doc_id, ids array<int>) of every row; ``end`` appends the model's end id."""

    def run(batches):
        enc = encoder(model)
        for b in slices(batches, 1, 4 << 20):
            ids, off = enc.encode(b.column(1))
            if end:
                ids, off = with_end(ids, off, enc.lib.eos_id())
            lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "ids"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(d, run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """``rows`` (doc_id, ids) with ``text``, which the library decodes; null ids decode to an empty text."""

    def run(batches):
        lib = encoder(model).lib
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                lists = [x if x is not None else [] for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lib.decode(lists, num_threads=1), pa.string())], names=["doc_id", "ids", "text"])

    rows = rows.select("doc_id", "ids")
    return map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, text string")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decoded(encoded(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
