"""Language identification by rank-order profiles.

A profile is a language's most frequent letter n-grams (1 to 3 letters, words
padded by a border mark) in rank order, counted over all training texts. A
document's own most frequent n-grams, of its whole text, are compared to each
profile by out-of-place distance: the sum of rank differences, an n-gram that
the profile lacks counting as the full profile length. The nearest language
wins, the first by code point where two are as near.

The score is 1 - distance / (n-grams compared * profile length). Ties in
frequency go by n-gram, in code point order.

Defined cases: null, empty and letterless texts are ``und`` with score 0; rows
without a lang teach nothing; with nothing learned all are ``und``; repeated rows
get equal results and count as often as they come; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import as_text, fold, map_arrow, slices, table

TOP, UNKNOWN = 300, "und"
SLICE = 3 << 19  # bytes of text worked on at a time; some hundred bytes of arrays for each
_BITS = 21
_PAD = (1 << _BITS) - 1  # after an n-gram of fewer than three letters; 0 is a word's border


@lru_cache(1)
def _letters() -> np.ndarray:
    """Each code point's lower-case letter, or 0."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            out[c] = ord(x.lower()[0])
    return out


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Alphabet (with the border mark), n-gram codes and their rows, and the
    packed n-gram of each code, ascending: codes are in n-gram order."""
    n_chars = np.array([len(t) for t in texts], np.int64)
    cp = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(texts), dtype=np.int32), n_chars + 1)[: len(cp)]
    x = _letters()[cp]
    keep = x != 0
    border = ~keep
    border[1:] &= keep[:-1]  # one border after each word
    if len(border):
        border[0] = False
    pick = keep | border
    x, row = x[pick], row[pick]
    first = np.concatenate([[True], row[1:] != row[:-1]]) if len(x) else np.zeros(0, bool)
    # a border before each text's first word, one after its last
    at = np.flatnonzero(first & (x != 0))
    x, row = np.insert(x, at, 0), np.insert(row, at, row[at])
    ends = np.flatnonzero(np.concatenate([row[1:] != row[:-1], [True]]) & (x != 0)) if len(x) else np.zeros(0, np.int64)
    x, row = np.insert(x, ends + 1, 0), np.insert(row, ends + 1, row[ends])
    seen = np.zeros(0x110000, bool)
    seen[x] = True
    seen[0] = True
    alphabet = np.flatnonzero(seen)
    dense = np.zeros(0x110000, np.int64)
    dense[alphabet] = np.arange(len(alphabet))
    c = dense[x]
    base = len(alphabet) + 1
    pad = base - 1
    solid = x != 0
    one = np.flatnonzero(solid)
    parts = [((c[one] * base + pad) * base + pad, row[one])]
    if len(x) > 1:
        two = np.flatnonzero((row[1:] == row[:-1]) & (solid[1:] | solid[:-1]))
        parts.append(((c[two] * base + c[two + 1]) * base + pad, row[two]))
    if len(x) > 2:
        three = np.flatnonzero((row[2:] == row[:-2]) & solid[1:-1])
        parts.append(((c[three] * base + c[three + 1]) * base + c[three + 2], row[three]))
    key, who = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    if base**3 <= 1 << 25:
        have = np.zeros(base**3, bool)
        have[key] = True
        kinds = np.flatnonzero(have)
        place = np.cumsum(have, dtype=np.int32) - 1
        code = place[key]
    else:
        kinds, code = np.unique(key, return_inverse=True)
    points = np.append(alphabet, _PAD)
    packed = (points[kinds // base // base] << (2 * _BITS)) | (points[kinds // base % base] << _BITS) | points[kinds % base]
    return alphabet, code, who, packed


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(values) and values.max() < 1 << 32:
        values = values.astype(np.uint32)
    v = np.sort(values)
    new = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
    return v[new].astype(np.int64), np.diff(np.append(new, len(v)))


def ranks(code: np.ndarray, who: np.ndarray, kinds: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, rank) of each row's ``top`` most frequent n-grams."""
    both, count = _counted(who.astype(np.int64) * max(1, kinds) + code)
    row, gram = both // max(1, kinds), both % max(1, kinds)
    order = np.lexsort((gram, -count, row))
    row, gram = row[order], gram[order]
    start = np.searchsorted(row, row)
    rank = np.arange(len(row)) - start
    keep = rank < top
    return row[keep], gram[keep], rank[keep]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> dict[str, np.ndarray]:
    """Profiles from all given rows with a lang: packed n-grams in rank order.

    Counts are added up in each piece of a task first. What reaches the driver
    is ``top`` n-grams for each of 16 hash classes and language."""

    def run(batches):
        for b in slices(batches, 0, SLICE):
            names = b.column(1).dictionary_encode()
            _, code, who, packed = ngrams(as_text(b.column(0)).to_pylist())
            lang = np.asarray(names.indices)[who].astype(np.int64)
            both, count = _counted(lang * max(1, len(packed)) + code)
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(both // max(1, len(packed)))), pa.array(packed[both % max(1, len(packed))].astype(np.int64)), pa.array(count.astype(np.int64))], names=["lang", "gram", "n"]
            )

    d = docs.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = map_arrow(d, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang", "part").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(16))).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top)
    out: dict[str, list[tuple[int, int]]] = {}
    for r in best.select("lang", "gram", "n").collect():
        out.setdefault(r["lang"], []).append((-r["n"], r["gram"]))
    return {k: np.array([g for _, g in sorted(v)[:top]], np.int64) for k, v in sorted(out.items())}


def predict(texts: list[str], profiles: dict[str, np.ndarray], top: int = TOP) -> tuple[list[str], np.ndarray]:
    langs = list(profiles)
    none = ([UNKNOWN] * len(texts), np.zeros(len(texts)))
    if not langs or not texts:
        return none
    _, code, who, packed = ngrams(texts)
    if not len(code):
        return none
    row, gram, rank = ranks(code, who, len(packed), top)
    compared = np.bincount(row, minlength=len(texts))
    away = np.empty((len(langs), len(texts)))
    for i, k in enumerate(langs):
        place = np.full(len(packed), -1, np.int64)
        at = np.minimum(np.searchsorted(packed, profiles[k]), len(packed) - 1)
        hit = packed[at] == profiles[k]
        place[at[hit]] = np.flatnonzero(hit)
        p = place[gram]
        away[i] = np.bincount(row, np.where(p < 0, top, np.abs(p - rank)), minlength=len(texts))
    best = away.argmin(0)
    score = 1 - away.min(0) / np.maximum(1, compared * top)
    found = compared > 0
    return [langs[b] if f else UNKNOWN for b, f in zip(best.tolist(), found.tolist(), strict=True)], np.where(found, np.clip(score, 0, 1), 0.0)


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", top: int = TOP) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def run(batches):
        for b in slices(batches, 1, SLICE):
            lang, score = predict(as_text(b.column(1)).to_pylist(), profiles, top)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(d, run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    profiles = learn(docs.filter(~held_out))
    return identify(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
