"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages of 64 words. Every passage of the whole text is
encoded (shape statistics of its words, a hashed bag of the words, how much of it
repeats in the document); a hidden layer turns the code into a vector h; gated
attention, softmax over w.(tanh(Vh) * sigmoid(Uh)), weighs the document's
passages; a logistic unit scores the weighted sum. Only document labels train
it: they say nothing on single passages, the attention learns that.

Fitted on a bounded sample: the ``max_train`` labelled ids first by a hash of the
id (all of them where there are fewer), one row of each (the least hash of its
text), and of those, in that order, the whole texts that together have at most
``max_passages`` passages; a text too long for what is left teaches nothing, it is
never cut. At most ``max_train`` rows and 538 bytes a passage reach the driver,
54 MB. Scoring reads all passages of all documents.

Defined cases: a null or empty text is one passage of zeros and gets that
passage's score; repeated rows get equal scores; unlabelled, null-id and
null-label rows teach nothing; an id on several rows teaches by one of them;
several labels of a document count by their mean
(good from 0.5 on); with no labels every score is 0.5, with labels of one kind
that kind's share; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import WORD, fold, fresh, map_arrow, owners, slices, split_words, sums, table, utf8, written
from ledgerscope.llm.text_stats import repeated_words

PASSAGE, BUCKETS, MAX_TRAIN, MAX_PASSAGES, THRESHOLD = 64, 256, 4000, 100_000, 0.7
SHAPES = 13


def encode_passages(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all passages (float32) and each document's offsets in them."""
    words, woff = split_words(arr)
    coded = words.dictionary_encode()
    codes = np.asarray(coded.indices, dtype=np.int64)
    data, off = utf8(coded.dictionary)
    size = np.maximum(1, np.diff(off))
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, wide = (data >= 48) & (data <= 57), data >= 128
    share = lambda f: sums(f.view(np.int8), off) / size
    letters = share(upper | lower | wide)
    shapes = np.stack([np.log1p(size), share(upper), share(digit), share(wide), letters, share(~(upper | lower | digit | wide)), letters == 0, size > 20, (share(upper) > 0.9) & (size > 1)], 1)
    bucket = np.array([zlib.crc32(x) % BUCKETS for x in coded.dictionary.cast(pa.large_binary()).to_pylist()], np.int64)
    n = np.diff(woff)
    parts = np.maximum(1, -(-n // PASSAGE))
    poff = np.concatenate([[0], np.cumsum(parts)])
    doc = owners(woff)
    pid = poff[doc] + (np.arange(len(codes)) - woff[doc]) // PASSAGE
    total = int(poff[-1])
    count = np.maximum(1, np.bincount(pid, minlength=total))
    x = np.zeros((total, SHAPES + BUCKETS), np.float32)
    for k in range(shapes.shape[1]):
        x[:, k] = np.bincount(pid, shapes[codes, k], minlength=total) / count
    x[:, 9] = np.bincount(pid, repeated_words(codes, woff), minlength=total) / count
    kinds = max(1, len(coded.dictionary))
    x[:, 10] = np.bincount(np.unique(pid * kinds + codes) // kinds, minlength=total) / count
    x[:, 11] = np.log1p(n)[np.repeat(np.arange(len(n)), parts)] / 8
    again = np.zeros(len(codes))
    again[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    x[:, 12] = np.bincount(pid, again, minlength=total) / count
    x[:, SHAPES:] = (np.bincount(pid * BUCKETS + bucket[codes], minlength=total * BUCKETS).reshape(total, BUCKETS) / count[:, None]).astype(np.float32)
    return x, poff


def _forward(m: dict, x: np.ndarray, off: np.ndarray) -> dict:
    h = np.maximum(0, ((x - m["mean"]) / m["sd"]) @ m["W"] + m["b"])
    a1 = np.tanh(h @ m["V"])
    a2 = 1 / (1 + np.exp(-(h @ m["U"])))
    e = (a1 * a2) @ m["w"]
    top = np.maximum.reduceat(e, off[:-1])
    doc = owners(off)
    e = np.exp(e - top[doc])
    a = e / np.add.reduceat(e, off[:-1])[doc]
    z = np.add.reduceat(a[:, None] * h, off[:-1], axis=0)
    p = 1 / (1 + np.exp(-np.clip(z @ m["c"] + m["d"], -30, 30)))
    return {"h": h, "a1": a1, "a2": a2, "a": a, "z": z, "p": p, "doc": doc}


def score_texts(m: dict, arr: pa.Array) -> np.ndarray:
    if "share" in m:
        return np.full(len(arr), m["share"])
    x, off = encode_passages(arr)
    return _forward(m, x, off)["p"].astype(np.float64)


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 40, batch: int = 128, rate: float = 0.005, decay: float = 1e-4, seed: int = 10) -> dict:
    """Adam on the documents' log-loss; the same bags in the same order give the same model."""
    if not len(labels) or labels.min() == labels.max():
        return {"share": float(labels.mean()) if len(labels) else 0.5}
    r = np.random.default_rng(seed)
    everything = np.concatenate(bags).astype(np.float32)
    mean = everything.mean(0)
    sd = everything.std(0) + 0.02
    n = everything.shape[1]
    p = {"W": r.normal(0, (2 / n) ** 0.5, (n, hidden)), "b": np.zeros(hidden), "V": r.normal(0, 0.2, (hidden, gate)), "U": r.normal(0, 0.2, (hidden, gate)), "w": r.normal(0, 0.2, gate), "c": r.normal(0, 0.2, hidden), "d": np.zeros(1)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    t = 0
    for _ in range(epochs):
        order = r.permutation(len(bags))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x = np.concatenate([bags[i] for i in pick]).astype(np.float32)
            off = np.concatenate([[0], np.cumsum([len(bags[i]) for i in pick])])
            f = _forward(p | {"mean": mean, "sd": sd}, x, off)
            g = ((f["p"] - labels[pick]) / len(pick)).astype(np.float32)
            dz = (g[:, None] * p["c"])[f["doc"]]
            dh = f["a"][:, None] * dz
            da = (f["h"] * dz).sum(1)
            de = f["a"] * (da - np.add.reduceat(f["a"] * da, off[:-1])[f["doc"]])
            dg = de[:, None] * p["w"]
            d1, d2 = dg * f["a2"] * (1 - f["a1"] ** 2), dg * f["a1"] * f["a2"] * (1 - f["a2"])
            dh = (dh + d1 @ p["V"].T + d2 @ p["U"].T) * (f["h"] > 0)
            grad = {"c": f["z"].T @ g, "d": g.sum(keepdims=True), "w": (f["a1"] * f["a2"]).T @ de, "V": f["h"].T @ d1, "U": f["h"].T @ d2, "W": ((x - mean) / sd).T @ dh, "b": dh.sum(0)}
            t += 1
            for k in p:
                gk = grad[k] + decay * p[k]
                m1[k] = 0.9 * m1[k] + 0.1 * gk
                m2[k] = 0.999 * m2[k] + 0.001 * gk * gk
                p[k] = (p[k] - rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return p | {"mean": mean, "sd": sd}


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN, max_passages: int = MAX_PASSAGES) -> DataFrame:
    """(id, label, text) of the rows that teach: see the module's bounds."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    known = known.select(F.col("doc_id").alias("_lid"), "label")
    mine = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # labels may name documents that an earlier stage dropped, so the sample is taken from those present
    ids = mine.select("id").join(known, F.col("id") == F.col("_lid")).select("_lid", "label").distinct()
    sample = F.broadcast(ids.orderBy(F.xxhash64(F.lit(10), "_lid"), "_lid").limit(max_train))  # max_train rows at most
    # an id may be on any number of rows: hashes find one of its texts, partial sums keep a row a task
    theirs = mine.join(sample, F.col("id") == F.col("_lid")).select("id", "label", "text", F.xxhash64("text").alias("h"))
    least = theirs.groupBy("id").agg(F.min("h").alias("h"))
    one = theirs.join(F.broadcast(least), ["id", "h"]).groupBy("id").agg(F.first("label").alias("label"), F.first("text").alias("text"))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    one = written(one.withColumn("passages", F.greatest(F.lit(1), F.ceil(words / PASSAGE)).cast("long")), "training")
    chosen, left = [], max_passages
    for r in one.orderBy(F.xxhash64(F.lit(10), "id"), "id").select("id", "passages").collect():  # max_train rows at most
        if r["passages"] <= left:
            chosen.append((r["id"],))
            left -= r["passages"]
    picked = docs.sparkSession.createDataFrame(chosen, T.StructType([one.schema["id"]]))
    return one.join(F.broadcast(picked), "id").select("id", "label", "text")


def training_bags(rows: DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """The codes of each row's passages, and the labels, in order of the ids."""

    def run(batches):
        for b in slices(batches, 2, 4 << 20):
            x, off = encode_passages(b.column(2))
            codes = [x[s:e].astype(np.float16).tobytes() for s, e in zip(off, off[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.binary())], names=["id", "label", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    got = sorted(map_arrow(rows, run, f"id {kind}, label int, x binary").collect(), key=lambda r: r["id"])
    bags = [np.frombuffer(r["x"], np.float16).reshape(-1, SHAPES + BUCKETS) for r in got]
    return bags, np.array([r["label"] for r in got], np.float32)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN, max_passages: int = MAX_PASSAGES) -> dict:
    """Fits on documents whose fold of 4 isn't 2. ``labels``: (doc_id, quality)."""
    return fit(*training_bags(training_rows(docs, labels, id_col, text_col, max_train, max_passages)))


def scored(docs: DataFrame, model: dict, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with all its columns and ``score_col``, which must be a new name."""
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for b in slices(batches, at, 2 << 20):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score_texts(model, b.column(at)))], names=[*names, score_col])

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``."""
    (score,) = fresh(docs.columns, "quality_score")
    return scored(docs, train(docs, labels, id_col, text_col), text_col, score).filter(F.col(score) >= threshold).drop(score)


def op10_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    out = scored(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
