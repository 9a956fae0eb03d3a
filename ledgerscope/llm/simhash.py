"""SimHash near-duplicates with pigeonring filtering.

A fingerprint bit is 1 if set in more than half of the 64-bit hashes of a
text's shingles. Different fingerprints are linked at ``max_bits`` differing
bits or fewer. The 64 bits lie on a ring of ``segments`` segments; two
fingerprints within the limit have a segment from where the differences summed
over 1, 2, 3... consecutive segments stay within 1, 2, 3... times max_bits /
segments (the pigeonring principle; the last budget is the limit itself). With
6 segments and 4 bits the budgets are 0, 1, 2, 2, 3, 4: the first segment is
equal, and one of the next three as well, so pairs are looked up by two equal
segments (15 tables, 21 or 22 bits each), checked for such a chain, and only then
for their full Hamming distance. No link is missed.

Equal fingerprints are one class, linked through its smallest doc_id.

Defined cases: a null or empty text, or one without words, has fingerprint 0,
which links like any other; fewer words than a shingle are one shingle; repeated
rows link like copies; a null doc_id never names a component while another id is
there; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import as_text, fresh, map_arrow, slices, sums, table, written
from ledgerscope.llm.components import components
from ledgerscope.llm.runs import Sets, into_runs, whole_runs

SHINGLE, MAX_BITS, SEGMENTS, SEED = 4, 4, 6, 42


def fingerprints(texts: list[str], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """uint64 fingerprints; bytes.split and bytes.lower work on ASCII alone."""
    hashes = array("Q")
    off = [0]
    hash64 = xxhash.xxh64_intdigest
    for t in texts:
        words = t.encode("utf-8", "surrogatepass").lower().split()
        if len(words) > shingle:
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            starts = [0, *ends]
            hashes.extend([hash64(joined[s : e - 1], seed) for s, e in zip(starts, ends[shingle - 1 :], strict=False)])
        elif words:
            hashes.append(hash64(b" ".join(words), seed))
        off.append(len(hashes))
    offs = np.array(off)
    h = np.frombuffer(hashes, np.uint64).astype(">u8")
    out = np.zeros(len(texts), np.uint64)
    n = np.diff(offs)
    row, step = 0, 1 << 18
    while row < len(texts):  # bits of at most a quarter million shingles at a time, or of one text
        to = max(row + 1, int(np.searchsorted(offs, offs[row] + step, side="right")) - 1)
        to = min(to, len(texts))
        counts = np.zeros((to - row, 64), np.int64)
        for at in range(offs[row], offs[to], step):
            end = min(at + step, offs[to])
            bits = np.unpackbits(h[at:end].view(np.uint8).reshape(-1, 8), axis=1)
            lo = np.clip(offs[row : to + 1], at, end) - at
            full = np.flatnonzero(lo[1:] > lo[:-1])
            counts[full] += np.add.reduceat(bits, lo[:-1][full], axis=0, dtype=np.int32)
        on = counts * 2 > n[row:to, None]
        out[row:to] = np.packbits(on, axis=1).view(">u8").ravel()
        row = to
    return out


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, marks: list[Column] | None = None) -> DataFrame:
    """(doc_id, fp long), and m0, m1... for the longs ``marks``."""
    names = [f"m{i}" for i in range(len(marks or []))]

    def run(batches):
        for b in slices(batches, 1, 4 << 20):
            fp = fingerprints(as_text(b.column(1)).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *names])

    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[m.alias(n) for m, n in zip(marks or [], names, strict=True)])
    return map_arrow(d, run, ", ".join([f"doc_id {d.schema['doc_id'].dataType.simpleString()}", "fp long", *[f"{n} long" for n in names]]))


def ring(segments: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment of the 64 bits."""
    cuts = [i * 64 // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def chained(diff: np.ndarray, max_bits: int, segments: int) -> np.ndarray:
    """Whether some start has all its chains within the proportional budgets."""
    per = [np.bitwise_count((diff >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in ring(segments)]
    found = np.zeros(len(diff), bool)
    for i in range(segments):
        total, ok = np.zeros(len(diff), np.int64), np.ones(len(diff), bool)
        for k in range(segments):
            total += per[(i + k) % segments]
            ok &= total * segments <= (k + 1) * max_bits
        found |= ok
    return found


def link_runs(max_bits: int, segments: int):
    """Task function: runs of fingerprints -> links that connect what a run's links connect."""

    def run(batches):
        for t, run_no in whole_runs(batches):
            fp = np.asarray(t["fp"]).view(np.uint64)
            side, whole = np.asarray(t["side"]), np.asarray(t["whole"])
            sets, at, d = Sets(len(fp)), np.arange(len(fp)), 1
            while True:
                at = at[at + d < len(fp)]
                at = at[run_no[at] == run_no[at + d]]
                if not len(at):
                    break
                a = at[(whole[at] | (side[at] != side[at + d])) & (sets.top[at] != sets.top[at + d])]
                diff = fp[a] ^ fp[a + d]
                ok = chained(diff, max_bits, segments)
                ok[ok] = np.bitwise_count(diff[ok]) <= max_bits
                if ok.any():
                    sets.join(a[ok], a[ok] + d)
                    sets.flat()
                d += 1
            top = sets.flat()
            own = np.flatnonzero(top != np.arange(len(fp)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[own].view(np.int64)), pa.array(fp[top[own]].view(np.int64))], names=["a", "b"])

    return run


def linked(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) between different fingerprints (column fp, one row each):
    enough of them to connect all that are within ``max_bits``."""
    if segments <= max_bits + 1:
        raise ValueError("segments must exceed max_bits by two at least")
    parts = ring(segments)
    seg = [F.shiftrightunsigned("fp", s).bitwiseAND((1 << w) - 1) for s, w in parts]
    pairs = [(i, j) for i in range(segments) for j in range(i + 1, segments)]
    keys = F.array(*[F.lit(k << 48).bitwiseOR(F.shiftleft(seg[i], parts[j][1])).bitwiseOR(seg[j]) for k, (i, j) in enumerate(pairs)])
    rows = fps.select("fp", F.explode(keys).alias("key"))
    return map_arrow(into_runs(rows, ["key"], "fp"), link_runs(max_bits, segments), "a long, b long")


def in_components(rows: DataFrame, low: Column, max_bits: int) -> DataFrame:
    """(fp, low, comp) of each different fingerprint; ``comp`` is the smallest one it is linked with."""
    classes = written(rows.groupBy("fp").agg(low.alias("low")), "classes")
    comp = components(linked(classes.select("fp"), max_bits))
    return classes.join(comp, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("component", "fp").alias("comp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    rows = written(with_fingerprints(docs, id_col, text_col, shingle), "simhash")
    c = in_components(rows, F.min("doc_id"), max_bits)
    lowest = c.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = c.join(lowest, "comp").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: of its smallest id (null last),
    and of its rows that share that id the first by a hash of the row."""
    # 128 bits of a row's columns, and of which are null (a null leaves a hash as it is)
    whole = [x for c, t in docs.dtypes if "map<" not in t for x in (F.col(c).isNull(), F.col(c))]
    marks = [F.xxhash64(F.lit(i), *whole) for i in (1, 2)]
    rows = written(with_fingerprints(docs, id_col, text_col, shingle, marks), "simhash")
    c = in_components(rows, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "m0", "m1")), max_bits)
    row, m0, m1, k0, k1 = fresh(docs.columns, "simhash_row", "simhash_m0", "simhash_m1", "simhash_k0", "simhash_k1")
    m = [m0, m1]
    keep = c.groupBy("comp").agg(F.min("low").alias("low")).select(F.col("low.m0").alias(k0), F.col("low.m1").alias(k1))
    d = docs.withColumns(dict(zip(m, marks, strict=True))).join(keep, (F.col(m0) == F.col(k0)) & (F.col(m1) == F.col(k1)), "left_semi")
    return d.groupBy(*m).agg(F.first(F.struct(*docs.columns)).alias(row)).select(f"{row}.*")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = near_duplicates(table(spark, sf_dir, "documents"))
    return n.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
