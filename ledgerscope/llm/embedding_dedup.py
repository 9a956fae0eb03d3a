"""Near-duplicate embeddings by iterative quantisation and multi-index hashing.

1. Equal vectors of a label become one class (a 128-bit hash finds them).
2. A rotation of the principal axes is learned so that signs are balanced, good
   codes (iterative quantisation), on a bounded sample: the ``sample`` classes
   first by a hash of their id. One model for each vector length in it.
3. Every class gets a code of up to 64 bits, cut into ``tables`` substrings. In each
   table it is entered under its substring and under the ``probes`` substrings made by
   flipping its bits of least margin; two classes meet where any of their entries are
   equal, so the flips of both sides add up.
4. Entries are range-sorted once by (bucket, class), so that a hot bucket spreads over
   many tasks; those alone in their bucket go before a vector is moved.
5. Classes that meet in a bucket are reranked with their vectors in double
   precision; links of ``least`` or more connect them. Buckets are processed in
   blocks, and a task emits only the links that connect its sets.
6. Within each component all pairs of classes are compared in blocks, so counts
   of links are exact there; only counts leave the tasks.

A pair is missed only if none of its tables brings the two together and no chain
of other links does; recall against brute force is measured in tests/llm.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, or have no label or id, link with nothing (n_links 0, their own
component, kept); vectors of unequal length never link; rows that share an id are
alike where vector and label are equal, else told apart (a component goes by its
smallest id, which another may share); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_arrow, table, written
from ledgerscope.llm.components import components
from ledgerscope.llm.runs import into_runs, whole_runs

LEAST, SAMPLE, TABLES, PROBES, BLOCK = 0.98, 10_000, 3, 11, 1024


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def learn_rotation(x: np.ndarray, bits: int = 64, rounds: int = 50, seed: int = 1) -> dict[str, np.ndarray]:
    """Mean and projection (principal axes times learned rotation) of unit rows."""
    d = x.shape[1]
    c = min(bits, d)
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(c, c)))[0]
    if len(x) < 2 * c:
        axes = np.linalg.qr(np.random.default_rng(seed + d).normal(size=(d, d)))[0][:, :c]
        return {"mean": np.zeros(d), "axes": axes @ r}
    mean = x.mean(0)
    v = x - mean
    axes = np.linalg.eigh(v.T @ v)[1][:, ::-1][:, :c]
    v = v @ axes
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.sign(v @ r).T @ v)
        r = (u @ w).T
    return {"mean": mean, "axes": axes @ r}


def _flips(probes: int, width: int) -> list[tuple[int, ...]]:
    """Sets of bits to flip, by rank of margin, cheapest first (margins grow about evenly)."""
    near = range(min(width, 12))
    sets = [s for n in (1, 2, 3, 4) for s in combinations(near, n)]
    return sorted(sets, key=lambda s: (sum((i + 1) ** 2 for i in s), s))[:probes]


def codes(model: dict[str, np.ndarray], x: np.ndarray, tables: int, probes: int) -> np.ndarray:
    """Entries of each row: its own substrings and the probed ones (rows, tables * (1 + probes) at most)."""
    v = (x - model["mean"]) @ model["axes"]
    on, margin = v > 0, np.abs(v)
    bits = v.shape[1]
    cuts = [i * bits // tables for i in range(tables + 1)]
    out = []
    for t, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        weight = np.int64(1) << np.arange(b - a, dtype=np.int64)
        key = (on[:, a:b] * weight).sum(1) | (np.int64(t) << 40)
        order = weight[np.argsort(margin[:, a:b], axis=1, kind="stable")]
        out.append(key)
        out += [key ^ order[:, list(s)].sum(1) for s in _flips(probes, b - a)]
    return np.stack(out, 1)


def shared(batches):
    """Of entries sorted by bucket, those that aren't alone there; a partition's first and last stay, since their bucket may go on beyond it."""
    last, left = None, True
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b] if last is None else [last, b])
        key = np.asarray(t["bucket"])
        same = key[1:] == key[:-1]
        keep = np.concatenate([[left], same[:-1]]) | same if len(same) else np.zeros(0, bool)
        yield from t.slice(0, len(keep)).filter(pa.array(keep)).to_batches()
        last, left = b.slice(b.num_rows - 1), bool(same[-1]) if len(same) else left
    if last is not None:
        yield last


def matrix(column: pa.ChunkedArray | pa.Array, rows: np.ndarray, length: int) -> np.ndarray:
    picked = column.take(pa.array(rows))
    picked = picked.combine_chunks() if isinstance(picked, pa.ChunkedArray) else picked
    return np.asarray(picked.flatten(), dtype=np.float64).reshape(len(rows), length)


def _groups(t: pa.Table, run_no: np.ndarray, most: int = 1 << 22):
    """(rows, unit vectors) of the groups of each run by length and label: groups of one
    size and length come stacked, (groups, size) and (groups, size, length)."""
    length = np.asarray(t["length"])
    label = np.asarray(t["label"].combine_chunks().dictionary_encode().indices)
    key = np.stack([run_no, length, label], 1)
    order = np.lexsort(key.T[::-1])
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1), [True]]))
    first, size = new[:-1], np.diff(new)
    for m, d in sorted({*zip(size[size > 1].tolist(), key[first[size > 1], 1].tolist(), strict=True)}):
        at = first[(size == m) & (key[first, 1] == d)]
        step = max(1, most // (m * (m + d)))
        for i in range(0, len(at), step):
            rows = order[at[i : i + step, None] + np.arange(m)]
            yield rows, unit_rows(matrix(t["vec"], rows.ravel(), d)).reshape(*rows.shape, d)


def _hits(t: pa.Table, run_no: np.ndarray, least: float):
    """(rows, links) of stacked groups; ``links`` (groups, size, size) holds the pairs that belong to their run."""
    side, whole = np.asarray(t["side"]), np.asarray(t["whole"])
    for rows, x in _groups(t, run_no):
        hit = x @ x.transpose(0, 2, 1) >= least
        hit &= whole[rows][:, :, None] | (side[rows][:, :, None] != side[rows][:, None, :])
        own = np.arange(rows.shape[1])
        hit[:, own, own] = False
        yield rows, hit


def lowest_linked(hit: np.ndarray) -> np.ndarray:
    """(groups, size): the smallest member each one's links lead to, itself included."""
    low = np.broadcast_to(np.arange(hit.shape[1]), hit.shape[:2]).copy()
    while True:
        near = np.minimum(low, np.where(hit, low[:, None, :], hit.shape[1]).min(2))
        near = np.take_along_axis(near, near, 1)
        if (near == low).all():
            return low
        low = near


def _linking(least: float):
    def run(batches):
        for t, run_no in whole_runs(batches, 1 << 13):
            rep = np.asarray(t["rep"])
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for rows, hit in _hits(t, run_no, least):
                some = hit.any((1, 2))
                rows, low = rows[some], lowest_linked(hit[some])
                g, own = np.nonzero(low != np.arange(low.shape[1]))
                a.append(rep[rows[g, own]])
                b.append(rep[rows[g, low[g, own]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _counting(least: float):
    def run(batches):
        for t, run_no in whole_runs(batches, 1 << 13):
            rep, n = np.asarray(t["rep"]), np.asarray(t["n"])
            found = np.zeros(len(rep), np.int64)
            for rows, hit in _hits(t, run_no, least):
                found[rows] = (hit @ n[rows][:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(found)], names=["rep", "links"])

    return run


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = LEAST, sample: int = SAMPLE, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    # floats travel as they are; tasks compare in double precision
    kind = "array<float>" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "array<double>"
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast(kind).alias("vec"), F.col(label_col).cast("string").alias("label"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    valid = F.coalesce(fine, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    hashes = [F.when(valid, F.xxhash64(F.lit(i), "label", "vec")).alias(f"h{i}") for i in (1, 2)]
    rows = v.select("vec_id", *hashes)
    found = v.filter(valid).select("vec_id", "vec", "label", *[h for h in hashes])
    classes = found.groupBy("h1", "h2").agg(F.min("vec_id").cast("long").alias("low"), F.min_by("label", "vec_id").alias("label"), F.min_by("vec", "vec_id").alias("vec"), F.count(F.lit(1)).alias("n"))
    # a class is told apart by a number of its own: an id can occur with several vectors or labels
    classes = written(classes.withColumn("length", F.size("vec")).withColumn("rep", F.monotonically_increasing_id()), "vectors")

    picked = classes.orderBy(F.xxhash64(F.lit(5), "low"), "low", "h1", "h2").limit(sample).select("vec", "length").toArrow()  # `sample` rows at most
    sizes = np.asarray(picked["length"])
    models = {int(d): learn_rotation(unit_rows(matrix(picked["vec"], np.flatnonzero(sizes == d), int(d)))) for d in np.unique(sizes)}

    def keyed(batches):
        for b in batches:
            length = np.asarray(b.column(2))
            for d in np.unique(length).tolist():
                at = np.flatnonzero(length == d)
                model = models.get(d) or learn_rotation(np.zeros((0, d)))  # a length the sample lacks: random axes
                keys = codes(model, unit_rows(matrix(b.column(1), at, d)), tables, probes)
                offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * keys.shape[1])
                where = pa.array(at)
                yield pa.RecordBatch.from_arrays([b.column(0).take(where), b.column(3).take(where), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], names=["rep", "kind", "keys"])

    # labels whose hashes are equal only share buckets: runs are told apart by label and length again
    keys = written(map_arrow(classes.select("rep", "vec", "length", F.xxhash64("label", "length").alias("kind")), keyed, "rep long, kind long, keys array<long>"), "keys")
    entries = keys.select("rep", "kind", F.explode("keys").alias("key")).select(F.xxhash64("kind", "key").alias("bucket"), "rep")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    entries = entries.repartitionByRange(n, "bucket", "rep").sortWithinPartitions("bucket")
    met = written(map_arrow(entries, shared, "bucket long, rep long"), "met")
    met = into_runs(met, ["bucket"], "rep", block, classes.select("rep", "label", "length", "vec"))
    comp = written(components(map_arrow(met.select("run", "rep", "side", "whole", "label", "length", "vec"), _linking(least), "a long, b long")), "near")
    members = classes.select("rep", "low", "label", "length", "vec", "n").join(comp, F.col("rep") == F.col("node"))
    blocks = into_runs(members.select("component", "rep"), ["component"], "rep", block, members.drop("component", "node", "low"))
    counted = map_arrow(blocks.select("run", "rep", "side", "whole", "label", "length", "vec", "n"), _counting(least), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    lowest = members.groupBy(F.col("component").alias("named")).agg(F.min("low").alias("lowest"))
    per = classes.select("h1", "h2", "rep", "low", "n").join(counted, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
    per = per.join(lowest, F.col("component") == F.col("named"), "left")
    per = per.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("lowest", "low").alias("component_id"))
    out = rows.join(per, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    own = F.col("vec_id").cast("long")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", own).alias("component_id"))
    return out.withColumn("kept", F.coalesce(own == F.col("component_id"), F.lit(True)))


def op1_embedding_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))
