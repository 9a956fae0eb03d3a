"""Rounds over all links of a graph without a shuffle.

Links are packed once: sorted by account, each task's run cut at borders of accounts into
blocks of some 262,144 links, three arrays of bytes a block. A round reads every block
once, in numpy, against arrays over the accounts (community, total weight), which are
broadcast; what comes back is one row a block with its accounts' best moves. Arrays
over accounts bound this by MAX_NODES (about 20 bytes an account are broadcast and as much
comes back at most); larger graphs take rounds of joins.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.session import cut_lineage

#: Accounts whose arrays the driver and the workers hold; beyond, rounds are joins.
MAX_NODES = 1 << 23
#: Links of a block, but for the last account's.
BLOCK_LINKS = 1 << 18
#: Links that a task packs on average.
LINKS_A_TASK = 4_000_000

_BLOCK = "u binary, v binary, w binary"


def pack(links: DataFrame) -> DataFrame:
    """(u, v, w), both directions of each link once -> blocks, written."""

    def run(batches):
        import pyarrow as pa

        def block(cols):
            kinds = (np.int32, np.int32, np.int64)
            return pa.RecordBatch.from_arrays([pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in zip(cols, kinds)], names=["u", "v", "w"])

        parts, size, least = [], 0, BLOCK_LINKS
        for b in batches:
            parts.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            size += b.num_rows
            if size < least:
                continue
            cols = [np.concatenate(x) for x in zip(*parts)]
            border = int(np.searchsorted(cols[0], cols[0][-1]))  # the last account may go on
            if border:
                yield block([x[:border] for x in cols])
            parts = [[x[border:] for x in cols]]
            size = len(parts[0][0])
            least = max(BLOCK_LINKS, 2 * size)  # an account of many links is not joined batch by batch
        if size:
            yield block([np.concatenate(x) for x in zip(*parts)])

    n = max(int(links.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-links.count() // LINKS_A_TASK), 2)
    ranged = links.select("u", "v", F.col("w").cast("long").alias("w")).repartitionByRange(n, "u").sortWithinPartitions("u")
    return cut_lineage(ranged.mapInArrow(run, _BLOCK))


def arrays(df: DataFrame, n: int, *cols: str) -> list[np.ndarray]:
    """Long columns of ``df`` (id, ...) as arrays over 0..n-1, zero where there is no row."""
    t, out = df.select("id", *cols).toArrow(), []
    at = t.column("id").to_numpy()
    for c in cols:
        out.append(np.zeros(n, np.int64))
        out[-1][at] = t.column(c).to_numpy()
    return out


@contextmanager
def _shared(df: DataFrame, *values):
    shared = df.sparkSession.sparkContext.broadcast(values)
    try:
        yield shared
    finally:
        shared.destroy()


def _grouped(u, other, w):
    """(u, other, sum of w), sorted; u is sorted already."""
    base = np.int64(u[0])
    key = (u.astype(np.int64) - base) * (int(other.max()) + 1) + other
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    first = order[start]
    return u[first], other[first], np.add.reduceat(w[order], start)


def best_moves(u, v, w, c, up=None, k=None, t=None, m2=None):
    """(ids, to, gain, inner) of one block's accounts that gain by their best move: weight of links to a
    community, less with ``k``, ``t`` and ``m2`` that expected by chance (modularity).
    ``up``: only to larger (False: smaller) communities. Ties: the smallest community."""
    gu, go, gw = _grouped(u, c[v], w)
    mine = c[gu]
    inner = int(gw[go == mine].sum())
    node = np.flatnonzero(np.concatenate([[True], gu[1:] != gu[:-1]]))
    which = np.repeat(np.arange(len(node)), np.diff(np.append(node, len(gu))))
    ids, own = gu[node], np.add.reduceat(np.where(go == mine, gw, 0), node)
    if k is None:
        value, stay = gw.astype(np.float64), own.astype(np.float64)
    else:
        value = gw - k[gu] * t[go] / m2
        stay = own - k[ids] * (t[c[ids]] - k[ids]) / m2
    able = np.full(len(gu), True) if up is None else go > mine if up else go < mine
    value = np.where(able, value, -np.inf)
    top = np.maximum.reduceat(value, node)
    hit = np.flatnonzero(able & (value == top[which]))
    at, first = np.unique(which[hit], return_index=True)
    gain = top[at] - stay[at]
    good = gain > 1e-9
    return ids[at][good], go[hit[first]][good], gain[good], inner


def sweep(blocks: DataFrame, c: np.ndarray, up: bool | None = None, k=None, t=None, m2: float | None = None):
    """(ids, to, gain, inner weight) of all accounts by ``best_moves``, ids ascending."""
    with _shared(blocks, c.astype(np.int32), k, t) as shared:

        def run(batches):
            import pyarrow as pa

            c, k, t = shared.value
            for b in batches:
                for row in zip(*(b.column(i).to_pylist() for i in range(3))):
                    u, v, w = (np.frombuffer(x, d) for x, d in zip(row, (np.int32, np.int32, np.int64)))
                    ids, to, gain, inner = best_moves(u, v, w, c, up, k, t, m2)
                    out = [ids.astype(np.int32).tobytes(), to.astype(np.int32).tobytes(), gain.tobytes()]
                    yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.binary()) for x in out), pa.array([inner], pa.int64())], names=["ids", "tos", "gain", "inside"])

        rows = blocks.mapInArrow(run, "ids binary, tos binary, gain binary, inside long").collect()
    joined = [np.concatenate([np.empty(0, d), *(np.frombuffer(r[i], d) for r in rows)]) for i, d in enumerate((np.int32, np.int32, np.float64))]
    order = np.argsort(joined[0])
    return (*(x[order] for x in joined), sum(r[3] for r in rows))


def contracted(blocks: DataFrame, c: np.ndarray) -> DataFrame:
    """Links between communities (u, v, w), also those inside one, written."""
    with _shared(blocks, c.astype(np.int32)) as shared:

        def run(batches):
            import pyarrow as pa

            (c,) = shared.value
            for b in batches:
                for row in zip(*(b.column(i).to_pylist() for i in range(3))):
                    u, v, w = (np.frombuffer(x, d) for x, d in zip(row, (np.int32, np.int32, np.int64)))
                    order = np.argsort(c[u], kind="stable")
                    cols = _grouped(c[u][order], c[v][order], w[order])
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], names=["u", "v", "w"])

        return cut_lineage(blocks.mapInArrow(run, "u long, v long, w long").groupBy("u", "v").agg(F.sum("w").alias("w")))


def named(index: DataFrame, by: np.ndarray) -> DataFrame:
    """(node, community) of ``index`` (node, id): the community of account i has the name of
    account ``by[i]``."""
    with _shared(index, by.astype(np.int64)) as shared:

        def run(batches):
            import pyarrow as pa

            (by,) = shared.value
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(by[b.column(1).to_numpy()])], names=["node", "by"])

        rows = cut_lineage(index.select("node", "id").mapInArrow(run, "node string, by long"))
    return rows.join(index.select(F.col("id").alias("by"), F.col("node").alias("community")), "by").select("node", "community")


def _mixed(h):
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(32))


def _turned(x, r):
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def hash_long(values, seed) -> np.ndarray:
    """Spark's xxhash64 of a long, continued from ``seed`` (42 at first)."""
    p1, p2, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    h = np.asarray(seed).astype(np.uint64) + p5 + np.uint64(8)
    h = h ^ (_turned(np.asarray(values).astype(np.uint64) * p2, 31) * p1)
    return _mixed(_turned(h, 27) * p1 + p4)


def hash_int(value: int, seed) -> np.ndarray:
    """Spark's xxhash64 of an int, continued from ``seed``."""
    p1, (p2, p3, p5) = 0x9E3779B185EBCA87, (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    h = np.asarray(seed).astype(np.uint64) + p5 + np.uint64(4)
    h = h ^ np.uint64((value & 0xFFFFFFFF) * p1 % (1 << 64))
    return _mixed(_turned(h, 23) * p2 + p3)
