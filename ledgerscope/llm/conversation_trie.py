"""Prefix trie of conversations, from padded turn-id matrices of range shards.

A conversation is the list of its turns; a node of the trie is a different list
of first turns. Conversations are range-partitioned by (turns, id), so a group of
equal ones, however large, spreads over as many shards as its rows need, and so
does a common first turn. A task numbers its shard's different turns and lays
WIDTH turns of each conversation at a time in a matrix padded with zeros (the
next WIDTH only of the conversations that go on, so a long one pads no other).
numpy's lexsort orders the matrix; the change masks of its columns, OR-ed from
the left, mark where nodes start; reduceat over those starts gives each node's
members and, from the deepest depth up, what its subtree holds.

Only nodes on the way to a shard's first or last conversation can lie in other
shards too. Those, at most two ways a shard, are named by a 128-bit digest of
their turns; their shares are summed up by it and then along the ways, in one
task that sees nothing but these rows. Turns are told apart by 128 bits of hash.

Conversations here are as the contract rebuilds them (``rebuilt``) or as they
are (``sequences``). One conversation is one row: it has to fit in a task, like
a text. Shards hold CELLS turns or so each, whatever the table's size.

Defined cases: null roles and texts are empty; turns in order of ``turn`` (null
first), equal ones in order of role, then text; repeated rows are turns of their
own; rows without a conv_id belong to no conversation and are left out; a
conversation without turns is a member of the root alone; ids are whole numbers,
and the hundred of a negative one is the next lower; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import map_arrow, table, written

WIDTH, CELLS = 16, 1 << 20
#: Rows of shared nodes that may be broadcast (some 60 bytes each); more are left to the optimizer's joins.
BROADCAST = 100_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

_PARTS = "depth int, conv_id long, parent_conv_id long, k1 long, k2 long, pk1 long, pk2 long, n_convs long, n_children long, n_leaves long, saved_tokens long, chars long, part int, ends array<long>"


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<h1, h2, chars>>) of every conversation."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", text("role").alias("role"), text("text").alias("text")).alias("t"))
    lists = rows.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def named(t: Column) -> Column:
        hashes = [F.xxhash64(F.lit(i), t["role"], t["text"]).alias(f"h{i}") for i in (1, 2)]
        return F.struct(*hashes, F.length(t["text"]).alias("chars"))

    return lists.select("conv_id", F.transform("ts", named).alias("turns"))


def rebuilt(seqs: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The first h turns of the hundred's first conversation, then the own ones after
    the first h; h is the unsigned crc32 of the decimal id modulo ``most``."""
    seqs = written(seqs, "turns")
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    heads = seqs.filter(F.pmod("conv_id", F.lit(every)) == 0).select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most - 1).alias("head"))
    j = seqs.withColumn("first", first).join(heads, F.col("first") == F.col("head_id"), "left")
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % most).cast("int")
    j = j.withColumn("h", h)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return j.select("conv_id", F.concat(head, own).alias("turns"))


def _numbered(h1: np.ndarray, h2: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 1 of the different turns, in the order of their hashes, and each turn's place in it."""
    order = np.lexsort((h2, h1))
    new = np.ones(len(order), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    code = np.empty(len(order), np.int32)
    code[order] = np.cumsum(new)
    return code, np.concatenate([[0], order[new]])


def _by_parent(values: np.ndarray, parent: np.ndarray, n: int) -> np.ndarray:
    """Sums of the children's values for each of n parents; ``parent`` is sorted."""
    out = np.zeros(n, np.int64)
    if len(parent):
        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        out[parent[first]] = np.add.reduceat(values, first)
    return out


def shard_nodes(conv: np.ndarray, off: np.ndarray, h1: np.ndarray, h2: np.ndarray, chars: np.ndarray) -> list[dict]:
    """The nodes of one shard, a dict of columns for each depth. Shared nodes have
    their digest and the sums of what lies below them in unshared nodes."""
    code, sample = _numbered(h1, h2, chars)
    size = np.diff(off)
    ended = size == 0
    levels = [{"parent": np.zeros(1, np.int64), "turn": np.zeros(1, np.int64), "low": conv.min(keepdims=True), "n": np.array([len(conv)]), "ends": np.sort(conv[ended]), "n_ends": np.array([ended.sum()])}]
    rows = np.flatnonzero(~ended)
    group = np.zeros(len(rows), np.int64)
    depth = 0
    while len(rows):
        width = min(WIDTH, int(size[rows].max()) - depth)
        m = np.zeros((len(rows), width), np.int32)
        for c in range(width):
            on = np.flatnonzero(size[rows] > depth + c)
            m[on, c] = code[off[rows[on]] + depth + c]
        order = np.lexsort((conv[rows], *m.T[::-1], group))
        rows, m, group = rows[order], m[order], group[order]
        mask = np.concatenate([[True], group[1:] != group[:-1]])
        above = group
        for c in range(width):
            mask[1:] |= m[1:, c] != m[:-1, c]
            seg = np.flatnonzero(mask)
            live = m[seg, c] > 0  # the others are rows that ended before
            start = seg[live]
            last = size[rows] == depth + c + 1
            levels.append(
                {
                    "parent": above[start],
                    "turn": sample[m[start, c]],
                    "low": np.minimum.reduceat(conv[rows], seg)[live],
                    "n": np.diff(np.append(seg, len(rows)))[live],
                    "ends": conv[rows[last]],
                    "n_ends": np.add.reduceat(last.astype(np.int64), seg)[live],
                }
            )
            number = np.zeros(len(rows), np.int64)
            number[start] = 1
            above = np.cumsum(number) - 1  # of no meaning for rows that ended
        depth += width
        on = size[rows] > depth
        rows, group = rows[on], above[on]
    _mark_shared(levels, h1, h2)
    below = None
    for d in range(len(levels) - 1, -1, -1):
        x, n = levels[d], len(levels[d]["n"])
        own = ~x["shared"]
        zero = np.zeros(n, np.int64)
        kids, leaves, saved = (_by_parent(v, below["parent"], n) for v in below["up"]) if below else (zero, zero, zero)
        x["chars"] = chars[x["turn"]] if d else zero
        x["kids"] = kids
        x["leaves"] = leaves + (own & (kids == 0))
        x["saved"] = saved + np.where(own, (x["n"] - 1) * x["chars"], 0)
        x["up"] = (own.astype(np.int64), np.where(own, x["leaves"], 0), np.where(own, x["saved"], 0))
        below = x
    return levels


def _mark_shared(levels: list[dict], h1: np.ndarray, h2: np.ndarray) -> None:
    """Marks the nodes on the way to the first and the last conversation and names them."""
    for x in levels:
        x["shared"] = np.zeros(len(x["n"]), bool)
        x["key"] = {}
    for end in (0, -1):
        key = b""
        for d, x in enumerate(levels):
            i = 0 if end == 0 else len(x["n"]) - 1
            if d:
                before = levels[d - 1]
                if int(x["parent"][i]) != (0 if end == 0 else len(before["n"]) - 1):
                    break
                t = x["turn"][i]
                key = hashlib.blake2b(key + h1[t].tobytes() + h2[t].tobytes(), digest_size=16).digest()
            x["shared"][i] = True
            x["key"][i] = np.frombuffer(key or bytes(16), "<i8").tolist()
            if end == 0 and x["n_ends"][i]:
                break  # the first conversation ends here


def _batches(levels: list[dict], part: int):
    for d, x in enumerate(levels):
        n = len(x["n"])
        parent = x["parent"]
        above = levels[d - 1] if d else None
        keys = [[x["key"].get(i, (None, None))[k] for i in range(n)] if x["key"] else [None] * n for k in (0, 1)]
        pk = [[above["key"].get(i, (None, None))[k] for i in parent.tolist()] if above and above["key"] else [None] * n for k in (0, 1)]
        up = pa.array(above["low"][parent]) if above else pa.nulls(n, pa.int64())
        ends = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(x["n_ends"])]).astype(np.int32)), pa.array(x["ends"]))
        longs = [pa.array(k, pa.int64()) for k in (*keys, *pk)]
        counts = [pa.array(x[k].astype(np.int64)) for k in ("n", "kids", "leaves", "saved", "chars")]
        cols = [pa.array(np.full(n, d, np.int32)), pa.array(x["low"]), up, *longs, *counts, pa.array(np.full(n, part, np.int32)), ends]
        names = [f.split()[0] for f in _PARTS.split(", ")]
        whole = pa.RecordBatch.from_arrays(cols, names=names)
        for at in range(0, n, 1 << 16):
            yield whole.slice(at, 1 << 16)


def shard_parts(seqs: DataFrame) -> DataFrame:
    """The nodes of every shard, shared ones with their digests, written."""
    seqs = written(seqs, "sequences")
    cells = seqs.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    n = max(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-cells // CELLS))
    order = F.transform("turns", lambda t: F.struct(t["h1"], t["h2"]))
    shards = seqs.withColumn("path", order).repartitionByRange(n, "path", "conv_id").drop("path")

    def run(batches):
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).combine_chunks()
        lists = t["turns"].chunk(0)
        off = np.asarray(lists.offsets, dtype=np.int64)
        turns = lists.values.slice(off[0], off[-1] - off[0])
        h1, h2, chars = (np.asarray(turns.field(k), dtype=np.int64) for k in ("h1", "h2", "chars"))
        levels = shard_nodes(np.asarray(t["conv_id"], dtype=np.int64), off - off[0], h1, h2, chars)
        yield from _batches(levels, TaskContext.get().partitionId())

    return written(map_arrow(shards.select("conv_id", "turns"), run, _PARTS), "trie")


def _recombined(parts: DataFrame) -> DataFrame:
    """Shared nodes, one row each, with the totals of all shards. Grouped by digest
    first; the sums along the ways take one task over at most 2 x shards x (longest
    conversation + 1) rows."""
    rows = parts.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("pk1").alias("pk1"), F.first("pk2").alias("pk2"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.first("chars").alias("chars"),
    )
    names = ["k1", "k2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).to_pydict()
        at = {k: i for i, k in enumerate(zip(t["k1"], t["k2"], strict=True))}
        up = [at.get(k) if d else None for k, d in zip(zip(t["pk1"], t["pk2"], strict=True), t["depth"], strict=True)]
        for i in sorted(range(len(up)), key=lambda i: -t["depth"][i]):
            t["n_leaves"][i] += t["n_children"][i] == 0
            t["saved_tokens"][i] += (t["n_convs"][i] - 1) * t["chars"][i]
            if up[i] is not None:
                t["n_children"][up[i]] += 1
                t["n_leaves"][up[i]] += t["n_leaves"][i]
                t["saved_tokens"][up[i]] += t["saved_tokens"][i]
        t["parent_conv_id"] = [None if u is None else t["conv_id"][u] for u in up]
        yield pa.RecordBatch.from_arrays([pa.array(t[k], pa.int32() if k == "depth" else pa.int64()) for k in names], names=names)

    schema = ", ".join(f"{k} {'int' if k == 'depth' else 'long'}" for k in names)
    return written(map_arrow(rows.repartition(1), run, schema), "shared-nodes")


def prefix_trie(seqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of conversations (conv_id, turns). A node goes by its smallest
    member and its depth. ``ends`` has the ids of the conversations that end at a
    node, ascending, in one or more parts (conv_id, depth, part, conv_ids)."""
    parts = shard_parts(seqs)
    shared = _recombined(parts)
    small = F.broadcast if shared.count() <= BROADCAST else (lambda df: df)
    values = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    own = parts.filter("k1 is null")
    names = shared.select(F.col("k1").alias("pk1"), F.col("k2").alias("pk2"), F.col("conv_id").alias("up"))
    below = own.filter("pk1 is not null").join(small(names), ["pk1", "pk2"], "left")  # their parents' ids are known now
    nodes = own.filter("pk1 is null").select("conv_id", "depth", "parent_conv_id", *values)
    nodes = nodes.unionByName(below.select("conv_id", "depth", F.col("up").alias("parent_conv_id"), *values))
    nodes = nodes.unionByName(shared.select("conv_id", "depth", "parent_conv_id", *values))
    names = shared.select("k1", "k2", F.col("conv_id").alias("low"))
    some = parts.filter(F.size("ends") > 0)
    ends = some.filter("k1 is null").select("conv_id", "depth", "part", F.col("ends").alias("conv_ids"))
    return nodes, ends.unionByName(some.filter("k1 is not null").join(small(names), ["k1", "k2"]).select(F.col("low").alias("conv_id"), "depth", "part", F.col("ends").alias("conv_ids")))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256): the hash of the decimal ids, comma-joined. A
    node's parts (one for each shard it lies in) stream through one task's hash."""

    def run(batches):
        last, hasher, out = None, None, []

        def flushed():
            cols = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.string()), strict=True)], names=["conv_id", "depth", "ends_sha256"])

        for b in batches:
            lists = b.column(2)
            for i, node in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                text = ",".join(map(str, lists[i].values.to_pylist())).encode()
                if node == last:
                    hasher.update(b"," + text)
                    continue
                if last is not None:
                    out.append((*last, hasher.hexdigest()))
                last, hasher = node, hashlib.sha256(text)
            if len(out) >= 10_000:
                yield flushed()
                out = []
        if last is not None:
            out.append((*last, hasher.hexdigest()))
        if out:
            yield flushed()

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = ends.repartition(n, "conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part").select("conv_id", "depth", "conv_ids")
    return map_arrow(rows, run, "conv_id long, depth int, ends_sha256 string")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie(rebuilt(sequences(table(spark, sf_dir, "conversations"))))
    out = nodes.join(ends_digests(ends), ["conv_id", "depth"], "left")
    longs = [F.col(c).cast("long").alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    return out.select(*longs, F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
