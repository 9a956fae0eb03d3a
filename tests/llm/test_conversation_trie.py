"""op13 against plain-Python tries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerscope.llm import conversation_trie
from ledgerscope.llm.conversation_trie import ends_digests, op13_conversation_trie, prefix_trie, rebuilt, sequences


def brute(rows, rebuild=True):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    seq = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    full = seq
    if rebuild:
        full = {}
        for c, own in seq.items():
            h = zlib.crc32(str(c).encode()) % 6
            full[c] = seq.get(c - c % 100, [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, s in full.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    out, total = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        m = nodes[k]
        leaves = sum(total[x][0] for x in kids[k]) if kids[k] else 1
        saved = sum(total[x][1] for x in kids[k]) + ((len(m) - 1) * len(k[-1][1]) if k else 0)
        total[k] = (leaves, saved)
        ends = ",".join(map(str, sorted(c for c in m if len(full[c]) == len(k))))
        parent = min(nodes[k[:-1]]) if k else None
        out[min(m), len(k)] = (parent, len(m), len(kids[k]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def as_dict(nodes, ends):
    sha = {(r.conv_id, r.depth): r.ends_sha256 for r in ends_digests(ends).collect()}
    rows = nodes.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, sha.get((r.conv_id, r.depth), conversation_trie.NO_ENDS)) for r in rows}
    assert len(out) == len(rows)
    return out


SCHEMA = "conv_id long, turn int, role string, text string"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(13)
    out = [(c, t, r.choice(["user", "bot"]), r.choice("ab") * r.choice([1, 3])) for c in range(300) for t in range(r.choice([0, 1, 2, 3, 7]))]
    out += [(c, t, "user", "the same words") for c in range(1000, 1400) for t in range(3)]  # over half of all are copies
    out += [(2000, t, "user", "x" if t % 7 else None) for t in range(90)] + [(2001, t, "user", "x" if t % 7 else None) for t in range(70)]  # deep
    out += [(7, None, None, None), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 1, "bot", "tie"), (None, 1, "user", "nobody's"), (2105, 0, "user", "base absent")]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("shards", [1, 2, 8, 31])
def test_any_number_of_shards_gives_the_trie(spark, rows, shards, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CELLS", max(1, 4_000 // shards))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        assert as_dict(*prefix_trie(sequences(df))) == brute(rows, rebuild=False)
        assert as_dict(*prefix_trie(rebuilt(sequences(df)))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_shared_nodes_without_a_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BROADCAST", 0)
    assert as_dict(*prefix_trie(rebuilt(sequences(spark.createDataFrame(rows, SCHEMA))))) == brute(rows)


def test_empty_table_and_clashing_columns(spark, rows):
    none = spark.createDataFrame([], SCHEMA)
    nodes, ends = prefix_trie(rebuilt(sequences(none)))
    assert nodes.collect() == [] and ends.collect() == []
    few = rows[:200]
    wide = spark.createDataFrame([(*r, 1, "p", 2, 3) for r in few], SCHEMA + ", h int, path string, k1 int, turns int")
    assert as_dict(*prefix_trie(rebuilt(sequences(wide)))) == brute(few)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_on_a_whole_table(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in op13_conversation_trie(spark, path).collect()}
    assert got == brute(rows)
