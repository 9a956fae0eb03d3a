"""SimHash, embeddings, components and the block runs behind them."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import ODD, Union, fingerprint, near_vectors

from ledgerscope.llm import embedding_dedup, simhash
from ledgerscope.llm.components import components


def test_components(spark):
    r = random.Random(1)
    for pairs in ([(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)], [(r.randrange(200), r.randrange(200)) for _ in range(110)], []):
        got = {x.node: x.component for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        nodes = sorted({x for p in pairs if p[0] != p[1] for x in p})
        u = Union(len(nodes))
        for a, b in pairs:
            if a != b:
                u.join(nodes.index(a), nodes.index(b))
        assert got == dict(zip(nodes, u.lowest(nodes), strict=True))


def test_fingerprints_match_brute_force():
    r = random.Random(2)
    texts = [t or "" for t in ODD if len(t or "") < 1000] + [" ".join(r.choice(["A", "b", "Çé", "d\n"]) for _ in range(r.randrange(40))) for _ in range(150)]
    assert [int(x) for x in simhash.fingerprints(texts)] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("max_bits, segments", [(4, 6), (3, 6), (4, 7)])
def test_chains_hold_for_all_pairs_within_the_limit(max_bits, segments):
    r = np.random.default_rng(3)
    flips = np.zeros(5000, np.uint64)
    for i in range(5000):
        for b in r.choice(64, r.integers(0, max_bits + 1), replace=False):
            flips[i] |= np.uint64(1) << np.uint64(b)
    assert simhash.chained(flips, max_bits, segments).all()


def test_links_connect_what_brute_force_connects(spark):
    r = np.random.default_rng(4)
    fps = list(r.integers(0, 1 << 63, 150, dtype=np.uint64))
    for _ in range(500):  # neighbours at 1 to 6 bits, and a hot group
        x = int(fps[r.integers(0, 40)])
        for b in r.choice(64, r.integers(1, 7), replace=False):
            x ^= 1 << int(b)
        fps.append(np.uint64(x))
    fps = np.unique(np.array(fps, np.uint64))
    signed = fps.view(np.int64).tolist()
    got = {x.node: x.component for x in components(simhash.linked(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()}
    u = Union(len(fps))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 4):
            u.join(i, i + 1 + int(j))
    low = u.lowest(signed)
    assert all(got.get(x, x) == y for x, y in zip(signed, low, strict=True))


def test_simhash_edges(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = dict(enumerate(ODD))
    assert all(r.fp % (1 << 64) == fingerprint(texts[r.doc_id]) for r in rows if r.doc_id is not None and len(texts[r.doc_id] or "") < 1000)
    same = {r.component_id for r in rows if r.doc_id in (0, 1, 2)}
    assert same == {0}  # null, empty and blank: fingerprint zero
    one = simhash.one_of_each(odd_docs)
    kept = [r.doc_id for r in one.collect()]
    assert one.columns == odd_docs.columns and len(kept) == len(set(kept))
    assert {r.component_id for r in rows if r.component_id is not None} <= set(kept)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_of_each(no_docs).count() == 0


def test_one_of_each_component_whatever_its_ids(spark):
    """Null ids and an id with two texts: components are told apart by texts, not by names."""
    r = random.Random(6)
    texts = [" ".join(r.choice("abcdefghijklmnopqrstuvwxyz") * 5 + str(r.randrange(999)) for _ in range(80)) for _ in range(12)]
    rows = [(None, t, "s") for t in texts[:6]] * 2  # six components of null ids alone, two rows each
    rows += [(5, texts[6], "s"), (5, texts[7], "s"), (5, texts[8], "s"), (3, texts[8], "s")]  # id 5 in three components, one of them 3's
    rows += [(None, texts[9], "s"), (7, texts[9], "s"), (8, texts[10], None), (8, texts[10], "s"), (9, None, "x"), (9, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [(x.doc_id, x.text) for x in simhash.one_of_each(df).collect()]
    want = [(None, t) for t in texts[:6]] + [(5, texts[6]), (5, texts[7]), (3, texts[8]), (7, texts[9]), (8, texts[10]), (9, None), (9, "x")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_simhash_query_on_a_whole_table(spark, sf):
    got = simhash.op6_simhash(spark, sf).toPandas().sort_values("doc_id")
    f = np.array([int(x, 16) for x in got.fingerprint], np.uint64)
    u = Union(len(f))
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 4):
            u.join(i, i + 1 + int(j))
    assert got.component_id.tolist() == u.lowest(got.doc_id.tolist())


def _planted(seed):
    r = np.random.default_rng(seed)
    rows = []
    for b in r.normal(size=(150, 48)):
        rows.append(b)
        for _ in range(r.integers(0, 4)):
            c, n = r.uniform(0.975, 1.0), r.normal(size=48)
            n -= n @ b / (b @ b) * b
            rows.append((c * b + np.sqrt(1 - c * c) * n * np.linalg.norm(b) / np.linalg.norm(n)) * r.uniform(0.5, 2))
    return rows + [rows[0]] * 30 + [rows[1] + r.normal(size=48) * 0.01 for _ in range(80)], r


def test_embeddings_recall_and_counts(spark):
    """Brute-force recall of links, at the threshold and above: 0.9 is asked for."""
    rows, r = _planted(0)
    labels, ids = [int(x) for x in r.integers(0, 2, len(rows))], list(range(len(rows)))
    df = spark.createDataFrame([(i, [float(v) for v in x], k, "x") for i, x, k in zip(ids, rows, labels, strict=True)], "vec_id long, embedding array<double>, label int, rep string")
    got = embedding_dedup.near_embeddings(df, block=32).toPandas().set_index("vec_id").sort_index()
    n, low = near_vectors(ids, rows, labels)
    assert (got.n_links <= n).all() and got.n_links.sum() >= 0.99 * sum(n)
    assert (got.component_id == low).mean() > 0.99
    assert (got.kept == (got.index == got.component_id)).all()


def test_recall_of_a_length_with_too_few_vectors_to_learn_from(spark):
    """Random axes: as many links as brute force finds, for 60 vectors of one length beside 400 of another."""
    r = np.random.default_rng(7)
    rows = [x for x in r.normal(size=(400, 32))]
    for b in r.normal(size=(20, 48)):
        for _ in range(3):
            n = r.normal(size=48)
            n -= n @ b / (b @ b) * b
            rows.append(0.995 * b + 0.0998 * n * np.linalg.norm(b) / np.linalg.norm(n))
    df = spark.createDataFrame([(i, [float(v) for v in x], 1) for i, x in enumerate(rows)], "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_embeddings(df).toPandas().set_index("vec_id").sort_index()
    few = [np.float32(x) for x in rows[400:]]
    n, low = near_vectors(list(range(400, 460)), few, [1] * 60)
    assert sum(n) > 60 and got.n_links[400:].sum() >= 0.95 * sum(n) and (got.n_links[400:] <= n).all()
    assert (got.component_id[400:] == low).mean() >= 0.95 and got.n_links[:400].sum() == 0


def test_entries_alone_in_their_bucket_go():
    r = np.random.default_rng(8)
    for size in (0, 1, 2, 40, 300):
        key = np.sort(r.integers(0, max(1, size), size))
        rep = np.arange(size)
        batches, at = [], 0
        while at < size:
            to = at + int(r.integers(1, 6))
            batches.append(pa.RecordBatch.from_arrays([pa.array(key[at:to]), pa.array(rep[at:to])], names=["bucket", "rep"]))
            at = to
        got = [x for b in embedding_dedup.shared(iter(batches)) for x in b.column(1).to_pylist()]
        n = np.bincount(key, minlength=1) if size else []
        assert got == [i for i in range(size) if n[key[i]] > 1 or i in (0, size - 1)]


def test_lowest_linked_matches_union_find():
    r = np.random.default_rng(9)
    for size in (1, 2, 5, 40):
        hit = r.random((30, size, size)) < r.choice([0.02, 0.1, 0.5], 30)[:, None, None]
        hit |= hit.transpose(0, 2, 1)
        hit[:, np.arange(size), np.arange(size)] = False
        for h, low in zip(hit, embedding_dedup.lowest_linked(hit), strict=True):
            u = Union(size)
            for i, j in zip(*np.nonzero(h), strict=True):
                u.join(i, j)
            assert low.tolist() == u.lowest(list(range(size)))


def test_embedding_edges(spark):
    odd = [(0, None, 1), (1, [0.0, 0.0], 1), (2, [float("nan"), 1.0], 1), (3, [None, 1.0], 1), (4, [1.0, 1.0], None), (5, [], 1), (6, [float("inf"), 1.0], 1)]
    fine = [(7, [1.0, 1.0], 1), (8, [2.0, 2.0], 1), (9, [1e200, 1e200], 1), (10, [1.0, 1.0, 1.0], 1), (11, [1.0, 1.0], 2), (11, [1.0, 1.0], 2)]
    df = spark.createDataFrame([*odd, *fine, (None, [1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_embeddings(df).collect()}
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (*range(7), 10))
    assert [got[i].component_id for i in (7, 8, 9)] == [7, 7, 7] and got[7].n_links == 2
    assert got[11].component_id == 11 and got[None].n_links == 0
    assert embedding_dedup.near_embeddings(df.limit(0)).count() == 0


def test_one_id_with_vectors_of_other_label_and_length(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0, 0.0], 2), (2, [1.0, 0.01], 1), (3, [0.0, 1.0, 0.01], 2), (3, [1.0, 0.0, 0.0], 1)]
    rows += [(4, [1.0, 1.0], 1), (4, [1.0, -1.0], 2), (5, [1.0, -1.01], 1)]  # 5 is near 4's vector of the other label
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(x) for x in embedding_dedup.near_embeddings(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (3, 1, 1, False), (4, 0, 4, True), (4, 0, 4, True), (5, 0, 5, True)]
