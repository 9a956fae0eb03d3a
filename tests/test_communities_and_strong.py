"""Communities against brute-force modularity, strong components against brute force, long chains."""

import random
import time

import pytest

from ledgerscope.operators import graph as GR
from ledgerscope.operators.communities import communities
from ledgerscope.operators.strong import strong_components


def _graph(spark, pairs, extra=()):
    nodes = sorted({x for p in pairs for x in p[:2]} | set(extra))
    rows = [(a, b, w) for a, b, w in [(*p, 1)[:3] for p in pairs]]
    return spark.createDataFrame(rows, "src string, dst string, weight long"), spark.createDataFrame([(n,) for n in nodes], "node string")


def _modularity(pairs, com):
    weight = {}
    for a, b, w in pairs:
        if a != b:
            weight[frozenset((a, b))] = weight.get(frozenset((a, b)), 0) + w
    m = sum(weight.values())
    inner, total = {}, {}
    for ab, w in weight.items():
        a, b = ab
        inner[com[a]] = inner.get(com[a], 0) + (w if com[a] == com[b] else 0)
        for x in ab:
            total[com[x]] = total.get(com[x], 0) + w
    return sum(inner.get(c, 0) / m - (t / (2 * m)) ** 2 for c, t in total.items())


def _partitions(items):
    if not items:
        yield []
        return
    for rest in _partitions(items[1:]):
        for i in range(len(rest)):
            yield rest[:i] + [[items[0], *rest[i]]] + rest[i + 1 :]
        yield [[items[0]], *rest]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_modularity_close_to_the_optimum(spark, seed):
    r = random.Random(seed)
    names = [f"n{i}" for i in range(8)]
    pairs = [(a, b, r.choice([1, 2, 5])) for a in names for b in names if a < b and r.random() < (0.8 if int(a[1]) // 4 == int(b[1]) // 4 else 0.2)]
    used = sorted({x for p in pairs for x in p[:2]})
    best = max(_modularity(pairs, {x: i for i, part in enumerate(p) for x in part}) for p in _partitions(used))
    edges, nodes = _graph(spark, pairs, ["alone"])
    com = {x.node: x.community for x in communities(edges, nodes).collect()}
    assert com["alone"] == "alone" and all(com[c] == c and c <= n for n, c in com.items())
    assert _modularity(pairs, com) >= 0.95 * best


def test_modularity_not_below_label_propagation_on_the_ledger(spark, sf):
    from ledgerscope.plans.registry import _g

    edges, nodes = _g(spark, sf)
    got = GR.modularity(edges, communities(edges, nodes)).first()
    other = GR.modularity(edges, GR.label_propagation(edges, nodes)).first()
    assert got.modularity >= other.modularity


def _brute_strong(pairs, nodes):
    out = {n: set() for n in nodes}
    for a, b, *_ in pairs:
        out[a].add(b)

    def reach(n):
        seen, todo = {n}, [n]
        while todo:
            for y in out[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        return seen

    to = {n: reach(n) for n in nodes}
    return {n: min(m for m in to[n] if n in to[m]) for n in nodes}


def test_strong_components_of_mixed_graphs(spark):
    r = random.Random(8)
    pairs = [(f"r{i}", f"r{(i + 1) % 9}") for i in range(9)]  # a ring alone
    pairs += [(f"c{i}", f"c{i + 1}") for i in range(12)] + [("c12", "r0")]  # a chain into it
    pairs += [(f"h{i}", f"h{i + 1}") for i in range(6)] + [("h6", "h0"), ("h2", "x"), ("x", "h5"), ("h3", "y")]  # a ring with a by-way
    pairs += [("u", "v"), ("v", "u"), ("s", "s")]
    pairs += [(f"g{r.randrange(30):02}", f"g{r.randrange(30):02}") for _ in range(55)]
    edges, nodes = _graph(spark, pairs, ["alone"])
    want = _brute_strong(pairs, [x.node for x in nodes.collect()])
    assert {x.node: x.component for x in strong_components(edges, nodes).collect()} == want


def test_a_chain_of_a_thousand_accounts(spark):
    names = [f"a{i:04}" for i in range(1_000)]
    random.Random(1).shuffle(names)
    edges, nodes = _graph(spark, list(zip(names, names[1:], strict=False)))
    began = time.time()
    rows = strong_components(edges, nodes).collect()
    assert len(rows) == 1_000 and all(x.node == x.component for x in rows)
    assert time.time() - began < 60


def test_strong_components_of_no_edges(spark):
    edges, nodes = _graph(spark, [("a", "b")])
    got = strong_components(edges.limit(0), nodes).collect()
    assert {x.node: x.component for x in got} == {"a": "a", "b": "b"}
    assert strong_components(edges.limit(0), nodes.limit(0)).collect() == [] and communities(edges.limit(0), nodes.limit(0)).collect() == []
