"""op12 against plain-Python neighbours."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerscope.llm.spelling import forms, near_words, op12_spelling_variants, trie_nodes, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_words(docs, least=7, count=2):
    out = Counter()
    for i, text in docs:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= count}


def brute_forms(words, factor=10):
    alphabet = sorted({c for w in words for c in w})
    out, form = {}, {}
    for w, n in words.items():
        near = set()
        for i in range(len(w) + 1):
            near |= {w[:i] + c + w[i:] for c in alphabet if w[:i] + c + w[i:] in words}
            if i < len(w):
                near |= {x for x in (w[:i] + c + w[i + 1 :] for c in alphabet) if x in words}
                if w[:i] + w[i + 1 :] in words:
                    near.add(w[:i] + w[i + 1 :])
        near.discard(w)
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None
        out[w] = len(near)
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], out[w], words[form[w]] if form[w] else None))
    return rows


def table_rows(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_numbers_of_trie_nodes_name_prefixes(spark, shards):
    r = random.Random(3)
    words = sorted({"".join(r.choice("abé") for _ in range(r.randint(0, 7))) for _ in range(500)})
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        for reverse in (False, True):
            names: dict[str, set[int]] = {}
            ids = {}
            for row in trie_nodes(df, reverse).collect():
                assert len(row.nodes) == len(row.word) + 1
                ids[row.word] = row.nodes[-1]
                for i, x in enumerate(row.nodes):
                    names.setdefault(row.word[:i], set()).add(x)
            assert all(len(v) == 1 for v in names.values())
            assert len({next(iter(v)) for v in names.values()}) == len(names)
            assert [ids[w] for w in sorted(ids)] == sorted(ids.values())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_near_words_forms_and_roots(spark):
    r = random.Random(4)
    words = {"".join(r.choice("ab") for _ in range(r.randint(1, 6))): r.choice([1, 2, 3, 20, 25, 400, 9000]) for _ in range(400)}
    words |= {w: n for w, n in zip(["aaaaaaaaa", "aaaaaaaaaa", "aaaaaaaab", "caaaaaaaa", "caaaaaaab"], [5, 5, 50, 50, 6000], strict=True)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert table_rows(forms(near_words(df))) == brute_forms(words)


def test_long_words_and_empty_tables(spark):
    words = {"x" * 5_000: 30, "x" * 4_999: 2, "x" * 5_001: 2, "x" * 2_500 + "y" + "x" * 2_499: 300}
    got = {r.word: (r.n_near, r.form) for r in forms(near_words(spark.createDataFrame(list(words.items()), "word string, n long"))).collect()}
    long = "x" * 2_500 + "y" + "x" * 2_499
    assert got == {"x" * 5_000: (3, long), "x" * 4_999: (2, long), "x" * 5_001: (1, "x" * 5_000), long: (2, None)}
    assert forms(near_words(spark.createDataFrame([], "word string, n long"))).collect() == []


def test_words_of_odd_texts(spark, odd_docs, no_docs):
    r = random.Random(5)
    extra = [(i, " ".join(r.choice(["Spelling", "speÀling", "ÀßXwords÷x", "spellingsĀ", "a-b", "variant", "Variants"]) for _ in range(40))) for i in range(80)] + [(None, "spelling spelling")]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    want = brute_words([tuple(x) for x in docs.collect()])
    assert len(want) > 8
    assert {x.word: x.n for x in word_counts(docs).collect()} == want
    assert table_rows(forms(near_words(word_counts(docs)))) == brute_forms(want)
    assert word_counts(no_docs).collect() == []


def test_query_on_a_whole_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert table_rows(op12_spelling_variants(spark, sf)) == brute_forms(brute_words(docs))
