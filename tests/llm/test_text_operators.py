"""Quality rules, language ID, mixing: brute force, edges, whole tables."""

import random
from collections import Counter

import numpy as np
import pytest
from brute import ODD, WORD, rules
from pyspark.sql import functions as F

from ledgerscope.llm import language_id, mixing, quality_rules
from ledgerscope.llm.prefix import running_sums


def test_rule_counts_match_brute_force(spark, odd_docs):
    r = random.Random(5)
    texts = [" ".join(r.choice(["a", "b", "cc", "\n", "#x", "é"]) for _ in range(r.randrange(90))) for _ in range(200)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(texts, 1000)), "doc_id long, text string"))
    got = quality_rules.judge(docs).collect()
    want = {i: t for i, t in [*enumerate(texts, 1000), *enumerate(ODD), (None, "no id at all")]}
    assert len(got) == docs.count()
    for g in got:
        n = rules(want[g.doc_id])
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == n
        assert g.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (g.kept and g.base_failed)


def test_label_model_finds_the_accurate_rules():
    r = np.random.default_rng(1)
    good = r.random(4000) < 0.8
    accuracy = [0.95, 0.9, 0.85, 0.6]
    votes = np.stack([np.where(r.random(4000) < a, np.where(good, 1, -1), np.where(good, -1, 1)) for a in accuracy], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    m = quality_rules.fit_label_model(patterns, counts, outweigh=1.0)
    right = m["chance"][1, :, 2]
    assert abs(m["prior"] - 0.8) < 0.06 and right[0] > right[3] and abs(right[0] - 0.95) < 0.06


def test_rules_keep_clean_documents_and_agree_with_labels(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    got = quality_rules.op5_quality_rules(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").toPandas()
    fine = got[~got.base_failed]
    assert fine[fine.quality == 1].kept.mean() > 0.97
    assert (~fine[fine.quality == 0].kept).mean() > 0.9


def test_empty_tables(spark, no_docs):
    assert quality_rules.judge(no_docs).count() == 0
    assert language_id.identify(no_docs, language_id.learn(no_docs)).count() == 0
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def _grams(text):
    c, words, now = Counter(), [], ""
    for ch in text or "":
        if ch.isalpha():
            now += ch.lower()[0]
        elif now:
            words, now = [*words, now], ""
    p = language_id._PAD
    for w in [*words, now] if now else words:
        y = [0, *map(ord, w), 0]
        c.update((a << 42) | (p << 21) | p for a in y[1:-1])
        c.update((y[i] << 42) | (y[i + 1] << 21) | p for i in range(len(y) - 1))
        c.update((y[i] << 42) | (y[i + 1] << 21) | y[i + 2] for i in range(len(y) - 2))
    return c


def test_language_profiles_and_distance_match_brute_force():
    r = random.Random(2)
    texts = ["".join(r.choice("abcé ABÉñ1.,\n日ß") for _ in range(r.randrange(60))) for _ in range(200)] + ["", "12 3", "a"]
    ranked = lambda c, n: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:n]]
    profiles = {k: np.array(ranked(_grams(t), 30), np.int64) for k, t in (("aa", "abc abc cab"), ("bb", "bab é ñandu ab"))}
    langs, scores = language_id.predict(texts, profiles, top=30)
    for t, lang, score in zip(texts, langs, scores, strict=True):
        mine = ranked(_grams(t), 30)
        if not mine:
            assert (lang, score) == ("und", 0)
            continue
        place = {k: {int(g): i for i, g in enumerate(p)} for k, p in profiles.items()}
        away = {k: sum(abs(i - place[k][g]) if g in place[k] else 30 for i, g in enumerate(mine)) for k in profiles}
        best = min(sorted(away), key=away.get)
        assert lang == best and abs(score - (1 - away[best] / (len(mine) * 30))) < 1e-12


def test_language_edges_and_held_out_accuracy(spark, sf, odd_docs):
    got = {r.doc_id: r for r in language_id.identify(odd_docs, language_id.learn(odd_docs)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (0, 1, 2))
    none = language_id.identify(odd_docs, {}).collect()
    assert {r.lang_pred for r in none} == {"und"}
    p = language_id.op2_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (p[p.held_out].lang == p[p.held_out].lang_pred).mean() > 0.95


def test_running_sums(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None, "hot", "hot", "hot"]), i, r.randrange(9)) for i in range(700)]
    got = {x.i: x.before for x in running_sums(spark.createDataFrame(rows, "k string, i long, v long"), "k", ["i"], "v").collect()}
    total = Counter()
    for k, i, v in rows:
        assert got[i] == total[k]
        total[k] += v


def test_mix_meets_targets(spark, odd_docs):
    got = mixing.mix(odd_docs).toPandas()
    assert len(got) == odd_docs.count()
    size = {i: len(WORD.findall(t or "")) for i, t in [*enumerate(ODD), (None, "no id at all")]}
    per = {}
    for _, r in got.iterrows():
        i = None if np.isnan(r.doc_id) else int(r.doc_id)
        assert r["size"] == size[i] and 0 <= r.taken <= 2 * r["size"]
        k = r.source if isinstance(r.source, str) else None
        s = per.setdefault(k, [r.source_size, r.target, 0, 0])
        s[2] += r.taken
        s[3] += r["size"]
    assert all(abs(t - int(target)) == 0 and n == source for source, target, t, n in per.values())
    want = targets({k: s[0] for k, s in per.items()})
    assert all(abs(per[k][1] - want[k]) < 1e-6 for k in want)


def targets(sizes, weights=(5, 2, 1)):
    """Share, cap at twice the size, share the excess again until none is above."""
    names = sorted(sizes, key=lambda k: (k is None, k))
    w = {k: weights[i % 3] for i, k in enumerate(names)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        each = {k: left * w[k] / sum(w[x] for x in open_) for k in open_}
        over = [k for k in open_ if each[k] > 2 * sizes[k]]
        if not over:
            return out | each
        for k in over:
            out[k] = 2.0 * sizes[k]
            left -= out[k]
            open_.remove(k)
    return out


def test_target_levels(spark):
    r = random.Random(4)
    for n in (1, 2, 3, 7):
        sizes = {f"s{i}": r.choice([0, 1, 5, 50, 1000]) for i in range(n)} | {None: 7}
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
        got = {x.source: x.target for x in mixing.source_targets(df).collect()}
        assert all(abs(got[k] - v) < 1e-9 * (1 + v) for k, v in targets(sizes).items())


def test_mixed_documents_take_the_planned_words(spark, odd_docs):
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    got = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    plan = {r.source: r.n for r in mixing.mix(odd_docs).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in plan.items() if n}


@pytest.mark.parametrize("copies", [1, 7, 300])
def test_equal_rows_are_dealt_every_word(spark, copies):
    """Rows of one id and text, other columns unequal: together they give what the plan takes, each at most twice its size."""
    rows = [(1, "a b c d e f g h i j k l m", "s", i) for i in range(copies)] + [(2, "x " * 9, "t", 0), (3, "y " * 11, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, url long")
    want = {(r.doc_id, r.source): r.n for r in mixing.mix(docs).groupBy("doc_id", "source").agg(F.sum("taken").alias("n")).collect()}
    got, per = {}, {}
    for r in mixing.mixed_documents(docs).collect():
        n = len(r.text.split())
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + n
        per[r.doc_id, r.url] = per.get((r.doc_id, r.url), 0) + n
    assert got == {k: n for k, n in want.items() if n}
    assert all(per.get((1, i), 0) <= 26 for i in range(copies))
