"""Chunk tokenizer, range coder, token files, packing: exact round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import ODD
from pyspark.sql import functions as F

from ledgerscope.llm import packing, rans, token_files
from ledgerscope.llm.tokens import tokenizer


def _ids(text, end):
    return [*tokenizer().lib.encode(text or "", add_special_tokens=False).ids, end]


def test_chunks_give_the_ids_of_whole_texts():
    r = random.Random(3)
    some = ["a", "the", " ", "  ", "\n", "\t", " ", "é", "'s", "1", "\x0b", "\x85", " ", ".", "word", "<|endoftext|>", "ñ", "\x1c", "你", " \n", "\n "]
    texts = ["".join(r.choice(some) for _ in range(r.randrange(14))) for _ in range(4000)] + ODD
    ids, off = tokenizer().encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == _ids(t, 0)[:-1]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, rans.LANES * rans.STEP, rans.BLOCK, rans.BLOCK + 1, 2 * rans.BLOCK + 70_001])
def test_range_coder_round_trip(n):
    r = np.random.default_rng(n)
    ids = (r.zipf(1.3, n) % 50_257).astype(np.uint32)
    lengths = np.array([n // 3, n - n // 3, 0], np.uint32)
    back, sizes = rans.decode(rans.encode(ids, lengths))
    assert (back == ids).all() and (sizes == lengths).all()


def test_range_coder_with_many_symbols_and_one():
    for ids in (np.arange(60_000, dtype=np.uint32), np.full(5000, 4_000_000_000, np.uint32)):
        assert (rans.decode(rans.encode(ids, np.array([len(ids)])))[0] == ids).all()


def test_damage_is_found():
    ids = np.arange(9000, dtype=np.uint32) % 700
    data = bytearray(rans.encode(ids, np.array([9000])))
    data[-5] ^= 1
    with pytest.raises(ValueError):
        rans.decode(bytes(data))


def test_token_files_hold_every_document(spark, odd_docs, no_docs, tmp_path):
    path = f"{tmp_path}/files"
    token_files.write_token_files(odd_docs, path)
    got = sorted(token_files.read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    assert len(got) == odd_docs.count()
    order = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    at, texts = 0, dict(enumerate(ODD)) | {None: "no id at all"}
    for r in got:
        want = _ids(texts[r.doc_id], 0)
        assert (r.start, r.n_tokens, r.ids) == (at, len(want), want)
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        at += len(want)
    token_files.write_token_files(no_docs, f"{tmp_path}/none")
    assert token_files.read_token_files(spark, f"{tmp_path}/none").count() == 0


def _check_packed(rows, texts, capacity):
    docs, bins = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    for d, ps in docs.items():
        want, at = _ids(texts[d], packing.END_ID), 0
        copies = sum(p.piece == 0 for p in ps)
        for p in sorted(ps, key=lambda p: p.piece)[::copies]:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(want[at : at + p.length], "<u4").tobytes())
            assert p.length == capacity or p.piece == 0
            at += p.length
        assert at == len(want)
    for ps in bins.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(bins)


def test_packing_is_exact_and_tight(spark, odd_docs, no_docs, sf):
    texts = dict(enumerate(ODD)) | {None: "no id at all"}
    _check_packed(packing.pack(odd_docs).collect(), texts, 1024)
    assert packing.pack(no_docs).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.op7_best_fit_packing(spark, sf).collect()
    used = _check_packed(rows, {r.doc_id: r.text for r in docs.collect()}, 1024)
    assert used <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1


def test_packing_holds_every_capacity(spark, odd_docs):
    rows = packing.pack(odd_docs, max_docs=2, max_cost=1024 * 1024).groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("length") * F.col("length")).alias("c")).collect()
    assert all(r.n <= 2 and r.c <= 1024 * 1024 for r in rows)


@pytest.mark.parametrize("rule, weights", packing.RULES)
def test_plan_places_every_piece_once(rule, weights):
    r = np.random.default_rng(6)
    counts = {int(k): int(n) for k, n in zip(*np.unique(r.integers(1, 1025, 5000), return_counts=True), strict=True)}
    slots, used = packing.plan(counts, rule=rule, weights=weights, max_docs=20, max_cost=900_000 + 1024 * 1024)
    placed, fill = {}, {}
    for length, rank, many, first, offset in slots:
        placed.setdefault(length, []).extend(range(rank, rank + many))
        for s in range(first, first + many):
            fill.setdefault(s, []).append((offset, length))
    assert all(sorted(placed[k]) == list(range(n)) for k, n in counts.items()) and len(fill) == used
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and len(parts) <= 20


def test_equal_pieces_of_a_hot_length(spark):
    docs = spark.createDataFrame([(i, "same words") for i in range(900)], "doc_id long, text string").repartition(7)
    rows = packing.pack(docs, capacity=16).collect()
    assert _check_packed(rows, dict.fromkeys(range(900), "same words"), 16) == -(-900 // (16 // len(_ids("same words", 2))))
