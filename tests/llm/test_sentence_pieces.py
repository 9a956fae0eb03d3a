"""op11 against the sentencepiece library, which defines its results."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from brute import ODD

from ledgerscope.llm import sentence_pieces
from ledgerscope.llm.sentence_pieces import decoded, encoded, encoder, model_path, op11_sentence_pieces


@pytest.fixture(scope="module")
def lib():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path())


ALPHABETS = ["abcdefghij klmnopqrstuvwxyz", "  \n\tab", "etaoin shrdlu", "日本語テキスト中文 ab", "aéß ▁x\r\n;(){}", "\x00\x01퟿\U0001f600 a1 2=", "0123456789.,- ", "ABCDEFabcdef0123456789+/", " ", "x▁ "]


def test_random_texts_equal_the_library(lib):
    r = random.Random(11)
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 200))) for a in ALPHABETS for _ in range(60)] + [t or "" for t in ODD]
    enc = encoder()
    ids, off = enc.encode(pa.array(texts))
    for t, s, e in zip(texts, off, off[1:], strict=False):
        assert ids[s:e].tolist() == lib.encode(t), ascii(t[:60])


def test_long_unbroken_words_and_restarted_stores(lib, monkeypatch):
    r = random.Random(12)
    enc = encoder()
    long = [" " * 9_000, "x" * 9_000, "日本" * 5_000, "".join(r.choice("etaoinshrdlu") for _ in range(9_000))]
    # by rounds alone, by the heap alone, and with a store that starts anew at each call
    for most in (10**9, 1):
        monkeypatch.setattr(sentence_pieces, "LONG", most)
        enc._reset()
        for t in [*[x[:700] for x in long], "a few plain words  of text\n\nand some more"]:
            assert enc.encode(pa.array([t]))[0].tolist() == lib.encode(t)
    monkeypatch.undo()
    monkeypatch.setattr(sentence_pieces, "KEEP", 0)
    for t in long:
        assert enc.encode(pa.array([t]))[0].tolist() == lib.encode(t)


def test_a_model_of_another_kind_is_refused():
    with pytest.raises(Exception):  # noqa: B017 - the library itself refuses a file that isn't a model
        encoder(__file__)


def test_odd_rows(spark, odd_docs, no_docs, lib):
    rows = decoded(encoded(odd_docs)).collect()
    assert len(rows) == odd_docs.count()
    want = sorted((str(r.doc_id), lib.encode(r.text or "", add_eos=True)) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert all(r.text == lib.decode(r.ids) for r in rows)
    assert decoded(encoded(no_docs)).collect() == []
    no_ids = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert decoded(no_ids).first().text == ""


def test_query_on_a_whole_table(spark, sf, lib):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = lib.encode(r.text or "", add_eos=True)
        want[r.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op11_sentence_pieces(spark, sf).collect()}
    assert got == want
