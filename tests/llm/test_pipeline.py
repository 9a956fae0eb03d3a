"""The five stages on a small table: what each keeps, changes and returns."""

import corpus_pipeline
import pytest
from brute import Union, fingerprint
from test_pii import base_spans


@pytest.fixture(scope="module")
def staged(spark, sf, tmp_path_factory):
    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs))
        stage(spark, docs, sf).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return dict([*out, ("end", docs)])


def test_stages_return_documents(staged):
    columns = staged["quality"].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "simhash", "pii", "mixing", "packing"]
    assert all(staged[n].columns == columns for n in ("simhash", "pii", "mixing", "packing"))


def test_quality_keeps_good_documents(spark, sf, staged):
    left = {r.doc_id for r in staged["simhash"].collect()}
    good = [r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()]
    assert sum(d in left for d in good) >= 0.97 * len(good)


def test_simhash_keeps_one_of_each_component(staged):
    before = sorted(staged["simhash"].collect(), key=lambda r: r.doc_id)
    fps, u = [fingerprint(r.text) for r in before], Union(len(before))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                u.join(i, j)
    assert sorted(r.doc_id for r in staged["pii"].collect()) == sorted(set(u.lowest([r.doc_id for r in before])))


def test_no_base_span_is_left(staged):
    before, after = ({r.doc_id: r for r in staged[n].collect()} for n in ("pii", "mixing"))
    assert before.keys() == after.keys() and any(base_spans(r.text) for r in before.values())
    for d, r in after.items():
        assert base_spans(r.text) == [] and r.n_chars == len(r.text)
        if not base_spans(before[d].text) and "[" not in r.text:
            assert r.text == before[d].text


def test_mix_and_pack(staged):
    import mixing_check

    mixing_check.check(staged["mixing"], staged["packing"])
    end = staged["end"].collect()
    assert {r.doc_id for r in end} == {r.doc_id for r in staged["packing"].collect()}


def test_run_and_null_columns(spark, sf, tmp_path):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "a b c", "en", "s", 5)], spark.read.parquet(f"{sf}/documents.parquet").schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0  # nothing learned: every score is 0.5, below 0.7
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() >= 1
