"""JSON arrays, objects and lines cut into records by byte ranges, and their scores."""

import json
import random

import pytest

from ledgerscope.sources.json_records import read_json_text, write_json_array


def _nasty(rng, i):
    text = "".join(rng.choice(['{', '}', '"', "\\", "[", "]", ",", "a", "é", "\n", " "]) for _ in range(rng.randrange(12)))
    return {"id": i, "t": text, "in": {"x": [{"y": text}, {}]} if i % 3 else {}, "}{": None}


def _layouts(rows):
    yield "array", json.dumps(rows)
    yield "pretty", json.dumps(rows, indent=2, ensure_ascii=False) + "\n"
    yield "lines", "\n".join(json.dumps(r) for r in rows) + "\n"
    yield "concatenated", "".join(json.dumps(r) for r in rows)


@pytest.fixture()
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("max_broadcast", [100_000, 0])
def test_every_layout_gives_the_records(spark, tmp_path, small_ranges, max_broadcast):
    rng = random.Random(5)
    rows = [_nasty(rng, i) for i in range(200)]
    rows.append({"id": 200, "t": "}" * 7_000, "long": ["{" * 50] * 3})  # over several ranges
    rows += [_nasty(rng, i) for i in range(201, 260)]
    for name, text in _layouts(rows):
        path = tmp_path / f"{name}-{max_broadcast}.json"
        path.write_text(text, encoding="utf-8")
        df = read_json_text(spark, str(path), max_broadcast)
        got = sorted((json.loads(r.record) for r in df.collect()), key=lambda r: r["id"])
        assert got == rows, name


def test_one_object_empty_files_and_a_cut_file(spark, tmp_path):
    cases = {"one": '{"id": 1}', "none": "", "array": "[]", "blank": " \n", "cut": '[{"id": 2}, {"id": 3456'}
    for name, text in cases.items():
        (tmp_path / f"{name}.json").write_text(text)
    read = lambda n: sorted(r.record for r in read_json_text(spark, str(tmp_path / f"{n}.json")).collect())
    assert read("one") == ['{"id": 1}']
    assert read("none") == read("array") == read("blank") == []
    assert read("cut") == ['{"id": 2}', '{"id": 3456']
    folder = sorted(r.record for r in read_json_text(spark, str(tmp_path)).collect())
    assert folder == ['{"id": 1}', '{"id": 2}', '{"id": 3456']


def test_arrays_written_by_partitions_come_back(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "concat('\"}', id) AS t").repartition(7)
    path = write_json_array(df, str(tmp_path / "out"))
    got = read_json_text(spark, path).selectExpr("from_json(record, 'id long, t string') AS r").select("r.*")
    assert sorted(got.collect()) == sorted(df.collect())
    for part in (tmp_path / "out").glob("part-*"):
        if part.stat().st_size:
            assert isinstance(json.loads(part.read_text()), list)
