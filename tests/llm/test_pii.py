"""Personal data: base spans against Python's re, added spans, redaction, no Python in the plan."""

import hashlib
import random
import re

from brute import ODD

from ledgerscope.llm import pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    out = []
    for k, (n, p) in enumerate(BASE.items()):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            if n == "ip" and any(int(x) > 255 for x in m.group().split(".")) or n == "card" and not (14 <= len(d) <= 19 and _luhn(d)) or n == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, f"{n}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def _rows(spark, monkeypatch, docs):
    monkeypatch.setattr(pii, "table", lambda *a: docs)
    return {r.doc_id: r for r in pii.op4_pii(spark, "").collect()}


def test_base_spans(spark, monkeypatch, odd_docs):
    r = random.Random(5)
    texts = dict(enumerate(ODD)) | {None: "no id at all"}
    texts |= {100 + i: "".join(r.choice("ab1 2-.@+()9 0é,\n4111") for _ in range(r.randrange(120))) for i in range(1200)}
    more = {5000: "4111 1111 1111 1111 4111111111111111 " * 40, 5001: "1.2.3.4" * 500, 5002: "a@b.c_d@e.f 1.2.3.4.5 300.1.1.1 0001.02.3.255"}
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([*[(k, v) for k, v in texts.items() if k is not None and k >= 100], *more.items()], "doc_id long, text string"))
    got = _rows(spark, monkeypatch, docs)
    for k, t in (texts | more).items():
        want = base_spans(t or "") if len(t or "") < 40_000 else []
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert set(want) <= set(got[k].spans.split(",")) | {""}
        assert [got[k].n_email, got[k].n_ip, got[k].n_card, got[k].n_phone] == [sum(w.startswith(n + ":") for w in want) for n in BASE]


def test_long_runs_stay_linear(spark, monkeypatch):
    docs = spark.createDataFrame([(0, "x" * 300_000), (1, "1" * 200_000), (2, "a." * 100_000), (3, "1." * 100_000), (4, "1 " * 100_000)], "doc_id long, text string")
    assert all(r.spans == "" for r in _rows(spark, monkeypatch, docs).values() if r.doc_id != 3)


def test_added_spans_and_redaction(spark, monkeypatch):
    text = "call (212) 555-1234 or joe (at) example (dot) com, server 10[.]0[.]0[.]1; invoice 4111 and 2024-01-02, at 5 (at home) 555 1234"
    docs = spark.createDataFrame([(0, text, "x"), (1, None, "x"), (2, "", "x"), (3, "plain words, 3.14 and 1,000", "x")], "doc_id long, text string, cand string")
    got = _rows(spark, monkeypatch, docs.select("doc_id", "text"))
    spans = [s.split(":") for s in got[0].spans.split(",")]
    assert [(k, text[int(a) : int(b)]) for k, a, b in spans] == [("phone", "(212) 555-1234"), ("email", "joe (at) example (dot) com"), ("ip", "10[.]0[.]0[.]1")]
    assert got[3].spans == "" and got[1].spans == ""
    out = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert out[0].startswith("call [PHONE] or [EMAIL], server [IP]; invoice 4111") and out[1] is None and out[2] == ""
    assert out[3] == "plain words, 3.14 and 1,000" and pii.redacted(docs).columns == docs.columns


def test_empty_table(spark, monkeypatch, no_docs):
    assert _rows(spark, monkeypatch, no_docs) == {} and pii.redacted(no_docs).count() == 0


def test_no_python_in_the_plan(spark, odd_docs):
    plan = pii.spans_of(odd_docs, "text", "found")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_em_separates_true_from_false():
    rows = [{"kind": 3, "votes": [0, 1, 1, 0, 1], "shape": 1, "count": 300}, {"kind": 3, "votes": [0, -1, 0, -1, -1], "shape": 1, "count": 200}]
    w = pii.fit_votes(rows)[3]
    good = w[0] + w[2] + w[3] + w[5] + w[12]
    bad = w[0] + w[7] + w[9] + w[10] + w[12]
    assert good > 0 > bad
