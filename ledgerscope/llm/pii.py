"""Personal data by weak-supervision aggregation, in DataFrame functions only.

Strict patterns give the base spans, loose ones further candidates (obfuscated
addresses, national numbers, IPv6, cards with other separators). Five labelers
vote on each candidate: its strict pattern and check digits; a gazetteer (top
domains, issuer digits, address ranges, area codes); words of context that point
to its kind; words that point away from it; its borders. Counts of vote patterns
(4 kinds x 3^5 rows at most) go to expectation-maximisation, which estimates for
each kind how often a labeler votes each way on true and on false candidates. The
posteriors train the final span classifier, a logistic model over votes and
shape, again on counts of patterns. Base spans stay whatever it says; another
candidate becomes a span if it scores 0.5 or more and meets no base span.

Positions are code points: text is split at a pattern, and lengths of gaps and
matches are added up.

Defined cases: a null or empty text has no spans; repeated rows get equal
results; an empty table gives no rows; other columns are kept or ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm.common import fresh, table, written

KINDS = ("email", "ip", "card", "phone")

# The base patterns of the contract. Runs are possessive and start at a run's first
# character or where the last match ended, which changes no match but keeps long runs linear.
_LOCAL, _LABEL, _PART = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]", "[0-9]++"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": rf"(?:\G|(?<![0-9])){_PART}\.{_PART}\.{_PART}\.{_PART}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OPEN, _CLOSE = r"\x20?[\(\[\{]\x20?", r"\x20?[\)\]\}]\x20?"
LOOSE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}{{1,64}}+{_OPEN}(?i:at){_CLOSE}{_LABEL}{{1,63}}+(?:(?:{_OPEN}(?i:dot){_CLOSE}|\.){_LABEL}{{1,63}}+){{1,9}}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])|(?<![0-9])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9./_])[0-9]{4}([./_\x{A0}])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9./_])",
    "phone": r"(?<![0-9+.-])(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[\x20.-])[2-9][0-9]{2}[\x20.-][0-9]{4}(?![0-9.-])|(?<![0-9+.-])00[1-9][0-9]{0,2}[\x20.-](?:[0-9][\x20().-]{0,2}){6,12}[0-9](?![0-9])",
}
#: Each kind's texts hold this; the rest is not searched.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TOP_DOMAINS = "com org net edu gov mil int info biz io co ai dev app me de fr es it nl uk us eu ch at pl se no dk fi pt br mx ar cl in jp cn kr au nz ca ru za test example".split()
TOWARD = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|reach|correo|courriel|kontakt)\b",
    "ip": r"(?i)\b(ip|ipv4|ipv6|host|server|address|client|login|gateway|dns)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|debit|payment|pay|tarjeta|carte|karte)\b",
    "phone": r"(?i)\b(tel|phone|call|fax|mobile|cell|whatsapp|sms|tfno|telefon|t[ée]l[ée]phone|tel[ée]fono)\b",
}
AWAY = r"(?i)\b(version|release|build|isbn|issn|doi|order|invoice|ticket|section|figure|fig|chapter|page|part|sku|serial|article)\b"
CONTEXT = 24
LABELERS = ("pattern", "gazetteer", "toward", "away", "border")

_SPAN = "array<struct<start:int,kind:int,end:int,base:boolean,ok:boolean,word:string>>"


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a text of digits holds."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def passes(kind: str, word: Column) -> Column:
    """The contract's check on a match of the base pattern."""
    if kind == "ip":
        part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return word.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(F.length(word) > 38, F.lit(False)).otherwise(F.when(F.length(_digits(word)).between(14, 19), _luhn(_digits(word))).otherwise(False))
    if kind == "phone":
        return F.length(_digits(word)).between(10, 15)
    return F.lit(True)


def found(text: Column, kind: str, base: bool) -> Column:
    """Spans of one pattern: of the base ones those that pass, of the loose ones all."""
    pattern = F.lit((BASE if base else LOOSE)[kind])

    def add(acc: Column, both: Column) -> Column:
        word = both["word"]
        start = acc["pos"] + F.length(both["gap"])
        end = start + F.length(F.coalesce(word, F.lit("")))
        ok = passes(kind, word) if base or kind in ("card",) else F.lit(True)
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), F.lit(base).alias("base"), F.coalesce(ok, F.lit(False)).alias("ok"), word.alias("word"))
        keep = F.when(word.isNull(), acc["found"])
        keep = keep.when(~ok, acc["found"]) if base else keep
        return F.struct(end.alias("pos"), keep.otherwise(F.array_append(acc["found"], span)).alias("found"))

    both = F.zip_with(F.split(text, BASE[kind] if base else LOOSE[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0)), lambda g, w: F.struct(g.alias("gap"), w.alias("word")))
    none = F.array().cast(_SPAN)
    return F.aggregate(both, F.struct(F.lit(0).alias("pos"), none.alias("found")), add)["found"]


def candidates(text: Column) -> Column:
    """All base spans, and the loose ones that meet none of them."""
    none = F.array().cast(_SPAN)
    digit = text.rlike("[0-9]")
    parts = []
    for k in KINDS:
        need = text.contains(NEEDS[k]) if NEEDS[k] else F.lit(True)
        need = need if k == "email" else need & digit
        parts.append(F.when(need, found(text, k, True)).otherwise(none))
    base = F.array_sort(F.concat(*parts))
    loose = F.concat(
        F.when(text.rlike(r"(?i)[\(\[\{]\x20?at\x20?[\)\]\}]"), found(text, "email", False)).otherwise(none),
        *[F.when(digit, found(text, k, False)).otherwise(none) for k in KINDS[1:]],
    )
    return F.struct(base.alias("base"), loose.alias("loose"))


def _voted(kind: Column, word: Column, ok: Column, base: Column, before: Column, left: Column, right: Column) -> list[Column]:
    def by_kind(f) -> Column:
        out = F.lit(0)
        for i, k in enumerate(KINDS):
            out = F.when(kind == i, f(k)).otherwise(out)
        return out

    def vote(good: Column, bad: Column) -> Column:
        return F.when(good, 1).when(bad, -1).otherwise(0)

    digits = _digits(word)
    domain = F.lower(F.regexp_extract(word, r"([A-Za-z0-9-]+)$", 1))

    def gazetteer(k: str) -> Column:
        if k == "email":
            known = domain.isin(TOP_DOMAINS)
            return vote(known, ~known)
        if k == "ip":
            first = F.regexp_extract(word, "^([0-9]{1,3})(?:\\.|\\[)", 1)
            n = F.when(first == "", F.lit(None)).otherwise(first).cast("int")
            return vote(n.between(1, 223), (n == 0) | (n > 223))
        if k == "card":
            return vote(digits.rlike("^(4|5[1-5]|2[2-7]|3[47068]|6)"), ~digits.rlike("^[2-6]"))
        return vote(digits.rlike("^(0?0?[1-9])"), digits.rlike("^(?:1?(?:000|123456))|^0{3}"))

    loose_border = left.rlike("[A-Za-z0-9]$") | right.rlike("^[A-Za-z0-9]")
    return [
        F.when(~ok, -1).when(base, 1).otherwise(0),
        by_kind(gazetteer),
        by_kind(lambda k: F.when(before.rlike(TOWARD[k]), 1).otherwise(0)),
        F.when(before.rlike(AWAY), -1).otherwise(0),
        F.when(loose_border, -1).otherwise(1),
    ]


def labelled(text: Column, both: Column) -> Column:
    """The candidates in order with their votes and shape class, as one array."""

    def mark(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
        right = F.substring(text, s["end"] + 1, F.lit(1))
        v = _voted(s["kind"], s["word"], s["ok"], s["base"], before, before, right)
        shape = F.least(F.lit(3), F.floor(F.length(s["word"]) / 8)).cast("int")
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["base"].alias("base"), F.array(*v).alias("votes"), shape.alias("shape"))

    meets = lambda s: F.exists(both["base"], lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    free = F.filter(both["loose"], lambda s: ~meets(s))
    return F.transform(F.array_sort(F.concat(both["base"], free)), mark)


def fit_votes(rows: list[dict], rounds: int = 300, tolerance: float = 1e-9) -> list[list[float]]:
    """Expectation-maximisation per kind, then the span classifier.

    ``rows``: kind, votes, shape, count. Dirichlet pseudo-counts say that a
    labeler rather votes with the truth. Returns per kind the logistic weights:
    bias, then two (for, against) a labeler, then one a shape class."""
    out = []
    for kind in range(len(KINDS)):
        mine = [r for r in rows if r["kind"] == kind]
        v = np.array([r["votes"] for r in mine], int).reshape(-1, len(LABELERS))
        n = np.array([r["count"] for r in mine], float)
        prior = np.array([[6.0, 4.0, 1.0], [1.0, 4.0, 6.0]])  # of votes -1, 0, 1 on a false, a true candidate
        share = 0.7
        chance = np.repeat((prior / prior.sum(1, keepdims=True))[:, None, :], len(LABELERS), 1)
        post, last = np.zeros(len(n)), -np.inf
        for _ in range(rounds if len(n) else 0):
            log = np.stack([np.log(chance[y][np.arange(len(LABELERS)), v + 1]).sum(1) + np.log((1 - share, share)[y]) for y in (0, 1)])
            total = np.logaddexp(log[0], log[1])
            post = np.exp(log[1] - total)
            for y, w in ((0, n * (1 - post)), (1, n * post)):
                for x in (-1, 0, 1):
                    chance[y, :, x + 1] = (w @ (v == x) + prior[y, x + 1]) / (w.sum() + prior[y].sum())
            share = float(np.clip((n @ post + 7) / (n.sum() + 10), 1e-3, 1 - 1e-3))
            if abs(n @ total / n.sum() - last) < tolerance:
                break
            last = n @ total / n.sum()
        # the classifier starts from the labelers' log-odds and is trained on the posteriors
        odds = np.log(chance[1] / chance[0])
        w = np.concatenate([[np.log(share / (1 - share)) + odds[:, 1].sum()], (odds[:, 2] - odds[:, 1]), (odds[:, 0] - odds[:, 1]), np.zeros(4)])
        if len(n):
            shape = np.array([r["shape"] for r in mine], int)
            x = np.concatenate([np.ones((len(n), 1)), v == 1, v == -1, np.eye(4)[shape]], 1).astype(float)
            anchor = w.copy()
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                grad = x.T @ (n * (p - post)) + 1.0 * (w - anchor)
                hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
                step = np.linalg.solve(hess, grad)
                w -= step
                if np.abs(step).max() < 1e-9:
                    break
        out.append([float(a) for a in w])
    return out


def accepted_span(s: Column, weights: list[list[float]]) -> Column:
    """Base, or classified as personal data."""
    out = F.lit(False)
    m = len(LABELERS)
    for kind, w in enumerate(weights):
        z = F.lit(w[0])
        for i in range(m):
            z = z + F.when(s["votes"][i] == 1, w[1 + i]).when(s["votes"][i] == -1, w[1 + m + i]).otherwise(0.0)
        for c in range(4):
            z = z + F.when(s["shape"] == c, w[1 + 2 * m + c]).otherwise(0.0)
        out = F.when(s["kind"] == kind, z >= 0).otherwise(out)
    return s["base"] | out


def fit_candidates(spans: DataFrame, column: str) -> list[list[float]]:
    """EM and classifier from the candidates of a table (an array column)."""
    s = spans.select(F.explode(column).alias("s"))
    seen = s.groupBy("s.kind", "s.votes", "s.shape").count().collect()  # 4 x 3^5 x 4 rows at most
    return fit_votes(sorted((r.asDict() for r in seen), key=lambda r: (r["kind"], r["votes"], r["shape"])))


def spans_of(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the candidates of each text in the new column ``name``."""
    (both,) = fresh([*docs.columns, name], "pii_found")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumn(both, candidates(text)).withColumn(name, labelled(text, F.col(both))).drop(both)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found: array of (start, kind, end, base) in order) of each row."""
    cand = written(spans_of(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", "cand").drop("text"), "pii")
    weights = fit_candidates(cand, "cand")
    return cand.select("doc_id", F.filter("cand", lambda s: accepted_span(s, weights)).alias("found"))


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; spans that meet
    are replaced together, under the first one's kind."""
    (cand,) = fresh(docs.columns, "pii_spans")
    d = spans_of(docs, text_col, cand)
    weights = fit_candidates(d, cand)
    text = F.col(text_col)
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["pos"]
        piece = F.concat(F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.get(kinds, s["kind"]))
        parts = F.when(clear, F.array_append(acc["parts"], piece)).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), parts.alias("parts"))

    empty = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("parts"))
    take = F.filter(F.col(cand), lambda s: accepted_span(s, weights))
    joined = F.aggregate(take, empty, step, lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["pos"] + 1, F.length(text))))
    return d.withColumn(text_col, F.when(text.isNull() | (F.size(cand) == 0), text).otherwise(joined)).select(*docs.columns)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    names = F.array(*[F.lit(k) for k in KINDS])
    as_text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return p.select("doc_id", *counts, F.sha2(F.encode(as_text(base), "UTF-8"), 256).alias("base_sha256"), as_text(F.col("found")).alias("spans"))
