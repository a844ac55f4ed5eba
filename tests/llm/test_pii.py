import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabkit.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def passes(kind, found):
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text):
    spans = [(m.start(), list(RULES).index(k), m.end()) for k, rule in RULES.items() for m in re.finditer(rule, text) if passes(k, m.group())]
    return [(s, e, k) for s, k, e in sorted(spans)]


@given(st.text(alphabet="0123456789.@+-() aB_%é\n", max_size=60) | st.text(alphabet="0159.@ -+", max_size=50))
@settings(max_examples=800, deadline=None)
def test_patterns_equal_the_rules(text):
    assert pii.pattern_spans(text)[0] == plain_base(text)


def test_patterns_take_linear_time():
    for text in ["a" * 400_000 + "@", "1" * 400_000, "+1" + " " * 400_000, "1." * 200_000, "a@" * 200_000, "x9" * 200_000]:
        pii.document_spans(text, lambda *_: [])


@pytest.fixture(scope="module")
def field():
    return pii.SpanField(pii._fit([(s, p, 1.0) for s, p in pii._templates()], pii.ROUNDS, pii.RATE, pii.PENALTY))


def every_segmentation(borders, options):
    """Score and spans of each way to choose disjoint segments."""
    for n in range(len(borders)):
        for chosen in itertools.combinations(options, n):
            if all(x[1] <= y[0] or y[1] <= x[0] for x, y in itertools.combinations(chosen, 2)):
                yield sum(c[3] for c in chosen), sorted((int(borders[c[0]]), int(borders[c[1]]), c[2]) for c in chosen)


@pytest.mark.parametrize("shape", ["9999 99", "+9 999", "a@a.aa", "99.9.9.9", "9-9a", "99@9"])
def test_viterbi_and_sums_equal_enumeration(shape):
    weights = np.random.default_rng(len(shape)).normal(0, 1, (pii.FEATURES, len(pii.KINDS)))
    borders, i, j, features = pii.segments(" ", shape, " ")
    scores = weights[features].sum(axis=1)
    options = [(int(a), int(b), k, float(scores[s, k])) for s, (a, b) in enumerate(zip(i, j, strict=True)) for k in range(4) if scores[s, k] > 0]
    best = max(every_segmentation(borders, options), key=lambda x: x[0])
    got = pii.SpanField(weights).best(" ", shape, " ")
    value = {(int(borders[o[0]]), int(borders[o[1]]), o[2]): o[3] for o in options}
    assert sum(value[s] for s in got) == pytest.approx(best[0])


def likelihood(weights, shape, spans):
    borders, i, j, features = pii.segments(" ", shape, " ")
    scores = weights[features].sum(axis=1)
    options = [(int(a), int(b), k, float(scores[s, k])) for s, (a, b) in enumerate(zip(i, j, strict=True)) for k in range(4)]
    ways = list(every_segmentation(borders, options))
    return next(s for s, p in ways if p == spans) - np.log(sum(np.exp(s) for s, _ in ways))


def test_fit_climbs_the_enumerated_likelihood():
    examples = [("99 9", [(0, 2, 2)], 1.0), ("9 99", [(2, 4, 2)], 1.0), ("a9", [], 1.0)]
    value = lambda w: sum(likelihood(w, s, p) for s, p, _ in examples)
    few, many = (pii._fit(examples, n, 0.1, 0.0) for n in (1, 60))
    assert value(many) > value(few) and value(many) > -0.5


def test_spans_that_the_checks_reject(field):
    found = lambda t: [(t[a:b], pii.KINDS[k], new) for a, b, k, new in pii.document_spans(t, field.best)]
    assert found("pay 7536784127813050 4845168114407329 now") == [("7536784127813050", "card", True), ("4845168114407329", "card", True)]
    assert found("de 9807915762804490 raie,") == [("9807915762804490", "card", True)]
    assert found("mail x.y@mail.example.com or +1 (743) 555-3824%%%") == [("x.y@mail.example.com", "email", False), ("+1 (743) 555-3824", "phone", False)]
    for clean in ["In 1999, 42 of 3,000 paid $12.50 at 10:30 on 2024-05-01.", "v1.2.3 a@b", "id 12345678", 'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"']:
        assert found(clean) == []


def test_rows_and_digests(spark, hard, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    field = pii.fit_span_field(docs)
    found = pii.personal_spans(docs, field)
    rows = {r["doc_id"]: r for r in pii.span_digests(found).collect()}
    for r in docs.collect():
        base = plain_base(r["text"] or "")
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in base)
        got = rows[r["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[f"n_{k}"] for k in pii.KINDS] == [sum(b[2] == k for b in base) for k in range(4)]
        assert set(filter(None, joined.split(","))) <= set(got["spans"].split(","))
    planted = docs.selectExpr("doc_id", "text", "regexp_extract_all(text, '(?<![0-9])[0-9]{16}(?![0-9])', 0) AS cards").where("size(cards) > 0")
    joined = planted.join(found, "doc_id").selectExpr("cards", "filter(spans, s -> s.kind = 'card').text AS got").collect()
    assert joined and all(set(r["cards"]) == set(r["got"]) for r in joined)
    assert pii.personal_spans(hard, field).count() == hard.count()
    assert pii.personal_spans(nothing, pii.fit_span_field(nothing)).collect() == []
    assert pii.masked(hard, pii.personal_spans(hard.where("doc_id = 1").limit(1), field)).count() == hard.count()


def test_masked_text(spark, field):
    docs = spark.createDataFrame([(1, "a +1 (743) 555-3824, b x@y.zz c", 7), (2, None, 8), (3, "plain", 9)], "doc_id long, text string, at int")
    got = {r["doc_id"]: tuple(r) for r in pii.masked(docs, pii.personal_spans(docs, field)).collect()}
    assert got == {1: (1, "a [phone], b [email] c", 7), 2: (2, None, 8), 3: (3, "plain", 9)}
