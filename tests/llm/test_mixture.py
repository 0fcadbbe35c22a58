"""Rates and draws against the definition."""

import os

import pytest

from folioforge.llm.mixture import emit, mix, rates, report, sized
from folioforge.llm.tokenize import DEFAULT_VOCABULARY

SIZES = "doc_id bigint, source string, n_tokens bigint"
TARGETS = "source string, target_share double, max_repeats int"


def data(spark):
    sizes = [(k, "a", 10) for k in range(3000)] + [(9000 + k, "b", 5) for k in range(1000)] + [(20000 + k, "c", 0) for k in range(5)]
    targets = [("a", 0.5, 1), ("b", 0.4, 3), ("c", 0.05, 2), ("none", 0.05, 2), (None, 0.3, 1), ("a", 0.5, 1)]
    return spark.createDataFrame(sizes, SIZES).repartition(4), spark.createDataFrame(targets, TARGETS)


def test_mix(spark):
    sizes, targets = data(spark)
    rated = rates(sizes, targets)
    by = {r.source: r for r in rated.collect()}
    total = 35_000
    assert set(by) == {"a", "b", "c", "none"} and {r.total_tokens for r in by.values()} == {total}
    assert by["a"].rate == pytest.approx(0.5 * total / 30_000) and by["b"].rate == pytest.approx(0.4 * total / 5_000) and by["c"].rate == by["none"].rate == 0
    mixed = mix(sizes, rated)
    rows = mixed.collect()
    copies = {r.doc_id: r.copies for r in rows}
    assert len(copies) == len(rows) and {r.copies for r in rows if r.source == "b"} == {2, 3} and {r.copies for r in rows if r.source == "a"} == {1}
    assert {r.doc_id: r.copies for r in mix(sizes.repartition(2), rated).collect()} == copies
    out = {r.source: r for r in report(mixed, rated).collect()}
    assert out["a"].actual_share == pytest.approx(0.5, abs=0.03) and out["b"].actual_share == pytest.approx(0.4, abs=0.02)
    assert out["c"].actual_share == out["none"].actual_share == 0 and sum(r.mixed_share for r in out.values()) == pytest.approx(1)


def test_emit(spark):
    sizes, targets = data(spark)
    rated = rates(sizes, targets)
    docs = sizes.selectExpr("doc_id", "source", "if(doc_id % 7 = 0, null, concat('t', doc_id)) as text", "1 as copies", "2 as rate")
    want = {r.doc_id: r.copies for r in mix(sizes, rated).collect()}
    rows = emit(docs, rated).collect()
    assert len(rows) == sum(want.values()) and {(r.doc_id, r.copy_no) for r in rows} == {(d, k) for d, n in want.items() for k in range(1, n + 1)}
    assert all(r.text == (None if r.doc_id % 7 == 0 else f"t{r.doc_id}") for r in rows) and emit(docs.limit(0), rated).count() == 0


def test_cap_and_empty(spark):
    sizes, targets = data(spark)
    capped = spark.createDataFrame([("b", 0.9, 2), ("a", None, None)], TARGETS)
    rated = rates(sizes.where("source = 'b'"), capped)
    by = {r.source: r.rate for r in rated.collect()}
    assert by == {"b": pytest.approx(0.9), "a": 0}
    rated = rates(sizes, spark.createDataFrame([("b", 0.9, 2)], TARGETS))
    assert rated.first().rate == 2 and {r.copies for r in mix(sizes, rated).collect()} == {2}
    assert mix(sizes.limit(0), rates(sizes.limit(0), targets)).count() == 0
    assert report(mix(sizes.limit(0), rates(sizes.limit(0), targets)), rates(sizes.limit(0), targets)).count() == 4


@pytest.mark.skipif(not os.path.exists(DEFAULT_VOCABULARY), reason="no vocabulary")
def test_sized(spark):
    docs = spark.createDataFrame([(1, "a", "Hello world", 9), (2, "a", None, 9), (3, "x", "left out", 9), (4, None, "y", 9)], "doc_id bigint, source string, text string, n_tokens int")
    got = {r.doc_id: r.n_tokens for r in sized(docs, data(spark)[1]).collect()}
    assert got == {1: 2, 2: 0}
