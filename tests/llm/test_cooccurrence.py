"""Pair counts against brute force."""

import random
from collections import Counter
from itertools import combinations

import pytest

from folioforge.llm import cooccurrence as co

SCHEMA = "node_id bigint, entities array<string>, keywords array<string>, item string, n bigint"


def records():
    rng = random.Random(2)
    pool = [f"i{k}" for k in range(40)] + ["A  B", " a b\t", "", "  ", None]
    draw = lambda: rng.choice([None, [], [rng.choice(pool) for _ in range(rng.randrange(7))]])
    rows = [(k, draw(), draw(), "clash", 1) for k in range(400)]
    return rows + rows[:30] + [(None, ["x", "y"], None, "c", 1), (None, ["x", "y"], None, "c", 1)]


def brute(rows):
    seen, singles, pairs, n = set(), Counter(), Counter(), 0
    for k, a, b, *_ in rows:
        if k is not None and k in seen:
            continue
        seen.add(k)
        n += 1
        items = {" ".join(x.split()).lower() for x in [*(a or []), *(b or [])] if x is not None} - {""}
        singles.update(items)
        pairs.update(combinations(sorted(items), 2))
    return n, singles, pairs


@pytest.mark.parametrize("limit", [200_000, 3])
def test_all_pairs(spark, limit):
    rows = records()
    n, singles, pairs = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {(r.item_a, r.item_b): r for r in co.cooccurrence(df, key="node_id", lists=["entities", "keywords"], dictionary_items=limit).collect()}
    assert set(got) == set(pairs)
    for (a, b), r in got.items():
        assert (r.n_a, r.n_b, r.n_ab, r.n_records) == (singles[a], singles[b], pairs[a, b], n)
        assert r.lift == pytest.approx(pairs[a, b] * n / (singles[a] * singles[b]))


def test_thresholds(spark):
    rows = records()
    n, singles, pairs = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.item_a, r.item_b) for r in co.cooccurrence(df, key="node_id", lists=["entities", "keywords"], min_count=4, min_support=0.012, min_lift=1.1).collect()}
    assert got == {k for k, c in pairs.items() if c >= 4 and c / n >= 0.012 and c * n / (singles[k[0]] * singles[k[1]]) >= 1.1}


def test_slices_and_flush(monkeypatch):
    import numpy as np

    monkeypatch.setattr(co, "PAIRS", 8)
    monkeypatch.setattr(co, "CELLS", 64)
    rng = np.random.default_rng(1)
    baskets = [np.unique(rng.integers(0, 30, rng.integers(0, 9))) for _ in range(200)]
    want = Counter((int(a), int(b)) for x in baskets for i, a in enumerate(x) for b in x[i:])
    gram, got = co._Gram(), Counter()
    for start in range(0, 200, 16):
        some = baskets[start : start + 16]
        rows, codes = np.repeat(np.arange(len(some)), [len(x) for x in some]), np.concatenate(some).astype(np.int64)
        shuffled = rng.permutation(len(rows))
        for batch in gram.add(rows[shuffled], codes[shuffled], len(some)):
            got.update({(a, b): n for a, b, n in zip(*(c.to_pylist() for c in batch.columns))})
    for batch in gram.cells():
        got.update({(a, b): n for a, b, n in zip(*(c.to_pylist() for c in batch.columns))})
    assert got == want


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert co.cooccurrence(df, key="node_id", lists=["entities", "keywords"]).count() == 0
    assert co.cooccurrence(spark.createDataFrame([(1, None, ["x"], "", 1)], SCHEMA), key="node_id", lists=["entities", "keywords"]).count() == 0


def test_wide_dictionary_stays_sparse():
    """A chunk over 200,000 items takes neither the memory nor the time of dense blocks."""
    import time
    import tracemalloc

    import numpy as np

    from folioforge.llm.cooccurrence import _Gram

    rng = np.random.default_rng(3)
    baskets = [np.unique(rng.integers(0, 200_000, 6)) for _ in range(4096)]
    rows = np.repeat(np.arange(4096), [len(b) for b in baskets])
    gram, began = _Gram(), time.perf_counter()
    tracemalloc.start()
    assert not list(gram.add(rows, np.concatenate(baskets).astype(np.int64), 4096))
    cells = next(gram.cells())
    assert tracemalloc.get_traced_memory()[1] < 100 << 20 and time.perf_counter() - began < 2
    tracemalloc.stop()
    assert cells.column(2).to_numpy().sum() == sum(len(b) * (len(b) + 1) // 2 for b in baskets)


def test_one_huge_basket():
    import numpy as np

    from folioforge.llm.cooccurrence import _Gram

    gram = _Gram()
    out = list(gram.add(np.zeros(3000, np.int64), np.arange(3000), 1)) + list(gram.cells())
    assert sum(b.num_rows for b in out) == 3000 * 3001 // 2
