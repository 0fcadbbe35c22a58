"""Per-key counts against brute force, with one key of most rows."""

import random
from collections import defaultdict

from folioforge.operators.hot_keys import dense_counts, hot_keys, key_profile, row_counts

SCHEMA = "node1 string, node2 string, edge_type string, shared_item string, n_rows string"


def edges():
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        key = ("entity", "hot") if rng.random() < 0.5 else (rng.choice(["entity", "figure", None]), rng.choice(["a", "b", "", None, "hot", "c|d"]))
        rows.append((rng.choice("abcdefgh"), rng.choice(["a", "b", "z", None]), *key, "clash"))
    return rows + rows[:200]


def test_profile(spark):
    rows = edges()
    n, e, v = defaultdict(int), defaultdict(set), defaultdict(set)
    for a, b, t, i, _ in rows:
        if t and i:
            n[t, i] += 1
            v[t, i] |= {a, b} - {None}
            if a is not None and b is not None:
                e[t, i].add((min(a, b), max(a, b)))
    got = {(r.edge_type, r.shared_item): (r.n_rows, r.n_edges, r.n_nodes) for r in key_profile(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == {k: (n[k], len(e[k]), len(v[k])) for k in n}


def test_hot(spark):
    rows = edges()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    counts = {(r.edge_type, r.shared_item): r.n_rows for r in row_counts(df).collect()}
    assert sum(counts.values()) == len(rows)
    assert (None, None) in counts and ("entity", "") in counts
    got = {(r.edge_type, r.shared_item) for r in hot_keys(df, 0.05).collect()}
    assert got == {k for k, n in counts.items() if k[0] and k[1] and n >= 0.05 * len(rows)}


def test_flush_and_empty(spark):
    df = spark.range(5000).selectExpr("cast(id % 700 as string) k", "id m")
    got = {r.k: r.m for r in dense_counts(df, ["k"], ["m"], flush_keys=50).collect()}
    assert got == {str(k): sum(range(k, 5000, 700)) for k in range(700)}
    empty = spark.createDataFrame([], SCHEMA)
    assert key_profile(empty).count() == hot_keys(empty).count() == 0
