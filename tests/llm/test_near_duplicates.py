"""Pairs against brute force; the guarantee of the masks."""

import random
import re
from itertools import combinations

import numpy as np

from folioforge.llm import near_duplicates as nd

SCHEMA = "node_id bigint, text string, id string, h string, class_id string"


def shingles(t, width):
    w = [x.lower() for x in re.findall(r"[^\W_]+", t)]
    return len(w), {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def corpus():
    rng = random.Random(6)
    vocabulary = [f"w{k}é" for k in range(3000)]
    rows, k = [], 0
    for _ in range(120):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(18, 160))]
        for _ in range(rng.randrange(1, 4)):
            words = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 14))):
                j = rng.randrange(len(words))
                words[j : j + 1] = rng.choice([[], [rng.choice(vocabulary)], [words[j], "new"]])
            if rng.random() < 0.2:
                words = words[len(words) // 2 :] + words[: len(words) // 2]
            rows.append((k, rng.choice([" ", ", ", "\n"]).join(words).upper() if rng.random() < 0.3 else " ".join(words), "a", "b", "c"))
            k += 1
    long = " ".join(rng.choice(vocabulary) for _ in range(6000))
    rows += [(k, long, "", "", ""), (k + 1, long + " end", "", "", ""), (k + 2, None, "", "", ""), (k + 3, "", "", "", ""), (k + 4, "few words", "", "", ""), (k + 5, "few words", "", "", "")]
    rows += [(900 + j, rows[0][1], "", "", "") for j in range(4)] + [(None, rows[0][1], "", "", "")]
    return rows + rows[:40]


def brute(rows, threshold, width):
    sets = {k: shingles(t, width) for k, t, *_ in rows if k is not None and t is not None}
    sets = {k: s for k, (n, s) in sets.items() if n >= 20 and s}
    return {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9}


def test_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for threshold, width in ((0.7, 3), (0.8, 5)):
        want = brute(rows, threshold, width)
        got = {(r.id_a, r.id_b) for r in nd.near_duplicate_pairs(df, key="node_id", text="text", threshold=threshold, width=width).collect()}
        assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 30


def test_groups_and_large_classes(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows, 0.7, 3)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in want:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r.id: r.group_id for r in nd.near_duplicate_groups(df, key="node_id", text="text", threshold=0.7, width=3).collect()}
    assert set(got) == set(parent)
    assert len(set(got.values())) == len({root(x) for x in parent})
    # above `expand` copies the pairs are given through the least record; the groups that follow from them are the same
    star = {(r.id_a, r.id_b) for r in nd.near_duplicate_pairs(df, key="node_id", text="text", threshold=0.7, width=3, expand=2).collect()}
    assert star < want
    linked = {}

    def find(x):
        while linked.setdefault(x, x) != x:
            x = linked[x]
        return x

    for a, b in star:
        linked[max(find(a), find(b))] = min(find(a), find(b))
    assert {x: find(x) for x in linked} == {x: root(x) for x in parent}


def test_blocks_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 3)
    rows = [(k % 4, h) for k in range(4) for h in range(k * 7)] + [(99, 1)]
    got = sorted((r.ha, r.hb) for r in nd._bucket_pairs(spark.createDataFrame(rows + rows, "table_key bigint, h bigint")).collect())
    assert got == sorted(combinations(range(21), 2))


def test_masks_cover_the_radius():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, (nd.DIMS, 1)).astype(np.uint64)
    for _ in range(300):
        other = base.copy()
        other[rng.choice(nd.DIMS, nd.RADIUS, replace=False)] += np.uint64(1)
        assert (nd.masked_keys(base) == nd.masked_keys(other)).any()
    assert len(np.unique(nd.masked_keys(base))) == nd.TABLES


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nd.near_duplicate_pairs(df, key="node_id", text="text").count() == 0
    assert nd.near_duplicate_groups(df, key="node_id", text="text").count() == 0
