"""Pieces join up to the text, keep the limit and prefer boundaries."""

import random
import re

from folioforge.llm.split import split_oversized

SCHEMA = "node_id bigint, parent_id string, child_id string, source_file string, text string, overlap string, limit string"
LIMITS = [("pdf", 120, 20), ("txt", 60, 0), ("other", 80, None), (None, 5, 1), ("big", 30, 29)]


def limits(spark):
    return spark.createDataFrame(LIMITS, "file_format string, max_chars int, overlap_chars int")


def texts():
    rng = random.Random(4)
    words = ["alpha", "beta,", "gamma.", "déjà", "👩‍👩‍👧", "é́", "x" * 50, "delta!\n\n", "zeta\n", "(eta)?"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    return out + ["y" * 1000, " " * 400, "\n" * 300, "🙏" * 300, "", None, "a b " * 5000]


def test_lossless(spark):
    files = ["a.PDF", "b.txt", "c.htm", None, "d", "e.big", "f.pdf.txt"]
    rows = [(k, f"p{k}", "c", files[k % 7], t, "x", "y") for k, t in enumerate(texts())]
    rows += rows[:50] + [(None, None, None, "a.pdf", "q " * 100, "", ""), (None, None, None, "a.pdf", "q " * 100, "", "")]
    got = {}
    loose = 0
    for r in split_oversized(spark.createDataFrame(rows, SCHEMA).repartition(3), limits(spark)).collect():
        if r.node_id is None:
            loose += r.piece_no == 1
            assert r.child_id == f"child_{r.piece_no}"
            continue
        got.setdefault(r.node_id, []).append(r)
    assert loose == 2
    by = {None: (80, 0), "c.htm": (80, 0), "d": (80, 0), "a.PDF": (120, 20), "b.txt": (60, 0), "f.pdf.txt": (60, 0), "e.big": (30, 15)}
    for k, _, _, f, t, *_ in rows[: len(texts())]:
        most, overlap = by[f]
        if t is None or len(t) <= most:
            assert k not in got
            continue
        pieces = sorted(got[k], key=lambda r: r.piece_no)
        assert [r.piece_no for r in pieces] == list(range(1, len(pieces) + 1)) and {r.parent_id for r in pieces} == {f"p{k}"}
        assert len({r.child_id for r in pieces}) == len(pieces)
        assert all(0 < len(r.text) <= most for r in pieces)
        at = 0  # every piece starts at most `overlap` before the end of the one before and ends beyond it
        for r in pieces:
            starts = [s for s in range(max(0, at - overlap), at + 1) if t.startswith(r.text, s) and s + len(r.text) > at]
            assert starts, (k, r.piece_no)
            at = starts[0] + len(r.text)
        assert at == len(t)


def test_boundaries(spark):
    text = "First one here. Second one here. " * 12
    df = spark.createDataFrame([(1, "p", "c", "a.pdf", text, "", "")], SCHEMA)
    pieces = [r.text for r in split_oversized(df, limits(spark)).orderBy("piece_no").collect()]
    assert all(re.search(r"\.\s$", p) for p in pieces)
    assert all(re.match(r"[A-Za-z]+\b", p) for p in pieces)
    assert split_oversized(df.limit(0), limits(spark)).count() == 0
    assert split_oversized(df, limits(spark).limit(0)).count() == 0
