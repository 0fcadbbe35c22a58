"""Structural parsing against a character-by-character reader and a grammar."""

import csv
import io
import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.operators.parse_rejects import NODE_FIELDS, parse_batch, parse_records

ITEMS = frozenset(("mercy", "costly summer"))
GOOD = ["x_1", "Node", "g.gml", 'a "b", c\nd', "mercy, costly summer", "", "", "parent_7", "l", "f.pdf"]
FIELD = r'(?:"(?:[^"]|"")*"|(?!")[^",\n\r]*)'
RECORD = re.compile(rf"{FIELD}(?:,{FIELD})*\Z")


def line(values):
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(values)
    return out.getvalue()


def reasons(lines):
    return parse_batch(pa.array(lines, pa.string()), ITEMS)


def expected(text):
    text = text or ""
    if not RECORD.match(text):
        return "quoting"
    return "column_count" if len(next(csv.reader(io.StringIO(text, newline="")), [""])) != 10 else "other"


def test_reasons():
    change = lambda k, v: line([*GOOD[:k], v, *GOOD[k + 1 :]])
    cases = {
        line(GOOD): None,
        line(GOOD[:9]): "column_count",
        line([*GOOD, ""]): "column_count",
        "": "column_count",
        "   ": "column_count",
        None: "column_count",
        'a,"b': "quoting",
        'a"b,c': "quoting",
        '"a"b,c': "quoting",
        "a\nb,c": "quoting",
        "a\r": "quoting",
        change(0, ""): "value",
        change(1, "node"): "value",
        change(2, "g.csv"): "value",
        change(3, "a\x00b"): "value",
        change(3, "a�"): "value",
        change(3, "a\x85"): "value",
        change(3, "a\tb\nc"): None,
        change(3, ""): None,
        change(4, "mercy,costly summer"): "value",
        change(4, "Mercy"): "value",
        change(4, "mercy, mercy"): None,
        change(5, "unknown"): "value",
        change(7, "parent_"): "value",
        change(7, "parent_٣"): "value",
        change(7, ""): None,
    }
    got, rows = reasons(list(cases))
    assert got == list(cases.values())
    assert rows[0] == GOOD
    assert all((r is None) != (x is None) for r, x in zip(got, rows))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='a",\n\ré', max_size=14), max_size=12))
def test_quoting_matches_grammar(lines):
    got, _ = reasons(lines)
    assert ["quoting" if not RECORD.match(x) else "column_count" for x in lines] == ["quoting" if r == "quoting" else "column_count" for r in got]


def test_long_and_sliced_batches():
    lines = [line([f"{k}", "Node", "g.gml", 'x" ,\n' * k, *GOOD[4:]]) for k in range(200)]
    array = pa.array(["junk", *lines, "junk"], pa.string()).slice(1, 200)
    got, rows = parse_batch(array, ITEMS)
    assert got == [None] * 200
    assert [r[3] for r in rows] == ['x" ,\n' * k for k in range(200)]


def test_random_damage_against_csv_reader():
    rng = random.Random(5)
    lines = []
    for _ in range(400):
        text = list(line(GOOD))
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(text))
            text[k : k + rng.randrange(2)] = rng.choice(['"', ",", "\n", ""])
        lines.append("".join(text))
    got, _ = reasons(lines)
    for text, reason in zip(lines, got):
        want = expected(text)
        assert reason == want if want != "other" else reason in (None, "value"), text


def test_table(spark):
    lexicon = spark.createDataFrame([("mercy", "k"), (None, "k"), ("costly summer", "e")], "item string, field string")
    raw = spark.createDataFrame([(1, line(GOOD), "x"), (2, None, "y"), (None, 'a"', "z"), (1, line(GOOD), "x")], "row_no bigint, raw_line string, reason string")
    rows = parse_records(raw, lexicon).collect()
    assert sorted((r.row_no or 0, r.reason or "") for r in rows) == [(0, "quoting"), (1, ""), (1, ""), (2, "column_count")]
    assert [rows[0][f] for f in NODE_FIELDS] == GOOD
    assert parse_records(raw.limit(0), lexicon).count() == 0
