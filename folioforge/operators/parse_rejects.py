"""Rows that fail to parse: load CSV records by structural indexing and give every other record its reason.

One Arrow batch at a time: the bytes of all records stand in one numpy buffer. A quote mask and its running parity
within the record tell which commas delimit fields and where a record ends, without a loop over characters. Quoting and
the field count are decided for the whole batch with array operations; only the values of well-formed records become
Python strings. The operator is a narrow map: no shuffle, constant memory for each batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUOTE, COMMA, LF, CR = 34, 44, 10, 13

#: The fields of a node record, in the order of the export.
NODE_FIELDS = ("id", "node_label", "source_file", "text", "entities", "keywords", "figures", "parent_id", "label", "original_source_file")
ITEM_FIELDS = ("entities", "keywords", "figures")

_BAD_TEXT = re.compile("[\x00-\x08\x0b-\x1f\x7f-\x9f�]")
_PARENT = re.compile(r"parent_[0-9]+\Z")


def structural_index(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Delimiters and quoting of many records at once.

    buffer: uint8 bytes of all records; record k is buffer[starts[k]:ends[k]], records in order and without gaps.
    Returns (field_starts, field_ends, record_of_field, bad_quoting): a field of a record with bad quoting is
    meaningless. An empty record is one empty field.
    """
    n = len(starts)
    base = int(starts[0]) if n else 0
    data = buffer[base : int(ends[-1])] if n else buffer[:0]
    s, e = starts - base, ends - base
    size = len(data)
    quote = data == QUOTE
    running = np.cumsum(quote, dtype=np.int64)
    before = np.concatenate(([0], running))  # quotes before each position
    lengths = e - s
    record = np.repeat(np.arange(n), lengths)
    inside_after = ((running - before[s][record]) & 1).astype(bool) if size else np.zeros(0, bool)  # parity after the byte
    opening, closing = quote & inside_after, quote & ~inside_after
    delimiter = (data == COMMA) & ~inside_after

    first = np.zeros(size + 1, bool)  # first byte of a field
    first[s[lengths > 0]] = True
    first[:size][record_first(delimiter, record)] = True
    last = np.zeros(size + 1, bool)  # last byte before a delimiter or the end of the record
    last[e[lengths > 0] - 1] = True
    if size:
        last[: size - 1] |= delimiter[1:]
    same_next = np.zeros(size, bool)
    if size > 1:
        same_next[:-1] = (record[1:] == record[:-1]) & quote[1:]  # a quote follows in the same record
    same_prev = np.zeros(size, bool)
    if size > 1:
        same_prev[1:] = (record[1:] == record[:-1]) & quote[:-1]
    wrong = closing & ~(last[:size] | same_next)
    wrong |= opening & ~first[:size] & ~same_prev
    wrong |= ((data == LF) | (data == CR)) & ~inside_after
    bad = np.zeros(n, bool)
    bad[record[wrong]] = True
    bad |= ((before[e] - before[s]) & 1).astype(bool)  # a quote never closed

    cut = np.flatnonzero(delimiter)
    cut_record = record[cut]
    owner = np.concatenate((np.arange(n), cut_record))
    begin = np.concatenate((s, cut + 1))
    order = np.lexsort((begin, owner))
    owner, begin = owner[order], begin[order]
    finish = np.empty_like(begin)
    finish[:-1] = begin[1:] - 1
    is_last = np.ones(len(owner), bool)
    is_last[:-1] = owner[1:] != owner[:-1]
    finish[is_last] = e[owner[is_last]]
    return begin + base, finish + base, owner, bad


def record_first(delimiter: np.ndarray, record: np.ndarray) -> np.ndarray:
    """Mask of bytes that follow a delimiter of their own record."""
    out = np.zeros(len(delimiter), bool)
    if len(delimiter) > 1:
        out[1:] = delimiter[:-1] & (record[1:] == record[:-1])
    return out


def _value_ok(values: Sequence[str], items: frozenset[str]) -> bool:
    row = dict(zip(NODE_FIELDS, values))
    return (
        row["id"] != ""
        and row["node_label"] == "Node"
        and row["source_file"].endswith(".gml")
        and _BAD_TEXT.search(row["text"]) is None
        and all(row[f] == "" or all(x in items for x in row[f].split(", ")) for f in ITEM_FIELDS)
        and (row["parent_id"] == "" or _PARENT.match(row["parent_id"]) is not None)
    )


def parse_batch(lines: pa.Array, items: frozenset[str]) -> tuple[list[str | None], list[list[str | None] | None]]:
    """(reason, the ten values) of each record of one batch; exactly one of the two is None."""
    lines = lines.fill_null("").cast(pa.large_string())
    n = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], np.int64, n + 1, lines.offset * 8)
    raw = lines.buffers()[2]
    buffer = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    begin, finish, owner, bad = structural_index(buffer, offsets[:-1], offsets[1:])
    counts = np.bincount(owner, minlength=n)
    head = np.concatenate(([0], np.cumsum(counts)))[:-1]
    data = memoryview(raw) if raw is not None and raw.size else memoryview(b"")
    reasons: list[str | None] = []
    rows: list[list[str | None] | None] = []
    for k in range(n):
        reason, values = None, None
        if bad[k]:
            reason = "quoting"
        elif counts[k] != len(NODE_FIELDS):
            reason = "column_count"
        else:
            values = []
            for j in range(head[k], head[k] + counts[k]):
                x = bytes(data[begin[j] : finish[j]])
                if x[:1] == b'"':
                    x = x[1:-1].replace(b'""', b'"')
                values.append(x.decode("utf-8", "replace"))
            if not _value_ok(values, items):
                reason, values = "value", None
        reasons.append(reason)
        rows.append(values)
    return reasons, rows


def parse_records(raw: DataFrame, lexicon: DataFrame, *, key: str = "row_no", line: str = "raw_line", max_items: int = 100_000) -> DataFrame:
    """Every record of raw with `reason` (null: it loads) and the ten fields (null where it does not load).

    raw: any DataFrame with the columns key and line; other columns are left out, so clashing names do no harm. lexicon:
    the allowed items; its size is checked against max_items before it goes to the executors.
    A null line counts as an empty record, which has one field: column_count. A null key is kept. Repeated rows are kept.
    Reasons, the first that applies: quoting, column_count, value. A carriage return outside quotes is a line break.
    """
    known = [r[0] for r in lexicon.select("item").where(F.col("item").isNotNull()).distinct().limit(max_items + 1).collect()]
    if len(known) > max_items:
        raise ValueError(f"the lexicon has more than {max_items} items; split the check by a join")
    items = frozenset(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reasons, rows = parse_batch(batch.column(1), items)
            columns = [batch.column(0), pa.array(reasons, pa.string())]
            columns += [pa.array([None if r is None else r[j] for r in rows], pa.string()) for j in range(len(NODE_FIELDS))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "reason", *NODE_FIELDS])

    kind = raw.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, reason string, " + ", ".join(f"{f} string" for f in NODE_FIELDS)
    return raw.select(key, F.col(line).cast("string").alias(line)).mapInArrow(run, schema)
