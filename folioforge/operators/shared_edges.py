"""Edges between nodes that share items, and what is done with edge tables.

Shared items are counted in cells: nodes are dealt into blocks of some NODES by hash, the postings of a block are packed
into one row, and each two blocks meet in a cell, where all items that two nodes share are added up, row by row. So the
pairs never move; what moves are as many copies of the packed postings as there are blocks. A hub item is spread over all
cells, and a cell is bounded whatever the items. Pairs leave Python as numbers of 8 bytes and get their names in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import trimmed_items

NODES = 12_000  # nodes of a block, at most; the names of two blocks fit the dictionary page of a Parquet column
FEWEST = 1_000  # nodes of a block where fewer would only make more tasks
CELLS = 10  # cells for each core, at least
PAIRS = 1 << 16  # pairs in a row that goes to the JVM
BITS = 20  # of a node's number in its cell


def item_table(nodes: DataFrame, node: str, fields: Mapping[str, str]) -> DataFrame:
    """(node, edge_type, item), distinct, from array columns; fields: column -> edge type. Null and blank items are dropped."""
    pairs = F.array(*(F.struct(F.lit(kind).alias("edge_type"), trimmed_items(F.col(column)).alias("items")) for column, kind in fields.items()))
    rows = nodes.select(F.col(node).alias("node"), F.explode(pairs).alias("x")).select("node", "x.edge_type", F.explode("x.items").alias("item"))
    return rows.where(F.col("node").isNotNull()).distinct()


def inverted_index(items: DataFrame) -> DataFrame:
    """(edge_type, item, n_nodes, first_node): the posting list of an item by its length and least node."""
    return items.groupBy("edge_type", "item").agg(F.count(F.lit(1)).alias("n_nodes"), F.min("node").alias("first_node"))


def _usable(items: DataFrame, least_nodes: int, most_nodes: int | None) -> DataFrame:
    """(edge_type, item, node) of the items with least_nodes to most_nodes nodes."""
    counted = items.groupBy("edge_type", "item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_nodes)
    if most_nodes is not None:
        counted = counted.where(F.col("n") <= most_nodes)
    return items.join(counted.select("edge_type", "item"), ["edge_type", "item"], "left_semi")


def _packed(block: pa.Table) -> pa.Table:
    """(block, postings): the postings of one block as a compressed stream of dictionary arrays."""
    rows = block.select(["edge_type", "item", "node"]).group_by(["edge_type", "item", "node"]).aggregate([]).sort_by([(c, "ascending") for c in ("edge_type", "node", "item")]).combine_chunks()
    coded = pa.table({c: rows.column(c).combine_chunks().dictionary_encode() for c in rows.column_names})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, coded.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(coded)
    return pa.table({"block": pa.array([block.column("block")[0].as_py()], pa.int32()), "postings": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _numbered(sides: Sequence[pa.Table], column: str) -> tuple[pa.Array, list[np.ndarray]]:
    """The values of a column of all sides in ascending order, and each side's rows as places in them."""
    parts = [t.column(column).combine_chunks() for t in sides]
    names = pc.unique(pa.concat_arrays([x.dictionary for x in parts]))
    names = names.take(pc.array_sort_indices(names))
    return names, [pc.index_in(x.dictionary, names).to_numpy(zero_copy_only=False).astype(np.int64)[x.indices.to_numpy()] for x in parts]


def _counted(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The places that lists hold, and in how many lists each is."""
    if len(lists) == 1:
        return lists[0], np.ones(len(lists[0]), np.int64)
    count = np.bincount(np.concatenate(lists))
    found = np.flatnonzero(count > 0)  # quicker than of numbers
    return found, count[found]


def _listed(lists: list[np.ndarray], items: list[int], most: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, tuple[int, ...]]]]:
    """The places that lists hold, the kind of each, and the kinds: number of lists, items of the first `most` lists.

    state: zeros for all places, and zeros again afterwards.
    """
    kinds: list[tuple[int, tuple[int, ...]]] = [(0, ())]
    number = {kinds[0]: 0}
    for hits, item in zip(lists, items):
        old = state[hits]
        seen = np.flatnonzero(np.bincount(old))
        to = np.zeros(seen[-1] + 1, state.dtype)
        for k in seen.tolist():
            n, first = kinds[k]
            after = (n + 1, (*first, item) if len(first) < most else first)
            if (x := number.setdefault(after, len(kinds))) == len(kinds):
                kinds.append(after)
            to[k] = x
        state[hits] = to[old]
    found = np.flatnonzero(state > 0)
    kind = state[found]
    state[found] = 0
    return found, kind, kinds


def _one(value: object, kind: pa.DataType) -> pa.Array:
    """An array of one value; a list is given as an array of its values."""
    if not pa.types.is_list(kind):
        return pa.array([value], kind)
    return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), pa.array(value, kind.value_type))


def _cell(left: pa.Table, right: pa.Table | None, min_weight: int, max_shared: int, separator: str | None = None) -> Iterator[dict[str, object]]:
    """Rows (names, edge_type, weights, shares, codes) of the node pairs between two blocks, or within one (right is None).

    A code stands for a pair: from its high bits on, the place of its weight in weights (and of its items in shares), and
    the places of its ends in names, which are in ascending order.
    """
    sides = [left] if right is None else [left, right]
    names, nodes = _numbered(sides, "node")
    if len(names) >= 1 << BITS:
        raise ValueError(f"a cell of {len(names)} nodes")
    types, kinds = _numbered(sides, "edge_type")
    items, held = _numbered(sides, "item")
    state = np.zeros(len(names), np.int32)
    for k, kind in enumerate(types.to_pylist()):
        (a, ia), (b, ib) = ((n[t == k], i[t == k]) for n, i, t in ((nodes[x], held[x], kinds[x]) for x in (0, -1)))
        to = np.lexsort((b, ib))
        post, ib = b[to], ib[to]
        own = np.lexsort((ia, a))
        row, item = a[own], ia[own]
        end = np.searchsorted(ib, item, side="right")
        if right is None:  # behind the node itself, so that each pair counts once
            place = np.empty(len(to), np.int64)
            place[to] = np.arange(1, len(to) + 1)
            begin = place[own]
        else:
            begin = np.searchsorted(ib, item)
        row, item, begin, end = (x[begin < end] for x in (row, item, begin, end))
        cuts = np.append(np.flatnonzero(np.diff(row, prepend=-1)), len(row)).tolist()
        begin, end, item = begin.tolist(), end.tolist(), item.tolist()
        xs: list[int] = []
        ys: list[np.ndarray] = []
        what: list[np.ndarray] = []
        known: dict[tuple[int, tuple[int, ...]], int] = {}

        def out() -> dict[str, object]:
            x, y, w = np.repeat(np.array(xs, np.int64), [len(y) for y in ys]), np.concatenate(ys), np.concatenate(what)
            got: dict[str, object] = {"names": names, "edge_type": kind}
            if max_shared:
                firsts = [first for _, first in known]
                got["weights"] = [n for n, _ in known]
                shares = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, firsts)]), pa.int32()), items.take(pa.array([i for first in firsts for i in first], pa.int64())))
                got["shares"] = shares if separator is None else pc.binary_join(shares, separator)
            else:
                got["weights"] = values = np.flatnonzero(np.bincount(w))
                place = np.zeros(values[-1] + 1, np.int64)
                place[values] = np.arange(len(values))
                w = place[w]
            return got | {"codes": w << 2 * BITS | np.minimum(x, y) << BITS | np.maximum(x, y)}

        total = 0
        for f, t in zip(cuts, cuts[1:]):
            lists = [post[x:y] for x, y in zip(begin[f:t], end[f:t])]
            if max_shared:
                y, w, found = _listed(lists, item[f:t], max_shared, state)
                codes = np.array([-1 if n < min_weight else known.setdefault((n, first), len(known)) for n, first in found])
                w = codes[w]
                if min_weight > 1:
                    y, w = y[w >= 0], w[w >= 0]
            else:
                y, w = _counted(lists)
                if min_weight > 1:
                    y, w = y[w >= min_weight], w[w >= min_weight]
            if len(y):
                xs.append(int(row[f]))
                ys.append(y)
                what.append(w)
                total += len(y)
            if total >= PAIRS:
                yield out()
                total = 0
                xs, ys, what, known = [], [], [], {}
        if total:
            yield out()


def _weighted(items: DataFrame, min_weight: int, max_shared: int, separator: str | None = None) -> DataFrame:
    """(src, dst, edge_type, weight, shared) for the node pairs of items (edge_type, item, node); shared only if max_shared."""
    items = items.where(F.col("node").isNotNull())
    n_nodes = items.select(F.approx_count_distinct("node")).first()[0]
    busy = 1
    while busy * (busy + 1) // 2 < CELLS * items.sparkSession.sparkContext.defaultParallelism:
        busy += 1
    blocks = max(1, -(-n_nodes // NODES), min(busy, n_nodes // FEWEST))
    cells = blocks * (blocks + 1) // 2
    dealt = items.select("edge_type", "item", "node", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block"))
    packed = dealt.groupBy("block").applyInArrow(_packed, "block int, postings binary")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    met = packed.select("block", "postings", every.alias("other")).select(F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "postings")
    fields = {"names": pa.list_(pa.string()), "edge_type": pa.string(), "weights": pa.list_(pa.int64()), **({"shares": pa.list_(pa.list_(pa.string()) if separator is None else pa.string())} if max_shared else {}), "codes": pa.list_(pa.int64())}
    ddl = "names array<string>, edge_type string, weights array<bigint>, " + f"shares array<{'array<string>' if separator is None else 'string'}>, " * bool(max_shared) + "codes array<bigint>"

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = [pa.ipc.open_stream(x).read_all() for batch in batches for x in batch.column("postings").to_pylist()]
        p, q = (x.as_py() for x in key)
        if p == q or len(sides) == 2:  # else one block is empty
            for row in _cell(sides[0], None if p == q else sides[1], min_weight, max_shared, separator):
                yield pa.RecordBatch.from_arrays([_one(row[c], kind) for c, kind in fields.items()], list(fields))

    code = F.col("code")
    number = lambda bits: F.shiftright(code, bits).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    which = F.shiftright(code, 2 * BITS).cast("int")
    coded = met.repartition(min(2 * cells, 10_000), "p", "q").groupBy("p", "q").applyInArrow(run, ddl)
    pairs = coded.select(*(c for c in fields if c != "codes"), F.explode("codes").alias("code"))
    shared = [F.get("shares", which).alias("shared")] if max_shared else []
    return pairs.select(F.get("names", number(BITS)).alias("src"), F.get("names", number(0)).alias("dst"), "edge_type", F.get("weights", which).alias("weight"), *shared)


def shared_item_edges(items: DataFrame, *, least_nodes: int = 2, most_nodes: int | None = 10_000, min_overlap: int = 1, max_shared: int = 3, separator: str | None = None) -> DataFrame:
    """(src, dst, edge_type, weight, shared): node pairs src < dst with the number of items they share, by type.

    Items of fewer than least_nodes or more than most_nodes nodes make no edges: the definition of the operator;
    most_nodes=None lifts it. min_overlap holds for a pair and type. shared lists the first max_shared items in ascending
    order, as one text if there is a separator to join them; the weight counts all. Rows with a null type, item or node make no edges; no rows give none.
    """
    return _weighted(_usable(items, least_nodes, most_nodes), min_overlap, max_shared, separator)


def overlap_edges(items: DataFrame, *, min_weight: int = 1, most_nodes: int | None = None) -> DataFrame:
    """(src, dst, weight): items shared in all types together. Every item counts, unless most_nodes leaves out those of more nodes."""
    usable = _usable(items, 2, most_nodes)
    return _weighted(usable.select(F.lit("any").alias("edge_type"), F.concat_ws("\u0001", "edge_type", "item").alias("item"), "node"), min_weight, 0).drop("edge_type")


def unordered(edges: DataFrame, a: str = "node1", b: str = "node2") -> DataFrame:
    """edges with src <= dst in place of a and b; rows with a null end are dropped."""
    whole = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return whole.withColumns({"src": F.least(a, b), "dst": F.greatest(a, b)}).drop(a, b)


def aggregate_raw_edges(edges: DataFrame) -> DataFrame:
    """(src, dst, edge_type, weight) of raw rows (node1, node2, edge_type, shared_item): distinct items for each pair and type.

    Rows with a null end, a null type or a null or empty item are dropped, repeated and reversed ones count once.
    """
    valid = edges.where(F.col("edge_type").isNotNull() & (F.col("shared_item") != ""))
    return unordered(valid).select("src", "dst", "edge_type", "shared_item").distinct().groupBy("src", "dst", "edge_type").agg(F.count(F.lit(1)).alias("weight"))


def one_edge_per_pair(edges: DataFrame, priority: Sequence[str]) -> DataFrame:
    """The edge of the first type in `priority` for each (src, dst); types beyond it follow in ascending order."""
    rank = F.coalesce(F.array_position(F.array(*(F.lit(p) for p in priority)), F.col("edge_type")), F.lit(0))
    best = F.min_by(F.struct("edge_type", "weight"), F.struct(F.when(rank > 0, rank).otherwise(len(priority) + 1).alias("r"), "edge_type"))
    return edges.groupBy("src", "dst").agg(best.alias("e")).select("src", "dst", "e.edge_type", "e.weight")


def heaviest_edge_per_pair(edges: DataFrame, order: Sequence[Column | str], a: str = "node1", b: str = "node2") -> DataFrame:
    """The row of most weight for each unordered pair (a null weight counts as 1); ties: the first by `order`.

    Returns src, dst and the other columns of the kept row; its own direction shows in from_node and to_node.
    """
    pair = Window.partitionBy("src", "dst").orderBy(F.coalesce("weight", F.lit(1)).desc(), *order)
    kept = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumns({"src": F.least(a, b), "dst": F.greatest(a, b), "from_node": F.col(a), "to_node": F.col(b)})
    return kept.withColumn("__k", F.row_number().over(pair)).where("__k = 1").drop("__k", a, b)


def symmetric(edges: DataFrame) -> DataFrame:
    """Both directions of each edge (src, dst, rest), a loop once."""
    back = edges.where("src <> dst").withColumns({"src": F.col("dst"), "dst": F.col("src")})
    return edges.unionByName(back)


def repeated_pairs(edges: DataFrame) -> DataFrame:
    """(src, dst, n) of unordered pairs with more than one row."""
    return unordered(edges).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def cross_group_counts(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """(group1, group2, n_edges) over edges (src, dst) whose ends lie in different groups (node, group), in both orders."""
    g = lambda end, name: groups.select(F.col("node").alias(end), F.col("group").alias(name))
    both = symmetric(edges.select("src", "dst")).join(g("src", "group1"), "src").join(g("dst", "group2"), "dst")
    return both.where("group1 <> group2").groupBy("group1", "group2").agg(F.count(F.lit(1)).alias("n_edges"))


def sibling_edges(nodes: DataFrame, node: str, parent: Sequence[str]) -> DataFrame:
    """(src, dst, weight 1.0) between nodes of the same parent; parents with a null part have no children here."""
    known = nodes.where(" and ".join(f"{p} is not null" for p in parent)).select(*parent, F.col(node).alias("n")).distinct()
    a, b = known.withColumnRenamed("n", "src"), known.withColumnRenamed("n", "dst")
    return a.join(b, list(parent)).where("src < dst").select("src", "dst", F.lit(1.0).alias("weight"))


def running_gate(mentions: DataFrame, least: int = 2) -> DataFrame:
    """Mentions (source_file, item, seq) from the least-th one of the item in its file on, in order of seq."""
    w = Window.partitionBy("source_file", "item").orderBy("seq")
    return mentions.withColumn("nth", F.row_number().over(w)).where(F.col("nth") >= least)


def entity_graph_edges(chunks: DataFrame, mentions: DataFrame, least: int = 2) -> DataFrame:
    """(source, target, relation, weight) of the entity graph: has_child from parent to chunk, mentions from chunk to every
    item past the gate, co_occurs_with between items with the number of chunks that hold both past it.

    chunks: node, parent; mentions: source_file, seq, item, node. Rows with a null node or parent have no has_child edge.
    """
    one = F.lit(1).cast("bigint").alias("weight")
    child = chunks.where("node is not null and parent is not null").select(F.col("parent").alias("source"), F.col("node").alias("target")).distinct().select("source", "target", F.lit("has_child").alias("relation"), one)
    held = running_gate(mentions, least).select(F.col("node").alias("source"), F.col("item").alias("target")).where("source is not null").distinct().select("source", "target", F.lit("mentions").alias("relation"), one)
    met = gated_cooccurrence(mentions, least).select(F.col("item_a").alias("source"), F.col("item_b").alias("target"), F.lit("co_occurs_with").alias("relation"), "weight")
    return child.unionByName(held).unionByName(met)


def gated_cooccurrence(mentions: DataFrame, least: int = 2) -> DataFrame:
    """(item_a, item_b, weight): chunks in which both items are past the gate of running_gate, item_a < item_b."""
    gated = running_gate(mentions, least).select("source_file", "seq", "item")
    a, b = gated.withColumnRenamed("item", "item_a"), gated.withColumnRenamed("item", "item_b")
    return a.join(b, ["source_file", "seq"]).where("item_a < item_b").groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("weight"))
