"""Hand-checked cases of the core operators."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import text as tx
from folioforge.functions import vector
from folioforge.operators import chunking, export, filenames, graph, retrieval, shared_edges
from folioforge.operators.components import connected_components


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [
        ("A\tb  c ,  sancti-\n fied ( x ) .\n\n\n\n  Next", "A b c, sanctified (x).\n\nNext"),
        ('He said "go" now', 'He said"go"now'),
        ("a\n \n \nb", "a\n\n\nb"),
        ("", ""),
        (None, None),
    ],
)
def test_tidy_layout(spark, text, want):
    assert one(spark, text, tx.tidy_layout) == want


def test_words_and_terms(spark):
    assert one(spark, "Sav e us. T he day. Gr ace", lambda c: tx.replace_words(c, {"Sav e": "save", "T he": "the", "Gr ace": "grace"})) == "save us. the day. grace"
    assert one(spark, "a.b axb c", lambda c: tx.replace_words(c, {"a.b": "$1", "c": "\\"})) == "$1 axb \\"
    assert one(spark, 'Élan  vital [x]\n—"ok"…  $5', tx.plain_text) == 'Élan vital x "ok" 5'
    assert one(spark, "See John 3:16; 1 Corinthians 13:4-7, 9 and romans 8:1", tx.verse_references) == ["See John 3:16", "1 Corinthians 13:4-7, 9"]
    text = "Disgraceful selection by Owen's Owenism"
    assert one(spark, text, lambda c: tx.contained_terms(c, ["grace", "election", "faith"])) == ["grace", "election"]
    assert one(spark, text, lambda c: tx.whole_terms(c, ["Owen", "Knox"])) == ["Owen"]
    assert one(spark, "a, b ,, a ,c", tx.split_items) == ["a", "b", "c"]
    assert one(spark, " One. Two!  Three", tx.sentences) == ["One.", "Two!", "Three"]
    assert one(spark, "a <b>b</b><script>x</script> &amp;lt; c", tx.without_markup) == "a b &lt; c"
    assert one(spark, "ÀB_c (x)--1", tx.safe_name) == "ÀB_c_x_--1"
    assert one(spark, "THE WORD OF LIFE", tx.is_heading_line) is True
    assert one(spark, "THE WORD of the life", tx.is_heading_line) is False
    assert one(spark, "an Ashen oak", lambda c: tx.ordered_case(c, [("ash", 1), ("oak", 2)], 0)) == 1


def nodes(spark):
    rows = [("n1", ["a", "b", None, " "]), ("n2", ["a", "b", "c", "a "]), ("n3", ["c"]), ("n4", None), ("n2", ["c"]), (None, ["a"])]
    return shared_edges.item_table(spark.createDataFrame(rows, "id string, e array<string>"), "id", {"e": "entity"})


def test_shared_edges(spark):
    get = lambda **k: sorted(tuple(r) for r in shared_edges.shared_item_edges(nodes(spark), **k).collect())
    assert get() == [("n1", "n2", "entity", 2, ["a", "b"]), ("n2", "n3", "entity", 1, ["c"])]
    assert get(min_overlap=2) == [("n1", "n2", "entity", 2, ["a", "b"])]
    assert get(max_shared=1) == [("n1", "n2", "entity", 2, ["a"]), ("n2", "n3", "entity", 1, ["c"])]
    assert get(most_nodes=1) == []


def test_edge_tables(spark):
    typed = spark.createDataFrame([("a", "b", "keyword", 5), ("a", "b", "entity", 1), ("a", "b", "figure", 2)], "src string, dst string, edge_type string, weight bigint")
    assert tuple(shared_edges.one_edge_per_pair(typed, ("entity", "figure", "keyword")).first()) == ("a", "b", "entity", 1)
    raw = spark.createDataFrame([("a", "b", 1, 1), ("b", "a", 3, 2), ("a", "b", 3, 3), ("c", None, 9, 1), ("c", "d", None, 4)], "node1 string, node2 string, weight bigint, file int")
    got = {(r.src, r.dst): (r.weight, r.file, r.from_node) for r in shared_edges.heaviest_edge_per_pair(raw, ["file"]).collect()}
    assert got == {("a", "b"): (3, 2, "b"), ("c", "d"): (None, 4, "c")}
    rows = [("f", "X", 1), ("f", "Y", 1), ("f", "X", 2), ("f", "X", 3), ("f", "Y", 3), ("f", "X", 4), ("f", "Y", 4)]
    mentions = spark.createDataFrame(rows, "source_file string, item string, seq int")
    assert sorted((r.item, r.seq) for r in shared_edges.running_gate(mentions).collect()) == [("X", 2), ("X", 3), ("X", 4), ("Y", 3), ("Y", 4)]
    assert [tuple(r) for r in shared_edges.gated_cooccurrence(mentions).collect()] == [("X", "Y", 2)]


def test_graph(spark):
    n = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    e = spark.createDataFrame([("a", "b", 2)], "src string, dst string, weight bigint")
    s = graph.degree_stats(n, e).first()
    assert (s.n_nodes, round(s.avg_degree, 3), s.max_degree, s.min_degree, s.n_isolated) == (3, 0.667, 1, 0, 1)
    assert tuple(graph.degree_stats(n.limit(0), e.limit(0)).first()) == (0, 0.0, 0, 0, 0)
    assert [r.node for r in graph.isolated_nodes(n, e).collect()] == ["c"]
    tri = spark.createDataFrame([("a", "b", 1), ("b", "c", 2), ("a", "c", 4)], "src string, dst string, weight bigint")
    paths = graph.trails(tri, spark.createDataFrame([("a",)], "node string"), 5).collect()
    assert len(paths) == 6 and max(r.weight for r in paths) == 7
    rows = spark.createDataFrame([("x", 1, "1", "1"), ("x", 2, "2", None), ("x", 3, "", None)], "id string, seq int, p string, q string")
    assert tuple(graph.compose(rows, "id", "seq", ["p", "q"]).first()) == ("x", "2", "1")
    merged = graph.merge_with_prefix(spark.createDataFrame([("g1", "1"), ("g2", "1"), ("g2", "2"), ("g3", "2"), ("g4", "1")], "g string, n string"), "g", "n")
    assert sorted(r.merged_id for r in merged.collect()) == ["1", "2", "g2_1", "g2_2", "g4_1"]
    ends = spark.createDataFrame([(1, "m", None), (2, "r", None), (3, "a", None), (4, "a", "f1"), (5, None, None)], "end_id int, original_id string, hint string")
    registry = spark.createDataFrame([("r", "R", "f1"), ("a", "A1", "f1"), ("a", "A2", "f2"), ("a", "A2", "f2")], "original_id string, final_id string, source_file string")
    got = {r.end_id: (r.status, r.final_id) for r in graph.resolve_endpoints(ends, registry).collect()}
    assert got == {1: ("missing", None), 2: ("resolved", "R"), 3: ("ambiguous", None), 4: ("resolved", "A1"), 5: ("missing", None)}


def test_components_random(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)] + [(7, 7), (5000, 5000)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame([*edges, (None, 4)], "src bigint, dst bigint")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {x: root(x) for x in parent}
    assert connected_components(df.limit(0)).count() == 0


def test_windows():
    assert chunking.window_spans(1250, [], 1500, 200) == [(0, 1250)]
    assert chunking.window_spans(3000, [], 1500, 200) == [(0, 1500), (1300, 2800), (2600, 3000)]
    spans = chunking.window_spans(4000, [50], 1500, 200)
    assert all(a < b for (a, _), (b, _) in zip(spans, spans[1:])) and spans[-1][1] == 4000
    tail = lambda n: chunking.window_spans(n, [], 1500, 200, tail=True)
    assert tail(1400) == [(0, 1400), (1300, 1400)] and tail(1250) == [(0, 1250)] and tail(3000) == [(0, 1500), (1300, 2800), (2600, 3000)]
    assert chunking.window_spans(30, [9, 19], 20, 5) == [(0, 20), (15, 30)] and chunking.window_spans(30, [9, 19], 20, 5, kept=0) == [(0, 19), (14, 30)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 400), st.lists(st.integers(0, 400), max_size=30), st.integers(1, 90), st.integers(0, 100))
def test_windows_cover(length, stops, size, overlap):
    spans = chunking.window_spans(length, sorted(x for x in set(stops) if x < length), size, overlap)
    assert all(b - a <= size for a, b in spans)
    assert all(a2 <= b1 and a1 < a2 for (a1, b1), (a2, _) in zip(spans, spans[1:]))
    assert not length or (spans[0][0], spans[-1][1]) == (0, length)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=300), st.integers(5, 60), st.integers(0, 20))
def test_recursive_split(text, size, overlap):
    parts = chunking.recursive_split(text, size, min(overlap, size - 1), ("\n\n", "\n", ".", " ", ""))
    assert all(0 < len(p) <= size for p in parts)
    assert set("".join(parts)) - set(" .\n") == set(text) - set(" .\n")


def test_chunks(spark):
    docs = spark.createDataFrame([(1, "INTRODUCTION PART\nalpha mercy.\nBOOK OF WAYS\nbeta mercy. gamma.\nEND OF THE BOOK\nlast"), (2, None), (3, " "), (4, "x" * 70_000)], "doc_id bigint, text string")
    parents = chunking.parent_chunks(docs, key="doc_id", text="text")
    got = {}
    for r in parents.orderBy("doc_id", "parent_no").collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert [x.split("\n")[0] for x in got[1]] == ["INTRODUCTION PART", "BOOK OF WAYS", "END OF THE BOOK"]
    assert set(got) == {1, 4} and max(map(len, got[4])) <= 30_000
    sents = chunking.sentence_rows(parents.where("doc_id = 1"), keys=["doc_id", "parent_no"], text="text")
    chunks = chunking.hybrid_chunks(sents, group=["doc_id", "parent_no"], terms=["Mercy"], most_words=50).orderBy("parent_no", "child_no").collect()
    assert chunks[0].items == ["mercy"] and sum(r.n_sentences for r in chunks) == sents.count()
    assert chunking.fold_sentences(["a b c", "d", "c a"], [["x"], [], ["x"]], 9.0, 5, frozenset()) == [[0], [1], [2]]
    assert chunking.fold_sentences(["a b c", "d", "c a"], [["x"], ["x"], ["x"]], 9.0, 5, frozenset()) == [[0, 1], [2]]


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, [1.0, 2.0]), (4, None), (5, [1.0])], "vec_id bigint, embedding array<float>")
    got = retrieval.nearest(df, [0.0, 0.0], 9).collect()
    assert [(r.vec_id, r.distance) for r in got] == [(2, 0.0), (1, 5.0), (3, 5.0)]
    assert df.select(vector.cosine(F.col("embedding"), F.lit([0.0, 0.0])).alias("c")).first().c == 0.0
    queries = df.where("vec_id in (1, 2)").select(F.col("vec_id").alias("query_id"), "embedding")
    rows = retrieval.nearest_for_all(df, queries, 2, block=1).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.distance) for r in rows] == [(1, 1, 0.0), (1, 3, 0.0), (2, 2, 0.0), (2, 1, 5.0)]
    assert retrieval.nearest_for_all(df, queries.limit(0), 2).count() == 0
    more = retrieval.append_vectors(df.where("vec_id < 3"), spark.createDataFrame([([3.0, 3.0],), ([4.0, 4.0],)], "embedding array<float>"), 2)
    assert sorted(r.vec_id for r in more.collect()) == [1, 2, 3, 4]
    with pytest.raises(Exception, match="dimension"):
        retrieval.append_vectors(df.where("vec_id < 3"), spark.createDataFrame([([3.0],)], "embedding array<float>"), 2).collect()


def test_retrieval(spark):
    docs = spark.createDataFrame([(1, "grace and faith"), (2, "faith faith alone"), (3, None), (4, "")], "id bigint, text string")
    got = {r.id: r.score for r in retrieval.bm25(docs, ["Faith", "grace"], key="id", text="text").collect()}
    assert set(got) == {1, 2} and got[1] > 0
    assert retrieval.bm25(docs.limit(0), ["x"], key="id", text="text").count() == 0
    assert (retrieval.candidates_wanted(5, True, 15), retrieval.candidates_wanted(5, True, None), retrieval.candidates_wanted(5, False, 15)) == (15, 15, 5)
    row = spark.createDataFrame([(1, 'Sermon, "T"', "t1"), (2, "f.pdf", None)], "rank int, citation string, text string")
    out = retrieval.context(row).first()
    assert out.context == '[Source 1 - Sermon, "T"]:\nt1\n\n---\n\n[Source 2 - f.pdf]:\n' and out.guide == 'Source 1: Sermon, "T"\nSource 2: f.pdf'
    w = {(r.id, r.term): r.weight for r in retrieval.tfidf(docs.withColumn("g", F.lit(1)), group=["g"], key="id", text="text").collect()}
    idf = lambda n: math.log(4 / (1 + n)) + 1
    size = math.sqrt((2 * idf(2)) ** 2 + idf(1) ** 2)
    assert w[2, "faith"] == pytest.approx(2 * idf(2) / size)


def test_files_and_export(spark):
    names = spark.createDataFrame([("A__b (copy).pdf",), ("A_b.PDF",), ("A_b.txt",), (None,)], "source_file string")
    assert one(spark, "The__Old__Book_.pdf", lambda c: filenames.clean_file_name(c, ["The_"])) == "Old_Book.pdf"
    assert len(one(spark, "x" * 50 + "_" + "y" * 60 + ".pdf", filenames.clean_file_name)) == 54
    plan = {r.old_name: r.new_name for r in filenames.rename_plan(names, F.lit("t.pdf")).collect()}
    assert sorted(plan.values()) == ["t.pdf", "t_1.pdf", "t_2.pdf"]
    assert [(r.stem, r.n_files) for r in filenames.duplicate_files(names).collect()] == [("a_b", 2)]
    assert export.untyped_header(["id:ID", ":LABEL", "x"]) == ["id", "label", "x"] and export.typed_header(["w"], {"w": "FLOAT"}) == ["w:FLOAT"]
    edges = spark.createDataFrame([("a", "a", None, ""), ("a", "b", "t", "i"), ("a", "b", "t", "i")], "node1 string, node2 string, edge_type string, shared_item string")
    assert tuple(export.quality_counts(edges).first()) == (3, 0, 1, 1, 1, 1)


def test_pieces_keep_their_separator_in_front():
    split = lambda t, n, o: chunking.recursive_split(t, n, o, chunking.PARENT_SEPARATORS)
    assert split("one two\n\nthree four\n\nfive", 14, 0) == ["one two", "three four", "five"]
    assert split("aaaa bbbb cccc dddd", 10, 5) == ["aaaa bbbb", "bbbb cccc", "cccc dddd"] and split("x" * 25, 10, 0) == ["x" * 10, "x" * 10, "x" * 5]
    assert split("  ", 10, 0) == [] and split(" a ", 10, 0) == ["a"]


def test_documents_to_marked_chunks(spark):
    long = "INTRODUCTION TO GRACE\n" + "Grace is free. Owen wrote of grace in John 3:16,18 at length. " * 4 + "\nOF THE SECOND PART\n" + "Faith works here. " * 8 + "\nOF THE THIRD PART\nAn end of it all is here, and no more of it."
    docs = spark.createDataFrame([(1, long), (2, None), (3, "short"), (4, "")], "doc_id bigint, text string")
    rows = chunking.chunk_documents(docs, key="doc_id", text="text", keywords=["grace", "faith"], figures=["Owen", "Knox"]).collect()
    assert {r.doc_id for r in rows} == {1} and {r.parent_id for r in rows} == {"parent_1", "parent_2", "parent_3"} and len({r.unique_id for r in rows}) == len(rows)
    first = [r for r in rows if r.parent_id == "parent_1"]
    assert {k for r in first for k in r.keywords} == {"grace"} and {f for r in first for f in r.figures} == {"Owen"} and {v for r in first for v in r.verses} == {"John 3:16,18"}
    assert chunking.chunk_documents(docs.limit(0), key="doc_id", text="text", keywords=["a"], figures=["b"]).count() == 0


def test_entity_graph(spark):
    mentions = spark.createDataFrame([("f", x, k, f"c{k}") for k, held in enumerate(["XY", "X", "XY", "XY"], 1) for x in held] + [("f", "X", 9, None)], "source_file string, item string, seq bigint, node string")
    nodes = spark.createDataFrame([("c1", "p"), ("c1", "p"), ("c2", None), (None, "p")], "node string, parent string")
    got = {tuple(r) for r in shared_edges.entity_graph_edges(nodes, mentions).collect()}
    said = {(f"c{k}", x) for k, x in [(2, "X"), (3, "X"), (4, "X"), (3, "Y"), (4, "Y")]}
    assert got == {("p", "c1", "has_child", 1), ("X", "Y", "co_occurs_with", 2)} | {(c, x, "mentions", 1) for c, x in said}


def test_tiles_and_cells(spark, monkeypatch):
    import numpy as np

    from folioforge.operators import ann

    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 8)) + rng.integers(0, 5, (700, 1)) * 3
    x[10:20] = x[0]  # ties
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(9000, None), (9001, [1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    queries = df.where("vec_id % 7 = 0").withColumnRenamed("vec_id", "query_id")
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2).round(9)
    want = {(q, r + 1): int(k) for q in range(0, 700, 7) for r, k in enumerate(np.lexsort((np.arange(700), d[q]))[:6])}
    monkeypatch.setattr(retrieval, "ROWS", 200)
    fit = queries.where("size(embedding) = 8")
    for block in (2048, 30):
        got = {(r.query_id, r.rank): r.vec_id for r in retrieval.nearest_for_all(df, fit, 6, block=block).collect()}
        assert got == want
    centres = ann.fit_centres(df, 12)
    index = ann.cells_of(df, centres)
    assert index.count() == 700
    exact = {(r.query_id, r.rank): r.vec_id for r in ann.probe(index, fit, centres, 6, n_probe=12).collect()}
    assert exact == want
    some = {(r.query_id, r.vec_id) for r in ann.probe(index, fit, centres, 6, n_probe=4).collect()}
    assert len(some & {(q, k) for (q, _), k in want.items()}) >= 0.9 * len(want)
    assert retrieval.nearest_for_all(df, fit.limit(0), 6).count() == retrieval.nearest_for_all(df.limit(0), fit, 6).count() == 0


def test_small_text_helpers(spark):
    assert one(spark, "12345678 9", tx.estimated_tokens) == 2 and one(spark, None, tx.estimated_tokens) is None
    assert [one(spark, v, tx.number_kind) for v in ("12", "-1.5", "1e", "", None)] == ["int", "float", "text", "text", None]
    assert one(spark, "Thomas-Sfintenia_de_Thomas_Cook", filenames.without_author_prefix) == "Sfintenia_de_Thomas_Cook"
    assert one(spark, "Owen-On_Grace_by_Knox", filenames.without_author_prefix) == "Owen-On_Grace_by_Knox"
    assert one(spark, "Of_Free_Grace_Of_Free_Grace_II", filenames.without_repeated_phrase) == "Of_Free_Grace_II"


def test_full_citation(spark):
    rows = [("985", "1865", "T", "214", "a/b.pdf"), ("", None, "Unknown Title", None, "a/b.pdf"), (None, None, None, "", None), (None, "1865", None, None, "x"), ("7", "", "T", None, "x")]
    df = spark.createDataFrame(rows, "n string, d string, t string, p string, s string")
    got = [r[0] for r in df.select(retrieval.full_citation(*(F.col(c) for c in "ndtps"))).collect()]
    assert got == ['Sermon #985, 1865, "T", p. 214', "b.pdf", "Unknown Source", "1865", 'Sermon #7, "T"']


def test_prefix_follows_the_order(spark):
    held = {"a": "12", "b": "23", "c": "34", "d": "5", "e": "56"}
    df = spark.createDataFrame([(g, x) for g, s in held.items() for x in s] + [("a", "1"), (None, "1"), ("a", None)], "g string, x string")
    got = {(r.g, r.x): r.merged_id for r in graph.merge_with_prefix(df, "g", "x").collect()}
    # b shares 2 with a, so its ids get its name and c is free to keep 3; e shares 5 with d
    assert got == {(g, x): (f"{g}_{x}" if g in "be" else x) for g, s in held.items() for x in s} and graph.merge_with_prefix(df.limit(0), "g", "x").count() == 0


def test_upsert_and_alias_nodes(spark):
    old = spark.createDataFrame([("a", "t", 1), ("a", "t", 2), (None, "t", 1)], "n string, k string, w int")
    new = spark.createDataFrame([("a", "t", 9), ("b", "t", 8), ("b", "t", 7), (None, "t", 5), ("c", None, 1)], "n string, k string, w int")
    got = sorted((tuple(r) for r in graph.upsert(old, new, ["n", "k"]).collect()), key=str)
    assert got == sorted([("a", "t", 1), ("a", "t", 2), (None, "t", 1), ("b", "t", 7), ("c", None, 1)], key=str)
    nodes = spark.createDataFrame([("J. Owen", "x", ""), ("John Owen", "y", None), ("John Owen", "x", "d"), ("Knox", None, None), (None, "z", "z")], "node string, p string, q string")
    aliases = spark.createDataFrame([("J. Owen", "John Owen"), ("unused", "z")], "alias string, canonical string")
    merged = {r.node: (r.n_merged, r.p, r.q) for r in graph.merge_alias_nodes(nodes, aliases, ["p", "q"]).collect()}
    assert merged == {"John Owen": (2, ["x", "y"], ["d"]), "Knox": (1, [], [])}


def test_verses(spark):
    for text, want in {"xJohn 3:16": [], "John 13:4,7 and on": ["John 13:4,7"], "9 Kings 1:2": ["9 Kings 1:2"], "": []}.items():
        assert one(spark, text, tx.verse_references) == want


def test_overlap_without_cap(spark, monkeypatch):
    monkeypatch.setattr(shared_edges, "NODES", 7)  # nine blocks
    rng = random.Random(4)
    held = {f"n{k}": {"hub", *(f"i{rng.randrange(30)}" for _ in range(3))} for k in range(60)}
    items = spark.createDataFrame([(n, "entity" if i < "i2" else "keyword", i) for n, s in held.items() for i in s], "node string, edge_type string, item string")
    want = {(a, b): len(held[a] & held[b]) for a in held for b in held if a < b}
    got = [tuple(r) for r in shared_edges.overlap_edges(items).collect()]
    assert len(got) == len(want) and {(a, b): w for a, b, w in got} == want
    assert shared_edges.overlap_edges.__kwdefaults__["most_nodes"] is None  # a hub of any size counts
    typed = [tuple(r) for r in shared_edges.shared_item_edges(items, most_nodes=None, max_shared=0).select("src", "dst", "edge_type", "weight").collect()]
    assert sum(w for *_, w in typed) == sum(want.values()) and len({r[:3] for r in typed}) == len(typed)


def test_components_of_all_nodes(spark, tmp_path):
    from folioforge.plans.reference_queries import connected_component_labels

    spark.createDataFrame([("a",), ("b",), ("c",), ("lone",)], "unique_id string").write.parquet(f"{tmp_path}/build_graph.parquet")
    spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y"), ("lone", "lone")], "node1 string, node2 string").write.parquet(f"{tmp_path}/edges.parquet")
    got = {r.node: r.component for r in connected_component_labels(spark, str(tmp_path)).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "lone": "lone", "x": "x", "y": "x"}


def test_resolve_edges(spark):
    rows = [("r", "r"), ("r", "m"), ("m", "a"), ("a", "m"), ("r", "a"), ("r", "h"), (None, "r"), ("r", ""), ("r", "r")]
    edges = spark.createDataFrame(rows, "node1 string, node2 string")
    hints = spark.createDataFrame([("h", "f1"), ("a", None)], "original_id string, hint string")
    registry = spark.createDataFrame([("r", "R", "f1"), ("a", "A1", "f1"), ("a", "A2", "f2"), ("h", "H1", "f1"), ("h", "H2", "f2")], "original_id string, final_id string, source_file string")
    got = sorted((tuple(r) for r in graph.resolve_edges(edges, hints, registry).collect()), key=str)
    ok, no = lambda a, b, x, y: (a, b, "resolved", x, y), lambda a, b, s: (a, b, s, None, None)
    want = [ok("r", "r", "R", "R"), ok("r", "r", "R", "R"), ok("r", "h", "R", "H1"), no("r", "m", "missing"), no("m", "a", "missing"), no("a", "m", "ambiguous"), no("r", "a", "ambiguous"), no(None, "r", "missing"), no("r", "", "missing")]
    assert got == sorted(want, key=str)


def test_trails_between(spark):
    rng = random.Random(6)
    pairs = {tuple(sorted((rng.randrange(9), rng.randrange(9)))) for _ in range(17)}
    edges = spark.createDataFrame([(f"n{a}", f"n{b}", a + 2 * b) for a, b in pairs], "src string, dst string, weight bigint")
    starts = spark.createDataFrame([("n1",), ("n2",)], "node string")
    ends = spark.createDataFrame([("n2",), ("n5",), ("n7",)], "node string")
    want = sorted(tuple(r) for r in graph.trails(edges, starts, 5).collect() if r.finish in ("n2", "n5", "n7"))
    assert sorted(tuple(r) for r in graph.trails_between(edges, starts, ends, 5).collect()) == want and {w[2] for w in want} == {1, 2, 3, 4, 5}


def test_lexicon_bound(spark, tmp_path, monkeypatch):
    from folioforge.plans import reference_queries as rq

    spark.createDataFrame([("keyword", "a"), ("keyword", "b"), ("keyword", "b"), ("figure", "c")], "field string, item string").write.parquet(f"{tmp_path}/lexicon.parquet")
    monkeypatch.setattr(rq, "MOST_TERMS", 1)
    assert rq._lexicon(spark, str(tmp_path), "figure") == ["c"]
    with pytest.raises(ValueError):
        rq._lexicon(spark, str(tmp_path), "keyword")


def test_compose_all_attributes(spark, tmp_path):
    from folioforge.plans import reference_queries as rq

    columns = ["id", "source_file", *rq.ATTRIBUTES]
    rows = [("x", "g1", *(f"{a}1" for a in rq.ATTRIBUTES)), ("x", "g2", *("" if a == "text" else f"{a}2" for a in rq.ATTRIBUTES))]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).write.parquet(f"{tmp_path}/simple_gml_to_csv.parquet")
    got = rq.graph_compose_last_wins(spark, str(tmp_path)).first().asDict()
    assert got == {"id": "x"} | {a: "text1" if a == "text" else f"{a}2" for a in rq.ATTRIBUTES}


def test_postings_move_packed(spark, monkeypatch):
    monkeypatch.setattr(shared_edges, "NODES", 50)  # twelve blocks or so
    items = spark.createDataFrame([(f"n{k}", "entity", i) for k in range(600) for i in ("hub", f"i{k % 2}")], "node string, edge_type string, item string")
    sc = spark.sparkContext
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for s in store(sc)}

    def store(sc):
        s = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return [s.apply(k) for k in range(s.size())]

    before = set(stages())
    r = shared_edges.overlap_edges(items).agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).first()
    assert (r.n, r.w) == (600 * 599 // 2, 600 * 599 // 2 + 2 * 300 * 299 // 2)
    assert max(v for k, v in stages().items() if k not in before) <= 1_200  # the postings once; not each of them for every block


def test_shared_items_joined(spark, monkeypatch, tmp_path):
    from folioforge.plans.reference_queries import shared_item_edges_uncapped

    monkeypatch.setattr(shared_edges, "NODES", 5)
    monkeypatch.setattr(shared_edges, "PAIRS", 7)
    rng = random.Random(8)
    rows = [(f"n{k}", ["hub", *(f"e{rng.randrange(9)}" for _ in range(3))], [f"k{j}" for j in range(70)] if k < 3 else [f"k{rng.randrange(70)}"], ["hub"] if k % 2 else None) for k in range(20)]
    spark.createDataFrame(rows, "unique_id string, entities array<string>, keywords array<string>, figures array<string>").write.parquet(f"{tmp_path}/build_graph.parquet")
    want = {}
    for a, *x in rows:
        for b, *y in rows:
            for kind, p, q in zip(("entity", "keyword", "figure"), x, y):
                if a < b and (both := sorted({*(p or ())} & {*(q or ())})):
                    want[a, b, kind] = (len(both), "|".join(both[:3]))
    edges = shared_item_edges_uncapped(spark, str(tmp_path))
    got = [tuple(r) for r in edges.select("src", "dst", "edge_type", "weight", "shared").collect()]
    assert len(got) == len(want) and {r[:3]: r[3:] for r in got} == want
    assert "array_join" not in edges._jdf.queryExecution().executedPlan().toString()  # joined for each combination, not for each pair
