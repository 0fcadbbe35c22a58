"""GML source and sink, document reading, incremental ingest."""

import datetime
import os
import zipfile

from folioforge.sources import documents, gml
from folioforge.streaming.ingest import ingest, windowed_counts

SAMPLE = """graph [
  node [ id 0 label "a [x]" text "one &#10;two &#8212; \\"q\\"" tag "p" tag "q" ]
  node [
    id 1
    label "b"
    text "over
lines"
  ]
  edge [ source 0 target 1 weight 2.5 ]
  node [
    id 2
    label "cut"
"""


def test_parse():
    blocks = list(gml.parse_gml(iter(SAMPLE.splitlines(True))))
    assert [b[0] for b in blocks] == ["node", "node", "edge", "node"]
    assert blocks[0][2] == {"id": "0", "label": "a [x]", "text": 'one \ntwo — "q"', "tag": "p,q"}
    assert blocks[1][2]["text"] == "over\nlines" and blocks[2][2]["weight"] == "2.5"
    assert blocks[3][3] == "unterminated block" and [b[3] for b in blocks[:3]] == [None] * 3
    assert "&#10;" in list(gml.parse_gml(iter(SAMPLE.splitlines(True)), entities=False))[0][2]["text"]
    assert list(gml.parse_gml(iter([]))) == []


def test_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "g.gml").write_text(SAMPLE)
    (tmp_path / "in" / "h.gml").write_text("graph [\n]\n")
    rows = gml.read_gml(spark, str(tmp_path / "in"))
    assert sorted((r.block, r.error, r.file) for r in rows.collect() if r.error) == [("node", "unterminated block", "g.gml")] and rows.count() == 4
    good = rows.where("error is null").select("block", "props")
    gml.write_gml(good.coalesce(1), str(tmp_path / "out"), mode="append")
    back = gml.read_gml(spark, str(tmp_path / "out"))
    key = lambda r: (r.block, sorted(r.props.items()))
    assert sorted(map(key, back.collect())) == sorted(map(key, good.collect()))


def test_large_file_in_splits(spark, tmp_path):
    """A file is cut between its blocks and read by many tasks, with the same rows."""
    props = [{"id": str(k), "label": f"n{k}", "text": "a [b] \"c\"\n" * (k % 7)} for k in range(3000)]
    (tmp_path / "g.gml").write_text("graph [\n" + "".join(gml.render_block("node", p) for p in props) + "]\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = gml.read_gml(spark, str(tmp_path / "g.gml"))
        assert rows.rdd.getNumPartitions() > 3
        got = {r.props["id"]: r for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 3000 and all(got[p["id"]].props == p and got[p["id"]].error is None for p in props)


def test_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.TXT").write_bytes("café".encode())
    (tmp_path / "b.txt").write_bytes("café".encode("latin-1"))
    (tmp_path / "sub" / "c.html").write_text("<p>x<script>no</script> &amp; y</p>")
    (tmp_path / "d.rtf").write_text("no")
    (tmp_path / "e.docx").write_bytes(b"broken")
    with zipfile.ZipFile(tmp_path / "f.epub", "w") as z:
        z.writestr("1.xhtml", "<p>one</p>")
    got = {r.source_file: r.text for r in documents.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.TXT": "café", "b.txt": "café", "c.html": "x & y", "e.docx": "", "f.epub": "one\n\n"}
    done = documents.read_documents(spark, str(tmp_path)).where("source_file <> 'b.txt'")
    assert [r.source_file for r in documents.read_documents(spark, str(tmp_path), processed=done).collect()] == ["b.txt"]


def test_ingest(spark, tmp_path):
    src, target, state = (str(tmp_path / x) for x in ("src", "target", "state"))
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id bigint, t string").write.parquet(src)
    run = lambda: ingest(spark, src, "id bigint, t string", lambda d: d, target, state, ["id"]).awaitTermination()
    run()
    run()
    assert spark.read.parquet(target).count() == 2
    spark.createDataFrame([(2, "b"), (3, "c")], "id bigint, t string").write.mode("append").parquet(src)
    run()
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]
    assert os.listdir(state)


def test_windows(spark):
    at = lambda h, m: datetime.datetime(2026, 1, 1, h, m)
    df = spark.createDataFrame([(at(1, 0), "x", 1.0), (at(1, 59), "x", 2.0), (at(2, 0), "x", None)], "ts timestamp, event_type string, value double")
    assert sorted((r.n, r.total) for r in windowed_counts(df).where("total is not null").collect()) == [(2, 3.0)]
