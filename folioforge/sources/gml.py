"""GML graphs by Spark's own text reader and writer: any file system that Spark knows, and large files in splits.

Rows: block (node or edge), props map<string,string>, error (null, or why the block doesn't count), file. Brackets inside
quoted text don't nest, lists of a repeated key are joined by commas, escapes and, with decode_entities, HTML entities are
decoded. An unterminated last block is an error row.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a file is cut: the end of a block as graph libraries lay it out, two spaces in.
BLOCK_END = "\n  ]"
SCHEMA = "block string, props map<string,string>, error string, file string"
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]]|[^\s\[\]"]+|"')
_QUOTE = re.compile(r'(?<!\\)"')
_ESCAPE = re.compile(r'\\(["\\nt])')


def unquote(value: str, entities: bool) -> str:
    if value[:1] == '"':
        value = _ESCAPE.sub(lambda m: {"n": "\n", "t": "\t"}.get(m.group(1), m.group(1)), value[1:-1])
        return html.unescape(value) if entities else value
    return value


def _tokens(lines: Iterator[str]) -> Iterator[tuple[str, int]]:
    """Tokens with their lines; a quoted value may run over several lines, each of which is looked at once."""
    held: list[str] = []
    since, odd = 0, False
    for n, line in enumerate(lines, 1):
        if not held:
            if line.lstrip().startswith("#"):
                continue
            since = n
        held.append(line)
        odd ^= len(_QUOTE.findall(line)) % 2 == 1
        if odd:
            continue
        text = "".join(held)
        held.clear()
        for m in _TOKEN.finditer(text):
            yield m.group(), since
    if held:
        yield "".join(held).rstrip("\n"), since


def parse_gml(lines: Iterator[str], entities: bool = True) -> Iterator[tuple[str, int, dict[str, str], str | None]]:
    """(block, line_no, props, error) of each node and edge block."""
    block: str | None = None
    key: str | None = None
    depth, at, props, error = 0, 0, {}, None
    last = ""
    for token, line in _tokens(lines):
        if block is None:
            if token == "[" and last in ("node", "edge"):
                block, at, depth, props, error, key = last, line, 1, {}, None, None
            last = token
            continue
        if token == "[":
            depth += 1
            if depth > 2:
                error = error or "nested list"
        elif token == "]":
            depth -= 1
            if depth == 0:
                if key is not None:
                    error = error or f"no value for {key}"
                yield block, at, props, error
                block, last = None, ""
            else:
                key = None
        elif key is None and depth == 1:
            key = token
            if token[:1] == '"':
                error = error or "a value without a key"
        elif token == '"' or (token[:1] == '"' and (len(token) < 2 or token[-1] != '"')):
            error = error or "unclosed quote"
        else:
            value = unquote(token, entities)
            name = key or ""
            props[name] = f"{props[name]},{value}" if name in props else value
            if depth == 1:
                key = None
    if block is not None:
        yield block, at, props, error or "unterminated block"


def render_block(block: str, props: dict[str, str]) -> str:
    """One block as GML text; numbers stand bare."""
    lines = [f"  {block} ["]
    for k, v in props.items():
        if v is None:
            continue
        if re.fullmatch(r"-?\d+(?:\.\d+)?", v):
            lines.append(f"    {k} {v}")
        else:
            quoted = v.replace("&", "&amp;").replace('"', "&quot;").replace("\n", "&#10;").replace("\\", "&#92;")
            lines.append(f'    {k} "{quoted}"')
    return "\n".join([*lines, "  ]"]) + "\n"


def read_gml(spark: SparkSession, path: str, *, decode_entities: bool = True) -> DataFrame:
    """The blocks of all files at path (a file, folder or pattern). A file is split between blocks, so a large one makes many
    tasks; one laid out otherwise is read as a whole. A quoted text with a line that looks like the end of a block gives
    error rows, not wrong ones, and so does the last block of a file that breaks off. No files raise Spark's error, empty
    ones give no rows."""

    def blocks(text: str, file: str, last: bool) -> Iterator[tuple]:
        if "[" in text:
            lines = (text if last else text + BLOCK_END).split("\n")
            for block, _, props, error in parse_gml((line + "\n" for line in lines), decode_entities):
                yield block, list(props.items()), error, file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # a record stays until the next one shows whether it was the last of its file
        types = (pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string())

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "props", "error", "file"])

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None:
                    out += blocks(held[0], held[1], held[3] and held[1:3] != row[1:3])
                held = row
            yield rows(out)
        if held is not None:
            yield rows(list(blocks(held[0], held[1], held[3])))

    read = spark.read.option("lineSep", BLOCK_END).option("recursiveFileLookup", "true").text(path)
    at = F.col("_metadata")
    ends = at["file_block_start"] + at["file_block_length"] >= at["file_size"]
    return read.select("value", at["file_path"].alias("path"), at["file_block_start"].alias("start"), ends.alias("ends")).mapInArrow(run, SCHEMA).withColumn("file", F.regexp_extract("file", r"([^/]*)$", 1))


def property_names(blocks: DataFrame) -> DataFrame:
    """(block, name, n_blocks): the properties that the good blocks carry, over all of them; optional columns are those of some."""
    names = blocks.where("error is null").select("block", F.explode(F.map_keys("props")).alias("name"))
    return names.groupBy("block", "name").agg(F.count(F.lit(1)).alias("n_blocks"))


def write_gml(blocks: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Write blocks (block, props) as text files, each a whole graph, by Spark's committer. Null properties are left out,
    null props are an empty block; rows without a block are dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(["graph ["])], names=["value"])
        for batch in batches:
            texts = [render_block(b, dict(p or ())).rstrip("\n") for b, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    blocks.where("block is not null").select("block", "props").mapInArrow(run, "value string").write.mode(mode).text(path)
