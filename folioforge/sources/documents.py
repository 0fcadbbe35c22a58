"""Documents of several formats as one table (path, source_file, extension, length, modified, text)."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The formats whose text is read here; others give an empty text.
PLAIN, MARKUP, ZIPPED = ("txt", "md", "rst"), ("html", "htm"), ("epub", "docx", "odt")


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def html_text(page: str) -> str:
    parser = _Text()
    parser.feed(page)
    parser.close()
    return "".join(parser.parts)


def zipped_text(content: bytes, kind: str) -> str:
    """Text of an EPUB, DOCX or ODT; of a broken file none."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            if kind == "epub":
                return "".join(html_text(z.read(n).decode("utf-8", "replace")) + "\n\n" for n in z.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")))
            body = z.read("word/document.xml" if kind == "docx" else "content.xml").decode("utf-8", "replace")
            body = re.sub(r"</(?:w:p|text:p|text:h)>", "\n", body)
            return html_text(re.sub(r"<[^>]*>", "", body)).strip("\n")
    except (zipfile.BadZipFile, KeyError):
        return ""


def decoded(content: Column) -> Column:
    """UTF-8 if the bytes are valid, else ISO-8859-1."""
    return F.when(F.expr("is_valid_utf8(content)"), F.decode(content, "UTF-8")).otherwise(F.decode(content, "ISO-8859-1"))


LISTED = 10_000  # new files that may stand in a filter on the listing, which spares the reader all others


def read_documents(spark: SparkSession, folder: str, extensions: Sequence[str] = (*PLAIN, *MARKUP, *ZIPPED), processed: DataFrame | None = None, pdf_text=None) -> DataFrame:
    """All files below folder whose extension is listed, in any letter case, without those in processed (path, length, modified).

    pdf_text: optional function bytes -> text for PDF files, for which no library is at hand here; without it they are
    read as empty. One plan for all files; contents don't reach the driver.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    named = files.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"), F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).alias("extension"), "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("at"), "content")
    named = named.where(F.col("extension").isin(*extensions))
    if processed is not None:  # by the listing alone; contents are read for the files that stay
        listed = named.select("path", "length", "modified", "at").join(processed.select("path", "length", "modified").distinct(), ["path", "length", "modified"], "left_anti")
        paths = [r["at"] for r in listed.select("at").limit(LISTED + 1).collect()]
        if len(paths) <= LISTED:
            named = named.where(F.col("at").isin(*paths)) if paths else named.limit(0)
        else:
            named = named.join(listed.select("at"), "at", "left_semi")

    @F.pandas_udf("string")
    def unpack(content: pd.Series, kind: pd.Series) -> pd.Series:
        out = []
        for c, k in zip(content, kind):
            if k in ZIPPED:
                out.append(zipped_text(c, k))
            elif k in MARKUP:
                out.append(html_text(c.decode("utf-8", "replace")))
            else:
                out.append(pdf_text(c) if k == "pdf" and pdf_text else "")
        return pd.Series(out)

    text = F.when(F.col("extension").isin(*PLAIN), decoded(F.col("content"))).otherwise(unpack("content", "extension"))
    return named.withColumn("text", text).drop("content", "at")


def worth_reading(docs: DataFrame, least: int = 100) -> DataFrame:
    """Documents of at least `least` characters."""
    return docs.where(F.char_length("text") >= least)
