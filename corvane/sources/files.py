"""File scans: routing by extension, plain text and DOCX paragraphs."""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as tx

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
# Text that run elements other than w:t stand for.
_RUN_TEXT = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n", f"{_W}noBreakHyphen": "-"}


def scan_corpus(spark: SparkSession, path: str, glob: str = "*.docx", recursive: bool = False) -> DataFrame:
    """Files under ``path`` whose name matches ``glob``: path, size, time and content."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(path))


def read_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Whole UTF-8 files as (path, text)."""
    return (spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


def kind(path: Column, fallback: str = "unsupported", ignore_case: bool = True, pdf: bool = True) -> Column:
    """``pdf``, ``docx`` or the fallback, from the file name."""
    name = F.lower(path) if ignore_case else path
    docx = F.when(F.endswith(name, F.lit(".docx")), "docx")
    return (docx.when(F.endswith(name, F.lit(".pdf")), "pdf") if pdf else docx).otherwise(fallback)


def route(files: DataFrame, path: str = "path", strict: bool = True) -> DataFrame:
    """Add ``kind``. Strict: .pdf and .docx in any case, others unsupported.
    Otherwise exactly .docx, and everything else is read as text."""
    if strict:
        return files.withColumn("kind", kind(F.col(path)))
    return files.withColumn("kind", kind(F.col(path), "text", ignore_case=False, pdf=False))


def _paragraph(node: ET.Element) -> str:
    return "".join((e.text or "") if e.tag == f"{_W}t" else _RUN_TEXT.get(e.tag, "")
                   for run in node.iter(f"{_W}r") for e in run)


def _read_docx(content):
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            body = ET.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
        return "\n".join(_paragraph(p) for p in body.findall(f"{_W}p")), None
    except Exception as e:  # a bad file yields empty text and its error, never a failed job
        return "", f"{type(e).__name__}: {e}"


def extract_docx(files: DataFrame, path: str = "path", content: str = "content",
                 drop_blank: bool = False) -> DataFrame:
    """(path, text, error): paragraphs joined by newlines; unreadable files give empty text.

    A plain Python function is used on purpose: it takes files in small batches, where
    an Arrow batch would hold thousands of whole files at once.
    """
    parse = F.udf(_read_docx, "text string, error string", useArrow=False)
    parsed = files.select(path, parse(content).alias("d")).select(path, "d.text", "d.error")
    return parsed.withColumn("text", tx.drop_blank_lines(F.col("text"))) if drop_blank else parsed
