"""Documents as files: what is there, what is missing, and their blocks and figures by a pluggable parser.

A parser turns the bytes of one file into blocks ``(page, block_no, kind, text, x0, y0, x1, y1)``; kind is
'text' or 'image'.  The default one reads a layout format of our own, a JSON object
``{"pages": [[{"kind": "text", "text": ..., "box": [x0, y0, x1, y1]}, ...], ...]}``; a cluster with a PDF
library plugs in another."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figmine.functions import text as T

_BLOCK = pa.struct([("page", pa.int32()), ("block_no", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("x0", pa.float64()), ("y0", pa.float64()), ("x1", pa.float64()), ("y1", pa.float64())])
SCHEMA = "path string, success boolean, error string, blocks array<struct<page:int,block_no:int,kind:string,text:string,x0:double,y0:double,x1:double,y1:double>>"


def read_files(spark: SparkSession, folder: str, ending: str = "pdf") -> DataFrame:
    """``path, length, content`` of the files of a folder; none where the folder is missing.  Spark's reader
    passes over empty files; they come back from its list of files, without content."""
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ending}").load(folder).select("path", "length", "content")
    except AnalysisException:
        return spark.createDataFrame([], "path string, length long, content binary")
    listed = [(re.sub("^([a-z0-9+.-]+):///", r"\1:/", unquote(p)),) for p in found.inputFiles()]
    empty = spark.createDataFrame(listed, "path string").join(found.select("path"), "path", "left_anti")
    return found.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")))


def to_fetch(papers: DataFrame, files: DataFrame, ending: str = "pdf") -> DataFrame:
    """Papers (``arxiv_id``) whose file is not there or empty: an anti join by file name, before any fetch."""
    have = files.where("length > 0").select(F.regexp_extract("path", r"([^/]+)$", 1).alias("__have"))
    return papers.join(have, F.concat(T.file_stem(F.col("arxiv_id")), F.lit(f".{ending}")) == F.col("__have"), "left_anti")


def parse_layout(content: bytes) -> list[dict]:
    out = []
    for p, blocks in enumerate(json.loads(content)["pages"]):
        for b in blocks:
            x0, y0, x1, y1 = map(float, b["box"])
            out.append({"page": p + 1, "block_no": len(out), "kind": str(b.get("kind", "text")), "text": b.get("text"), "x0": x0, "y0": y0, "x1": x1, "y1": y1})
    return out


def extract(files: DataFrame, parse: Callable[[bytes], list[dict]] = parse_layout) -> DataFrame:
    """``path, success, error, blocks`` of each file (``path, content``): an empty file fails, and so does one
    that the parser cannot read; neither stops the others."""

    def one(content):
        if not content:
            return False, "empty file", []
        try:
            return True, None, parse(content)
        except Exception as e:  # a parser's errors are its own: the row says which
            return False, type(e).__name__, []

    def run(batches):
        for batch in batches:
            made = [one(c) for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([m[i] for m in made], k) for i, k in enumerate((pa.bool_(), pa.string(), pa.list_(_BLOCK))))], ["path", "success", "error", "blocks"])

    return files.select("path", "content").mapInArrow(run, SCHEMA)


def blocks_of(documents: DataFrame, kind: str = "text") -> DataFrame:
    """``path, page, block_no, text, x0, y0, x1, y1`` of the documents that were read."""
    return documents.where("success").select("path", F.explode("blocks").alias("b")).where(F.col("b.kind") == kind).select("path", "b.*").drop("kind")
