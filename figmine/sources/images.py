"""Labelled image folders: one folder a class."""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENDINGS = "*.{png,jpg,jpeg,PNG,JPG,JPEG}"
#: names in a batch of a listing, and bytes of files in a batch read
NAMES, BYTES = 1000, 16 << 20
#: files that one task reads at least, so that small folders are not dealt out in vain
LEAST = 200


def _qualified(spark: SparkSession, path: str) -> tuple[str, bool]:
    """A path as a URI of its store, and whether it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:///", store.makeQualified(target).toString()), store.exists(target)


def _reads(uri: str) -> bool:
    """Whether tasks can open a store themselves."""
    try:
        return uri.startswith("file:") or fs.FileSystem.from_uri(uri) is not None
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ValueError):
        return False


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI and the path in it; a local path stands in the URI as it is."""
    return (fs.LocalFileSystem(), uri.removeprefix("file://")) if uri.startswith("file:") else fs.FileSystem.from_uri(uri)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` of the images of a folder, listed by a task: the driver holds none of the names."""

    def names(batches):
        store, root = _open(folder)
        for _ in batches:
            found = [i.base_name for i in store.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.File]
            found = [n for n in found if re.fullmatch(r"(?s)[^._].*\.(png|jpg|jpeg|PNG|JPG|JPEG)", n)]
            for i in range(0, len(found), NAMES):
                yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{n}" for n in found[i : i + NAMES]], pa.string())], ["path"])

    return spark.range(0, 1, 1, 1).mapInArrow(names, "path string")


def _contents(paths: DataFrame) -> DataFrame:
    """``path, content, is_target`` of files, read by the tasks."""

    def read(batches):
        kinds = [pa.string(), pa.binary(), pa.int32()]
        made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "content", "is_target"])
        for batch in batches:
            rows, size = [], 0
            for path, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, at = _open(path)
                with store.open_input_stream(at) as f:
                    rows.append((path, f.read(), label))
                size += len(rows[-1][1])
                if size > BYTES:
                    yield made(rows)
                    rows, size = [], 0
            if rows:
                yield made(rows)

    return paths.select("path", "is_target").mapInArrow(read, "path string, content binary, is_target int")


def read_labeled_images(spark: SparkSession, base: str, target: str = "circuits", other: str = "non_circuits") -> DataFrame:
    """``path, content, is_target`` of the images of two class folders.  A missing folder or a class without
    images is a ValueError; rows have no order, so readers that need one sort by ``path``.

    Folders are listed and read by tasks; those of a store that only Spark opens by Spark's reader, which holds all names in
    the driver."""
    parts, n = [], 0
    for label, folder in ((1, target), (0, other)):
        uri, there = _qualified(spark, f"{base}/{folder}")
        if not there:
            raise ValueError(f"no folder {base}/{folder}")
        if _reads(uri):
            found = listed(spark, uri)
            here = found.count()
        else:
            try:
                found = spark.read.format("binaryFile").option("pathGlobFilter", ENDINGS).load(f"{base}/{folder}")
            except AnalysisException as e:
                raise ValueError(f"no folder {base}/{folder}") from e
            here = found.select("path").limit(1).count()
        if not here:
            raise ValueError(f"no images in {base}/{folder}")
        n += here
        parts.append(found.withColumn("is_target", F.lit(label)))
    if any("content" in p.columns for p in parts):
        return parts[0].select("path", "content", "is_target").unionByName(parts[1].select("path", "content", "is_target"))
    tasks = min(max(1, -(-n // LEAST)), max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism))
    return _contents(parts[0].unionByName(parts[1]).repartition(tasks, "path"))
