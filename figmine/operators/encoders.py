"""Vectors of texts and images: pluggable encoders, one a worker, with offline ones as defaults.

An encoder is made by a function without arguments and turns a list of values into one row of a matrix
each; None stands for a value that it cannot read.  The defaults are approximations for tables that bring no
vectors: hashed word counts for texts, counted in the JVM, and a small gray picture for images."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from figmine.vision import backend, png

Encoder = Callable[[list], list]
_HELD: dict = {}


def held(make: Callable[[], Encoder]):
    """The encoder of this process, made once; None where making it failed before, which is not tried again."""
    key = getattr(make, "__qualname__", ""), getattr(make, "__module__", ""), getattr(make, "size", None)
    if key not in _HELD:
        try:
            _HELD[key] = make()
        except (ImportError, OSError, RuntimeError):
            _HELD[key] = False
    return _HELD[key] or None


#: dimensions of hashed word counts
SIZE = 64


def word_buckets(df: DataFrame, key: str, text: str, size: int = SIZE) -> DataFrame:
    """``key, bucket, n``: how many lower-case words of ASCII letters and digits of each text fall into a bucket, the first
    32 bits of a word's md5 modulo ``size``.  The sparse vector of a text; one without words has no rows."""
    words = df.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))).alias("word"))
    bucket = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("long") % size
    return words.select(key, bucket.cast("int").alias("bucket")).groupBy(key, "bucket").agg(F.count("*").alias("n"))


def bucket_vectors(df: DataFrame, key: str, text: str, out: str = "embedding", size: int = SIZE) -> DataFrame:
    """``key, out``: those counts as an array, zeros for texts without words, not normalised.  Keys are distinct; a
    key's buckets meet, not its words."""
    counts = word_buckets(df, key, text, size).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("counts")).withColumnRenamed(key, "counted")
    dense = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("counts", i), F.lit(0)).cast("float"))
    return df.select(key).join(counts, F.col(key) == F.col("counted"), "left").select(key, dense.alias(out))


class image_encoder:
    """Makes an encoder of image files: gray, cut to ``size`` x ``size`` means, of length one."""

    def __init__(self, size: int = 8, decode: Callable[[bytes], np.ndarray] = png.decode):
        self.size, self.decode = size, decode

    def __call__(self) -> Encoder:
        def encode(files: list) -> list:
            out = []
            for raw in files:
                try:
                    row = backend.cell_means(backend.to_gray(self.decode(raw or b"")), self.size).ravel()
                    out.append(row / max(np.linalg.norm(row), 1e-12))
                except ValueError:
                    out.append(None)
            return out

        return encode


def encode(df: DataFrame, column: str, make: Callable[[], Encoder], out: str = "embedding") -> DataFrame:
    """``df`` with the vector of a column; null where the value, or the encoder, cannot be read."""
    kept = df.select(*[c for c in df.columns if c != out])
    at = kept.columns.index(column)

    def run(batches):
        encoder = held(make)
        for batch in batches:
            values = batch.column(at).to_pylist()
            rows = encoder(values) if encoder else [None] * len(values)
            vectors = pa.array([None if r is None else np.asarray(r, np.float32).tolist() for r in rows], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, vectors], [*batch.schema.names, out])

    return kept.mapInArrow(run, type(kept.schema)([*kept.schema.fields]).add(out, ArrayType(FloatType())))
