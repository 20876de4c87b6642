"""Image files: the bytes of accepted figures, written by the executors."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame


def save_images(images: DataFrame, path: str) -> DataFrame:
    """Write ``content`` of each row to ``path/filename``; gives ``filename, n_bytes`` of what was written.

    ``path`` is a URI that all executors reach (file, hdfs, s3).  A file appears whole or not at all: it is
    written under another name and moved, so a task that runs again replaces its own files.  A row that
    cannot be written, or has no content, gives an empty file name and is not counted; the numbers in the
    names of others stay as they are."""

    def run(batches):
        system, root = fs.FileSystem.from_uri(path)
        system.create_dir(root, recursive=True)
        for batch in batches:
            names, sizes = [], []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    if content is None or not name:
                        raise OSError("nothing to write")
                    with system.open_output_stream(f"{root}/.{name}.part") as f:
                        f.write(content)
                    system.move(f"{root}/.{name}.part", f"{root}/{name}")
                except OSError:
                    name, content = "", b""
                names.append(name)
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["filename", "n_bytes"])

    return images.select("filename", "content").mapInArrow(run, "filename string, n_bytes long")
