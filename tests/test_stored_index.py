"""The stored index: nine neighbours in ten, folders that are not asked stay closed, failed writes change nothing."""

import re
from pathlib import Path

import numpy as np
import pytest

from figmine.operators import classify as K
from figmine.operators import stored_index as S
from figmine.sinks import snapshots
from figmine.sinks.shared import shared_path


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(11)
    x = r.normal(0, 4, (12, 16))[r.integers(0, 12, 600)] + r.normal(0, 1, (600, 16))
    return spark.createDataFrame([(i, x[i].tolist(), i % 3) for i in range(600)] + [(600, None, 1)], "vec_id long, embedding array<double>, label int")


def test_opened_again_it_reaches_nine_in_ten(spark, vectors):
    path = shared_path(spark, "cells")
    S.write_index(vectors, path, file_rows=20)
    index = S.open_index(spark, path)
    assert index.vectors.count() == 600 and index.sizes.agg({"n": "sum"}).first()[0] == 600
    q = vectors.where("vec_id % 50 = 0")
    exact = K.knn(q.where("embedding is not null"), vectors.where("embedding is not null"))
    found = S.search(index, q, block=40)
    assert K.recall(found, exact).first()["recall"] >= 0.9
    whole = S.search(index, q, probes=len(index.centres), block=40)
    key = lambda r: (r["vec_id"], r["rank"], r["ref_id"], r["label"], round(r["distance"], 6))
    assert sorted(map(key, whole.collect())) == sorted(map(key, exact.collect()))
    assert S.search(index, q.limit(0)).count() == 0


def test_only_the_asked_cells_are_read(spark, vectors):
    path = shared_path(spark, "cells")
    S.write_index(vectors, path)
    index = S.open_index(spark, path)
    q = vectors.where("vec_id = 100")
    found = S.search(index, q, probes=2)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    asked = set(K.in_cells(q.select("vec_id", "embedding"), "embedding", index.centres, 2).first()["cells"])
    want = found.collect()
    spoiled = 0
    for f in Path(path.removeprefix("file:")).resolve().rglob("vectors/cell=*/*.parquet"):
        if int(re.search(r"cell=(\d+)", str(f)).group(1)) not in asked:
            f.write_bytes(b"not a file of vectors")
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
            spoiled += 1
    assert spoiled > 10
    assert S.search(S.open_index(spark, path), q, probes=2).collect() == want and want[0]["ref_id"] == 100


def test_a_failed_write_keeps_the_index(spark, vectors):
    path = shared_path(spark, "cells")
    with pytest.raises(FileNotFoundError):
        S.open_index(spark, path)
    first = S.write_index(vectors.limit(50), path)
    broken = vectors.selectExpr("vec_id", "IF(vec_id = 599, slice(embedding, 1, 3), embedding) AS embedding", "label")
    with pytest.raises(Exception):  # noqa: B017
        S.write_index(broken, path)
    assert S.open_index(spark, path).vectors.count() == 50 and snapshots.versions(spark, path) == [first]
    assert S.write_index(vectors, path) == first + 1 and S.open_index(spark, path).vectors.count() == 600


def test_an_empty_index(spark, vectors):
    path = shared_path(spark, "cells")
    S.write_index(vectors.limit(0), path)
    assert S.search(S.open_index(spark, path), vectors).collect() == []
