"""Vision rules, outputs, resume and streams."""

import json

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from figmine.sinks import outputs as O
from figmine.sinks import snapshots
from figmine.streaming import incremental as I
from figmine.vision import backend, rules


def test_components_and_rules(spark):
    a = np.full((120, 300), 255, np.uint8)
    for y in (30, 60, 90):
        a[y : y + 2, 10:290] = 0
    a[100:115, 20:60] = 0
    b = backend.components(a < 200)
    assert sorted(map(tuple, b[:, :4].tolist())) == [(10, 30, 280, 2), (10, 60, 280, 2), (10, 90, 280, 2), (20, 100, 40, 15)]
    slope = np.eye(6, dtype=bool)
    assert backend.components(slope)[:, :4].tolist() == [[0, 0, 6, 6]]
    df = spark.createDataFrame([(1, 300, 120, bytearray(a.tobytes())), (2, 5, 5, bytearray(b"x")), (3, None, None, None)], "image_id long, width int, height int, pixels binary")
    s = backend.with_statistics(df)
    r = {x["image_id"]: x for x in s.select("image_id", "h_lines", rules.has_circuit_structure(F.struct(*s.columns)).alias("circuit")).collect()}
    assert r[1]["h_lines"] == 3 and r[1]["circuit"] and r[2]["h_lines"] is None and r[3]["circuit"] is None
    one = spark.range(1).select(rules.is_matrix(F.lit(1.0), F.lit(0.0), F.lit(0.5), F.lit(0.0)).alias("m"), rules.is_matrix(F.lit(0.8), F.lit(0.0), F.lit(0.0), F.lit(0.5)).alias("n")).first()
    assert one["m"] and not one["n"]
    assert backend.to_gray(np.full((1, 1, 3), 255, np.uint8))[0, 0] == 255


def test_outputs(spark, tmp_path):
    counts = spark.createDataFrame([("a", 3), ("b", None)], "arxiv_id string, circuit_count int")
    O.write_counts(counts, f"{tmp_path}/counts")
    assert O.read_counts(spark, f"{tmp_path}/absent").count() == 0
    assert sorted(map(tuple, O.read_counts(spark, f"{tmp_path}/counts").collect()), key=str) == [("a", 3), ("b", None)]
    assert O.read_counts(spark, f"{tmp_path}/none").count() == 0
    records = spark.createDataFrame([("a_1.png", "a", 2)], "filename string, arxiv_number string, page_number int")
    assert json.loads(O.dataset_object(records).first()["json"]) == {"a_1.png": {"arxiv_number": "a", "page_number": 2}}
    assert O.load_state(spark, f"{tmp_path}/state") is None and O.resume_point(None) == (0, 0)


def _detect(papers):
    return papers.withColumn("image_index", F.explode(F.sequence(F.lit(0), (F.col("paper_idx") % 3).cast("int")))).where("paper_idx % 2 = 0")


def test_resume_equals_one_run(spark, tmp_path):
    papers = spark.range(23).select(F.col("id").alias("paper_idx"), F.concat(F.lit("x/"), F.col("id").cast("string")).alias("arxiv_id"))
    read = lambda df: sorted((r["paper_idx"], r["image_index"]) for r in df.collect())
    whole = read(I.run(papers, _detect, f"{tmp_path}/one", batch=5, most=17))
    I.run(papers, _detect, f"{tmp_path}/two", batch=5, most=17, stop_after=2)
    assert read(I.run(papers, _detect, f"{tmp_path}/two", batch=5, most=17)) == whole and len(whole) == 17
    assert I.numbered(_detect(papers)).where("paper_idx = 2").select("filename").orderBy("filename").first()[0] == "x_2_1.png"


def test_stream(spark, tmp_path):
    spark.range(6).select(F.col("id").alias("paper_idx")).write.parquet(f"{tmp_path}/in")
    q = I.file_stream(spark, f"{tmp_path}/in", "paper_idx long", _detect, f"{tmp_path}/out", f"{tmp_path}/cp")
    q.awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() == _detect(spark.range(6).select(F.col("id").alias("paper_idx"))).count()


# outputs that stay whole ------------------------------------------------------------------------


def _failing(spark, schema, n=200):
    """Rows of which one cannot be written, in the last of several tasks."""
    bad = F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long"))
    return spark.range(n).repartition(8, "id").select(F.concat(F.lit("f"), bad.cast("string")).alias(schema[0]), bad.cast(schema[2]).alias(schema[1]))


def test_failed_rewrite_keeps_the_old_rows(spark, tmp_path):
    records, counts = "filename string, page long", O.COUNTS
    first = spark.createDataFrame([("a.png", 1), ("b.png", 2), ("c.png", None)], records)
    path = f"{tmp_path}/dataset"
    assert O.read_dataset(spark, path, records).count() == 0
    O.write_dataset(first, path)
    for _ in range(2):
        with pytest.raises(PySparkException):
            O.write_dataset(_failing(spark, ("filename", "page", "long")), path)
        assert sorted(map(tuple, O.read_dataset(spark, path, records).collect())) == sorted(map(tuple, first.collect()))
    assert len(snapshots.names(spark, f"{path}/data")) == 1  # nothing is left of the failed ones
    held = O.read_dataset(spark, path, records)
    O.write_dataset(first.limit(1), path)
    assert held.count() == 3 and O.read_dataset(spark, path, records).count() == 1
    O.write_dataset(first.limit(2), path)
    assert O.read_dataset(spark, path, records).count() == 2 and len(snapshots.names(spark, f"{path}/data")) == 2
    numbers = spark.createDataFrame([("a", 3), ("b", None)], counts)
    both = f"{tmp_path}/both"
    assert O.save_all(first, numbers, both)
    with pytest.raises(PySparkException):
        O.save_all(first.limit(1), _failing(spark, ("arxiv_id", "circuit_count", "int")), both)
    assert O.read_dataset(spark, both, records, "/dataset").count() == 3 and O.read_counts(spark, both, "/counts").count() == 2


def test_lost_files_are_an_error(spark, tmp_path):
    path = f"{tmp_path}/dataset"
    O.write_dataset(spark.createDataFrame([("a.png", 1)], "filename string, page long"), path)
    snapshots.remove(spark, snapshots.folder(spark, path))
    with pytest.raises(PySparkException):
        O.read_dataset(spark, path, "filename string, page long").count()


def test_broken_lines_are_seen(spark, tmp_path):
    path, schema = f"{tmp_path}/dataset", "filename string, page long"
    snapshots.write(spark, path, lambda folder: spark.createDataFrame([('{"filename": "a", "page": 1}',), ('{"filename": "b", "pa',), ("",), ('{"filename": "c", "page": "x"}',)], "value string").write.text(folder))
    assert [r["filename"] for r in O.read_dataset(spark, path, schema).collect()] == ["a"]
    assert sorted(r["line"] for r in O.broken_lines(spark, path, schema).collect()) == ['{"filename": "b", "pa', '{"filename": "c", "page": "x"}']
    assert O.broken_lines(spark, f"{tmp_path}/none", schema).count() == 0


def test_commits_of_two_writers(spark, tmp_path):
    root = f"{tmp_path}/x"

    def slow(folder):
        spark.range(1).write.parquet(folder)
        snapshots.write(spark, root, lambda f: spark.range(2).write.parquet(f))  # another writer is faster

    with pytest.raises(snapshots.Conflict):
        snapshots.write(spark, root, slow)
    assert spark.read.parquet(snapshots.folder(spark, root)).count() == 2 and snapshots.versions(spark, root) == [1]
    assert len(snapshots.names(spark, f"{root}/data")) == 1


def test_state_survives(spark, tmp_path):
    path, state = f"{tmp_path}/state", {"last_paper_index": 4, "last_paper_id": "p4", "total_found": 2, "processed": 5, "skipped": 0, "failed": 0, "timestamp": "t", "version": "1.0"}
    O.save_state(spark, path, **state)
    O.save_state(spark, path, **state | {"last_paper_index": 9})
    assert O.load_state(spark, path)["last_paper_index"] == 9 and len(snapshots.versions(spark, path)) == 1
    O.save_state(spark, path, **state | {"timestamp": None})
    assert O.load_state(spark, path) is None
    with open(snapshots.commit_path(path, snapshots.versions(spark, path)[-1]), "w") as f:
        f.write('{"last_paper')
    assert O.load_state(spark, path) is None
    O.clear_state(spark, path)
    O.clear_state(spark, path)
    assert O.load_state(spark, path) is None


@pytest.mark.parametrize("most", [None, 7])
def test_no_stale_batch_is_read(spark, tmp_path, most):
    """A stopped run whose state is lost, and one whose state stays, go on with batches of another size."""
    papers = spark.range(20).select(F.col("id").alias("paper_idx"))
    read = lambda df: sorted((r["paper_idx"], r["image_index"]) for r in df.collect())
    whole = read(I.run(papers, _detect, f"{tmp_path}/one", batch=4, most=most))
    out = f"{tmp_path}/two"
    I.run(papers, _detect, out, batch=5, most=most, stop_after=2)
    snapshots.remove(spark, f"{out}/commits")  # the state is lost, the rows are not
    assert read(I.run(papers, _detect, out, batch=10, most=most)) == whole
    out = f"{tmp_path}/three"
    I.run(papers, _detect, out, batch=5, most=most, stop_after=1)
    spark.range(3).selectExpr("id as paper_idx", "0 as image_index").write.parquet(f"{out}/data/v-stopped")  # of a batch without a commit
    assert read(I.run(papers, _detect, out, batch=3, most=most)) == whole and "v-stopped" not in snapshots.names(spark, f"{out}/data")
    I.clear(spark, out)
    assert read(I.run(papers, _detect, out, batch=20, most=most)) == whole


def test_failed_batch_is_done_again(spark, tmp_path):
    papers = spark.range(10).select(F.col("id").alias("paper_idx"))
    out, calls = f"{tmp_path}/run", []

    def detect(p):
        calls.append(1)
        rows = _detect(p)
        return rows.withColumn("image_index", F.raise_error(F.lit("lost")).cast("int")) if len(calls) == 2 else rows

    with pytest.raises(PySparkException):
        I.run(papers, detect, out, batch=4)
    got = I.run(papers, detect, out, batch=4)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _detect(papers).collect()))


@pytest.mark.parametrize("most", [1, 7, 100])
def test_stream_until_enough(spark, tmp_path, most):
    """Stopped and started again: the first rows in order, and the total stays where it was."""
    papers = spark.range(24).select(F.col("id").alias("paper_idx"))
    want = sorted((r["paper_idx"], r["image_index"]) for r in _detect(papers).collect())[:most]
    source, out, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))

    def go():
        I.file_stream(spark, source, "paper_idx long", _detect, out, state, most=most).awaitTermination()
        return sorted((r["paper_idx"], r["image_index"]) for r in spark.read.parquet(out).collect())

    for part in range(6):
        papers.where(F.col("paper_idx").between(4 * part, 4 * part + 3)).orderBy(F.desc("paper_idx")).coalesce(1).write.mode("append").parquet(source)
        if part in (0, 3):
            got = go()
            assert got == want[: len(got)]
    assert go() == want and go() == want
