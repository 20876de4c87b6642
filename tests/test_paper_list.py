"""Paper lists over many splits: the order of the file, its odd lines, and positions in an order."""

import pytest

from figmine.sources.paper_list import indexed, numbered_lines, read_paper_list


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for n, v in zip(names, ("400", "1"), strict=True):
        spark.conf.set(n, v)
    yield spark
    for n in names:
        spark.conf.unset(n)


def body(n):
    kinds = ["2401.{:05d}", "# note {}", "", "arXiv:2401.{:05d} ", "no id {}", "2401.00001", " quant-ph/{:07d}", "#2401.{:05d}"]
    return [kinds[(i * i + i // 7) % len(kinds)].format(i % 60) for i in range(n)]


def brute(lines):
    import re

    seen, out = set(), []
    for i, raw in enumerate(lines):
        bare = raw.strip()
        name = re.sub(r"^arXiv:", "", bare).strip()
        if not bare:
            kind = "empty"
        elif bare.startswith("#"):
            kind = "comment"
        elif not re.fullmatch(r"\d{4}\.\d{4,5}|[a-z\-]+/\d{7}", name):
            kind = "invalid"
        else:
            kind = "duplicate" if name in seen else "valid"
            seen.add(name)
        out.append((i, raw, kind))
    return out


@pytest.mark.parametrize("end", ["", "\n", "\r\n"])
def test_a_list_over_many_splits(small_splits, tmp_path, end):
    lines = body(700)
    lines[-1] = "2499.00001"
    (tmp_path / "ids.txt").write_bytes(("\r\n" if end == "\r\n" else "\n").join(lines).encode() + end.encode())
    rows = read_paper_list(small_splits, str(tmp_path / "ids.txt"))
    assert numbered_lines(small_splits, str(tmp_path / "ids.txt")).select("raw").rdd.getNumPartitions() > 1
    assert small_splits.read.text(str(tmp_path / "ids.txt")).rdd.getNumPartitions() > 10
    assert sorted((r["line_no"], r["raw"], r["kind"]) for r in rows.collect()) == brute(lines)


def test_files_of_a_folder_by_name(small_splits, tmp_path):
    for k in (1, 0, 2):
        (tmp_path / f"part-{k}.txt").write_text("\n".join(f"line {k} {i}" for i in range(40 * k)))
    rows = numbered_lines(small_splits, str(tmp_path)).orderBy("line_no").collect()
    assert [r["raw"] for r in rows] == [f"line {k} {i}" for k in (1, 2) for i in range(40 * k)]
    assert [r["line_no"] for r in rows] == list(range(120))


def test_an_empty_file(spark, tmp_path):
    (tmp_path / "none.txt").write_text("")
    assert read_paper_list(spark, str(tmp_path / "none.txt")).count() == 0


def test_positions_in_an_order(spark):
    df = spark.range(5000).selectExpr("id * 7919 % 5000 AS v", "concat('r', id) AS name").repartition(7)
    got = {r["v"]: r["place"] for r in indexed(df, "v", "place").collect()}
    assert got == {i: i for i in range(5000)}
    assert indexed(df.limit(0), "v", "place").columns == ["v", "name", "place"]
