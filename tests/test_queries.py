"""Every query against its SQL twin on the smallest tables."""

import duckdb
import pytest

from figmine.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(repr(tuple(map(plain, r))) for r in cursor.fetchall())
    assert sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect()) == want


def test_matrix_text_of_odd_letters_and_blanks(spark, tmp_path):
    """Words beside other letters and numbers between other blanks, as the SQL has them; very many numbers in a row."""
    numbers = " x".join(map(str, range(12)))
    odd = [numbers + " " + "ñabc漢def " * 3, numbers + " é_abc " * 6, "= + = + = + = 漢abc漢def漢", "1\u00a02\u00a03\u00a04\u00a0 abcd efgh ijkl", "a\x0b1\x0b2\x0b3\x0b4\x0b5 abcd", "a \x1c1\t2\f3\r4 5 abcd", "7 " * 20000, None, ""]
    rows = [(2 * 63 * i + 1, t, "en") for i, t in enumerate(odd)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = QUERIES["is_matrix_text"](spark, str(tmp_path)).select("doc_id", "is_matrix").collect()
    want = con.execute(f"select doc_id, is_matrix from ({ORACLE_SQL['is_matrix_text']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and len({r[1] for r in want}) == 2


def test_text_queries_stay_in_the_jvm(spark, sf):
    for name in ("caption_filter", "phrase_match_join", "caption_join", "surrounding_join", "orchestrate_detect"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan, name
