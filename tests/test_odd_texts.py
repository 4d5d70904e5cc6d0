"""Queries over entries against their SQL on texts that the test tables don't have: markup, other white space, blanks, nulls."""

import duckdb
import pytest

import __spark_entry__ as entry

TEXTS = [
    None, "", " ", "\n", "\u00a0 \u00a0", "kata", "kata a b c d", "<b>kata</b> a b c", "<p>", "<p> <q> <r> <s>", "<p>\n<q>", "<> a", "<kata a b", "kata <b> <i> c", "kata < b > c",
    "ka\u00a0ta a b c", "ka\u0085ta a b", "ka\x1cta a", "\u2003 a b c", "ka\x0bta a b c", "\x0bkata a b", "kata \n \t \r a", "kata \u3000 a", "kata  a  b", "kata   a", " kata a b", "kata\na b c",
    "kata \u200b a", "kata a\nb c d",
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder whose documents are the odd texts."""
    folder = tmp_path_factory.mktemp("odd")
    rows = [(i, t, "en", f"src{i % 5}", len(t or "")) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return folder


def by_sql(odd, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{odd}/documents.parquet/*.parquet'")
    return sorted(con.execute(sql).fetchall())


@pytest.mark.parametrize("name", ["q_embedding_doc"])
def test_query_equals_sql(spark, odd, name):
    assert sorted(map(tuple, entry.queries()[name](spark, str(odd)).collect())) == by_sql(odd, entry.oracle_sql()[name])
