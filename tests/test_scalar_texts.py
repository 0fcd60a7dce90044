"""Scalar queries over texts without any word."""

import duckdb

import __spark_entry__ as entry


def test_scalar_array_of_texts_without_letters(spark, tmp_path):
    rows = [(1, ""), (2, "123 45 -- 6"), (3, "the long-winded end"), (4, "Über the the")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    df = entry.queries()["scalar_array"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute("create view documents as select *, 'en' as lang, 'feed1' as source, length(text) as n_chars "
                f"from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    rel = con.sql(entry.oracle_sql()["scalar_array"])
    order = [rel.columns.index(c) for c in df.columns]
    got = {r.id: tuple(r) for r in df.collect()}
    assert got == {r[0]: tuple(r[i] for i in order) for r in rel.fetchall()}
    assert got[1] == (1, 0, False, 0, None, 0, 0, 0, 1)
    assert got[2][4] is None and got[3][4] == "end"
