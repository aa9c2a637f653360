"""J28 on ties, repeated ids and components that are no numbers, against its SQL."""

from sparkloom import queries as library
from sparkloom.operators import resolve as R

from .helpers import connection, of_spark, of_sql


def test_roots_that_are_equal_go_to_the_smaller_value(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "id long, L double, a double, b double")
    bar = spark.createDataFrame([(2, 1.0, 0.0, 0.0), (1, 1.0, 2.0**-26, 0.0)], "value long, L double, a double, b double")
    assert [tuple(r) for r in R.nearest_colour(rows, bar, "id").collect()] == [(1, 1, 1.0)]


def test_odd_vectors_equal_the_sql(spark, tmp_path):
    con = connection()
    con.sql(f"COPY region TO '{tmp_path}/region.parquet' (FORMAT parquet)")
    con.sql(f"""COPY (SELECT * FROM (VALUES (1, [0.1, 0.2, 0.3]::FLOAT[]), (1, [0.05, 0.01, 0.2]::FLOAT[]), (2, NULL), (3, [0.1, NULL, 0.3]::FLOAT[]), (3, [0.2, 0.1, 0.3]::FLOAT[]),
      (4, ['NaN'::FLOAT, 0.1::FLOAT, 0.2::FLOAT]), (5, [0.1]::FLOAT[]), (6, ['inf'::FLOAT, 0.1::FLOAT, 0.2::FLOAT])) AS v(vec_id, embedding)) TO '{tmp_path}/embeddings.parquet' (FORMAT parquet)""")
    con = connection()
    con.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet')")
    name = "J28_nearest_colour"
    assert of_spark(library.QUERIES[name](spark, str(tmp_path))) == of_sql(con, library.ORACLES[name])
