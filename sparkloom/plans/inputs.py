"""Inputs that queries derive from the given tables, and the SQL that derives the same for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labels_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, label: identifiers as people write them, one for each part."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 10
    label = (
        F.when(kind == 0, F.concat(F.lit("Fig. "), size, F.lit("b")))
        .when(kind == 1, F.concat(F.lit("Supplementary Figure S"), size))
        .when(kind == 2, F.concat(F.lit("Table_"), size, F.lit("-"), F.col("p_brand")))
        .when(kind == 3, F.concat(F.lit("suppl fig "), size, F.lit("c; "), F.col("p_name")))
        .when(kind == 4, F.concat(F.lit("FIGURE  "), size, F.lit(" ("), F.col("p_type"), F.lit(")")))
        .when(kind == 5, F.concat(F.lit("S"), size, F.lit("a "), F.col("p_type")))
        .when(kind == 6, F.concat(F.lit("tbl S"), size))
        .when(kind == 7, F.concat(F.lit("Extended Data Fig. "), size, F.lit("d and Fig. 2a, table 3")))
        .when(kind == 8, F.concat(F.lit(" supp. table "), size, F.lit("., ")))
        .otherwise(F.col("p_name"))
    )
    return p.select(F.col("p_partkey").alias("id"), label.alias("label"))


LABELS_SQL = """m AS (
  SELECT p_partkey AS id, CASE p_partkey % 10
    WHEN 0 THEN 'Fig. ' || p_size || 'b' WHEN 1 THEN 'Supplementary Figure S' || p_size
    WHEN 2 THEN 'Table_' || p_size || '-' || p_brand WHEN 3 THEN 'suppl fig ' || p_size || 'c; ' || p_name
    WHEN 4 THEN 'FIGURE  ' || p_size || ' (' || p_type || ')' WHEN 5 THEN 'S' || p_size || 'a ' || p_type
    WHEN 6 THEN 'tbl S' || p_size WHEN 7 THEN 'Extended Data Fig. ' || p_size || 'd and Fig. 2a, table 3'
    WHEN 8 THEN ' supp. table ' || p_size || '., ' ELSE p_name END AS label
  FROM part)"""


def lines_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no from 1, line: every line of every document, blank ones too."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).select("doc_id", (F.col("at") + 1).alias("line_no"), "line")


LINES_SQL = """l AS (
  SELECT doc_id, CAST(unnest(range(1, len(p) + 1)) AS INTEGER) AS line_no, unnest(p) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))"""


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, value: prices as text in several spellings."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return o.select(
        k.alias("id"),
        F.when(k % 7 == 0, price).when(k % 7 == 1, F.concat(F.lit("1,"), F.lpad((k % 1000).cast("string"), 3, "0"))).when(k % 7 == 2, F.concat((k % 100).cast("string"), F.lit("%")))
        .when(k % 7 == 3, F.concat(F.lit("-"), (k % 50).cast("string"), F.lit("e2"))).when(k % 7 == 4, F.lit("n/a")).when(k % 7 == 5, F.concat((k % 9).cast("string"), F.lit(" / 4")))
        .otherwise(F.col("o_orderpriority")).alias("value"),
    )


NUMBERS_SQL = """v AS (
  SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
    WHEN 1 THEN '1,' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') WHEN 2 THEN (o_orderkey % 100) || '%'
    WHEN 3 THEN '-' || (o_orderkey % 50) || 'e2' WHEN 4 THEN 'n/a' WHEN 5 THEN (o_orderkey % 9) || ' / 4'
    ELSE o_orderpriority END AS value
  FROM orders)"""
