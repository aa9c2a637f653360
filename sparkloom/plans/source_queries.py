"""Queries of scans and sinks: given tables are written to the shared folder and scanned again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import files as S
from ..sources.stage import fresh_path
from .inputs import table

QUERIES, ORACLES = {}, {}


def _folders(s, d):
    """Document texts below a root, in a folder of notes and one that reference scans pass over."""
    root = fresh_path(s)
    docs = table(s, d, "documents")
    docs.filter("lang = 'en'").select("text").write.text(f"{root}/notes")
    docs.filter("lang <> 'en'").select("text").write.text(f"{root}/cache")
    return root


def _by_folder(files):
    return files.groupBy(F.regexp_extract("path", "/([a-z]+)/[^/]*$", 1).alias("folder")).agg(F.sum("length").alias("bytes"))


QUERIES["S1_inventory"] = lambda s, d: _by_folder(S.inventory(s, _folders(s, d), ("txt",)))
ORACLES["S1_inventory"] = "SELECT CASE WHEN lang = 'en' THEN 'notes' ELSE 'cache' END AS folder, CAST(sum(strlen(text)) + count(*) AS BIGINT) AS bytes FROM documents GROUP BY 1"
QUERIES["S9_reference_files"] = lambda s, d: _by_folder(S.reference_files(S.inventory(s, _folders(s, d), ("txt",))))
ORACLES["S9_reference_files"] = "SELECT 'notes' AS folder, CAST(sum(strlen(text)) + count(*) AS BIGINT) AS bytes FROM documents WHERE lang = 'en'"
QUERIES["S7_source_documents"] = lambda s, d: _by_folder(S.source_documents(s, _folders(s, d), extension="txt").withColumn("length", F.octet_length("text")))
ORACLES["S7_source_documents"] = ORACLES["S9_reference_files"]


def _matrix(s, d):
    """Suppliers as ragged sheets, one for each nation, some rows with a quoted cell of two lines."""
    path = fresh_path(s)
    line = F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.when(F.col("s_suppkey") % 3 == 0, F.lit('"a, ""b""\nc"')))
    rows = table(s, d, "supplier").repartition("s_nationkey").sortWithinPartitions("s_nationkey", "s_suppkey")
    rows.select("s_nationkey", line.alias("value")).write.partitionBy("s_nationkey").text(path)
    return S.matrix_cells(s, f"{path}/*").select(F.regexp_extract("sheet", "s_nationkey=([0-9]+)", 1).alias("sheet"), "r", "c", "value")


QUERIES["S4_matrix_cells"] = _matrix
ORACLES["S4_matrix_cells"] = """WITH t AS (SELECT *, CAST(s_nationkey AS VARCHAR) AS sheet, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS r FROM supplier)
SELECT sheet, r, 1 AS c, CAST(s_suppkey AS VARCHAR) AS value FROM t UNION ALL SELECT sheet, r, 2, s_name FROM t UNION ALL SELECT sheet, r, 3, 'a, "b"' || chr(10) || 'c' FROM t WHERE s_suppkey % 3 = 0"""


def _listed(s, d):
    item = F.concat(F.lit('{"i'), "event_id", F.lit('": '))
    body = F.when(F.col("event_id") % 2 == 0, F.concat(item, F.lit('["b1", "'), "event_type", F.lit('"]}'))).otherwise(F.concat(item, F.lit('"'), "event_type", F.lit('"}')))
    return S.listed_blocks(table(s, d, "events").select(body.alias("body")), "body")


QUERIES["S6_listed_blocks"] = _listed
ORACLES["S6_listed_blocks"] = "SELECT 'i' || event_id AS item, event_type AS block FROM events UNION ALL SELECT 'i' || event_id, 'b1' FROM events WHERE event_id % 2 = 0"


def _partitions(s, d):
    path = fresh_path(s)
    S.write_partitions(table(s, d, "part"), path, F.when(F.col("p_size") < 25, "small").otherwise("large"), "p_brand")
    return s.read.parquet(path).groupBy("role", "p_brand").agg(F.count("*").alias("rows"), F.sum("p_size").alias("size"))


QUERIES["S11_write_partitions"] = _partitions
ORACLES["S11_write_partitions"] = "SELECT CASE WHEN p_size < 25 THEN 'small' ELSE 'large' END AS role, p_brand, count(*) AS rows, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY ALL"


def _report(s, d):
    path = fresh_path(s)
    S.write_report(table(s, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")), path)
    return s.read.schema("o_orderstatus string, o_orderpriority string, n long").json(path)


QUERIES["S12_report"] = _report
ORACLES["S12_report"] = "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL"
