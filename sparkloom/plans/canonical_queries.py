"""Queries of canonical rows and of the predicates and joins around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import item_id
from ..operators import canonical as C
from .grid_queries import SHEETS_SQL, sheets
from .inputs import LABELS_SQL, NUMBERS_SQL, labels_of_parts, number_texts, table
from .text_queries import ITEM_KEY_SQL, item_sql

QUERIES, ORACLES = {}, {}


def _values(s, d):
    # keys are work rather than bytes: the rows of a small file are dealt out to all tasks
    rows = labels_of_parts(s, d).repartition(int(s.conf.get("spark.sql.shuffle.partitions"))).select(F.col("label").alias("Figure"), F.lit("x").alias("X Label"), F.when(F.col("id") % 4 == 0, "").otherwise(F.concat(F.lit("1,"), F.lpad((F.col("id") % 900).cast("string"), 3, "0"))).alias("Value"), F.lit("f.csv").alias("src"), F.col("id").alias("row"))
    return C.value_rows(rows, "Value", "src", "row").select("expval_id", "figure_name", "x_label", "unit", "value", "value_text", "manual_required", "normalization_warning", "figure_key", "partition_key", "source_row", F.col("payload")["Value"].alias("in_payload"))


QUERIES["F3_value_rows"] = _values
ORACLES["F3_value_rows"] = f"""WITH {LABELS_SQL}, {ITEM_KEY_SQL}, v AS (SELECT *, CASE WHEN id % 4 = 0 THEN '' ELSE '1,' || lpad(CAST(id % 900 AS VARCHAR), 3, '0') END AS t FROM m)
SELECT 'EV' || lpad(CAST(v.id AS VARCHAR), CAST(greatest(8, length(CAST(v.id AS VARCHAR))) AS INTEGER), '0') AS expval_id, label AS figure_name, 'x' AS x_label, '' AS unit, TRY_CAST(replace(t, ',', '') AS DOUBLE) AS value, t AS value_text, t = '' AS manual_required, CASE WHEN t = '' THEN 'missing value' ELSE '' END AS normalization_warning,
  item_key AS figure_key, CASE WHEN item_key = '' THEN 'unknown_figure_table' ELSE item_key END AS partition_key, v.id AS source_row, t AS in_payload FROM v JOIN i ON i.id = v.id"""


def _targets(s, d):
    """The row's own key, else the mapped one."""
    rows = labels_of_parts(s, d).select(F.col("label").alias("Item_ID"), F.when(F.col("id") % 2 == 0, "3.5").otherwise("").alias("experimental_value"), F.lit("t.csv").alias("src"), F.col("id").alias("row"))
    return C.target_rows(rows, "experimental_value", "src", "row", F.when(F.col("row") % 3 == 0, "figure 77").otherwise("")).select("target_row_id", "item_id", "existing_value_text", F.col("figure_key").contains("77").alias("mapped"), (F.col("partition_key") == C.UNKNOWN).alias("unknown"))


QUERIES["F4_target_rows"] = _targets
ORACLES["F4_target_rows"] = f"""WITH {LABELS_SQL}, {ITEM_KEY_SQL} SELECT 'LN' || lpad(CAST(m.id AS VARCHAR), CAST(greatest(8, length(CAST(m.id AS VARCHAR))) AS INTEGER), '0') AS target_row_id, label AS item_id, CASE WHEN m.id % 2 = 0 THEN '3.5' ELSE '' END AS existing_value_text,
  item_key = '' AND m.id % 3 = 0 AS mapped, item_key = '' AND m.id % 3 <> 0 AS unknown FROM m JOIN i ON i.id = m.id"""


def _mapped(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("file"), F.col("o_orderpriority").alias("sheet"))
    keys = table(s, d, "orders").filter("o_orderkey % 100 = 1").select(F.col("o_orderstatus").alias("file"), F.col("o_orderpriority").alias("sheet"), F.when(F.col("o_orderstatus") == "P", "Unknown").otherwise(F.concat_ws(" ", F.lit("figure"), F.lower("o_orderstatus"))).alias("mapped_key"))
    return C.mapped_keys(o, keys, ["file", "sheet"]).groupBy("file", "mapped_key").agg(F.count("*").alias("n"))


QUERIES["J1_key_map"] = _mapped
ORACLES["J1_key_map"] = """WITH k AS (SELECT DISTINCT o_orderstatus AS f, o_orderpriority AS p, 'figure ' || lower(o_orderstatus) AS v FROM orders WHERE o_orderkey % 100 = 1 AND o_orderstatus <> 'P')
SELECT o_orderstatus AS file, coalesce(v, '') AS mapped_key, count(*) AS n FROM orders LEFT JOIN k ON f = o_orderstatus AND p = o_orderpriority GROUP BY ALL"""
QUERIES["F11_axis_cells"] = lambda s, d: C.numeric_to_skip(sheets(s, d))
ORACLES["F11_axis_cells"] = f"""WITH {SHEETS_SQL} SELECT sheet, r, c, value, NOT starts_with(value, 'w') AND c = min(c) OVER w AND count_if(NOT starts_with(value, 'w')) OVER w > 1 AS skip FROM cells WINDOW w AS (PARTITION BY sheet, r)"""


def _ignored(s, d):
    p = table(s, d, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, F.col("url")).when(F.col("page_id") % 3 == 1, F.left("html", F.lit(200))).otherwise(F.concat(F.lit("n/a"), F.lit(""))).alias("v"))
    return p.select("page_id", C.ignored_reference("note", F.col("v")).alias("ignored"), C.ignored_reference("page_id", F.col("v")).alias("id_ignored"))


QUERIES["F12_reference_values"] = _ignored
ORACLES["F12_reference_values"] = """SELECT page_id, page_id % 3 = 0 OR (page_id % 3 = 1 AND (length(trim(left(html, 200))) > 160 OR regexp_matches(lower(left(html, 200)), '\\\\|/users/|/home/|\\.xlsx|\\.csv|\\.png|\\.jpg|\\.pdf'))) AS ignored, false AS id_ignored FROM pages"""
QUERIES["F13_provenance_terms"] = lambda s, d: table(s, d, "part").select("p_partkey", C.says_any(["p_name", "p_type"], ["GEAR", "promo"]).alias("hit"))
ORACLES["F13_provenance_terms"] = "SELECT p_partkey, lower(p_name || ' ' || p_type) LIKE '%gear%' OR lower(p_name || ' ' || p_type) LIKE '%promo%' AS hit FROM part"
QUERIES["F15_export_projection"] = lambda s, d: C.export_rows(table(s, d, "part").drop("p_retailprice"), "p_partkey", ["p_brand"], ["p_type"])
ORACLES["F15_export_projection"] = "SELECT p_partkey, p_name, '' AS p_type, p_size FROM part"


def _assets(s, d):
    p = table(s, d, "part")
    rows = p.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_brand", "p_type").alias("item"), F.col("p_brand").alias("base"), (F.col("p_size") % 2 == 0).alias("supplementary"))
    panels = p.filter("p_size < 3").select(F.concat_ws(" ", "p_brand", "p_type").alias("item"), F.lit("panel.png").alias("asset")).distinct().unionByName(p.filter("p_brand < 'Brand#15'").select(F.col("p_brand").alias("item"), F.lit("base.png").alias("asset")).distinct())
    documents = table(s, d, "region").filter("r_regionkey = 0").select(F.lit(True).alias("supplementary"), F.lit("supp.pdf").alias("document"))
    return C.evidence_assets(rows, panels, documents)


QUERIES["J23_evidence_assets"] = _assets
ORACLES["J23_evidence_assets"] = """WITH a AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size < 3),
x AS (SELECT p_partkey AS id, CASE WHEN EXISTS (SELECT 1 FROM a WHERE a.p_brand = p.p_brand AND a.p_type = p.p_type) THEN 'panel' WHEN p_brand < 'Brand#15' THEN 'base' WHEN p_size % 2 = 0 THEN 'document' ELSE 'none' END AS status FROM part p)
SELECT id, CASE status WHEN 'panel' THEN 'panel.png' WHEN 'base' THEN 'base.png' WHEN 'document' THEN 'supp.pdf' ELSE '' END AS asset, status FROM x"""


def _allowed(s, d):
    rows = labels_of_parts(s, d)
    allowed = rows.filter("id % 20 = 0").select(item_id(F.col("label")).alias("item")).distinct()
    return C.mentioned_items(rows, "label", allowed).select("id", "item")


QUERIES["J27_allowed_items"] = _allowed
ORACLES["J27_allowed_items"] = f"""WITH {LABELS_SQL}, w AS (SELECT DISTINCT {item_sql('label')} AS item FROM m WHERE id % 20 = 0),
u AS (SELECT id, unnest(list_concat(regexp_extract_all(label, '(?i)(figure\\s+\\d+[a-z]?)', 1), regexp_extract_all(label, '(?i)(fig\\.?\\s*\\d+[a-z]?)', 1))) AS s FROM m)
SELECT DISTINCT id, {item_sql('s')} AS item FROM u WHERE {item_sql('s')} IN (SELECT item FROM w)"""
QUERIES["A7_extraction_verdicts"] = lambda s, d: C.verdicts(number_texts(s, d).withColumn("block", F.col("id") % 7 * 100 + F.col("id") % 3).withColumn("label", F.when(F.col("id") % 3 == 0, " ").otherwise("x")), "block", "value", "label")
ORACLES["A7_extraction_verdicts"] = f"""WITH {NUMBERS_SQL}, p AS (SELECT id % 7 * 100 + id % 3 AS block, TRY_CAST(replace(value, ',', '') AS DOUBLE) IS NOT NULL AS n, id % 3 <> 0 AS l FROM v)
SELECT block, count(*) AS "rows", count_if(n) AS numbers, count_if(l) AS labels, CASE WHEN count_if(n) = 0 AND count_if(l) = 0 THEN 'empty' WHEN count_if(n) = 0 THEN 'no_numbers' WHEN count_if(l) = 0 THEN 'no_labels' ELSE 'ok' END AS verdict FROM p GROUP BY block"""
QUERIES["A4_block_items"] = lambda s, d: C.block_items([table(s, d, "part").select("p_brand", F.concat_ws("; ", "p_type", F.split("p_name", " ")[0]).alias("x")), table(s, d, "part").filter("p_size < 5").select("p_brand", F.concat(F.lit(",small|"), F.col("p_type")).alias("x"))], "p_brand", "x")
ORACLES["A4_block_items"] = "SELECT p_brand, string_agg(DISTINCT x, '|' ORDER BY x) AS items FROM (SELECT p_brand, unnest([p_type, split_part(p_name, ' ', 1)]) AS x FROM part UNION ALL SELECT p_brand, 'small' FROM part WHERE p_size < 5) GROUP BY 1"


def _sheet_keys(s, d):
    rows = table(s, d, "part").select("p_brand", F.when(F.col("p_size") % 4 == 0, "").otherwise(F.concat(F.lit("Fig. "), (F.col("p_size") % 4).cast("string"), F.lit(" of it"))).alias("t"))
    return C.sheet_keys(rows, ["p_brand"], "t")


QUERIES["P10_sheet_keys"] = _sheet_keys
ORACLES["P10_sheet_keys"] = """WITH k AS (SELECT p_brand, p_size % 4 AS k, count(*) AS n FROM part WHERE p_size % 4 <> 0 GROUP BY ALL), b AS (SELECT p_brand, k, n, sum(n) OVER (PARTITION BY p_brand) AS t, count(*) OVER (PARTITION BY p_brand) AS c FROM k QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, k) = 1)
SELECT p.p_brand, coalesce('figure ' || k, '') AS figure_key, CASE WHEN c IS NULL THEN 'low' WHEN c = 1 THEN 'high' WHEN 2 * n > t THEN 'medium' ELSE 'low' END AS confidence, c IS NULL OR (c > 1 AND 2 * n <= t) AS needs_review FROM (SELECT DISTINCT p_brand FROM part) p LEFT JOIN b ON b.p_brand = p.p_brand"""
QUERIES["P11_example_values"] = lambda s, d: C.example_values(table(s, d, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 2 == 0, "N/A").otherwise(F.col("p_type")).alias("kind")), ["p_name", "kind"], "p_partkey")
ORACLES["P11_example_values"] = """WITH c AS (SELECT 'p_name' AS col, p_name AS v, min(p_partkey) AS pos FROM part GROUP BY 2 UNION ALL SELECT 'kind', p_type, min(p_partkey) FROM part WHERE p_size % 2 <> 0 GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY pos, v) AS n FROM c) SELECT col AS "column", string_agg(v, '|' ORDER BY n) AS "values" FROM r WHERE n <= 30 GROUP BY col"""


def _asset_items(s, d):
    rows = table(s, d, "part").select(F.col("p_type").alias("asset"), F.concat(F.lit("figure "), (F.col("p_size") % 6).cast("string"), F.when(F.col("p_size") % 2 == 0, "b").otherwise("")).alias("item"))
    chosen = rows.filter("item > 'figure 2'").select("item").distinct()
    return C.asset_items(rows, chosen, "asset", "item")


QUERIES["J31_asset_items"] = _asset_items
ORACLES["J31_asset_items"] = """WITH r AS (SELECT DISTINCT p_type AS asset, 'figure ' || (p_size % 6) || CASE WHEN p_size % 2 = 0 THEN 'b' ELSE '' END AS item FROM part)
SELECT asset, string_agg(item, '|' ORDER BY item) AS items, string_agg(regexp_extract(item, '[0-9]([a-z])$', 1), '' ORDER BY item) AS panels, count(*) = 1 AS single FROM r WHERE item > 'figure 2' GROUP BY asset"""
QUERIES["A12_stage_completeness"] = lambda s, d: C.completeness(table(s, d, "orders"), ["o_orderkey", "o_note", "o_clerk"], {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT"]}, table(s, d, "lineitem").select((F.col("l_orderkey") + 5).alias("o_orderkey")), "o_orderkey")
ORACLES["A12_stage_completeness"] = """SELECT count(*) AS "rows", count_if(o_orderstatus NOT IN ('F', 'O')) AS bad_o_orderstatus, count_if(o_orderpriority <> '1-URGENT') AS bad_o_orderpriority,
  (SELECT count(DISTINCT l_orderkey + 5) FROM lineitem WHERE l_orderkey + 5 NOT IN (SELECT o_orderkey FROM orders)) AS lost, 'o_note,o_clerk' AS missing_columns FROM orders"""
