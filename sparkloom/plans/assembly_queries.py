"""Queries of the unified table, its evidence, review contexts, table spans, and blocks of several members."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import head_middle_tail, search_terms, table_line
from ..functions.values import group_labels
from ..operators import assembly as A
from ..operators import grid as G
from ..operators.tables import column_profile
from .grid_queries import BANDS_SQL, SHEETS_SQL, sheets
from .inputs import table

QUERIES, ORACLES = {}, {}


def _assembled(s, d):
    """Parts are items; large returned order lines match them to the blocks of suppliers, a quarter of which cannot be read."""
    p = table(s, d, "part").select(F.col("p_partkey").alias("item_id"), F.concat_ws(" of ", "p_type", "p_name").alias("caption"), F.when(F.col("p_size") % 2 == 0, "scan.png").otherwise("").alias("image"))
    l = table(s, d, "lineitem").filter("l_returnflag = 'R' and l_quantity >= 49")
    matches = l.select(F.col("l_partkey").alias("item_id"), F.concat(F.lit("b"), "l_suppkey").alias("block"), (F.col("l_suppkey") % 4 != 0).alias("readable"), F.array(F.concat(F.lit("s"), "l_suppkey"), F.lit("x")).alias("context")).distinct()
    return A.unified_rows(p, matches, group_labels(F.col("caption"), [(1, "PROMO|LARGE"), (2, "bolt|gear")]))


_ASSEMBLY_SQL = """i AS (SELECT p_partkey AS item_id, p_type || ' of ' || p_name AS caption, p_size % 2 = 0 AS image, list_distinct(list_concat(regexp_extract_all(p_type || ' of ' || p_name, 'PROMO|LARGE'), regexp_extract_all(p_type || ' of ' || p_name, 'bolt|gear'))) AS labels FROM part),
m AS (SELECT DISTINCT l_partkey AS item_id, l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49), good AS (SELECT * FROM i JOIN m USING (item_id) WHERE k % 4 <> 0),
bare AS (SELECT * FROM i WHERE item_id NOT IN (SELECT item_id FROM good))"""
QUERIES["J26_unified_rows"] = lambda s, d: _assembled(s, d)[0]
ORACLES["J26_unified_rows"] = f"""WITH {_ASSEMBLY_SQL} SELECT item_id, 'excel_block_context' AS source_type, 'b' || k AS block, 's' || k || '; x' AS context, '' AS label, 'low' AS confidence, true AS manual_required, caption AS evidence_text FROM good
UNION ALL SELECT item_id, CASE WHEN image THEN 'image_caption_fallback' ELSE 'caption_fallback' END, '', '', unnest(labels), 'medium', true, caption FROM bare WHERE len(labels) > 0
UNION ALL SELECT item_id, 'manual_review_placeholder', '', '', '', 'low', true, caption FROM bare WHERE len(labels) = 0"""
QUERIES["J26_review_flags"] = lambda s, d: _assembled(s, d)[1]
ORACLES["J26_review_flags"] = f"""WITH {_ASSEMBLY_SQL} SELECT item_id, 'b' || k AS block, 'block' AS field, 'missing block' AS issue, 'high' AS severity FROM i JOIN m USING (item_id) WHERE k % 4 = 0
UNION ALL SELECT item_id, '', 'label', 'fallback rows to review', 'medium' FROM bare WHERE len(labels) > 0 UNION ALL SELECT item_id, '', 'row', 'placeholder only', 'high' FROM bare WHERE len(labels) = 0"""


def _evidence(s, d):
    """Orders as unified rows of their customers' items: a third has a block, the others a text or nothing."""
    k, blank = F.col("o_orderkey"), F.lit("")
    rows = table(s, d, "orders").select(
        k.alias("row_id"), F.col("o_custkey").alias("item_id"), F.when(k % 4 == 0, F.concat(F.lit("F"), k % 3)).otherwise(blank).alias("entity"),
        F.when(F.col("o_orderstatus") == "P", A.PLACEHOLDER).when(k % 5 == 0, A.CAPTION).otherwise(blank).alias("source_type"), F.when(k % 3 == 0, F.concat(F.lit("b"), F.col("o_custkey") % 10)).otherwise(blank).alias("block"),
        blank.alias("image"), F.when(k % 2 == 0, "a.pdf").otherwise(blank).alias("pdf"), blank.alias("page"), F.when(k % 7 == 0, blank).otherwise(F.concat(F.lit("Mouse model of "), "o_orderpriority")).alias("evidence_text"),
        F.lit("no phrase").alias("reason"), F.when(k % 2 == 0, "low").otherwise("high").alias("confidence"), (k % 5 == 0).alias("manual_required"),
        F.when(k % 11 == 0, blank).otherwise(F.lit("m")).alias("model"), F.when(k % 6 == 1, blank).otherwise(F.col("o_orderpriority")).alias("method"), F.when(k % 3 == 0, "1").otherwise(blank).alias("value"),
    )
    return A.evidence_tables(rows, ["method", "value"], ["model", "method", "value"], ["value"], ["method"], [(("model",), ("mouse", "cell")), (("method",), ("high", "low"))], "E")


_EVIDENCE_SQL = """r AS (SELECT o_orderkey AS k, o_custkey AS item_id, CASE WHEN o_orderkey % 4 = 0 THEN 'F' || o_orderkey % 3 ELSE '' END AS entity, CASE WHEN o_orderkey % 3 = 0 THEN 'b' || o_custkey % 10 ELSE '' END AS block,
  CASE WHEN o_orderstatus = 'P' THEN 'manual_review_placeholder' WHEN o_orderkey % 5 = 0 THEN 'caption_fallback' ELSE '' END AS st, CASE WHEN o_orderkey % 2 = 0 THEN 'a.pdf' ELSE '' END AS pdf,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'Mouse model of ' || o_orderpriority END AS txt, CASE WHEN o_orderkey % 2 = 0 THEN 'low' ELSE 'high' END AS confidence, o_orderkey % 5 = 0 AS manual,
  list_filter([CASE WHEN o_orderkey % 11 <> 0 THEN 'model' END, CASE WHEN o_orderkey % 6 <> 1 THEN 'method' END, CASE WHEN o_orderkey % 3 = 0 THEN 'value' END], lambda x: x IS NOT NULL) AS filled FROM orders),
e AS (SELECT *, unnest(CASE WHEN len(list_filter(filled, lambda x: x <> 'model')) > 0 THEN list_filter(filled, lambda x: x <> 'model') ELSE filled[1:1] END) AS seed FROM r WHERE len(filled) > 0),
t AS (SELECT *, CASE WHEN st <> '' THEN st WHEN block <> '' AND seed = 'value' THEN 'excel_block_value' WHEN block <> '' AND seed = 'method' THEN 'excel_block' WHEN pdf <> '' THEN 'pdf_caption' WHEN txt <> '' THEN 'markdown' ELSE 'inferred_from_context' END AS kind FROM e),
u AS (SELECT *, CASE WHEN starts_with(kind, 'excel') THEN block ELSE txt END AS phrase FROM t),
v AS (SELECT *, CASE WHEN phrase <> '' THEN kind WHEN manual THEN 'manual_review_placeholder' ELSE 'inferred_from_context' END AS evidence_type, CASE WHEN phrase = '' THEN 'no phrase' ELSE phrase END AS body FROM u),
w AS (SELECT *, list_filter(filled, lambda x: (x = 'model' AND contains(lower(body), 'mouse')) OR (x = 'method' AND (contains(lower(body), 'high') OR contains(lower(body), 'low') OR evidence_type = 'excel_block'))) AS named FROM v),
x AS (SELECT *, CASE WHEN evidence_type = 'manual_review_placeholder' THEN filled WHEN evidence_type = 'excel_block_value' THEN ['value'] WHEN len(named) > 0 THEN named ELSE filled END AS cols FROM w),
p AS (SELECT item_id, body, evidence_type, pdf, block, min(k * 10 + CASE seed WHEN 'method' THEN 1 WHEN 'value' THEN 2 ELSE 3 END) AS first FROM x GROUP BY ALL),
ev AS (SELECT *, CAST(row_number() OVER (ORDER BY first) AS VARCHAR) AS n FROM p),
ed AS (SELECT *, 'E' || lpad(n, CAST(greatest(6, length(n)) AS INTEGER), '0') AS evidence_id FROM ev)"""
QUERIES["A8_evidence"] = lambda s, d: _evidence(s, d)[0].select("evidence_id", "item_id", "evidence_text_exact", "evidence_type", "pdf", "block")
ORACLES["A8_evidence"] = f"WITH {_EVIDENCE_SQL} SELECT evidence_id, item_id, body AS evidence_text_exact, evidence_type, pdf, block FROM ed"
QUERIES["A8_evidence_map"] = lambda s, d: _evidence(s, d)[1]
ORACLES["A8_evidence_map"] = f"""WITH {_EVIDENCE_SQL}, g AS (SELECT x.item_id, evidence_id, array_to_string(cols, '|') AS supported_columns, list_sort(list_distinct(list(k))) AS ks, list_sort(list_distinct(list_filter(list(entity), lambda y: y <> ''))) AS es,
  any_value(x.evidence_type) AS evidence_type, bool_or(manual) AS manual_required, CASE WHEN bool_or(confidence = 'low') THEN 'low' ELSE 'high' END AS confidence
  FROM x JOIN ed ON ed.item_id = x.item_id AND ed.body = x.body AND ed.evidence_type = x.evidence_type AND ed.pdf = x.pdf AND ed.block = x.block GROUP BY ALL),
c AS (SELECT o_custkey AS item_id, count(*) AS n FROM orders GROUP BY 1)
SELECT item_id, evidence_id, supported_columns, array_to_string(ks, '|') AS supported_rows, array_to_string(es, '|') AS supported_entities, CASE WHEN evidence_type = 'manual_review_placeholder' THEN evidence_type WHEN len(es) > 0 THEN 'formulation_level'
  WHEN len(ks) >= n THEN 'item_level_all_rows' WHEN len(ks) > 1 THEN 'item_level_subset_rows' ELSE 'column_context' END AS support_scope, confidence, manual_required FROM g JOIN c USING (item_id)"""


def _integrity(s, d):
    """A third of the evidence is lost, and the rows of late orders are twice there."""
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderstatus")
    evidence, links = _evidence(s, d)
    return A.integrity(o.unionByName(o.filter("o_orderstatus = 'F'")), evidence.filter("item_id % 3 <> 0"), links, ["model", "method"])


QUERIES["A11_evidence_integrity"] = _integrity
ORACLES["A11_evidence_integrity"] = f"""WITH {_EVIDENCE_SQL}, l AS (SELECT DISTINCT ed.item_id, evidence_id, array_to_string(cols, '|') AS cs FROM x JOIN ed ON ed.item_id = x.item_id AND ed.body = x.body AND ed.evidence_type = x.evidence_type AND ed.pdf = x.pdf AND ed.block = x.block),
one AS (SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS repeated_rows, CAST(0 AS BIGINT) AS repeated_evidence, CAST(0 AS BIGINT) AS repeated_links, (SELECT count(*) FROM l WHERE item_id % 3 = 0) AS links_without_evidence, CAST(0 AS BIGINT) AS evidence_without_link, CAST(0 AS BIGINT) AS links_to_no_row,
  (SELECT count(*) + count_if(o_orderstatus = 'F') FROM orders WHERE o_orderkey NOT IN (SELECT k FROM x)) AS rows_without_evidence, (SELECT count(*) FROM l WHERE contains(cs, 'value')) AS unknown_columns)
UNPIVOT one ON COLUMNS(*) INTO NAME "check" VALUE n"""


def _violations(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("priority"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")).alias("source"), F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("value"))
    return A.row_violations(o, ["source"], ["value"], {"o_orderstatus": ["F", "O"]}, ["priority"], ["priority", "o_orderstatus"], "o_custkey", words=1)


QUERIES["A10_row_rules"] = _violations
ORACLES["A10_row_rules"] = """WITH one AS (SELECT count_if(o_orderstatus = 'P') AS no_provenance, count_if(o_orderkey % 5 = 0) AS not_numeric_value, count_if(o_orderstatus = 'P') AS not_allowed_o_orderstatus, count_if(contains(o_orderpriority, ' ')) AS prose_priority,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderpriority, o_orderstatus FROM orders)) AS collapsed_contexts FROM orders) UNPIVOT one ON COLUMNS(*) INTO NAME "rule" VALUE n"""


def _contexts(s, d):
    keys = table(s, d, "part").select(F.lower("p_brand").alias("partition_key")).distinct()
    docs = table(s, d, "documents").select(F.col("doc_id").alias("place"), F.concat(F.lit("d"), "doc_id").alias("path"), "text")
    out = A.partition_context(keys, docs, search_terms(F.col("partition_key")), head_middle_tail(F.col("text"), 300))
    return out.select("partition_key", "path", "original_chars", "included_chars", "mode")


QUERIES["P13_partition_context"] = _contexts
ORACLES["P13_partition_context"] = """WITH x AS (SELECT 'd' || doc_id AS path, CAST(length(text) AS INTEGER) AS n FROM documents WHERE trim(coalesce(text, '')) <> '' ORDER BY doc_id LIMIT 6)
SELECT DISTINCT lower(p_brand) AS partition_key, path, n AS original_chars, CAST(CASE WHEN n <= 300 THEN n ELSE 310 END AS INTEGER) AS included_chars, CASE WHEN n <= 310 THEN 'full' ELSE 'compacted' END AS mode FROM part, x"""
QUERIES["P12_reference_availability"] = lambda s, d: A.reference_availability(column_profile(table(s, d, "part"), ["p_partkey"]), table(s, d, "documents"), table(s, d, "pages").select(F.col("html").alias("text")))
ORACLES["P12_reference_availability"] = """SELECT true AS has_any_reference, CAST(4 + count(p_retailprice) // greatest(count(p_retailprice), 1) AS BIGINT) AS columns_with_examples, (SELECT count_if(trim(coalesce(text, '')) <> '') FROM documents) AS notes,
  (SELECT count_if(trim(coalesce(html, '')) <> '') FROM pages) AS guide_blocks, '' AS warnings FROM part"""


def _spans(s, d):
    """Each order as a document: a caption, the rows of a table, a remark, and the caption of another table."""
    l = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("x"))
    key = F.col("l_orderkey").cast("string")
    lines = F.concat(F.array(F.concat(F.lit("Table "), key, F.lit(". Lines")), F.lit("")), F.transform("x", lambda y: F.concat(F.lit("| "), y["l_partkey"], F.lit(" | "), y["l_suppkey"], F.lit(" |"))), F.array(F.lit(""), F.lit("A remark."), F.lit("Table 0. Other")))
    docs = l.select(F.col("l_orderkey").alias("doc_id"), F.posexplode(lines).alias("line_no", "line"))
    hits = l.select(F.concat(F.lit("table "), key).alias("item"), F.col("l_orderkey").alias("doc_id"), F.lit(0).alias("line_no"))
    return A.table_spans(docs, hits, table_line(F.col("line")), F.col("line").rlike("^(#|(Table|Figure) [0-9])"))


QUERIES["R9_table_spans"] = _spans
ORACLES["R9_table_spans"] = """WITH t AS (SELECT l_orderkey AS k, count(*) AS n, string_agg('| ' || l_partkey || ' | ' || l_suppkey || ' |', chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey) AS body FROM lineitem GROUP BY 1)
SELECT 'table ' || k AS item, k AS doc_id, n >= 2 AS is_table, 'Table ' || k || '. Lines' || chr(10) || chr(10) || body || CASE WHEN n < 2 THEN chr(10) || chr(10) || 'A remark.' || chr(10) || 'Table 0. Other' ELSE '' END AS snippet FROM t"""
QUERIES["R10_entity_labels"] = lambda s, d: G.entity_labels(sheets(s, d), "w[A-R]")
ORACLES["R10_entity_labels"] = f"""WITH {SHEETS_SQL}, f AS (SELECT sheet, value AS label, min(r * 1000 + c) AS p FROM cells WHERE regexp_matches(value, 'w[A-R]') GROUP BY ALL)
SELECT sheet, label, CAST(row_number() OVER (PARTITION BY sheet ORDER BY p) AS INTEGER) AS n FROM f"""
QUERIES["R10_crossed_labels"] = lambda s, d: G.crossed_labels(sheets(s, d), "^w")
ORACLES["R10_crossed_labels"] = f"""WITH {SHEETS_SQL}, cr AS (SELECT *, min(r) OVER (PARTITION BY sheet) AS top, first_value(value) OVER w AS name, first_value(c) OVER w AS c0 FROM cells WINDOW w AS (PARTITION BY sheet, r ORDER BY c))
SELECT DISTINCT cr.sheet, cr.name || '-' || h.value AS label FROM cr JOIN cells h ON h.sheet = cr.sheet AND h.c = cr.c AND h.r = cr.top WHERE cr.r > top AND cr.c > c0 AND starts_with(h.value, 'w')"""


def _members(s, d):
    """A sheet's blocks in groups of every third band."""
    cells = sheets(s, d)
    b, words = G.bands(cells), F.col("cells") - F.col("numbers")
    kind = G.block_kind(F.col("r2") - F.col("r1") + 1, F.col("c2") - F.col("c1") + 1, F.col("numbers"), words, words)
    element = F.concat(F.lit("e"), "r1", F.lit("_"), "c1")
    return cells, b.select("sheet", (F.col("r1") % 3).alias("grp"), element.alias("element"), kind.alias("kind"), "r1", "r2", "c1", "c2", F.when(kind == "note", element).otherwise("").alias("title"))


_MEMBERS_SQL = BANDS_SQL + """, bb AS (SELECT sheet, r1, r2, c1, c2, count_if(NOT starts_with(value, 'w')) AS n, count_if(starts_with(value, 'w')) AS t FROM cb JOIN cx USING (sheet, r1, c) GROUP BY ALL),
me AS (SELECT sheet, r1 % 3 AS grp, 'e' || r1 || '_' || c1 AS element, CASE WHEN r2 - r1 < 2 AND n = 0 THEN CASE WHEN t <= 6 THEN 'table_title' ELSE 'note' END WHEN r2 - r1 >= 11 AND c2 - c1 >= 7 AND n >= 10 THEN 'multi_table' WHEN n >= 3 AND t > 0 THEN 'title_and_table'
  WHEN n >= greatest(3, t) AND r2 > r1 THEN 'table_body' WHEN r2 - r1 <= 2 AND t > n THEN 'note' ELSE 'other' END AS kind, r1, r2, c1, c2 FROM bb),
nx AS (SELECT *, lead(struct_pack(element, kind, r1, r2, c1, c2)) OVER (PARTITION BY sheet, grp ORDER BY r1, c1, element) AS b FROM me),
sc AS (SELECT *, greatest(0, least(c2, b.c2) - greatest(c1, b.c1) + 1) AS co, greatest(0, least(r2, b.r2) - greatest(r1, b.r1) + 1) AS ro, greatest(0, greatest(r1, b.r1) - least(r2, b.r2) - 1) AS vg, greatest(0, greatest(c1, b.c1) - least(c2, b.c2) - 1) AS hg,
  list_contains([kind, b.kind], 'table_title') AND (list_contains([kind, b.kind], 'table_body') OR list_contains([kind, b.kind], 'title_and_table')) AS titled FROM nx WHERE b IS NOT NULL),
so AS (SELECT sheet, grp, element, b.element AS next_element, CASE WHEN co > 0 THEN 2.0::DOUBLE + least(1.5::DOUBLE, co::DOUBLE / (least(c2 - c1, b.c2 - b.c1) + 1)) ELSE 0.0::DOUBLE END + greatest(0.0::DOUBLE, 1.5::DOUBLE - least(vg, 6) * 0.25::DOUBLE) + CASE WHEN titled THEN 3.0::DOUBLE ELSE 0.0::DOUBLE END AS v,
  CASE WHEN ro > 0 THEN 2.0::DOUBLE + least(1.5::DOUBLE, ro::DOUBLE / (least(r2 - r1, b.r2 - b.r1) + 1)) ELSE 0.0::DOUBLE END + greatest(0.0::DOUBLE, 1.5::DOUBLE - least(hg, 6) * 0.25::DOUBLE) - CASE WHEN titled THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS h FROM sc),
orl AS (SELECT *, CASE WHEN v - h >= 1 THEN 'vertical' WHEN v - h <= -1 THEN 'horizontal' ELSE 'ambiguous' END AS o, CASE WHEN abs(v - h) >= 2 THEN 'high' WHEN abs(v - h) >= 1 THEN 'medium' ELSE 'low' END AS conf FROM so),
vo AS (SELECT sheet, grp, count_if(o = 'vertical') AS v, count_if(o = 'horizontal') AS h, count_if(o = 'vertical' AND conf = 'high') AS sv, count_if(o = 'horizontal' AND conf = 'high') AS sh, count(*) AS n FROM orl GROUP BY ALL),
ax AS (SELECT DISTINCT me.sheet, me.grp, CASE WHEN sv > sh OR (v > h AND sv >= 1) THEN 'vertical' WHEN sh > sv OR (h > v AND sh >= 1) THEN 'horizontal' WHEN v > h AND v >= greatest(2, n) THEN 'vertical' WHEN h > v AND h >= greatest(2, n) THEN 'horizontal' ELSE 'none' END AS axis,
  CASE WHEN sv > sh OR (v > h AND sv >= 1) OR sh > sv OR (h > v AND sh >= 1) THEN 'high' WHEN (v > h AND v >= greatest(2, n)) OR (h > v AND h >= greatest(2, n)) THEN 'medium' ELSE 'low' END AS confidence FROM me LEFT JOIN vo ON vo.sheet = me.sheet AND vo.grp = me.grp)"""
QUERIES["G8_member_relations"] = lambda s, d: G.member_relations(_members(s, d)[1]).select("sheet", "grp", "element", "next_element", "orientation", "confidence")
ORACLES["G8_member_relations"] = f"WITH {_MEMBERS_SQL} SELECT sheet, grp, element, next_element, o AS orientation, conf AS confidence FROM orl"
QUERIES["G8_group_axis"] = lambda s, d: G.group_axis(_members(s, d)[1])
ORACLES["G8_group_axis"] = f"WITH {_MEMBERS_SQL} SELECT * FROM ax"


def _composed(s, d):
    cells, members = _members(s, d)
    return G.composed(cells, members, G.group_axis(members))


QUERIES["G9_composed_groups"] = _composed
ORACLES["G9_composed_groups"] = f"""WITH {_MEMBERS_SQL}, po AS (SELECT me.*, axis, min(r1) OVER g AS r0, min(c1) OVER g AS c0, coalesce(sum(r2 - r1 + 2) OVER (PARTITION BY me.sheet, me.grp ORDER BY r1, c1, element ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS down,
  coalesce(sum(c2 - c1 + 2) OVER (PARTITION BY me.sheet, me.grp ORDER BY c1, r1, element ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS side FROM me JOIN ax ON ax.sheet = me.sheet AND ax.grp = me.grp WINDOW g AS (PARTITION BY me.sheet, me.grp))
SELECT DISTINCT po.sheet, po.grp, CAST(CASE axis WHEN 'vertical' THEN cells.r - r1 + down WHEN 'horizontal' THEN cells.r - r1 ELSE cells.r - r0 END AS BIGINT) AS r, CAST(CASE axis WHEN 'vertical' THEN cells.c - c1 WHEN 'horizontal' THEN cells.c - c1 + side ELSE cells.c - c0 END AS BIGINT) AS c, value
FROM po JOIN cells ON cells.sheet = po.sheet AND cells.r BETWEEN r1 AND r2 AND cells.c BETWEEN c1 AND c2"""


def _final(s, d):
    _, members = _members(s, d)
    return G.final_blocks(members, G.group_axis(members))


QUERIES["G10_final_blocks"] = _final
ORACLES["G10_final_blocks"] = f"""WITH {_MEMBERS_SQL}, gr AS (SELECT sheet, grp, min(r1) AS r1, max(r2) AS r2, min(c1) AS c1, max(c2) AS c2, list(DISTINCT kind) AS ks, string_agg(element, '|' ORDER BY r1, c1) AS elements, (list(element ORDER BY r1, c1) FILTER (kind = 'note'))[1] AS title FROM me GROUP BY ALL)
SELECT gr.sheet || '__block_' || lpad(CAST(row_number() OVER (PARTITION BY gr.sheet ORDER BY r1, c1, gr.grp) AS VARCHAR), 3, '0') AS block_id, gr.sheet, gr.grp, r1, r2, c1, c2,
  CASE WHEN list_contains(ks, 'title_and_table') OR (list_contains(ks, 'table_body') AND list_contains(ks, 'table_title')) THEN 'title_and_table' WHEN list_contains(ks, 'table_body') THEN 'table_body' WHEN list_contains(ks, 'table_title') THEN 'table_title' ELSE 'other' END AS kind,
  elements, coalesce(title, CAST(gr.sheet AS VARCHAR)) AS title, axis, confidence FROM gr JOIN ax ON ax.sheet = gr.sheet AND ax.grp = gr.grp"""
