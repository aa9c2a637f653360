"""Queries of review tables: numbered candidates, conflicts and flags of the merge, and counters of a finalised table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import review as V
from ..operators.linkage import pair_counts
from .inputs import table
from .linkage_queries import PAIRS_SQL, candidates, judged, target_rows, value_rows

QUERIES, ORACLES = {}, {}

_ORDER = "row_number() OVER (ORDER BY partition_key, source_id, target_id)"
_ID = lambda prefix: f"'{prefix}' || lpad(CAST({_ORDER} AS VARCHAR), CAST(greatest(8, length(CAST({_ORDER} AS VARCHAR))) AS INTEGER), '0')"
_NUMBERED = f"{PAIRS_SQL}, n AS (SELECT *, {_ID('MC')} AS candidate_id FROM m)"
QUERIES["J8_candidate_ids"] = lambda s, d: V.numbered_candidates(candidates(s, d)).select("candidate_id", "source_id", "target_id", "accepted")
ORACLES["J8_candidate_ids"] = f"WITH {_NUMBERED} SELECT candidate_id, source_id, target_id, accepted FROM n"
QUERIES["J8_conflict_table"] = lambda s, d: V.conflict_table(V.numbered_candidates(candidates(s, d)))
ORACLES["J8_conflict_table"] = f"""WITH {_NUMBERED} SELECT {_ID('CF')} AS conflict_id, target_id, source_id, 'mapping_rule_conflict' AS conflict_type, conflict_reason, candidate_id AS candidate_ids,
existing AS existing_value, extracted AS extracted_value, 'review partition_mapping_rules.csv and value mappings' AS review_action FROM n WHERE conflict_reason <> ''"""
QUERIES["A13_review_flags"] = lambda s, d: V.review_flags(candidates(s, d))
ORACLES["A13_review_flags"] = f"""WITH {PAIRS_SQL} SELECT {_ID('FL')} AS flag_id, 'high' AS severity, target_id, source_id, 'match' AS field, conflict_reason AS issue,
'X_Label+Size->Name+Size|Group->Group' AS reason, 'manual review' AS recommended_action FROM m WHERE conflict_reason <> ''"""


def _merge_report(s, d):
    j = judged(s, d)
    return V.merge_report(value_rows(s, d), target_rows(s, d), j.accepted, pair_counts(j))


QUERIES["A13_merge_report"] = _merge_report
ORACLES["A13_merge_report"] = f"""WITH {PAIRS_SQL} SELECT 'source_rows' AS counter, count(*) AS n FROM s UNION ALL SELECT 'target_rows', count(*) FROM t UNION ALL SELECT 'candidates', count(*) FROM m
UNION ALL SELECT 'accepted_matches', count_if(accepted) FROM m UNION ALL SELECT 'conflict_rows', count_if(conflict_reason <> '') FROM m UNION ALL SELECT 'severe_conflicts', count_if(conflict_reason <> '') FROM m
UNION ALL SELECT 'manual_required_rows', count_if((reason IS NULL AND takers > 1) OR (partition_key = 'brand#5' AND NOT accepted)) FROM m
UNION ALL SELECT 'unmatched_source_rows', count(*) FROM s WHERE id NOT IN (SELECT source_id FROM m WHERE accepted) UNION ALL SELECT 'unmatched_target_rows', count(*) FROM t WHERE id NOT IN (SELECT target_id FROM m WHERE accepted)
UNION ALL SELECT 'merge_steps', count(DISTINCT partition_key) FROM t"""

#: A finalised table from orders, its evidence from parts, links from line items and sentences from turns; columns in Spark's SQL and DuckDB's alike.
_ROWS = """SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'R50' WHEN o_orderkey % 53 = 0 THEN '' ELSE concat('R', o_orderkey) END AS row_id, CASE WHEN o_custkey % 9 = 0 THEN ' ' ELSE concat('fig ', o_custkey % 40) END AS item_id,
CASE o_custkey % 5 WHEN 0 THEN 'excel_block_context' WHEN 1 THEN 'image_caption_fallback' WHEN 2 THEN 'caption_fallback' WHEN 3 THEN 'manual_review_placeholder' END AS source_type,
CASE o_orderstatus WHEN 'F' THEN 'high' WHEN 'O' THEN ' Low' END AS confidence, CASE WHEN o_orderkey % 3 = 0 THEN 'TRUE' ELSE 'no' END AS manual_required,
CASE o_orderkey % 5 WHEN 0 THEN '1|2.5' WHEN 1 THEN '3' WHEN 2 THEN 'x|1' ELSE ' ' END AS original_values, CASE o_orderkey % 5 WHEN 0 THEN '1.75' WHEN 1 THEN '3%' WHEN 2 THEN 'oops' END AS aggregated_value,
CASE WHEN o_orderkey % 7 > 1 THEN 'b.csv' END AS provenance, concat(CASE WHEN o_orderkey % 2 = 0 THEN 'Aqueous_buffer ' ELSE '' END, CASE WHEN o_orderkey % 6 = 0 THEN 'Dose ' ELSE '' END) AS filled_text FROM orders"""
_EVIDENCE = """SELECT concat('E', p_partkey) AS evidence_id, CASE p_partkey % 4 WHEN 0 THEN 'methods_global' WHEN 1 THEN 'caption_fallback' WHEN 2 THEN 'image_caption_fallback' ELSE 'excel_block' END AS source_type,
CASE WHEN p_partkey % 10 = 0 THEN ' ' ELSE p_name END AS text, CASE WHEN p_partkey % 3 > 0 THEN concat('S', p_partkey % 700, '; S', p_partkey % 1100) END AS sentence_ids,
CASE WHEN p_size % 4 = 0 THEN '3' END AS page, CASE WHEN p_size % 5 = 0 THEN 'b.csv' END AS block, CASE WHEN p_size % 6 = 0 THEN '1,2' ELSE '' END AS bbox, CASE WHEN p_size % 7 = 0 THEN 'yes' END AS manual_required FROM part"""
_LINKS = """SELECT concat('E', l_partkey) AS evidence_id, concat('fig ', l_suppkey % 30) AS item_id, concat('R', l_orderkey, '|') AS row_ids,
CASE l_linenumber % 4 WHEN 0 THEN 'Aqueous_buffer|Dose' WHEN 1 THEN 'Dose' WHEN 2 THEN 'Unknown;Aqueous_buffer' ELSE '' END AS columns, CASE WHEN l_linenumber > 1 THEN concat('S', l_partkey % 700) END AS sentence_ids, l_returnflag AS scope FROM lineitem"""


def _report(s, d):
    for name in ("orders", "part", "lineitem"):
        table(s, d, name).createOrReplaceTempView(f"report_{name}")
    of = lambda sql, name: s.sql(sql.replace(f"FROM {name}", f"FROM report_{name}"))
    rows = of(_ROWS, "orders").withColumn("filled", F.filter(F.split("filled_text", " "), lambda x: x != ""))
    sentences = table(s, d, "conversations").select(F.concat(F.lit("S"), F.col("conv_id")).alias("sentence_id"))
    selected = table(s, d, "supplier").select(F.concat(F.lit("fig "), F.col("s_suppkey") % 60).alias("item_id"))
    return V.finalisation_report(rows, of(_EVIDENCE, "part"), of(_LINKS, "lineitem"), sentences, selected, ("Aqueous_buffer", "Dialysis_buffer", "Dose"), {"buffer": ("Aqueous_buffer", "Dialysis_buffer"), "dose": ("Dose",)})


QUERIES["A9_finalisation_report"] = _report
_FALL = "IN ('image_caption_fallback', 'caption_fallback')"
_TOTALS = {
    "r": {
        "rows": "count(*)", "filled_cells": "sum(len(filled))", "manual_required_rows": "count_if(manual_required = 'TRUE')", "low_confidence_rows": "count_if(coalesce(confidence, '') <> 'high')", "missing_item_id_rows": "count_if(item_id = ' ')",
        "image_caption_fallback_rows": "count_if(source_type = 'image_caption_fallback')", "caption_fallback_rows": "count_if(source_type = 'caption_fallback')", "manual_review_placeholder_rows": "count_if(source_type = 'manual_review_placeholder')",
        "value_rows": "count_if(v)", "value_rows_without_provenance": "count_if(v AND provenance IS NULL)", "value_rows_not_numeric": "count_if(aggregated_value = 'oops')", "value_rows_averaged": "count_if(contains(original_values, '|'))",
        "rows_left_blank": "count_if(NOT v AND provenance IS NULL)", "items_expanded_by_fallback": f"count(DISTINCT CASE WHEN source_type {_FALL} THEN item_id END)", "items_with_values": "count(DISTINCT CASE WHEN v AND item_id <> ' ' THEN item_id END)",
        "items_still_placeholder": f"count(DISTINCT CASE WHEN source_type = 'manual_review_placeholder' AND item_id NOT IN (SELECT item_id FROM r WHERE source_type {_FALL}) THEN item_id END)",
        "items_missing_evidence": "count(DISTINCT CASE WHEN len(filled) > 0 AND item_id <> ' ' AND item_id NOT IN (SELECT item_id FROM l WHERE columns <> '') THEN item_id END)",
    },
    "e": {
        "evidence_rows": "count(*)", "evidence_without_text": "count_if(text = ' ')", "evidence_with_sentences": "count(sentence_ids)", "evidence_without_sentences": "count_if(sentence_ids IS NULL)",
        "fallback_evidence_with_sentences": f"count_if(source_type {_FALL} AND sentence_ids IS NOT NULL)", "fallback_evidence_without_sentences": f"count_if(source_type {_FALL} AND sentence_ids IS NULL)",
        "cross_document_evidence": "count_if(source_type = 'methods_global')", "evidence_with_page": "count(page)", "evidence_with_block": "count(block)", "evidence_with_bbox": "count_if(bbox <> '')", "manual_required_evidence": "count(manual_required)",
    },
    "l": {
        "links": "count(*)", "links_with_sentences": "count(sentence_ids)", "links_of_several_columns": "count_if(contains(columns, '|') OR contains(columns, ';'))", "links_to_unknown_columns": "count_if(contains(columns, 'Unknown'))",
        "items_with_evidence": "count(DISTINCT CASE WHEN columns <> '' THEN item_id END)", "link_sentences_missing": "count_if(sentence_ids NOT IN (SELECT sid FROM sn))",
    },
    "(SELECT item_id FROM picked EXCEPT SELECT item_id FROM r WHERE source_type = 'excel_block_context')": {"selected_items_without_excel": "count(*)"},
    "(SELECT row_id FROM r WHERE row_id <> '' GROUP BY ALL HAVING count(*) > 1)": {"duplicate_row_ids": "count(*)"},
    "(SELECT evidence_id FROM l GROUP BY ALL HAVING count(*) > 1)": {"evidence_used_several_times": "count(*)"},
    "(SELECT unnest(string_split(sentence_ids, '; ')) AS sid FROM e)": {"evidence_sentences_missing": "count_if(sid NOT IN (SELECT sid FROM sn))"},
}
_BACKED = lambda group, col: " UNION ALL ".join(
    f"""SELECT '{group}_rows_{what}', count(DISTINCT row_id) FROM r WHERE list_contains(filled, '{col}') AND row_id {op} (SELECT rtrim(row_ids, '|') FROM l WHERE sentence_ids IS NOT NULL AND contains(columns, '{col}'))"""
    for what, op in (("with_evidence", "IN"), ("missing_evidence", "NOT IN"))
)
ORACLES["A9_finalisation_report"] = f"""WITH r AS (SELECT *, trim(original_values) <> '' OR aggregated_value IS NOT NULL AS v, list_filter(string_split(filled_text, ' '), lambda x: x <> '') AS filled FROM ({_ROWS})), e AS ({_EVIDENCE}), l AS ({_LINKS}),
sn AS (SELECT DISTINCT 'S' || conv_id AS sid FROM conversations), picked AS (SELECT DISTINCT 'fig ' || s_suppkey % 60 AS item_id FROM supplier), c AS (
{" UNION ALL ".join(f"SELECT '{name}' AS counter, CAST({sql} AS BIGINT) AS n FROM {rel}" for rel, them in _TOTALS.items() for name, sql in them.items())}
UNION ALL SELECT 'evidence_of:' || source_type, count(*) FROM e GROUP BY ALL UNION ALL SELECT 'links_in:' || scope, count(*) FROM l GROUP BY ALL UNION ALL {_BACKED("buffer", "Aqueous_buffer")} UNION ALL {_BACKED("dose", "Dose")})
SELECT counter, n FROM c"""
