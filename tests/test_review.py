"""Counters of finalised tables on nulls, odd lists and empty tables; severity of flags."""

from sparkloom.operators import review as V

ROWS = "row_id string, item_id string, source_type string, confidence string, manual_required string, original_values string, aggregated_value string, provenance string, filled array<string>"
EVIDENCE = "evidence_id string, source_type string, text string, sentence_ids string, page string, block string, bbox string, manual_required string"
LINKS = "evidence_id string, item_id string, row_ids string, columns string, sentence_ids string, scope string"
GROUPS = {"dose": ("Dose",), "buffer": ("B1", "B2")}


def _report(spark, rows, evidence, links, sentences, selected):
    frames = (spark.createDataFrame(x, t) for x, t in ((rows, ROWS), (evidence, EVIDENCE), (links, LINKS), (sentences, "sentence_id string"), (selected, "item_id string")))
    return {r.counter: r.n for r in V.finalisation_report(*frames, allowed=("Dose", "B1", "B2"), groups=GROUPS).collect()}


def test_counters_by_hand(spark):
    rows = [
        ("R10", "fig 1", "excel_block_context", "high", "yes", "1 | 2;x", "1.5", "b.csv", ["Dose", "B1"]), ("R10", "fig 1", "caption_fallback", None, None, "3", "4%", None, ["B2"]),
        ("R20", " fig 2 ", "manual_review_placeholder", "LOW", "0", None, None, None, None), (None, None, None, "unmatched", None, " ", "", " ", []), ("", "fig 3", "excel_block_context", "high", "", "1|2", "1", "b", ["Dose"]),
    ]
    evidence = [("E1", "caption_fallback", " ", "S10|S20; S30", "3", None, "0,1", "true"), ("E2", "methods_global", None, None, None, "b", None, None)]
    links = [("E1", "fig 1", "R10 | R200", "Dose;B1", "S10", "row"), ("E1", "fig 9", "R10", "B2|Other|B2", "", "item"), (None, None, None, None, None, None)]
    got = _report(spark, rows, evidence, links, [("S10",), (None,)], [("fig 2",), ("fig 1",), ("fig 7",)])
    want = {
        "rows": 5, "filled_cells": 4, "manual_required_rows": 1, "low_confidence_rows": 3, "missing_item_id_rows": 1, "value_rows": 3, "value_rows_without_provenance": 1, "value_rows_not_numeric": 1,
        "value_rows_averaged": 2, "rows_left_blank": 2, "duplicate_row_ids": 1, "selected_items_without_excel": 2, "items_expanded_by_fallback": 1, "items_still_placeholder": 1, "items_with_values": 2,
        "items_with_evidence": 2, "items_missing_evidence": 1, "evidence_rows": 2, "evidence_without_text": 2, "evidence_with_sentences": 1, "fallback_evidence_with_sentences": 1, "cross_document_evidence": 1,
        "evidence_with_page": 1, "evidence_with_block": 1, "evidence_with_bbox": 1, "links": 3, "links_with_sentences": 1, "links_of_several_columns": 2, "links_to_unknown_columns": 1, "evidence_used_several_times": 1,
        "evidence_sentences_missing": 1, "link_sentences_missing": 0, "dose_rows_with_evidence": 1, "dose_rows_missing_evidence": 1, "buffer_rows_with_evidence": 1, "buffer_rows_missing_evidence": 0, "links_in:": 1, "links_in:row": 1, "evidence_of:methods_global": 1,
    }
    assert {k: got[k] for k in want} == want


def test_empty_tables_count_nothing(spark):
    got = _report(spark, [], [], [], [], [])
    assert len(got) > 35 and set(got.values()) == {0}


def test_severity_and_numbers(spark):
    pairs = spark.createDataFrame(
        [("b", "s2", "t1", 60, "x", True), ("a", "s9", "t1", 59, "x", False), ("a", "s1", "t2", None, "x", False), ("a", "s1", "t1", 90, "", True)],
        "partition_key string, source_id string, target_id string, score int, conflict_reason string, accepted boolean",
    ).selectExpr("*", "'f' AS fields", "'' AS existing", "'1' AS extracted")
    assert [(r.candidate_id, r.source_id, r.target_id) for r in V.numbered_candidates(pairs).orderBy("candidate_id").collect()] == [
        ("MC00000001", "s1", "t1"), ("MC00000002", "s1", "t2"), ("MC00000003", "s9", "t1"), ("MC00000004", "s2", "t1")]
    assert [(r.flag_id, r.severity) for r in V.review_flags(pairs).orderBy("flag_id").collect()] == [("FL00000001", "medium"), ("FL00000002", "medium"), ("FL00000003", "high")]
    assert [(r.conflict_id, r.candidate_ids) for r in V.conflict_table(V.numbered_candidates(pairs)).orderBy("conflict_id").collect()] == [("CF00000001", "MC00000002"), ("CF00000002", "MC00000003"), ("CF00000003", "MC00000004")]
