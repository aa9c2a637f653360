"""What a reviewer reads: numbered candidates, conflicts and flags of a merge, and the counters of a finalised table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import given, percent_number
from .tables import sequence_ids

ORDER = ["partition_key", "source_id", "target_id"]
#: From which score a conflict is severe, what to do about it, and the kinds of rows and evidence that are counted.
SEVERE = 60
MAPPING_ACTION, MATCH_ACTION = "review partition_mapping_rules.csv and value mappings", "manual review"
EXCEL, PLACEHOLDER, GLOBAL = "excel_block_context", "manual_review_placeholder", "methods_global"
FALLBACKS = ("image_caption_fallback", "caption_fallback")
UNSURE = ("", "low", "unmatched")


def numbered_candidates(resolved: DataFrame) -> DataFrame:
    """Resolved pairs with candidate_id: MC and eight digits or more, in the order of partition, source and target."""
    return sequence_ids(resolved, ORDER, "MC", 8, "candidate_id")


def conflict_table(candidates: DataFrame) -> DataFrame:
    """One row for each numbered candidate that is refused, in the same order, with its own CF id and both values."""
    return sequence_ids(candidates.filter("conflict_reason <> ''"), ORDER, "CF", 8, "conflict_id").select(
        "conflict_id", "target_id", "source_id", F.lit("mapping_rule_conflict").alias("conflict_type"), "conflict_reason", F.col("candidate_id").alias("candidate_ids"),
        F.col("existing").alias("existing_value"), F.col("extracted").alias("extracted_value"), F.lit(MAPPING_ACTION).alias("review_action"),
    )


def review_flags(candidates: DataFrame) -> DataFrame:
    """One flag for each refused candidate: high from a score of 60, else medium; a missing score is medium."""
    severity = F.when(F.coalesce(F.col("score").try_cast("int"), F.lit(0)) >= SEVERE, "high").otherwise("medium")
    return sequence_ids(candidates.filter("conflict_reason <> ''"), ORDER, "FL", 8, "flag_id").select(
        "flag_id", severity.alias("severity"), "target_id", "source_id", F.lit("match").alias("field"), F.col("conflict_reason").alias("issue"), F.col("fields").alias("reason"), F.lit(MATCH_ACTION).alias("recommended_action")
    )


def _lines(one: DataFrame) -> DataFrame:
    """A row of counters as lines of counter and n."""
    return one.select(*[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in one.columns]).unpivot([], one.columns, "counter", "n")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def merge_report(sources: DataFrame, targets: DataFrame, accepted: DataFrame, counts: DataFrame) -> DataFrame:
    """Counters of a merge as lines of counter and n; without candidates all but the rows of either side are 0 or all rows.

    accepted: the pairs that are; counts: candidates, accepted, conflicts and manual, in one row. A linked pair has a
    score of 100, so each refused one is a severe conflict.
    """
    left = lambda rows, side: rows.join(accepted.select(F.col(side).alias("id")), "id", "left_anti").agg(F.count("*"))
    return _union([
        _lines(sources.agg(F.count("*").alias("source_rows"))), _lines(targets.agg(F.count("*").alias("target_rows"))),
        _lines(counts.select(
            "candidates", F.col("accepted").alias("accepted_matches"), F.col("conflicts").alias("conflict_rows"), F.col("manual").alias("manual_required_rows"), F.col("conflicts").alias("severe_conflicts"),
        )),
        _lines(left(sources, "source_id").toDF("unmatched_source_rows")), _lines(left(targets, "target_id").toDF("unmatched_target_rows")),
        _lines(targets.select("partition_key").distinct().agg(F.count("*").alias("merge_steps"))),
    ])


def _text(name: str) -> Column:
    return F.trim(given(F.col(name)))


def _parts(name: str) -> Column:
    """Parts between bars, or between semicolons where there is no bar; blanks dropped."""
    text = _text(name)
    return F.filter(F.transform(F.split(F.when(F.contains(text, F.lit("|")), text).otherwise(F.replace(text, F.lit(";"), F.lit("|"))), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def _yes(name: str) -> Column:
    return F.lower(_text(name)).isin("1", "true", "yes", "y")


def _numeric(text: Column) -> Column:
    return percent_number(F.trim(text)) != ""


def finalisation_report(rows: DataFrame, evidence: DataFrame, links: DataFrame, sentences: DataFrame, selected: DataFrame, allowed: tuple[str, ...], groups: dict[str, tuple[str, ...]]) -> DataFrame:
    """Counters of a finalised table, its evidence, the links between them and the sentences they name: counter, n.

    rows: row_id, item_id, source_type, confidence, manual_required, original_values, aggregated_value, provenance, filled
    (names of its columns that hold something). evidence: evidence_id, source_type, text, sentence_ids, page, block, bbox,
    manual_required. links: evidence_id, item_id, row_ids, columns, sentence_ids, scope; lists are text between bars or
    semicolons. sentences: sentence_id. selected: item_id. ``allowed`` are columns that evidence may support. A group of
    columns is counted in rows that fill one of them, with or without a link of it that names sentences. Nulls count as
    blank; rows of no id are no duplicates. Each counter is one aggregate or equi-join; empty tables count 0.
    """
    source, item = _text("source_type"), _text("item_id")
    original, mean = _text("original_values"), _text("aggregated_value")
    has_value = (original != "") | (mean != "")
    values = _parts("original_values")
    parsed = (F.size(values) > 0) & F.forall(values, _numeric) & _numeric(mean)
    r = rows.select(
        "row_id", item.alias("item_id"), source.alias("source"), F.lower(_text("confidence")).alias("confidence"), _yes("manual_required").alias("manual"), has_value.alias("has_value"),
        parsed.alias("parsed"), (F.contains(original, F.lit("|")) & (mean != "")).alias("averaged"), (_text("provenance") != "").alias("placed"), F.coalesce("filled", F.array().cast("array<string>")).alias("filled"),
    )
    out = [_lines(r.agg(
        F.count("*").alias("rows"), F.sum(F.size("filled")).alias("filled_cells"), F.count_if("manual").alias("manual_required_rows"), F.count_if(F.col("confidence").isin(*UNSURE)).alias("low_confidence_rows"),
        F.count_if(F.col("item_id") == "").alias("missing_item_id_rows"), *[F.count_if(F.col("source") == x).alias(f"{x}_rows") for x in (*FALLBACKS, PLACEHOLDER)],
        F.count_if("has_value").alias("value_rows"), F.count_if(F.col("has_value") & ~F.col("placed")).alias("value_rows_without_provenance"),
        F.count_if(F.col("has_value") & ~F.col("parsed")).alias("value_rows_not_numeric"), F.count_if(F.col("has_value") & F.col("averaged")).alias("value_rows_averaged"),
        F.count_if(~F.col("has_value") & ~F.col("placed")).alias("rows_left_blank"),
    ))]
    repeated = r.filter(_text("row_id") != "").groupBy("row_id").agg(F.count("*").alias("k")).filter("k > 1")
    out.append(_lines(repeated.agg(F.count("*").alias("duplicate_row_ids"))))
    linked = links.filter(F.size(_parts("columns")) > 0).select(_text("item_id").alias("item_id")).distinct().withColumn("linked", F.lit(True))
    items = r.groupBy("item_id").agg(
        F.max(F.col("source") == EXCEL).alias("excel"), F.max(F.col("source").isin(*FALLBACKS)).alias("fallback"), F.max(F.col("source") == PLACEHOLDER).alias("placeholder"),
        F.max("has_value").alias("valued"), F.max(F.size("filled") > 0).alias("scientific"),
    )
    chosen = selected.select(_text("item_id").alias("item_id")).distinct().withColumn("chosen", F.lit(True))
    every = items.join(chosen, "item_id", "full_outer").join(linked, "item_id", "full_outer")
    flag = lambda c: F.coalesce(c, F.lit(False))
    out.append(_lines(every.select("item_id", *[flag(F.col(c)).alias(c) for c in ("excel", "fallback", "placeholder", "valued", "scientific", "chosen", "linked")]).agg(
        F.count_if(F.col("chosen") & ~F.col("excel")).alias("selected_items_without_excel"), F.count_if("fallback").alias("items_expanded_by_fallback"), F.count_if(F.col("placeholder") & ~F.col("fallback")).alias("items_still_placeholder"),
        F.count_if(F.col("valued") & (F.col("item_id") != "")).alias("items_with_values"), F.count_if("linked").alias("items_with_evidence"),
        F.count_if(F.col("scientific") & ~F.col("linked") & (F.col("item_id") != "")).alias("items_missing_evidence"),
    )))

    e = evidence.select(source.alias("source"), (_text("text") == "").alias("empty"), (F.size(_parts("sentence_ids")) > 0).alias("has_ids"), *[(_text(c) != "").alias(c) for c in ("page", "block", "bbox")], _yes("manual_required").alias("manual"))
    fallback = F.col("source").isin(*FALLBACKS)
    out.append(_lines(e.agg(
        F.count("*").alias("evidence_rows"), F.count_if("empty").alias("evidence_without_text"), F.count_if("has_ids").alias("evidence_with_sentences"), F.count_if(~F.col("has_ids")).alias("evidence_without_sentences"),
        F.count_if(fallback & F.col("has_ids")).alias("fallback_evidence_with_sentences"), F.count_if(fallback & ~F.col("has_ids")).alias("fallback_evidence_without_sentences"),
        F.count_if(F.col("source") == GLOBAL).alias("cross_document_evidence"), *[F.count_if(c).alias(f"evidence_with_{c}") for c in ("page", "block", "bbox")], F.count_if("manual").alias("manual_required_evidence"),
    )))
    columns, known = _parts("columns"), F.array(*[F.lit(c) for c in allowed])
    m = links.select("evidence_id", _text("scope").alias("scope"), columns.alias("columns"), _parts("row_ids").alias("row_ids"), (F.size(_parts("sentence_ids")) > 0).alias("has_ids"))
    out.append(_lines(m.agg(
        F.count("*").alias("links"), F.count_if("has_ids").alias("links_with_sentences"), F.count_if(F.size(F.array_distinct("columns")) > 1).alias("links_of_several_columns"),
        F.sum(F.size(F.filter("columns", lambda c: ~F.array_contains(known, c)))).alias("links_to_unknown_columns"),
    )))
    used = m.groupBy("evidence_id").agg(F.count("*").alias("k")).filter("k > 1")
    out.append(_lines(used.agg(F.count("*").alias("evidence_used_several_times"))))
    known_ids = sentences.select(F.col("sentence_id").cast("string").alias("sid")).distinct()
    for name, df in (("evidence_sentences_missing", evidence), ("link_sentences_missing", links)):
        out.append(_lines(df.select(F.explode(_parts("sentence_ids")).alias("sid")).join(known_ids, "sid", "left_anti").agg(F.count("*").alias(name))))
    out.append(e.groupBy(F.concat(F.lit("evidence_of:"), F.col("source")).alias("counter")).agg(F.count("*").alias("n")))
    out.append(m.groupBy(F.concat(F.lit("links_in:"), F.col("scope")).alias("counter")).agg(F.count("*").alias("n")))
    of = lambda c: F.array_compact(F.array(*[F.when(F.arrays_overlap(c, F.array(*[F.lit(x) for x in names])), F.lit(g)) for g, names in groups.items()]))
    wanted = r.select(given(F.col("row_id")).alias("id"), F.explode(of(F.col("filled"))).alias("grp")).distinct()
    backed = m.filter("has_ids").select(F.explode("row_ids").alias("id"), "columns").select("id", F.explode(of(F.col("columns"))).alias("grp")).distinct().withColumn("backed", F.lit(True))
    state = wanted.join(backed, ["id", "grp"], "left").groupBy("grp").agg(F.count("backed").alias("with_evidence"), F.count_if(F.col("backed").isNull()).alias("missing_evidence"))
    out.append(state.unpivot(["grp"], ["with_evidence", "missing_evidence"], "what", "n").select(F.concat("grp", F.lit("_rows_"), "what").alias("counter"), "n"))
    return _union(out)
