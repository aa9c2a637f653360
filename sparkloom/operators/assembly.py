"""The unified table of selected items, and the evidence that its cells rest on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import comparison_text, given, number, phrase_around
from ..sources.stage import written
from .tables import sequence_ids

#: States that rows and evidence are given.
BLOCK, CAPTION, IMAGE_CAPTION, PLACEHOLDER = "excel_block_context", "caption_fallback", "image_caption_fallback", "manual_review_placeholder"


def unified_rows(items: DataFrame, matches: DataFrame, labels: Column, item: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """(rows, flags) of the selected items.

    items: item_id, caption, image. matches: item_id, block, readable, context (the block's labels). An item
    with readable blocks has a row for each; else a row for each group label that its caption names
    (``labels``, over the columns of items); else one placeholder. Blocks that cannot be read, fallback rows
    and placeholders are flagged. Matches of items that are not selected count for nothing.
    """
    fields = lambda kind, block, context, label, confidence: [
        item, kind.alias("source_type"), block.alias("block"), context.alias("context"), label.alias("label"), confidence.alias("confidence"), F.lit(True).alias("manual_required"), given(F.col("caption")).alias("evidence_text")
    ]
    none = F.lit("")
    own = items.join(matches, item)
    of_blocks = own.filter("readable").select(*fields(F.lit(BLOCK), F.col("block"), F.array_join("context", "; "), none, F.lit("low")))
    bare = items.join(own.filter("readable").select(item).distinct(), item, "left_anti").withColumn("_labels", labels)
    by_caption = F.when(given(F.col("image")) != "", IMAGE_CAPTION).otherwise(CAPTION)
    named = bare.filter(F.size("_labels") > 0)
    of_labels = named.withColumn("label", F.explode("_labels")).select(*fields(by_caption, none, none, F.col("label"), F.lit("medium")))
    left = bare.filter(F.size("_labels") == 0)
    placeholders = left.select(*fields(F.lit(PLACEHOLDER), none, none, none, F.lit("low")))
    flag = lambda df, block, field, issue, severity: df.select(item, block.alias("block"), F.lit(field).alias("field"), F.lit(issue).alias("issue"), F.lit(severity).alias("severity"))
    flags = flag(own.filter("not readable"), F.col("block"), "block", "missing block", "high")
    flags = flags.unionByName(flag(named, none, "label", "fallback rows to review", "medium")).unionByName(flag(left, none, "row", "placeholder only", "high"))
    return of_blocks.unionByName(of_labels).unionByName(placeholders), flags


def evidence_type(column: Column, value_columns: list[str], block_columns: list[str]) -> Column:
    """What a cell's evidence is, by its row's kind, block, image, page and text; the first rule that holds."""
    has = lambda *c: F.coalesce(*[F.nullif(F.trim(given(F.col(x))), F.lit("")) for x in c]).isNotNull()
    return (
        F.when(F.col("source_type").isin(PLACEHOLDER, CAPTION, IMAGE_CAPTION), F.col("source_type"))
        .when(has("block") & column.isin(*value_columns), "excel_block_value").when(has("block") & column.isin(*block_columns), "excel_block")
        .when(has("image") & ~has("evidence_text"), "figure_image").when(has("pdf", "page"), "pdf_caption").when(has("evidence_text"), "markdown").otherwise("inferred_from_context")
    )


def evidence_tables(rows: DataFrame, seeds: list[str], columns: list[str], value_columns: list[str], block_columns: list[str], rules: list[tuple[tuple[str, ...], tuple[str, ...]]], prefix: str) -> tuple[DataFrame, DataFrame]:
    """(evidence, map) of unified rows.

    rows: row_id, item_id, entity, source_type, block, image, pdf, page, evidence_text, reason, confidence,
    manual_required and the scientific ``columns``. Each filled seed column (else the first filled column) of
    a row gives a piece of evidence: the block, or the phrase around the cell's value. Pieces equal in item,
    text, type and source are one, numbered in the order of their first row. A piece supports the filled
    columns that its rules name by the terms in its text; all filled ones if none does. The map has a line
    for each item, piece and set of columns: its rows and entities, and how wide the support is.
    """
    filled = F.filter(F.array(*[F.when(F.trim(given(F.col(c))) != "", F.lit(c)) for c in columns]), lambda c: c.isNotNull())
    wanted = F.filter(F.array(*[F.lit(c) for c in seeds]), lambda c: F.array_contains("_filled", c))
    with_seeds = rows.withColumn("_filled", filled).filter(F.size("_filled") > 0).withColumn("_seed", F.explode(F.when(F.size(wanted) > 0, wanted).otherwise(F.slice("_filled", 1, 1))))
    cell = F.element_at(F.create_map(*[x for c in columns for x in (F.lit(c), given(F.col(c)))]), F.col("_seed"))
    kind = evidence_type(F.col("_seed"), value_columns, block_columns)
    typed = with_seeds.withColumn("_kind", kind).withColumn("_text", F.when(F.col("_kind").startswith("excel"), given(F.col("block"))).otherwise(phrase_around(F.col("evidence_text"), cell)))
    typed = written(typed)  # phrases are cut once
    blank = F.col("_text") == ""
    state = F.when(~blank, F.col("_kind")).when(F.col("manual_required"), PLACEHOLDER).otherwise("inferred_from_context")
    typed = typed.withColumn("evidence_type", state).withColumn("evidence_text_exact", F.left(F.when(blank, given(F.col("reason"))).otherwise(F.col("_text")), F.lit(500)))
    named_by = lambda low: F.flatten(F.array(*[F.when(F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(low, t)), F.array(*[F.lit(c) for c in of])).otherwise(F.array().cast("array<string>")) for of, terms in rules]))
    by_rule = F.transform(F.array(comparison_text(F.col("evidence_text_exact"))), named_by)[0]
    by_kind = F.when(F.col("evidence_type") == "excel_block", F.array(*[F.lit(c) for c in block_columns])).otherwise(F.array().cast("array<string>"))
    named = F.array_intersect("_filled", F.concat(by_rule, by_kind))
    support = (
        F.when(F.col("evidence_type") == PLACEHOLDER, F.col("_filled")).when(F.col("evidence_type") == "excel_block_value", F.array_intersect("_filled", F.array(*[F.lit(c) for c in value_columns])))
        .when(F.size(named) > 0, named).otherwise(F.col("_filled"))
    )
    key = ["item_id", "evidence_text_exact", "evidence_type", "pdf", "page", "image", "block"]
    pieces = typed.select("row_id", "entity", "confidence", "manual_required", *[given(F.col(c)).alias(c) if c != "item_id" else F.col(c) for c in key], support.alias("columns"), F.array_position(F.array(*[F.lit(c) for c in [*seeds, *columns]]), F.col("_seed")).alias("_nth"))
    pieces = written(pieces.filter(F.size("columns") > 0))
    first = pieces.groupBy(*key).agg(F.min(F.struct("row_id", "_nth")).alias("_at"))
    evidence = sequence_ids(first, ["_at"], prefix, 6, "evidence_id").drop("_at")
    linked = pieces.join(evidence, key)
    per_item = rows.groupBy("item_id").agg(F.count("*").alias("_of_item"))
    groups = linked.groupBy("item_id", "evidence_id", "columns").agg(
        F.array_sort(F.collect_set("row_id")).alias("rows"), F.array_sort(F.collect_set(F.nullif(F.trim(given(F.col("entity"))), F.lit("")))).alias("entities"),
        F.first("evidence_type").alias("evidence_type"), F.max("manual_required").alias("manual_required"), F.min(F.when(F.lower(given(F.col("confidence"))).isin("", "low"), "low").otherwise(F.col("confidence"))).alias("_least"),
        F.max(F.lower(given(F.col("confidence"))).isin("", "low")).alias("_low"),
    )
    scope = (
        F.when(F.col("evidence_type") == PLACEHOLDER, PLACEHOLDER).when(F.size("entities") > 0, "formulation_level").when(F.size("rows") >= F.col("_of_item"), "item_level_all_rows")
        .when(F.size("rows") > 1, "item_level_subset_rows").otherwise("column_context")
    )
    out = groups.join(per_item, "item_id").select(
        "item_id", "evidence_id", F.array_join("columns", "|").alias("supported_columns"), F.array_join(F.transform("rows", lambda x: x.cast("string")), "|").alias("supported_rows"),
        F.array_join("entities", "|").alias("supported_entities"), scope.alias("support_scope"), F.when(F.col("_low"), "low").otherwise(F.col("_least")).alias("confidence"), "manual_required",
    )
    return evidence, out


def row_violations(rows: DataFrame, provenance: list[str], numeric: list[str], allowed: dict[str, list[str]], concise: list[str], context: list[str], by: str, words: int = 8) -> DataFrame:
    """A10: one line per rule with the rows that break it.

    provenance: one of these must say something. numeric: cells with text must be numbers. allowed: cells with
    text must be of the vocabulary. concise: cells of over ``words`` words are prose. context: rows of one
    ``by`` of which several share all of these are collapsed contexts, counted by their surplus.
    """
    text = lambda c: F.trim(given(F.col(c)))
    rules = {"no_provenance": ~F.exists(F.array(*[text(c) for c in provenance]), lambda x: x != "")}
    rules |= {f"not_numeric_{c}": (text(c) != "") & number(F.col(c)).isNull() for c in numeric}
    rules |= {f"not_allowed_{c}": (text(c) != "") & ~text(c).isin(*values) for c, values in allowed.items()}
    rules |= {f"prose_{c}": F.size(F.filter(F.split(text(c), r"\s+"), lambda x: x != "")) > words for c in concise}
    broken = rows.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    same = rows.groupBy(by, *context).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("collapsed_contexts"))
    one = broken.crossJoin(F.broadcast(same))  # single rows
    return one.unpivot([], one.columns, "rule", "n")


def integrity(rows: DataFrame, evidence: DataFrame, evidence_map: DataFrame, columns: list[str]) -> DataFrame:
    """One line per check between rows (row_id), evidence (evidence_id) and map (lists with bars between): how many fail."""
    repeats = lambda df, key, name: df.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))
    lost = lambda left, right, key, name: left.join(right.select(key).distinct(), key, "left_anti").agg(F.count("*").alias(name))
    named = evidence_map.select(F.explode(F.split("supported_rows", r"\|")).alias("row_id")).filter("row_id <> ''")
    ids = rows.select(F.col("row_id").cast("string").alias("row_id"))
    unknown = F.exists(F.split("supported_columns", r"\|"), lambda c: ~c.isin(*columns))
    checks = [
        repeats(rows, "row_id", "repeated_rows"), repeats(evidence, "evidence_id", "repeated_evidence"), repeats(evidence_map.withColumn("k", F.struct("evidence_id", "supported_columns")), "k", "repeated_links"),
        lost(evidence_map, evidence, "evidence_id", "links_without_evidence"), lost(evidence, evidence_map, "evidence_id", "evidence_without_link"), lost(named, ids, "row_id", "links_to_no_row"), lost(ids, named, "row_id", "rows_without_evidence"),
        evidence_map.agg(F.count_if(unknown).alias("unknown_columns")),
    ]
    one = checks[0]
    for c in checks[1:]:
        one = one.crossJoin(F.broadcast(c))  # single rows
    return one.unpivot([], one.columns, "check", "n")


def partition_context(partitions: DataFrame, docs: DataFrame, terms: Column, content: Column, most: int = 6) -> DataFrame:
    """For each partition key its search terms and the first ``most`` readable documents, each compacted; docs: place, path, text."""
    first = docs.filter(F.trim(given(F.col("text"))) != "").orderBy("place", "path").limit(most)  # few rows, whatever the input
    compact = first.select("place", "path", F.char_length("text").alias("original_chars"), content.alias("content"))
    compact = compact.withColumn("mode", F.when(F.char_length("content") < F.col("original_chars"), "compacted").otherwise("full")).withColumn("included_chars", F.char_length("content"))
    return partitions.withColumn("terms", terms).crossJoin(F.broadcast(compact))


def reference_availability(profile: DataFrame, notes: DataFrame, guides: DataFrame) -> DataFrame:
    """One row: whether there is any reference, how many columns with examples, notes and guide blocks, and what is missing."""
    one = profile.agg(F.count_if(F.col("non_empty") > 0).alias("columns_with_examples")).crossJoin(F.broadcast(notes.agg(F.count_if(F.trim(given(F.col("text"))) != "").alias("notes"))))
    one = one.crossJoin(F.broadcast(guides.agg(F.count_if(F.trim(given(F.col("text"))) != "").alias("guide_blocks"))))
    warnings = F.array_compact(F.array(F.when(F.col("columns_with_examples") + F.col("notes") == 0, "no reference rows"), F.when(F.col("guide_blocks") == 0, "no column guides")))
    return one.select(
        (F.col("columns_with_examples") + F.col("notes") + F.col("guide_blocks") > 0).alias("has_any_reference"), "columns_with_examples", "notes", "guide_blocks", F.array_join(warnings, "|").alias("warnings")
    )


def table_spans(lines: DataFrame, hits: DataFrame, is_table: Column, stops: Column, most: int = 12_000, window: int = 20) -> DataFrame:
    """For each hit (item, doc_id, line_no) the table that follows its line, or the lines around it where none does.

    lines: doc_id, line_no, line. The span ends before the first later line that ``stops`` holds for, before
    text after a blank line after table rows, and before the second line of text right after rows with bars.
    Spans of under two table lines and 500 characters are no tables. A document's lines and hits are gathered once, as
    one row, and each hit goes through the lines by itself; nothing is sorted or joined after that.
    """
    blank, table = F.trim("line") == "", is_table
    bars = F.char_length("line") - F.char_length(F.replace("line", F.lit("|"), F.lit(""))) >= 2
    kind = sum((F.when(c, bit).otherwise(0) for bit, c in ((1, blank), (2, table), (4, ~blank & ~table), (8, stops & ~blank), (16, bars))), F.lit(0))
    own = lines.select("doc_id", F.struct("line_no", kind.alias("kind"), "line").alias("l"))
    asked = hits.select("doc_id", F.struct("item", F.col("line_no").alias("hit")).alias("h"))
    own, asked = own.withColumn("h", F.lit(None).cast(asked.schema["h"].dataType)), asked.withColumn("l", F.lit(None).cast(own.schema["l"].dataType))
    docs = own.unionByName(asked).filter("doc_id is not null").groupBy("doc_id").agg(F.array_sort(F.collect_list("l")).alias("lines"), F.collect_set("h").alias("hits"))
    each = docs.select("doc_id", F.explode("hits").alias("h"), "lines").select("doc_id", "h.item", "h.hit", "lines")

    def step(at: Column, line: Column) -> Column:
        blank, table, text, stop, bars = (line["kind"].bitwiseAND(F.lit(bit)) != 0 for bit in (1, 2, 4, 8, 16))
        gap = ~table & (at["gap"] | blank)
        texts = F.when(table, 0).otherwise(at["texts"] + text.cast("int"))
        over = at["over"] | stop | (text & at["seen"] & (gap | (at["bars"] & (texts >= 2))))
        one = lambda c: (c & ~over).cast("int")
        return F.struct(
            over.alias("over"), (at["seen"] | table).alias("seen"), F.when(table, bars).otherwise(at["bars"]).alias("bars"), gap.alias("gap"), texts.alias("texts"),
            (at["lines"] + one(F.lit(True))).alias("lines"), (at["tables"] + one(table)).alias("tables"),
        )

    start = F.struct(*[F.lit(False).alias(c) for c in ("over", "seen", "bars", "gap")], *[F.lit(0).alias(c) for c in ("texts", "lines", "tables")])
    later = F.filter("lines", lambda x: x["line_no"] > F.col("hit"))
    walked = each.withColumn("end", F.aggregate(later, start, step))
    first = F.size(F.filter("lines", lambda x: x["line_no"] == F.col("hit")))
    span = F.slice(F.filter("lines", lambda x: x["line_no"] >= F.col("hit")), F.lit(1), first + F.col("end.lines"))
    local = F.filter("lines", lambda x: x["line_no"].between(F.col("hit") - window // 3, F.col("hit") + 2 * window // 3))
    found = walked.select("item", "doc_id", span.alias("span"), local.alias("local"), F.col("end.tables").alias("table_lines")).filter((F.size("span") > 0) & (F.size("local") > 0))
    text = lambda c: F.btrim(F.array_join(F.transform(c, lambda x: x["line"]), "\n"), F.lit(" \n\t\r"))
    found = found.select("item", "doc_id", "table_lines", text("span").alias("span"), text("local").alias("local"))
    good = (F.col("table_lines") >= 2) | (F.char_length("span") >= 500)
    return found.select("item", "doc_id", good.alias("is_table"), F.left(F.when(good, F.col("span")).otherwise(F.col("local")), F.lit(most)).alias("snippet"))
