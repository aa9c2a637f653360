"""Sentence index of documents and evidence located in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import document_priority, document_type, item_hint, sentence_kind, sentence_text, useful_line
from ..sources.stage import written

#: Abbreviations whose stops end no sentence, and how they are masked while sentences are cut.
PROTECTED = (("Fig.", "Fig§"), ("fig.", "fig§"), ("Dr.", "Dr§"), ("e.g.", "e§g§"), ("i.e.", "i§e§"), ("et al.", "et al§"))
BREAK = r"(?<=[.!?])\s+(?=[A-Z0-9\[])"
SHORT, LEAST = 25, 8


def marked_lines(docs: DataFrame) -> DataFrame:
    """Lines with the heading in force, the item hint carried down, and where they start.

    docs: doc_id, text. A heading's own hint holds for the heading only.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    w = Window.partitionBy("doc_id").orderBy("n")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    stripped = F.trim("line")
    heading = stripped.startswith("#")
    useful = useful_line(F.col("line")) & ~heading
    # the length goes through the windows by itself, so that a line is sorted once and not as it is and stripped
    lines = lines.withColumn("stripped", stripped).withColumn("is_heading", heading).withColumn("useful", useful).withColumn("_size", F.char_length("line") + 1)
    lines = lines.withColumn("start", F.sum("_size").over(upto) - F.col("_size")).drop("_size")
    own = F.when(F.col("useful"), item_hint(F.col("stripped"), F.lit(None).cast("string")))
    lines = lines.withColumn("hint", F.last(own, ignorenulls=True).over(upto))
    name = F.when(F.col("is_heading"), F.trim(F.regexp_replace("stripped", "^#+", "")))
    lines = lines.withColumn("heading", F.coalesce(F.last(name, ignorenulls=True).over(upto), F.lit("")))
    return lines.withColumn("hint", F.when(F.col("is_heading"), item_hint(F.col("stripped"), F.coalesce("hint", F.lit("")))).otherwise(F.coalesce("hint", F.lit(""))))


def segments(docs: DataFrame) -> DataFrame:
    """Headings, and paragraphs of useful lines that follow one another; doc_id, seg (line it begins at), start, text, heading, hint."""
    lines = marked_lines(docs)
    w = Window.partitionBy("doc_id").orderBy("n")
    before = F.coalesce(F.lag("useful").over(w), F.lit(False))
    begins = F.when(F.col("is_heading") | (F.col("useful") & ~before), F.col("n"))
    lines = lines.withColumn("seg", F.last(begins, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    body = lines.filter(F.col("is_heading") | F.col("useful"))
    content = F.when(F.col("is_heading"), F.col("heading")).otherwise(F.col("stripped"))
    grouped = body.groupBy("doc_id", "seg").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", content.alias("c")))), lambda x: x["c"]), " ").alias("text"),
        F.min_by(F.struct("start", "heading", "hint"), "n").alias("at"),
    )
    return grouped.select("doc_id", "seg", "at.start", F.trim("text").alias("text"), "at.heading", "at.hint")


def sentences(rows: DataFrame) -> DataFrame:
    """Sentence-like chunks of ``text`` with their spans; a chunk under 25 characters joins the one before it."""
    masked = F.col("text")
    for plain, mask in PROTECTED:
        masked = F.replace(masked, F.lit(plain), F.lit(mask))
    pieces, gaps = F.split(masked, BREAK), F.regexp_extract_all(masked, F.lit(BREAK), F.lit(0))
    cut = rows.withColumn("gaps", F.transform(gaps, lambda g: F.char_length(g))).select("*", F.posexplode(pieces).alias("i", "piece"))
    w = Window.partitionBy("doc_id", "seg").orderBy("i")
    # a piece goes through the windows with the length of its own gap, without those of the whole text
    cut = cut.withColumn("_gap", F.coalesce(F.get("gaps", F.col("i")), F.lit(0))).withColumn("_reach", F.char_length("piece") + F.col("_gap")).drop("gaps")
    cut = cut.withColumn("end", F.sum("_reach").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_gap")).drop("_gap", "_reach")
    cut = cut.withColumn("begin", F.col("end") - F.char_length("piece")).withColumn("raw", F.trim("piece")).filter("raw <> ''")
    opens = F.when((F.char_length("raw") >= SHORT) | (F.row_number().over(w) == 1), 1).otherwise(0)
    cut = cut.withColumn("chunk", F.sum(opens).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = cut.groupBy("doc_id", "seg", "start", "heading", "hint", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "raw"))), lambda x: x["raw"]), " ").alias("raw"), F.min("begin").alias("b"), F.max("end").alias("e")
    )
    return merged.withColumn("sentence", sentence_text(F.replace("raw", F.lit("§"), F.lit("."))))


def sentence_index(docs: DataFrame, stem: Column | None = None) -> DataFrame:
    """doc_id, sentence_no, heading, hint, kind, sentence, char_start, char_end; sentences under 8 characters are left out."""
    of_docs = written(segments(docs))
    # a heading may be as long as its document, and each sentence has it: it joins last, and goes through no sort of sentences
    none = F.lit("")
    found = sentences(of_docs.select("doc_id", "seg", "start", "text", none.alias("heading"), none.alias("hint"))).filter(F.char_length("sentence") >= LEAST)
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("seg", "chunk"))
    found = found.select("doc_id", "seg", "start", "b", "e", "sentence", number.alias("sentence_no"))
    heads = of_docs.select(F.col("doc_id").alias("_doc"), F.col("seg").alias("_seg"), "heading", "hint")
    found = found.join(heads.hint("merge"), found["doc_id"].eqNullSafe(heads["_doc"]) & (found["seg"] == heads["_seg"]))
    kind = sentence_kind(F.col("sentence"), F.col("heading"), F.lit("") if stem is None else stem)
    return found.select(
        "doc_id", "sentence_no", "heading", "hint", kind.alias("kind"), "sentence", (F.col("start") + F.col("b")).alias("char_start"), (F.col("start") + F.col("e")).alias("char_end")
    )


def unique_names(rows: DataFrame, base: str, order: str) -> DataFrame:
    """Base names made unique: the second in the order gets _2, the third _3."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(order))
    return rows.withColumn("n", n).withColumn("unique_name", F.when(F.col("n") == 1, F.col(base)).otherwise(F.concat_ws("_", base, F.col("n").cast("string")))).drop("n")


def document_context(docs: DataFrame) -> DataFrame:
    """Per document type, documents, lines and the priority."""
    kind = document_type(F.col("path"))
    counts = docs.groupBy(kind.alias("kind")).agg(F.count("*").alias("documents"), F.sum(F.size(F.split("text", "\n"))).alias("lines"))
    return counts.withColumn("priority", document_priority(F.col("kind")))


def located(needles: DataFrame, docs: DataFrame) -> DataFrame:
    """Per needle (id, needle), the first document with a hit, how it was hit, and where.

    Candidates share the needle's longest inner word with the document, so that no needle meets all documents.
    Needles of one or two words may begin and end inside words: they share three characters in a row.
    Hits are exact, without case, or with runs of white space as one; a document earlier in the order wins
    whatever its tier.
    """
    words = F.filter(F.split(F.lower(F.trim("needle")), r"\s+"), lambda x: x != "")
    inner = F.slice(words, F.lit(2), F.greatest(F.lit(0), F.size(words) - 2))  # its ends may be parts of words
    longest = F.array_max(F.transform(inner, lambda x: F.struct(F.char_length(x).alias("n"), x.alias("w"))))["w"]
    squeezed = lambda c: F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
    keyed = needles.withColumn("few", F.size(words) <= 2).withColumn("word", F.when(F.col("few"), F.left(squeezed(F.col("needle")), F.lit(3))).otherwise(longest)).filter("word <> ''")
    short = keyed.filter("few").select(F.char_length("word").alias("n")).distinct()  # 1, 2 and 3 at most
    cut = docs.select("doc_id", squeezed(F.col("text")).alias("t")).crossJoin(F.broadcast(short)).filter(F.char_length("t") >= F.col("n"))
    parts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length("t") - F.col("n") + 1), lambda i: F.substring("t", i, F.col("n"))))
    own = docs.select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("word"), F.lit(False).alias("few"))
    own = own.unionByName(cut.select("doc_id", F.explode(parts).alias("word"), F.lit(True).alias("few")))
    hit = keyed.join(own, ["word", "few"]).select("id", "needle", "doc_id").join(docs.select("doc_id", "text"), "doc_id")
    exact, loose = F.position("needle", "text"), F.position(F.lower("needle"), F.lower("text"))
    spaced = F.position(squeezed(F.col("needle")), squeezed(F.col("text")))
    tier = F.when(exact > 0, 1).when(loose > 0, 2).when(spaced > 0, 3)
    at = F.when(exact > 0, exact).when(loose > 0, loose).otherwise(spaced)
    found = hit.select("id", "doc_id", tier.alias("tier"), at.alias("at")).filter("tier is not null")
    return found.groupBy("id").agg(F.min(F.struct("doc_id", "tier", "at")).alias("best")).select("id", "best.doc_id", "best.tier", "best.at")


def first_with_all(sentences_: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group of terms, the first sentence that has all of them. groups: grp, terms; a small table of rules."""
    both = sentences_.join(F.broadcast(groups), F.forall("terms", lambda t: F.contains(F.lower(F.col("sentence")), t)))
    return both.groupBy("grp").agg(F.min(F.struct("doc_id", "sentence_no")).alias("first"), F.count("*").alias("hits")).select("grp", "first.doc_id", "first.sentence_no", "hits")


def dose_sentences(sentences_: DataFrame, required: str, any_of: tuple[str, ...], bonus: dict[str, int], by: list[str], most: int = 2) -> DataFrame:
    """Per group the best sentences that hold the required text and one of some terms; terms add to a base score of 10."""
    low = F.lower("sentence")
    hit = sentences_.filter(F.contains(low, F.lit(required)) & F.exists(F.array(*[F.lit(t) for t in any_of]), lambda t: F.contains(F.lower(F.col("sentence")), t)))
    score = sum((F.when(F.contains(low, F.lit(t)), n).otherwise(0) for t, n in bonus.items()), F.lit(10))
    ranked = hit.withColumn("score", score).withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "sid")))
    return ranked.filter(F.col("rank") <= most)
