"""Schema summaries per partition, mapping plans inferred from them, and evidence for cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import matcher_key, matcher_text, number

#: Parts of names that make a column more or less likely to identify rows.
GOOD_HINTS = ("figure", "panel", "group", "condition", "treatment", "formulation", "experiment", "model", "cargo", "method", "type", "label", "row", "col")
BAD_HINTS = ("smiles", "descriptor", "debug", "publication", "pmid", "link", "numeric", "mean", "std", "median", "count", "atoms", "rings", "volume", "weight", "logp", "refractivity")


def partition_schema(rows: DataFrame, values: int = 50) -> DataFrame:
    """Per partition and column of the payload, rows with text and the first distinct values, compared normalised.

    rows: partition_key, pos (the input order), payload.
    """
    cells = rows.select("partition_key", "pos", F.explode("payload").alias("column", "value")).withColumn("norm", matcher_text(F.col("value"))).filter("norm <> ''")
    first = cells.groupBy("partition_key", "column", "norm").agg(F.count("*").alias("n"), F.min(F.struct("pos", "value")).alias("at"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("partition_key", "column").orderBy("at")))
    kept = F.when(F.col("rank") <= values, F.struct("rank", F.col("at.value").alias("value")))
    return ranked.groupBy("partition_key", "column").agg(F.sum("n").alias("non_empty"), F.count("*").alias("distinct"), F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["value"]).alias("values"))


def ranked_columns(rows: DataFrame, most: int, sample: int = 300, pool: DataFrame | None = None) -> DataFrame:
    """Per partition, the columns most likely to identify rows, from names and the first rows: partition_key, column, score, rank.

    pool: partition_key, column, place of the columns to rank; ties then go by place, else by name.
    """
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("partition_key").orderBy("pos"))).filter(F.col("_n") <= sample)
    total = first.groupBy("partition_key").agg(F.count("*").alias("total"))
    cells = first.select("partition_key", F.explode("payload").alias("column", "value")).filter(F.trim("value") != "")
    per = cells.groupBy("partition_key", "column").agg(F.count_distinct(matcher_text(F.col("value"))).alias("distinct"), F.count_if(number(F.col("value")).isNotNull()).alias("numbers"))
    per = per.join(total, "partition_key").withColumn("name", matcher_key(F.col("column")))
    ratio, d = F.col("numbers") / F.greatest(F.col("total"), F.lit(1)), F.col("distinct")
    score = (
        F.when(F.col("name").rlike("|".join(GOOD_HINTS)), 4.0).otherwise(0.0) - F.when(F.col("name").rlike("|".join(BAD_HINTS)), 6.0).otherwise(0.0)
        + F.when((d > 1) & (d <= 80), 2.0).otherwise(0.0) - F.when(d > 120, 2.0).otherwise(0.0) - F.when((ratio > 0.8) & (d > 20), 4.0).otherwise(0.0) - F.char_length("name") / 100
    )
    scored = per.withColumn("score", score)
    if pool is not None:
        scored = scored.join(pool.select("partition_key", "column", "place"), ["partition_key", "column"])
    by = Window.partitionBy("partition_key").orderBy(F.desc("score"), "column" if pool is None else "place")
    return scored.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= most).select("partition_key", "column", "score", "rank", *(["place"] if pool is not None else []))


def same_name_relations(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """P5: per partition, source and target columns whose names agree. Both sides: partition_key, column."""
    s = sources.select("partition_key", "column", matcher_key(F.col("column")).alias("key"))
    t = targets.select("partition_key", F.col("column").alias("target_column"), matcher_key(F.col("column")).alias("key"))
    return s.join(t, ["partition_key", "key"]).select("partition_key", F.col("column").alias("source_column"), "target_column")


def disjoint_relations(candidates: DataFrame, order: str | None = None) -> DataFrame:
    """From candidate relations (partition_key, source_columns, target_column, score) the best ones that share no column.

    The pick goes down a partition's candidates by score, then the column ``order`` if one is named, then target and source columns; they are few (columns, not rows).
    """
    ties = F.lit(0) if order is None else F.col(order)
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), ties.alias("ties"), "target_column", "source_columns")))
    kind = "int" if order is None else candidates.schema[order].dataType.simpleString()
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("sources"), none.alias("targets"), F.array().cast(f"array<struct<s:double,ties:{kind},target_column:string,source_columns:array<string>>>").alias("kept"))

    def step(acc, x):
        free = ~F.arrays_overlap(acc["sources"], x["source_columns"]) & ~F.array_contains(acc["targets"], x["target_column"])
        grown = F.struct(F.concat(acc["sources"], x["source_columns"]).alias("sources"), F.array_append(acc["targets"], x["target_column"]).alias("targets"), F.array_append(acc["kept"], x).alias("kept"))
        return F.when(free, grown).otherwise(acc)

    typed = candidates.select("partition_key", "source_columns", "target_column", F.col("score").cast("double").alias("score"), *([order] if order else []))
    picked = typed.groupBy("partition_key").agg(best.alias("all")).select("partition_key", F.explode(F.aggregate("all", start, step)["kept"]).alias("k"))
    return picked.select("partition_key", "k.source_columns", "k.target_column", (-F.col("k.s")).alias("score"))


def checked_plans(plans: DataFrame, columns: DataFrame) -> DataFrame:
    """Plans without relations on unknown columns, with known modes, and review asked for where nothing is left.

    columns: partition_key, source_columns, target_columns, the names that there are.
    """
    both = plans.join(columns, "partition_key", "left")
    known = F.filter(
        "relations",
        lambda r: (F.size(r["source_columns"]) > 0) & (F.size(r["target_columns"]) > 0)
        & F.forall(r["source_columns"], lambda c: F.array_contains("known_source", c)) & F.forall(r["target_columns"], lambda c: F.array_contains("known_target", c)),
    )
    good = F.transform(known, lambda r: r.withField("mode", F.when(r["mode"].isin("exact", "value_map", "contains", "token_overlap"), r["mode"]).when(F.size(r["value_pairs"]) > 0, "value_map").otherwise("exact")))
    out = both.withColumn("relations", good)
    review = F.col("needs_review") | (F.size("relations") == 0) | ~F.array_contains("known_source", F.col("source_value_column"))
    return out.withColumn("needs_review", review).drop("known_source", "known_target")


def plan_summary(plans: DataFrame) -> DataFrame:
    """One line per plan."""
    return plans.select("partition_key", F.size("relations").alias("relations"), "confidence", "needs_review")


def cell_evidence(cells: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence for cells (row_id, item_id, column): same item, the column supported, and the row named or the scope the item.

    evidence: evidence_id, item_id, columns, rows, scope.
    """
    each = evidence.select("evidence_id", "item_id", "scope", "rows", F.explode("columns").alias("column"))
    hit = cells.join(each, ["item_id", "column"]).filter((F.col("scope") == "item") | F.array_contains("rows", F.col("row_id")))
    return hit.select("row_id", "item_id", "column", "evidence_id").distinct()


def columns_by_position(cells: DataFrame) -> DataFrame:
    """Elements in reading order with the one before and after and the rows between."""
    w = Window.partitionBy("sheet").orderBy("r1", "c1")
    out = cells.withColumn("place", F.row_number().over(w)).withColumn("before", F.lag("r2").over(w))
    return out.withColumn("rows_between", F.when(F.col("before").isNotNull(), F.greatest(F.lit(0), F.col("r1") - F.col("before") - 1))).drop("before")


def grouped_elements(placed: DataFrame, most: int = 2) -> DataFrame:
    """Neighbours in reading order go together while at most ``most`` rows lie between and both hold numbers."""
    w = Window.partitionBy("sheet").orderBy("place")
    together = (F.coalesce("rows_between", F.lit(999)) <= most) & (F.col("numbers") > 0) & (F.lag("numbers").over(w) > 0)
    return placed.withColumn("_opens", F.when(F.coalesce(together, F.lit(False)), 0).otherwise(1)).withColumn("grp", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")


def mean_by_cell(pixels: DataFrame, cells: DataFrame, margin: float = 0.2) -> DataFrame:
    """Mean of the pixels inside each cell's box, without a margin at its sides. Pixels meet cells by figure and row band."""
    inner = cells.select(
        "figure", "cell", (F.col("x1") + (F.col("x2") - F.col("x1")) * margin).alias("x1"), (F.col("x2") - (F.col("x2") - F.col("x1")) * margin).alias("x2"),
        (F.col("y1") + (F.col("y2") - F.col("y1")) * margin).alias("y1"), (F.col("y2") - (F.col("y2") - F.col("y1")) * margin).alias("y2"),
    )
    banded = inner.withColumn("y", F.explode(F.sequence(F.ceil("y1"), F.floor("y2"))))
    return pixels.join(banded, ["figure", "y"]).filter("x >= x1 and x <= x2").groupBy("figure", "cell").agg(F.avg("value").alias("mean"), F.count("*").alias("pixels"))
