"""Selection, schema, de-duplication, reshape, profiling and report operators on tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import comparison_text, given, matcher_text, number
from ..functions.values import padded
from ..sources.stage import written

#: Words for a missing value in experiment keys.
NA_WORDS = ("", "na", "n/a", "nan", "none", "null", "not available", "not applicable", "not reported", "unknown", "-")


def find_column(columns: list[str], candidates: list[str]) -> str | None:
    """by name without case and signs, candidates in order, later duplicates first; else by containment, columns in order."""
    plain = lambda x: "".join(ch for ch in x.lower() if ch.isascii() and ch.isalnum())
    by_name = {plain(c): c for c in columns}
    for c in candidates:
        if plain(c) in by_name:
            return by_name[plain(c)]
    return next((col for col in columns for c in candidates if plain(c) and plain(c) in plain(col)), None)


def table_type(columns: list[str]) -> str:
    """what a value table is, from its column names."""
    names = {"".join(ch for ch in c.lower() if ch.isalnum()) for c in columns}
    if "xlabel" in names:
        return "bar_plot"
    if {"rowlabel", "collabel"} <= names:
        return "heatmap_long"
    return "matrix" if len(names) > 2 else "unknown"


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """the given columns in order, trimmed text; missing ones and blanks take the default."""
    have = set(df.columns)
    return df.select(*[
        F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(default)).alias(c) if c in have else F.lit(default).alias(c) for c, default in columns.items()
    ])


def select_with_override(df: DataFrame, manual: Column, automatic: Column) -> DataFrame:
    """rows that a manual yes picks, or an automatic rule where the manual value is blank; all rows if none is picked."""
    said = F.lower(F.trim(given(manual)))
    picked = F.when(said.isin("1", "true", "yes", "y"), True).when(said == "", automatic).otherwise(False)
    marked = df.withColumn("_picked", F.coalesce(picked, F.lit(False)))
    any_ = marked.agg(F.max("_picked").alias("_any"))  # one row
    return marked.crossJoin(F.broadcast(any_)).filter(F.col("_picked") | ~F.coalesce("_any", F.lit(False))).drop("_picked", "_any")


def split_covered(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with ``covered``: whether any match column says something."""
    return df.withColumn("covered", F.exists(F.array(*[F.lower(F.trim(given(F.col(c)))) for c in columns]), lambda v: ~v.isin("", "nan", "none", "[]")))


def facets(df: DataFrame, equal: dict[str, list], search: str, columns: list[str]) -> DataFrame:
    """F8: rows that have one of the values in each facet, and the search text in the columns, raw or normalised."""
    for c, values in equal.items():
        df = df.filter(F.col(c).isin(*values))
    hay = F.lower(F.concat_ws(" ", *columns))
    return df.filter(F.contains(hay, F.lit(search.lower())) | F.contains(comparison_text(hay), comparison_text(F.lit(search))))


def slice_rows(df: DataFrame, order: list[str], start: int, count: int) -> DataFrame:
    """rows start .. start + count - 1 of an explicit order. Spark keeps only the first start + count of each task."""
    top = df.orderBy(*order).limit(start + count - 1)
    return top.withColumn("_n", F.row_number().over(Window.orderBy(*order))).filter(F.col("_n") >= start).drop("_n")


def sequence_ids(df: DataFrame, order: list[str], prefix: str, width: int = 6, name: str = "row_id") -> DataFrame:
    """Zero-padded ids in the given order, without gathering the rows in one task.

    Rows are range-partitioned by the order; each partition counts on from the totals of those before it,
    of which there is one per partition.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    # written, so that the ranges, which Spark samples anew for each use, are drawn once
    inside = written(spread.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order))))
    totals = inside.groupBy("_p").agg(F.count("*").alias("_rows"))
    before = totals.select("_p", F.coalesce(F.sum("_rows").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = inside.join(F.broadcast(before), "_p").withColumn(name, F.concat(F.lit(prefix), padded(F.col("_i") + F.col("_before"), width)))
    return numbered.drop("_p", "_i", "_before")


def first_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the order. The minimum is taken in the tasks before rows are moved."""
    rest = [c for c in df.columns if c not in key]
    lead = F.struct(*order, *[c for c in rest if c not in order])
    return df.groupBy(*key).agg(F.min(lead).alias("_row")).select(*key, *[F.col("_row")[c].alias(c) for c in rest]).select(df.columns)


def experiment_value(c: Column) -> Column:
    """Text for comparing experiments: words for missing values become NA, spaces and case do not count."""
    text = F.lower(F.trim(F.regexp_replace(given(c), r"\s+", " ")))
    return F.when(text.isin(*NA_WORDS), "NA").otherwise(text)


def same_experiment(df: DataFrame, item: str, columns: list[str], order: list[str]) -> DataFrame:
    """U4: df with the experiment key and ``kept``: the first row of each key within its item stays."""
    key = F.array_join(F.array(*[experiment_value(F.col(c)) for c in columns]), "|")
    keyed = df.withColumn("experiment_key", key)
    w = Window.partitionBy(item, "experiment_key").orderBy(*order)
    return keyed.withColumn("kept", F.row_number().over(w) == 1)


def matrix_to_long(df: DataFrame, row_label: str) -> DataFrame:
    """row_label, col_label, value for each cell that is not blank."""
    others = [c for c in df.columns if c != row_label]
    long = df.select(row_label, *[F.col(c).cast("string").alias(c) for c in others]).unpivot([row_label], others, "col_label", "value")
    return long.filter(F.trim(given(F.col("value"))) != "")


def long_to_matrix(df: DataFrame, row: str, col: str, value: str, columns: list) -> DataFrame:
    """R2: a row for each row label, a column for each named column label, the first value in each cell."""
    return df.groupBy(row).pivot(col, columns).agg(F.min(value))


def explode_list(df: DataFrame, column: str) -> DataFrame:
    """A row for each part of a comma list; a blank list keeps its row."""
    parts = F.filter(F.transform(F.split(given(F.col(column)), ","), lambda x: F.trim(x)), lambda x: x != "")
    return df.withColumn(column, F.explode_outer(F.nullif(parts, F.array().cast("array<string>")))).withColumn(column, F.coalesce(column, F.lit("")))


def explode_product(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Every combination of the parts of several list columns, distinct; an empty list counts as one blank."""
    for name, parts in columns.items():
        df = df.withColumn(name, F.explode(F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))))
    return df.distinct()


def column_profile(df: DataFrame, keys: list[str], top: int = 3) -> DataFrame:
    """Per column, cells with text, distinct values, and the most frequent with their counts (ties by value)."""
    others = [c for c in df.columns if c not in keys]
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in others]).unpivot([], others, "column", "value").filter(F.trim(given(F.col("value"))) != "")
    counts = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("non_empty"), F.count("*").alias("distinct"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))).filter(F.col("rank") <= top)
    lists = ranked.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("top"))
    return totals.join(lists, "column").select("column", "non_empty", "distinct", F.array_join(F.transform("top", lambda x: F.concat_ws("=", x["value"], x["n"].cast("string"))), "|").alias("top"))


def numeric_column(payloads: DataFrame, ignored: list[str]) -> DataFrame:
    """Per partition, the column of most numeric cells; of equals, the greatest name."""
    cells = payloads.select("partition_key", F.explode("payload").alias("column", "value")).filter(~F.col("column").isin(*ignored))
    counts = cells.groupBy("partition_key", "column").agg(F.count_if(number(F.col("value")).isNotNull()).alias("numbers")).filter("numbers > 0")
    return counts.groupBy("partition_key").agg(F.max(F.struct("numbers", "column")).alias("best")).select("partition_key", F.col("best.column").alias("value_column"), F.col("best.numbers").alias("numbers"))


def overlap_coverage(sources: DataFrame, targets: DataFrame, tuples: int = 250, values: int = 40) -> DataFrame:
    """Per partition, source column and target column, the share of distinct source values that stand in just one target value.

    sources and targets: partition_key, column, value, pos (the input order, which decides what the limits keep).
    The limits are part of the measure: of more than ``tuples`` source values the next one counts in the
    denominator only.
    """
    def firsts(cells: DataFrame, most: int) -> DataFrame:
        norm = cells.withColumn("norm", matcher_text(F.col("value"))).filter("norm <> ''")
        each = norm.groupBy("partition_key", "column", "norm").agg(F.min("pos").alias("pos"))
        return each.withColumn("n", F.row_number().over(Window.partitionBy("partition_key", "column").orderBy("pos", "norm"))).filter(F.col("n") <= most)

    s, t = firsts(sources, tuples + 1), firsts(targets, values)
    seen = s.groupBy("partition_key", "column").agg(F.count("*").alias("observed"))
    t = t.select("partition_key", F.col("column").alias("target_column"), F.col("norm").alias("target_norm"))
    hits = s.filter(F.col("n") <= tuples).join(t, "partition_key").filter(F.contains("target_norm", F.col("norm")))
    once = hits.groupBy("partition_key", "column", "target_column", "norm").agg(F.count("*").alias("k")).filter("k = 1")
    met = once.groupBy("partition_key", "column", "target_column").agg(F.count("*").alias("matched"))
    return met.join(seen, ["partition_key", "column"]).select("partition_key", "column", "target_column", "matched", "observed", (F.col("matched") / F.col("observed")).alias("coverage"))


def base_groups(items: DataFrame, base: Column, item: Column) -> DataFrame:
    """A1: the sorted distinct panels of each base item."""
    return items.groupBy(base.alias("base")).agg(F.array_join(F.array_sort(F.collect_set(item)), "|").alias("panels"))


def without_parents(items: DataFrame, item: str) -> DataFrame:
    """A2: distinct items without those of which a panel (the item and one letter) is there."""
    each = items.select(item).distinct()
    parents = each.filter(F.col(item).rlike("[a-z]$")).select(F.rtrim(F.regexp_replace(item, "[a-z]$", "")).alias("_parent")).distinct()
    return each.join(parents, F.col(item) == F.col("_parent"), "left_anti")


def six_digits(c: Column) -> Column:
    """A number in six significant digits, without trailing zeros; plain for exponents from -5 to 5."""
    exponent = F.floor(F.log10(F.abs(c)))
    rounded = F.when(c == 0, F.lit(0.0)).otherwise(F.round(c * F.pow(F.lit(10.0), 5 - exponent)) / F.pow(F.lit(10.0), 5 - exponent))
    return F.regexp_replace(F.format_string("%.10f", rounded), r"\.?0+$", "")


def replicates(cells: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """A3: per group its numbers in the order, how many there are, their mean in six digits, and whether they are replicates or single."""
    n = number(F.col(value))
    per = cells.filter(n.isNotNull()).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("all"), F.count("*").alias("replicates"), F.avg(n).alias("mean")
    )
    kind = F.when(F.col("replicates") > 1, "replicate_mean").otherwise("single_value")
    return per.select(*by, F.array_join(F.transform("all", lambda x: x["v"]), "|").alias("original_values"), "replicates", "mean", six_digits(F.col("mean")).alias("aggregated_value"), kind.alias("replicate_type"))


def count_diagnostics(actual: DataFrame, expected: DataFrame, key: str, tolerance: float = 0.1) -> DataFrame:
    """Expected against actual numbers, with the verdict: match, near (within the tolerance), short or over."""
    both = expected.join(actual, key, "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    ratio = F.abs(F.col("actual") - F.col("expected")) / F.col("expected")
    verdict = F.when(F.col("expected") == 0, "unknown").when(F.col("actual") == F.col("expected"), "match").when(ratio <= tolerance, "near").when(F.col("actual") < F.col("expected"), "short").otherwise("over")
    return both.select(key, "expected", "actual", verdict.alias("verdict"))
