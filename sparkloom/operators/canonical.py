"""Canonical value and target rows from tables of any columns, provenance predicates, and evidence assets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import given, item_key, item_mentions, number, panel_letter, percent_number
from ..functions.values import padded
from .tables import find_column

#: Loose names under which canonical columns may stand in a table.
VALUE_COLUMNS = {
    "figure_name": ("figure_name", "Figure", "Item_ID", "Item"), "box_id": ("box_id", "box"), "x_label": ("X_Label", "x_label", "xlabel"), "group_label": ("Group", "group", "matched_class_label"),
    "row_label": ("row_label", "rowlabel"), "col_label": ("col_label", "collabel"), "metric_type": ("metric_type", "metric", "Type", "type"), "unit": ("unit", "units"),
    "x_pixel": ("x_pixel", "xpixel"), "y_pixel": ("y_pixel", "ypixel"),
}
TARGET_COLUMNS = {
    "item_id": ("Item_ID", "item"), "figure_name": ("figure_name", "Figure"), "formulation_name": ("Formulation_Name", "formulation", "IL_name"), "group_label": ("Group", "group"), "metric_type": ("metric_type", "Experiment_method"),
}
UNKNOWN = "unknown_figure_table"
FILE_WORDS = ("\\", "/users/", "/home/", ".xlsx", ".csv", ".png", ".jpg", ".pdf")


def _named(df: DataFrame, names: dict[str, tuple[str, ...]]) -> list[Column]:
    found = {out: find_column(df.columns, list(c)) for out, c in names.items()}
    return [(given(F.col(f"`{c}`")) if c else F.lit("")).alias(out) for out, c in found.items()]


def _row_text(df: DataFrame, without: set[str]) -> Column:
    cells = [F.nullif(F.trim(given(F.col(f"`{c}`"))), F.lit("")) for c in df.columns if c not in without]
    return F.concat_ws(" | ", *cells)


def value_rows(df: DataFrame, value_column: str, source: str, row: str, mapped: Column | None = None, prefix: str = "EV") -> DataFrame:
    """canonical value rows. ``source`` and ``row`` name the columns of provenance; the row number gives the id.

    The mapped key wins, else the key that figure name, row and column names and source give.
    """
    inside = df.drop(source, row)
    names = _named(inside, VALUE_COLUMNS)
    context = _row_text(df, {source, row})
    own = item_key(names[0], context, F.lit(" | ".join(inside.columns)), F.col(source))
    df = df.withColumn("_own", own)  # told once a row, and not again for each column that names it
    own = F.col("_own")
    key = own if mapped is None else F.coalesce(F.nullif(mapped, F.lit("")), own)
    text = given(F.col(f"`{value_column}`"))
    payload = F.create_map(*[x for c in inside.columns for x in (F.lit(c), given(F.col(f"`{c}`")))])
    return df.select(
        F.concat(F.lit(prefix), padded(F.col(row), 8)).alias("expval_id"), F.col(source).alias("source_file"), F.col(row).alias("source_row"), *names,
        own.alias("item_id"), panel_letter(names[0]).alias("panel_id"), key.alias("figure_key"), F.coalesce(F.nullif(key, F.lit("")), F.lit(UNKNOWN)).alias("partition_key"),
        number(text).alias("value"), text.alias("value_text"), payload.alias("payload"), (text == "").alias("manual_required"), F.when(text == "", "missing value").otherwise("").alias("normalization_warning"),
    )


def target_rows(df: DataFrame, value_column: str, source: str, row: str, mapped: Column | None = None, prefix: str = "LN") -> DataFrame:
    """canonical target rows. Here the key that the row gives wins, and the mapped key is what is left."""
    inside = df.drop(source, row)
    names = _named(inside, TARGET_COLUMNS)
    own = item_key(names[0], names[1], _row_text(df, {source, row}))
    key = own if mapped is None else F.coalesce(F.nullif(own, F.lit("")), mapped)
    text = given(F.col(f"`{value_column}`"))
    payload = F.create_map(*[x for c in inside.columns for x in (F.lit(c), given(F.col(f"`{c}`")))])
    return df.select(
        F.concat(F.lit(prefix), padded(F.col(row), 8)).alias("target_row_id"), F.col(source).alias("source_file"), F.col(row).alias("source_row"), *names,
        key.alias("figure_key"), F.coalesce(F.nullif(key, F.lit("")), F.lit(UNKNOWN)).alias("partition_key"), text.alias("existing_value_text"), payload.alias("payload"),
    )


def mapped_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows with the key that a map of files gives; ``unknown`` counts as none."""
    known = keys.filter(~F.lower("mapped_key").isin("", "unknown")).groupBy(*on).agg(F.max("mapped_key").alias("mapped_key"))
    return rows.join(known, on, "left").withColumn("mapped_key", F.coalesce("mapped_key", F.lit("")))


def numeric_to_skip(cells: DataFrame) -> DataFrame:
    """numeric cells that are an axis: in the first column, of rows that hold other numbers as well."""
    n = cells.withColumn("numeric", percent_number(F.col("value")) != "")
    w = Window.partitionBy("sheet", "r")
    return n.withColumn("skip", F.col("numeric") & (F.col("c") == F.min("c").over(w)) & (F.count_if("numeric").over(w) > 1)).drop("numeric")


def ignored_reference(column: str, value: Column) -> Column:
    """values that are blank, paths, links, file names, or over 160 characters; ids and words for missing are not."""
    text = F.trim(given(value))
    low = F.lower(text)
    if column.lower().endswith("id"):
        return text == ""
    files = F.exists(F.array(*[F.lit(w) for w in FILE_WORDS]), lambda w: F.contains(low, w))
    path = low.rlike(r"^[a-z]:[\\/]") | low.rlike(r"^(/|\\|https?://)")
    return (text == "") | (~low.isin("nan", "none", "null", "n/a") & (path | files | (F.char_length(text) > 160)))


def says_any(columns: list[str], terms: list[str]) -> Column:
    """whether the joined text of the columns contains one of the terms, without case."""
    hay = F.lower(F.concat_ws(" ", *[given(F.col(c)) for c in columns]))
    return F.exists(F.array(*[F.lit(t.lower()) for t in terms]), lambda t: F.contains(hay, t))


def export_rows(df: DataFrame, row_id: str, drop: list[str], blank: list[str]) -> DataFrame:
    """the row id first, listed columns left out, others forced blank."""
    rest = [c for c in df.columns if c not in {row_id, *drop}]
    return df.select(row_id, *[F.lit("").alias(c) if c in blank else F.col(c) for c in rest])


def evidence_assets(rows: DataFrame, panels: DataFrame, documents: DataFrame) -> DataFrame:
    """Per row (id, item, base, supplementary) the panel's asset, else the item's base asset, else the document by kind, with its status."""
    own = rows.join(panels.select("item", F.col("asset").alias("own")), "item", "left")
    base = own.join(panels.select(F.col("item").alias("base"), F.col("asset").alias("of_base")), "base", "left")
    doc = base.join(F.broadcast(documents), "supplementary", "left")
    status = F.when(F.col("own").isNotNull(), "panel").when(F.col("of_base").isNotNull(), "base").when(F.col("document").isNotNull(), "document").otherwise("none")
    return doc.select("id", F.coalesce("own", "of_base", "document", F.lit("")).alias("asset"), status.alias("status"))


def mentioned_items(rows: DataFrame, text: str, allowed: DataFrame) -> DataFrame:
    """Rows with the items they mention that the allow-list (item) has."""
    return rows.withColumn("item", F.explode(item_mentions(F.col(text)))).join(allowed, "item", "left_semi")


def verdicts(rows: DataFrame, block: str, value: str, label: str) -> DataFrame:
    """Per block, rows, rows with numbers and labels, and the verdict: ok, no_numbers, no_labels or empty."""
    numbers, labels = F.count_if(number(F.col(value)).isNotNull()), F.count_if(F.trim(given(F.col(label))) != "")
    per = rows.groupBy(block).agg(F.count("*").alias("rows"), numbers.alias("numbers"), labels.alias("labels"))
    return per.withColumn("verdict", F.when((F.col("numbers") == 0) & (F.col("labels") == 0), "empty").when(F.col("numbers") == 0, "no_numbers").when(F.col("labels") == 0, "no_labels").otherwise("ok"))


def block_items(tables: list[DataFrame], block: str, items: str) -> DataFrame:
    """A4: the distinct items of each block, from several tables whose cells list them."""
    out = None
    for t in tables:
        each = t.select(block, F.explode(F.split(items, "[|;,]")).alias("item")).select(block, F.trim("item").alias("item")).filter("item <> ''")
        out = each if out is None else out.unionByName(each)
    return out.groupBy(block).agg(F.array_join(F.array_sort(F.collect_set("item")), "|").alias("items"))


def sheet_keys(rows: DataFrame, by: list[str], text: str) -> DataFrame:
    """P10: the figure key that each sheet's rows name most often, with confidence and whether to look at it.

    Equals go to the first key. A key that all keyed rows agree on is high, a majority medium, else low.
    """
    keyed = rows.select(*by, item_key(F.col(text)).alias("key"))
    counts = keyed.filter("key <> ''").groupBy(*by, "key").agg(F.count("*").alias("n"))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("m"), "key")).alias("b"), F.sum("n").alias("keyed"), F.count("*").alias("keys"))
    out = keyed.groupBy(*by).agg(F.count("*").alias("rows")).join(best, by, "left")
    top = -F.col("b.m")
    band = F.when(F.col("keys") == 1, "high").when(2 * top > F.col("keyed"), "medium").otherwise("low")
    return out.select(*by, F.coalesce("b.key", F.lit("")).alias("figure_key"), band.alias("confidence"), (band == "low").alias("needs_review"))


def example_values(df: DataFrame, columns: list[str], order: str, most: int = 30) -> DataFrame:
    """Per column the first distinct values that say something, in the order of the rows."""
    cells = df.select(F.col(order).alias("pos"), *[given(F.col(c)).alias(c) for c in columns]).unpivot(["pos"], columns, "column", "value")
    first = cells.filter(~F.lower(F.trim("value")).isin("", "na", "n/a", "nan", "none")).groupBy("column", F.trim("value").alias("value")).agg(F.min("pos").alias("pos"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy("pos", "value"))).filter(F.col("rank") <= most)
    return ranked.groupBy("column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]), "|").alias("values"))


def asset_items(rows: DataFrame, selected: DataFrame, asset: str, item: str) -> DataFrame:
    """Per asset the selected items that show it; a panel suffix names the panel, an asset of one item needs none."""
    kept = rows.join(selected.select(item), item, "left_semi")
    per = kept.groupBy(asset).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return per.select(asset, F.array_join("items", "|").alias("items"), F.array_join(F.transform("items", lambda x: F.regexp_extract(x, "[0-9]([a-z])$", 1)), "").alias("panels"), (F.size("items") == 1).alias("single"))


def completeness(df: DataFrame, required: list[str], allowed: dict[str, list[str]], references: DataFrame, key: str) -> DataFrame:
    """One line per check of a stage's output: rows, missing columns, values not allowed, referenced keys that are not there."""
    missing = ",".join(c for c in required if c not in df.columns)
    bad = [F.count_if(~given(F.col(c)).isin(*v)).alias(f"bad_{c}") for c, v in allowed.items()]
    own = df.agg(F.count("*").alias("rows"), *bad)
    lost = references.select(key).distinct().join(df.select(key), key, "left_anti").agg(F.count("*").alias("lost"))
    return own.crossJoin(F.broadcast(lost)).withColumn("missing_columns", F.lit(missing))
