"""Sheets as tables of occupied cells (sheet, r, c, value): bands, components, boxes and label context."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import matcher_key, percent_number
from ..functions.values import gap, overlap, padded
from ..sources.stage import written


def _islands(rows: DataFrame, by: list[str], at: str, name: str) -> DataFrame:
    """Distinct positions with the first position of the unbroken run that each is in."""
    each = rows.select(*by, at).distinct()
    w = Window.partitionBy(*by).orderBy(at)
    opens = F.when(F.coalesce(F.col(at) - F.lag(at).over(w), F.lit(2)) > 1, F.col(at))
    return each.withColumn(name, F.last(opens, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def bands(cells: DataFrame) -> DataFrame:
    """G1: blocks between blank rows, and inside them between blank columns: sheet, r1, r2, c1, c2, cells, numbers."""
    filled = cells.filter(F.trim("value") != "")
    in_band = filled.join(_islands(filled, ["sheet"], "r", "band"), ["sheet", "r"])
    in_block = in_band.join(_islands(in_band, ["sheet", "band"], "c", "block"), ["sheet", "band", "c"])
    number = percent_number(F.col("value")) != ""
    out = in_block.groupBy("sheet", "band", "block").agg(
        F.max("c").alias("c2"), F.count("*").alias("cells"), F.count_if(number).alias("numbers")
    )
    ends = in_band.groupBy("sheet", "band").agg(F.max("r").alias("r2"))
    return out.join(ends, ["sheet", "band"]).select("sheet", F.col("band").alias("r1"), "r2", F.col("block").alias("c1"), "c2", "cells", "numbers")


def block_kind(rows, cols, numbers, words, first_row_words):
    """The kind of a block from its counts; the first rule that holds."""
    return (
        F.when((rows <= 2) & (numbers == 0), F.when(words <= 6, "table_title").otherwise("note"))
        .when((rows >= 12) & (cols >= 8) & (numbers >= 10), "multi_table")
        .when((numbers >= 3) & (first_row_words > 0), "title_and_table")
        .when((numbers >= F.greatest(F.lit(3), words)) & (rows >= 2), "table_body")
        .when((rows <= 3) & (words > numbers), "note")
        .otherwise("other")
    )


def components(cells: DataFrame) -> DataFrame:
    """4-connected components of occupied cells: sheet, r, c1, c2 (a run of cells in a row) and component, its smallest run.

    Cells of a row form runs; runs of neighbouring rows are linked where they overlap. Labels are numbers
    r * 2**20 + c1. Bands of rows are linked first; between them the smallest label spreads along the links, twice
    as far in each round by taking the label of the label; each round is written, so that plans do not grow.
    """
    filled = cells.filter(F.trim("value") != "").select("sheet", "r", "c").distinct()
    return linked_runs(_islands(filled, ["sheet", "r"], "c", "c1").groupBy("sheet", "r", "c1").agg(F.max("c").alias("c2")))


#: Rows of a sheet whose runs are linked in one task; runs of neighbouring bands are linked after, by their components.
BAND = 64


def _band_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs, sorted by band (``key``), row and column, with ``component``, the smallest run that they are linked with inside their band."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        starts = _starts(table["key"])
        yield from _linked(table.slice(0, starts[-1]), starts[:-1])
        rest = table.slice(starts[-1])  # the last band may go on
    if rest is not None:
        yield from _linked(rest, _starts(rest["key"]))


def _starts(key: pa.ChunkedArray) -> np.ndarray:
    """Where another key begins."""
    other = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1))
    return np.append(0, np.flatnonzero(other.to_numpy()) + 1) if len(key) else np.zeros(1, np.int64)


def _linked(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(table):
        return
    r, c1, c2 = (table[c].to_numpy() for c in ("r", "c1", "c2"))
    ends = np.append(starts[1:], len(r))
    height = r[ends - 1] - r[starts] + 2  # a row between bands stays empty
    row = (r + np.repeat(np.cumsum(height) - height - r[starts], ends - starts)) << 24  # labels have 20 bits for columns
    low = np.searchsorted(row + c2, row - (1 << 24) + c1)
    high = np.searchsorted(row + c1, row - (1 << 24) + c2, side="right")
    n = np.maximum(high - low, 0)
    here = np.repeat(np.arange(len(r)), n)
    above = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    label, moved = np.arange(len(r)), True  # runs are in order, so that the smallest place is the smallest run
    while moved:
        before, least = label, np.minimum(label[here], label[above])
        label = label.copy()
        for end in (here, above, before[here], before[above]):
            np.minimum.at(label, end, least)
        label = label[label]
        moved = (label != before).any()
    found = table.drop_columns(["key"]).append_column("component", pa.array(r[label] * (1 << 20) + c1[label]))
    yield from found.combine_chunks().to_batches()


def linked_runs(runs: DataFrame) -> DataFrame:
    """Runs (sheet, r, c1, c2, apart in their row) with the smallest run of their component.

    Runs of a band of rows are linked in one task, so that only components that touch the edge of a band go through
    the rounds in which labels spread.
    """
    given = [F.col(c).cast(runs.schema[c].dataType) for c in ("r", "c1", "c2")]
    runs = runs.filter("sheet is not null").select("sheet", F.col("r").cast("long").alias("r"), F.col("c1").cast("long").alias("c1"), F.col("c2").cast("long").alias("c2"))
    shape = runs.withColumn("component", F.lit(0).cast("long")).schema
    bands_ = runs.withColumn("band", F.floor(F.col("r") / BAND)).repartition("sheet", "band").sortWithinPartitions("sheet", "band", "r", "c1")
    found = written(bands_.select(*runs.columns, F.to_json(F.struct("sheet", "band")).alias("key")).mapInArrow(_band_components, shape))
    edge = lambda at, r, c: found.filter(F.pmod("r", F.lit(BAND)) == at).select("sheet", r.alias("r"), F.col("c1").alias(f"{c}1"), F.col("c2").alias(f"{c}2"), F.col("component").alias(c))
    links = edge(0, F.col("r"), "a").join(edge(BAND - 1, F.col("r") + 1, "b"), ["sheet", "r"]).filter("a1 <= b2 and b1 <= a2")
    links = written(links.select("sheet", "a", "b").distinct())
    if links.isEmpty():
        return found.select("sheet", *given, "component")
    both = links.select("sheet", F.col("a").alias("run"), F.col("b").alias("other"))
    both = written(both.unionByName(links.select("sheet", F.col("b").alias("run"), F.col("a").alias("other"))))
    labels = _spread(both)
    return found.withColumnRenamed("component", "run").join(labels, ["sheet", "run"], "left").withColumn("component", F.coalesce("component", "run")).select("sheet", *given, "component")


def _spread(links: DataFrame) -> DataFrame:
    """sheet, run, component: the smallest number that a run is linked with; links go both ways."""
    labels = written(links.select("sheet", "run", F.col("run").alias("component")).distinct())
    moved = True
    while moved:
        near = links.join(labels.select("sheet", F.col("run").alias("other"), "component"), ["sheet", "other"]).groupBy("sheet", "run").agg(F.min("component").alias("near"))
        lower = labels.join(near, ["sheet", "run"], "left").withColumn("low", F.least("component", "near"))
        of_low = labels.select("sheet", F.col("run").alias("low"), F.col("component").alias("jump"))
        after = written(lower.join(of_low, ["sheet", "low"]).select("sheet", "run", F.least("low", "jump").alias("component"), (F.least("low", "jump") < F.col("component")).alias("moved")))
        labels = after.select("sheet", "run", "component")
        moved = not after.filter("moved").isEmpty()
    return labels


def dilated(cells: DataFrame, rows: int = 0, cols: int = 1, first: int = 1) -> DataFrame:
    """Runs (sheet, r, c1, c2) of the places at most ``rows`` and ``cols`` from an occupied cell, within the sheet.

    A run of cells grows as a whole and is repeated in the rows around it; what overlaps or touches in a row
    becomes one run. A sheet begins at row and column ``first`` and ends at its last occupied ones.
    """
    filled = cells.filter(F.trim("value") != "").select("sheet", "r", "c").distinct()
    ends = filled.groupBy("sheet").agg(F.max("r").alias("last_r"), F.max("c").alias("last_c"))
    runs = _islands(filled, ["sheet", "r"], "c", "a").groupBy("sheet", "r", "a").agg(F.max("c").alias("b")).join(ends, "sheet")
    grown = runs.select(
        "sheet", F.explode(F.sequence(F.greatest(F.lit(first), F.col("r") - rows), F.least("last_r", F.col("r") + rows))).alias("r"),
        F.greatest(F.lit(first), F.col("a") - cols).alias("a"), F.least("last_c", F.col("b") + cols).alias("b"),
    )
    w = Window.partitionBy("sheet", "r").orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = grown.withColumn("opens", F.when(F.col("a") > F.coalesce(reach, F.lit(first - 2)) + 1, F.col("a")))
    opens = opens.withColumn("c1", F.last("opens", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return opens.groupBy("sheet", "r", "c1").agg(F.max("b").alias("c2"))


def layout_boxes(cells: DataFrame, merged: DataFrame | None = None, rows: int = 0, cols: int = 1, first: int = 1) -> DataFrame:
    """Boxes of the components of dilated cells, grown by merged ranges they touch, cut to the occupied cells inside.

    merged: sheet, r1, r2, c1, c2. A range counts whole for each component with a place in it, but does not link components.
    """
    cells = written(cells.filter(F.trim("value") != "").select("sheet", "r", "c", "value"))  # read several times
    runs = linked_runs(dilated(cells, rows, cols, first))
    edges = runs.select("sheet", "component", F.col("r").alias("r1"), F.col("r").alias("r2"), "c1", "c2")
    if merged is not None:
        spans = merged.select("sheet", F.explode(F.sequence("r1", "r2")).alias("r"), F.struct("r1", "r2", "c1", "c2").alias("m"))
        met = runs.join(spans, ["sheet", "r"]).filter("c1 <= m.c2 and m.c1 <= c2").select("sheet", "component", "m.*")
        edges = edges.unionByName(met)
    wide = edges.groupBy("sheet", "component").agg(F.min("r1").alias("r1"), F.max("r2").alias("r2"), F.min("c1").alias("c1"), F.max("c2").alias("c2"))
    filled = cells.filter(F.trim("value") != "").select("sheet", "r", "c").distinct()
    inside = filled.join(wide.withColumn("r", F.explode(F.sequence("r1", "r2"))), ["sheet", "r"]).filter("c between c1 and c2")
    return inside.groupBy("sheet", "component").agg(F.min("r").alias("r1"), F.max("r").alias("r2"), F.min("c").alias("c1"), F.max("c").alias("c2"))


def absorbed(found: DataFrame) -> DataFrame:
    """Boxes no other contains, each with the components it takes in, in the order of size, place and component.

    Of equal boxes the one with the smallest component stays. A box inside several that stay goes to the first of them.
    """
    found = written(found)  # read several times
    at = F.struct((-(F.col("r2") - F.col("r1") + 1) * (F.col("c2") - F.col("c1") + 1)).alias("size"), "r1", "c1", "component")
    placed = found.withColumn("at", at)
    outer = placed.select("sheet", F.col("at").alias("o_at"), F.col("r2").alias("o_r2"), F.col("c1").alias("o_c1"), F.col("c2").alias("o_c2"), F.explode(F.sequence("r1", "r2")).alias("r1"))
    held = placed.join(outer, ["sheet", "r1"]).filter("o_at < at and r2 <= o_r2 and c1 >= o_c1 and c2 <= o_c2").select("sheet", "component", "at", "o_at")
    held = written(held)
    inner = held.select("sheet", F.col("component").alias("gone")).distinct()
    kept = held.join(inner.withColumnRenamed("gone", "o_component"), (held["sheet"] == inner["sheet"]) & (F.col("o_at.component") == F.col("o_component")), "left_anti")
    first = kept.groupBy("sheet", "component", "at").agg(F.min("o_at").alias("parent"))
    taken = first.groupBy("sheet", F.col("parent.component").alias("component")).agg(F.transform(F.array_sort(F.collect_list("at")), lambda x: x["component"]).alias("absorbed"))
    stay = found.join(inner.withColumnRenamed("gone", "component"), ["sheet", "component"], "left_anti")
    return stay.join(taken, ["sheet", "component"], "left").withColumn("absorbed", F.coalesce("absorbed", F.array().cast("array<bigint>")))


def numeric_bodies(cells: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per block (sheet, r1, r2, c1, c2) the box of its largest component of numeric cells, and its place in the block.

    Of equal numbers of cells the higher box counts, then the wider one, then the one met first in reading order. Blocks
    without numbers have nulls. title_row: the first row has a text and a bold or merged cell (columns bold and merged of
    the cells, where they have them).
    """
    key = ["sheet", "r1", "r2", "c1", "c2"]
    b = written(blocks.select(*key).distinct())
    within = cells.filter(F.trim("value") != "").join(b.withColumn("r", F.explode(F.sequence("r1", "r2"))), ["sheet", "r"]).filter("c between c1 and c2")
    block = F.struct(*key)
    bodies = boxes(components(within.filter(percent_number(F.col("value")) != "").select(block.alias("sheet"), "r", "c", "value")))
    best = F.struct("cells", (F.col("r2") - F.col("r1")).alias("h"), (F.col("c2") - F.col("c1")).alias("w"), (-F.col("component")).alias("p"))
    body = bodies.groupBy("sheet").agg(F.max_by(F.struct(F.col("r1").alias("body_r1"), F.col("r2").alias("body_r2"), F.col("c1").alias("body_c1"), F.col("c2").alias("body_c2"), F.col("cells").alias("body_cells")), best).alias("body"))
    marked = [F.col(n) for n in ("bold", "merged") if n in cells.columns]
    mark = F.coalesce(F.greatest(*marked) if len(marked) == 2 else marked[0] if marked else F.lit(False), F.lit(False))
    top = within.filter("r = r1").groupBy(*key).agg(F.bool_or(mark).alias("title_row"))
    out = b.join(top, key, "left").join(body.select("sheet.*", "body.*"), key, "left")
    gaps = {"title_gap": F.col("body_r1") - F.col("r1"), "left_margin": F.col("body_c1") - F.col("c1")}
    return out.withColumn("title_row", F.coalesce("title_row", F.lit(False))).withColumns(gaps)


def element_gaps(cells: DataFrame, elements: DataFrame) -> DataFrame:
    """Elements (sheet, r1, r2, c1, c2) in reading order, the one before and after, and the empty rows and columns from the one before.

    Rows count from its end to the first that holds a cell between the outer columns of the two; columns likewise.
    """
    w = Window.partitionBy("sheet").orderBy("r1", "c1", "r2", "c2")
    box = F.struct("r1", "r2", "c1", "c2")
    e = elements.select("sheet", "r1", "r2", "c1", "c2", F.row_number().over(w).alias("place"), F.lag(box).over(w).alias("p"), F.lead(box).over(w).alias("n"))
    filled = cells.filter(F.trim("value") != "").select("sheet", "r", "c").distinct()

    def first(rows: tuple, cols: tuple, what: str) -> DataFrame:
        span = e.filter(F.col("p").isNotNull() & (rows[0] <= rows[1]) & (cols[0] <= cols[1]))
        span = span.select("sheet", "place", F.explode(F.sequence(*rows)).alias("r"), cols[0].alias("a"), cols[1].alias("b"))
        return span.join(filled, ["sheet", "r"]).filter("c between a and b").groupBy("sheet", "place").agg(F.min(what).alias(f"first_{what}"))

    outer = lambda x, y: (F.least(x, f"p.{x}"), F.greatest(y, f"p.{y}"))
    down = first((F.col("p.r2") + 1, F.col("r1") - 1), outer("c1", "c2"), "r")
    right = first(outer("r1", "r2"), (F.col("p.c2") + 1, F.col("c1") - 1), "c")
    out = e.join(down, ["sheet", "place"], "left").join(right, ["sheet", "place"], "left")
    gap_from = lambda end, begin, seen: F.when(F.col("p").isNotNull(), F.greatest(F.lit(0), F.coalesce(seen, begin) - F.col(f"p.{end}") - 1))
    return out.select(
        "sheet", "r1", "r2", "c1", "c2", "place", F.col("p.r1").alias("before_r1"), F.col("p.c1").alias("before_c1"), F.col("n.r1").alias("after_r1"), F.col("n.c1").alias("after_c1"),
        gap_from("r2", "r1", "first_r").alias("gap_rows"), gap_from("c2", "c1", "first_c").alias("gap_cols"),
    )


def boxes(found: DataFrame) -> DataFrame:
    """Bounding box and number of cells of each component."""
    return found.groupBy("sheet", "component").agg(F.min("r").alias("r1"), F.max("r").alias("r2"), F.min("c1").alias("c1"), F.max("c2").alias("c2"), F.sum(F.col("c2") - F.col("c1") + 1).alias("cells"))


def uncontained(found: DataFrame) -> DataFrame:
    """Boxes that no larger box of their sheet contains."""
    area = lambda p: (F.col(f"{p}r2") - F.col(f"{p}r1") + 1) * (F.col(f"{p}c2") - F.col(f"{p}c1") + 1)
    big = found.select("sheet", *[F.col(c).alias(f"b_{c}") for c in ("component", "r1", "r2", "c1", "c2")])
    rows = big.withColumn("r1", F.explode(F.sequence("b_r1", "b_r2")))  # a box can only be in one that covers its first row
    inside = found.join(rows, ["sheet", "r1"]).filter("component <> b_component and r2 <= b_r2 and c1 >= b_c1 and c2 <= b_c2").filter(area("b_") > area(""))
    return found.join(inside.select("sheet", "component").distinct(), ["sheet", "component"], "left_anti")


def nearest_labels(cells: DataFrame) -> DataFrame:
    """For each numeric cell, the nearest text to its left in the row and above it in the column."""
    text = F.when((percent_number(F.col("value")) == "") & (F.trim("value") != ""), F.col("value"))
    row = Window.partitionBy("sheet", "r").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    col = Window.partitionBy("sheet", "c").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    marked = cells.withColumn("row_label", F.last(text, ignorenulls=True).over(row)).withColumn("col_label", F.last(text, ignorenulls=True).over(col))
    return marked.filter(percent_number(F.col("value")) != "").select("sheet", "r", "c", "value", F.coalesce("row_label", F.lit("")).alias("row_label"), F.coalesce("col_label", F.lit("")).alias("col_label"))


#: What names a metric rather than a group, and how the title of a figure begins.
METRIC_TERMS = ("tumor volume", "tumour volume", "body weight")
FIGURE_TITLE = r"(?i)^Fig\.\s*[0-9]+"


def spread_headers(cells: DataFrame, merged: DataFrame) -> DataFrame:
    """Cells with the text of each merged range (sheet, r1, r2, c1, c2) in all blank columns of its first row, ``carried`` there."""
    filled = cells.filter(F.trim("value") != "").select("sheet", "r", "c", "value")
    ranges = merged.filter("c2 > c1").select("sheet", F.col("r1").alias("r"), F.col("c1").alias("c"), "c2")
    text = filled.filter(percent_number(F.col("value")) == "").join(ranges, ["sheet", "r", "c"])
    wide = text.select("sheet", "r", F.explode(F.sequence(F.col("c") + 1, F.col("c2"))).alias("to"), F.struct("c", "value").alias("by"))
    last = wide.groupBy("sheet", "r", F.col("to").alias("c")).agg(F.max("by").alias("by"))  # of ranges that cross, the one that begins last
    free = last.join(filled.select("sheet", "r", "c"), ["sheet", "r", "c"], "left_anti").select("sheet", "r", "c", F.col("by.value").alias("value"))
    return filled.withColumn("carried", F.lit(False)).unionByName(free.withColumn("carried", F.lit(True)))


def column_context(cells: DataFrame, merged: DataFrame | None = None, terms: tuple[str, ...] = METRIC_TERMS, first: int = 1) -> DataFrame:
    """For each numeric cell its group, metric, and the axis of its row: sheet, r, c, value, grp, metric, axis_label, axis_value.

    Of the texts above the cell in its column, titles of figures aside, the first that names no metric is the group and
    the last that names one the metric; where there is no group, the last text of any kind. The text of a merged range
    stands over all its columns. The axis of a row is its cell in the first column: a text is its own value, named
    ``row_label``; a number is named by the nearest text above it; a blank has neither. A column of a sheet is one group
    of a window, as a sheet is one file.
    """
    base = cells.filter(F.trim("value") != "")
    all_ = spread_headers(base, merged) if merged is not None else base.select("sheet", "r", "c", "value").withColumn("carried", F.lit(False))
    is_number = percent_number(F.col("value")) != ""
    marked = all_.withColumn("is_number", is_number).withColumn("text", F.when(~is_number, F.trim("value")))
    kind = F.when(F.col("text").rlike(FIGURE_TITLE), "title").when(F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.lower("text"), t)), "metric").when(F.col("text").isNotNull(), "group")
    above = Window.partitionBy("sheet", "c").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("kind", kind)
    of = lambda k: F.when(F.col("kind") == k, F.col("text"))
    found = marked.select(
        "sheet", "r", "c", "value", "is_number", "carried", F.first(of("group"), ignorenulls=True).over(above).alias("grp"),
        F.last(of("metric"), ignorenulls=True).over(above).alias("metric"), F.last("text", ignorenulls=True).over(above).alias("last_text"),
    )
    lead = marked.filter((F.col("c") == first) & ~F.col("carried"))
    named = F.coalesce(F.last("text", ignorenulls=True).over(above), F.lit(""))
    axis = lead.select("sheet", "r", F.when(F.col("is_number"), named).otherwise("row_label").alias("axis_label"), F.trim("value").alias("axis_value"))
    text_of = lambda c: F.coalesce(c, F.lit(""))
    return found.filter("is_number and not carried").join(axis, ["sheet", "r"], "left").select(
        "sheet", "r", "c", "value", text_of(F.coalesce("grp", "last_text")).alias("grp"), text_of(F.col("metric")).alias("metric"),
        text_of(F.col("axis_label")).alias("axis_label"), text_of(F.col("axis_value")).alias("axis_value"),
    )


def context_labels(cells: DataFrame, most: int = 12) -> DataFrame:
    """A sheet's first distinct texts in reading order."""
    texts = cells.filter((percent_number(F.col("value")) == "") & (F.trim("value") != "")).groupBy("sheet", F.trim("value").alias("label")).agg(F.min(F.struct("r", "c")).alias("at"))
    ranked = texts.withColumn("n", F.row_number().over(Window.partitionBy("sheet").orderBy("at"))).filter(F.col("n") <= most)
    return ranked.groupBy("sheet").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "label"))), lambda x: x["label"]), "|").alias("labels"))


def block_features(cells: DataFrame, blocks: DataFrame) -> DataFrame:
    """Per block the shares of filled, numeric and text cells, blank rows inside, and rows near the top that look like headers."""
    b = blocks.select("sheet", "r1", "r2", "c1", "c2")
    filled = cells.filter(F.trim("value") != "").withColumn("number", percent_number(F.col("value")) != "")
    inside = filled.join(b.withColumn("r", F.explode(F.sequence("r1", "r2"))), ["sheet", "r"]).filter("c between c1 and c2")
    key = ["sheet", "r1", "r2", "c1", "c2"]
    per_row = inside.groupBy(*key, "r").agg(F.count_if("number").alias("n"), F.count_if(~F.col("number")).alias("t"))
    header = (F.col("r") <= F.col("r1") + 3) & (F.col("t") >= 1) & (F.col("t") >= F.col("n"))
    per = per_row.groupBy(*key).agg(F.sum("n").alias("numbers"), F.sum("t").alias("texts"), F.count("*").alias("filled_rows"), F.count_if(header).alias("header_rows"))
    cols = inside.groupBy(*key).agg(F.count_distinct("c").alias("filled_cols"))
    area = (F.col("r2") - F.col("r1") + 1) * (F.col("c2") - F.col("c1") + 1)
    out = per.join(cols, key)
    return out.select(
        *key, ((F.col("numbers") + F.col("texts")) / area).alias("filled"), (F.col("numbers") / area).alias("numeric"), (F.col("texts") / area).alias("text"),
        (F.col("r2") - F.col("r1") + 1 - F.col("filled_rows")).alias("empty_rows"), (F.col("c2") - F.col("c1") + 1 - F.col("filled_cols")).alias("empty_cols"), "header_rows",
    )


def block_route(features: DataFrame) -> DataFrame:
    """Blocks that are worth reading, with the route: complex_layout or regular_table; sparse ones are skipped."""
    kept = features.filter("filled >= 0.03 and (numeric > 0 or header_rows >= 1 or text >= 0.08)")
    route = F.when(F.col("filled") < 0.08, "too_sparse").when((F.col("header_rows") >= 2) | (F.col("empty_cols") >= 1), "complex_layout").otherwise("regular_table")
    return kept.withColumn("route", route)


def with_context(cells: DataFrame, blocks: DataFrame, up: int = 2) -> DataFrame:
    """Blocks grown by rows above that fill a third of their columns (the topmost of ``up`` rows that does), then by a filled column to the left."""
    key = ["sheet", "r1", "r2", "c1", "c2"]
    filled = cells.filter(F.trim("value") != "").select("sheet", "r", "c")
    b = blocks.select(*key)
    higher = b.withColumn("r", F.explode(F.sequence(F.col("r1") - up, F.col("r1") - 1)))
    above = higher.join(filled, ["sheet", "r"]).filter("c between c1 and c2").groupBy(*key, "r").agg(F.count("*").alias("n"))
    need = F.greatest(F.lit(1), F.floor((F.col("c2") - F.col("c1") + 1) / 3))
    top = above.filter(F.col("n") >= need).groupBy(*key).agg(F.min("r").alias("top"))
    grown = b.join(top, key, "left").withColumn("new_r1", F.coalesce("top", "r1"))
    beside = grown.withColumn("c", F.col("c1") - 1).withColumn("r", F.explode(F.sequence("new_r1", "r2")))
    left = beside.join(filled, ["sheet", "r", "c"]).select(*key).distinct().withColumn("left", F.lit(1))
    return grown.join(left, key, "left").select(*key, "new_r1", (F.col("c1") - F.coalesce("left", F.lit(0))).alias("new_c1"))


def entity_labels(cells: DataFrame, pattern: str, ignored: str = "^$") -> DataFrame:
    """A sheet's distinct texts that hold a keyword (``pattern``), by their letters and digits, numbered as first seen."""
    texts = cells.filter((percent_number(F.col("value")) == "") & F.col("value").rlike(pattern) & ~F.col("value").rlike(ignored))
    first = texts.groupBy("sheet", matcher_key(F.col("value")).alias("key")).agg(F.min(F.struct("r", "c", F.trim("value").alias("label"))).alias("at")).filter("key <> ''")
    return first.select("sheet", "at.label", F.row_number().over(Window.partitionBy("sheet").orderBy("at")).alias("n"))


def crossed_labels(cells: DataFrame, tail: str) -> DataFrame:
    """For a sheet whose first row holds tails and whose rows begin with names, each name joined to each tail that has a cell below."""
    sheet, row = Window.partitionBy("sheet"), Window.partitionBy("sheet", "r").orderBy("c")
    marked = cells.filter(F.trim("value") != "").withColumn("top", F.min("r").over(sheet)).withColumn("name", F.first("value").over(row)).withColumn("c0", F.first("c").over(row))
    heads = marked.filter((F.col("r") == F.col("top")) & F.col("value").rlike(tail)).select("sheet", "c", F.trim("value").alias("tail"))
    return marked.filter("r > top and c > c0").join(heads, ["sheet", "c"]).select("sheet", F.concat_ws("-", F.trim("name"), "tail").alias("label")).distinct()


def member_relations(members: DataFrame) -> DataFrame:
    """How each member (sheet, grp, element, kind, r1, r2, c1, c2) of a group lies to the next in reading order: scores, orientation, confidence."""
    w = Window.partitionBy("sheet", "grp").orderBy("r1", "c1", "element")
    nxt = F.lead(F.struct("element", "kind", "r1", "r2", "c1", "c2")).over(w)
    pairs = members.withColumn("b", nxt).filter("b is not null")
    rows, cols = (F.col("r1"), F.col("r2"), F.col("b.r1"), F.col("b.r2")), (F.col("c1"), F.col("c2"), F.col("b.c1"), F.col("b.c2"))

    def score(along, across):
        """Members in line share positions across; near ones have a small gap along."""
        shared, least = overlap(*across), F.least(across[1] - across[0], across[3] - across[2]) + 1
        return F.when(shared > 0, 2.0 + F.least(F.lit(1.5), shared / least)).otherwise(0.0) + F.greatest(F.lit(0.0), 1.5 - F.least(gap(*along), F.lit(6)) * 0.25)

    kinds = F.array("kind", "b.kind")
    titled = F.array_contains(kinds, "table_title") & (F.array_contains(kinds, "table_body") | F.array_contains(kinds, "title_and_table"))
    down, side = score(rows, cols) + F.when(titled, 3.0).otherwise(0.0), score(cols, rows) - F.when(titled, 0.5).otherwise(0.0)
    lead = F.col("vertical_score") - F.col("horizontal_score")
    scored = pairs.select("sheet", "grp", "element", F.col("b.element").alias("next_element"), down.alias("vertical_score"), side.alias("horizontal_score"))
    return scored.withColumn("orientation", F.when(lead >= 1, "vertical").when(lead <= -1, "horizontal").otherwise("ambiguous")).withColumn(
        "confidence", F.when(F.abs(lead) >= 2, "high").when(F.abs(lead) >= 1, "medium").otherwise("low")
    )


def group_axis(members: DataFrame) -> DataFrame:
    """The axis that a group's pairs vote for: vertical, horizontal or none (the original layout), with its confidence."""
    rel = member_relations(members)
    says = lambda o, *c: F.count_if((F.col("orientation") == o) & F.col("confidence").isin(*c))
    votes = rel.groupBy("sheet", "grp").agg(
        says("vertical", "high", "medium").alias("v"), says("horizontal", "high", "medium").alias("h"), says("vertical", "high").alias("sv"), says("horizontal", "high").alias("sh"), F.count("*").alias("pairs")
    )
    every = lambda a, b: (F.col(a) > F.col(b)) & (F.col(a) >= F.greatest(F.lit(2), F.col("pairs")))
    strong = lambda a, b, x, y: (F.col(x) > F.col(y)) | ((F.col(a) > F.col(b)) & (F.col(x) >= 1))
    rule = F.when(strong("v", "h", "sv", "sh"), "vertical|high").when(strong("h", "v", "sh", "sv"), "horizontal|high").when(every("v", "h"), "vertical|medium").when(every("h", "v"), "horizontal|medium")
    said = members.select("sheet", "grp").distinct().join(votes.withColumn("rule", rule), ["sheet", "grp"], "left")
    parts = F.split(F.coalesce("rule", F.lit("none|low")), r"\|")
    return said.select("sheet", "grp", parts[0].alias("axis"), parts[1].alias("confidence"))


def composed(cells: DataFrame, members: DataFrame, axis: DataFrame) -> DataFrame:
    """The cells of each group's members on one canvas from (0, 0): stacked or side by side with a gap of one, else as they lay."""
    placed = members.join(axis.select("sheet", "grp", "axis"), ["sheet", "grp"])
    before = lambda *order: Window.partitionBy("sheet", "grp").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy("sheet", "grp")
    down = F.coalesce(F.sum(F.col("r2") - F.col("r1") + 2).over(before("r1", "c1", "element")), F.lit(0))
    side = F.coalesce(F.sum(F.col("c2") - F.col("c1") + 2).over(before("c1", "r1", "element")), F.lit(0))
    dr = F.when(F.col("axis") == "vertical", down).when(F.col("axis") == "horizontal", 0).otherwise(F.col("r1") - F.min("r1").over(all_))
    dc = F.when(F.col("axis") == "vertical", 0).when(F.col("axis") == "horizontal", side).otherwise(F.col("c1") - F.min("c1").over(all_))
    offset = placed.withColumn("dr", dr).withColumn("dc", dc).withColumn("r", F.explode(F.sequence("r1", "r2")))
    own = cells.filter(F.trim("value") != "").join(offset, ["sheet", "r"]).filter("c between c1 and c2")
    return own.select("sheet", "grp", (F.col("r") - F.col("r1") + F.col("dr")).alias("r"), (F.col("c") - F.col("c1") + F.col("dc")).alias("c"), "value").distinct()


def final_blocks(members: DataFrame, axis: DataFrame) -> DataFrame:
    """A block for each group: number, box, kind, its elements in reading order, first title, and how it is composed. members: also title."""
    per = members.groupBy("sheet", "grp").agg(
        F.min("r1").alias("r1"), F.max("r2").alias("r2"), F.min("c1").alias("c1"), F.max("c2").alias("c2"), F.collect_set("kind").alias("kinds"),
        F.array_sort(F.collect_list(F.struct("r1", "c1", "element", "title"))).alias("all"),
    )
    has = lambda k: F.array_contains("kinds", k)
    kind = F.when(has("title_and_table") | (has("table_body") & has("table_title")), "title_and_table").when(has("table_body"), "table_body").when(has("table_title"), "table_title").otherwise("other")
    number = padded(F.row_number().over(Window.partitionBy("sheet").orderBy("r1", "c1", "grp")), 3)
    title = F.get(F.filter(F.transform("all", lambda x: F.trim(x["title"])), lambda t: t != ""), F.lit(0))
    return per.join(axis, ["sheet", "grp"]).select(
        F.concat(F.col("sheet").cast("string"), F.lit("__block_"), number).alias("block_id"), "sheet", "grp", "r1", "r2", "c1", "c2", kind.alias("kind"),
        F.array_join(F.transform("all", lambda x: x["element"]), "|").alias("elements"), F.coalesce(title, F.col("sheet").cast("string")).alias("title"), "axis", "confidence",
    )
