"""Queries of sheet grids, over order lines laid out as cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from .inputs import table

QUERIES, ORACLES = {}, {}


def sheets(s, d):
    """One cell for each place that an order line falls on: a third hold words, the others the number of lines."""
    l = table(s, d, "lineitem").filter("l_partkey % 10 < 6")
    g = l.groupBy((F.col("l_orderkey") % 97).cast("int").alias("sheet"), F.floor(F.col("l_partkey") % 41).cast("int").alias("r"), F.floor(F.col("l_suppkey") % 23).cast("int").alias("c")).agg(F.count("*").alias("n"), F.min("l_returnflag").alias("flag"))
    return g.filter("(r * 7 + c * 3 + sheet) % 5 < 3").select("sheet", "r", "c", F.when((F.col("r") + F.col("c")) % 3 == 0, F.concat(F.lit("w"), F.col("flag"))).otherwise(F.col("n").cast("string")).alias("value"))


SHEETS_SQL = """x AS (SELECT CAST(l_orderkey % 97 AS INTEGER) AS sheet, CAST(l_partkey % 41 AS INTEGER) AS r, CAST(l_suppkey % 23 AS INTEGER) AS c, count(*) AS n, min(l_returnflag) AS flag FROM lineitem WHERE l_partkey % 10 < 6 GROUP BY ALL),
cells AS (SELECT sheet, r, c, CASE WHEN (r + c) % 3 = 0 THEN 'w' || flag ELSE CAST(n AS VARCHAR) END AS value FROM x WHERE (r * 7 + c * 3 + sheet) % 5 < 3)"""
BANDS_SQL = SHEETS_SQL + """,
rr AS (SELECT sheet, r, r - dense_rank() OVER (PARTITION BY sheet ORDER BY r) AS g FROM (SELECT DISTINCT sheet, r FROM cells)),
rb AS (SELECT sheet, r, min(r) OVER (PARTITION BY sheet, g) AS r1, max(r) OVER (PARTITION BY sheet, g) AS r2 FROM rr),
cb AS (SELECT cells.*, r1, r2 FROM cells JOIN rb USING (sheet, r)),
cc AS (SELECT sheet, r1, c, c - dense_rank() OVER (PARTITION BY sheet, r1 ORDER BY c) AS g FROM (SELECT DISTINCT sheet, r1, c FROM cb)),
cx AS (SELECT sheet, r1, c, min(c) OVER (PARTITION BY sheet, r1, g) AS c1, max(c) OVER (PARTITION BY sheet, r1, g) AS c2 FROM cc)"""
QUERIES["G1_bands"] = lambda s, d: G.bands(sheets(s, d))
ORACLES["G1_bands"] = f"WITH {BANDS_SQL} SELECT sheet, r1, r2, c1, c2, count(*) AS cells, count_if(NOT starts_with(value, 'w')) AS numbers FROM cb JOIN cx USING (sheet, r1, c) GROUP BY ALL"


def _kinds(s, d):
    cells = sheets(s, d)
    b = G.bands(cells)
    first = cells.filter(F.col("value").startswith("w")).select("sheet", F.col("r").alias("r1"), "c").join(b.select("sheet", "r1", "c1", "c2"), ["sheet", "r1"]).filter("c between c1 and c2")
    b = b.join(first.groupBy("sheet", "r1", "c1").agg(F.count("*").alias("first_row_words")), ["sheet", "r1", "c1"], "left").fillna(0, ["first_row_words"])
    words = F.col("cells") - F.col("numbers")
    kind = G.block_kind(F.col("r2") - F.col("r1") + 1, F.col("c2") - F.col("c1") + 1, F.col("numbers"), words, F.col("first_row_words"))
    return b.groupBy(kind.alias("kind")).agg(F.count("*").alias("blocks"))


QUERIES["G6_block_kinds"] = _kinds
ORACLES["G6_block_kinds"] = f"""WITH {BANDS_SQL}, b AS (SELECT r2 - r1 + 1 AS h, c2 - c1 + 1 AS w, count_if(NOT starts_with(value, 'w')) AS n, count_if(starts_with(value, 'w')) AS t, count_if(starts_with(value, 'w') AND r = r1) AS f FROM cb JOIN cx USING (sheet, r1, c) GROUP BY sheet, r1, r2, c1, c2)
SELECT CASE WHEN h <= 2 AND n = 0 THEN CASE WHEN t <= 6 THEN 'table_title' ELSE 'note' END WHEN h >= 12 AND w >= 8 AND n >= 10 THEN 'multi_table' WHEN n >= 3 AND f > 0 THEN 'title_and_table'
  WHEN n >= greatest(3, t) AND h >= 2 THEN 'table_body' WHEN h <= 3 AND t > n THEN 'note' ELSE 'other' END AS kind, count(*) AS blocks FROM b GROUP BY 1"""
_COMPONENTS = f"""WITH RECURSIVE {SHEETS_SQL}, few AS (SELECT sheet, r, c FROM cells),
walk(sheet, r, c, id) AS (SELECT sheet, r, c, r * 1048576 + c FROM few UNION
  SELECT few.sheet, few.r, few.c, walk.id FROM walk JOIN few ON few.sheet = walk.sheet AND abs(few.r - walk.r) + abs(few.c - walk.c) = 1),
low AS (SELECT sheet, r, c, min(id) AS id FROM walk GROUP BY ALL),
box AS (SELECT sheet, CAST(id AS BIGINT) AS component, min(r) AS r1, max(r) AS r2, min(c) AS c1, max(c) AS c2, count(*) AS cells FROM low GROUP BY sheet, id)"""
QUERIES["G2_components"] = lambda s, d: G.boxes(G.components(sheets(s, d))).select(F.col("component").cast("bigint").alias("component"), "sheet", "r1", "r2", "c1", "c2", "cells")
ORACLES["G2_components"] = _COMPONENTS + " SELECT component, sheet, r1, r2, c1, c2, cells FROM box"
QUERIES["G3_uncontained_boxes"] = lambda s, d: G.uncontained(G.boxes(G.components(sheets(s, d)))).select(F.col("component").cast("bigint").alias("component"), "sheet", "r1", "r2", "c1", "c2")
ORACLES["G3_uncontained_boxes"] = _COMPONENTS + """ SELECT component, sheet, r1, r2, c1, c2 FROM box a WHERE NOT EXISTS (SELECT 1 FROM box b WHERE b.sheet = a.sheet AND b.component <> a.component
  AND a.r1 >= b.r1 AND a.r2 <= b.r2 AND a.c1 >= b.c1 AND a.c2 <= b.c2 AND (b.r2 - b.r1 + 1) * (b.c2 - b.c1 + 1) > (a.r2 - a.r1 + 1) * (a.c2 - a.c1 + 1))"""
QUERIES["W8_nearest_labels"] = lambda s, d: G.nearest_labels(sheets(s, d))
ORACLES["W8_nearest_labels"] = f"""WITH {SHEETS_SQL}, q AS (SELECT *, CASE WHEN starts_with(value, 'w') THEN value END AS t FROM cells),
z AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY sheet, r ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS row_label, last_value(t IGNORE NULLS) OVER (PARTITION BY sheet, c ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS col_label FROM q)
SELECT sheet, r, c, value, coalesce(row_label, '') AS row_label, coalesce(col_label, '') AS col_label FROM z WHERE t IS NULL"""
QUERIES["R7_context_labels"] = lambda s, d: G.context_labels(sheets(s, d))
ORACLES["R7_context_labels"] = f"""WITH {SHEETS_SQL}, f AS (SELECT sheet, value, min(r * 1000 + c) AS p FROM cells WHERE starts_with(value, 'w') GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY p) AS n FROM f) SELECT sheet, string_agg(value, '|' ORDER BY n) AS labels FROM k WHERE n <= 12 GROUP BY sheet"""
_BLOCKS = BANDS_SQL + """, bl AS (SELECT DISTINCT sheet, r1, r2, c1, c2 FROM cb JOIN cx USING (sheet, r1, c)), fi AS (SELECT sheet, r, c, NOT starts_with(value, 'w') AS num FROM cells)"""
_FEATURES = _BLOCKS + """, ro AS (SELECT bl.*, r, count_if(num) AS n, count_if(NOT num) AS t FROM fi JOIN bl ON fi.sheet = bl.sheet AND r BETWEEN r1 AND r2 AND c BETWEEN c1 AND c2 GROUP BY ALL),
co AS (SELECT bl.*, count(DISTINCT c) AS k FROM fi JOIN bl ON fi.sheet = bl.sheet AND r BETWEEN r1 AND r2 AND c BETWEEN c1 AND c2 GROUP BY ALL),
fe AS (SELECT ro.sheet, ro.r1, ro.r2, ro.c1, ro.c2, sum(n + t) / ((ro.r2 - ro.r1 + 1) * (ro.c2 - ro.c1 + 1)) AS filled, sum(n) / ((ro.r2 - ro.r1 + 1) * (ro.c2 - ro.c1 + 1)) AS numeric, sum(t) / ((ro.r2 - ro.r1 + 1) * (ro.c2 - ro.c1 + 1)) AS text,
  ro.r2 - ro.r1 + 1 - count(*) AS empty_rows, ro.c2 - ro.c1 + 1 - any_value(k) AS empty_cols, count_if(r <= ro.r1 + 3 AND t >= 1 AND t >= n) AS header_rows FROM ro JOIN co ON ro.sheet = co.sheet AND ro.r1 = co.r1 AND ro.c1 = co.c1 GROUP BY ro.sheet, ro.r1, ro.r2, ro.c1, ro.c2)"""


def _features(s, d):
    cells = sheets(s, d)
    f = G.block_features(cells, G.bands(cells))
    return f.select("sheet", "r1", "c1", *[F.round(c, 4).alias(c) for c in ("filled", "numeric", "text")], "empty_rows", "empty_cols", "header_rows")


QUERIES["G4_block_features"] = _features
ORACLES["G4_block_features"] = f'WITH {_FEATURES} SELECT sheet, r1, c1, round(filled, 4) AS filled, round("numeric", 4) AS "numeric", round(text, 4) AS text, empty_rows, empty_cols, header_rows FROM fe'
ORACLES["G4_block_features"] = ORACLES["G4_block_features"].replace("AS numeric,", 'AS "numeric",')


def _routes(s, d):
    cells = sheets(s, d)
    return G.block_route(G.block_features(cells, G.bands(cells))).select("sheet", "r1", "c1", "route")


QUERIES["G5_block_routes"] = _routes
ORACLES["G5_block_routes"] = f"""WITH {_FEATURES.replace('AS numeric,', 'AS "numeric",')} SELECT sheet, r1, c1, CASE WHEN filled < 0.08 THEN 'too_sparse' WHEN header_rows >= 2 OR empty_cols >= 1 THEN 'complex_layout' ELSE 'regular_table' END AS route
FROM fe WHERE filled >= 0.03 AND ("numeric" > 0 OR header_rows >= 1 OR text >= 0.08)"""


def _grown(s, d):
    """Bands cut by dropping some cells, grown again over the cells that were dropped."""
    cells = sheets(s, d)
    return G.with_context(cells, G.bands(cells.filter("r % 6 > 1 and c % 5 > 0")))


QUERIES["G7_block_context"] = _grown
ORACLES["G7_block_context"] = f"""WITH {BANDS_SQL.replace('FROM (SELECT DISTINCT sheet, r FROM cells)', 'FROM (SELECT DISTINCT sheet, r FROM part_of)').replace('FROM cells JOIN rb', 'FROM part_of AS cells JOIN rb').replace('rr AS (', 'part_of AS (SELECT * FROM cells WHERE r % 6 > 1 AND c % 5 > 0), rr AS (', 1)},
bl AS (SELECT DISTINCT sheet, r1, r2, c1, c2 FROM cb JOIN cx USING (sheet, r1, c)),
up AS (SELECT bl.sheet, bl.r1, bl.r2, bl.c1, bl.c2, r FROM bl JOIN cells x ON x.sheet = bl.sheet AND r < r1 AND r >= r1 - 2 AND c BETWEEN c1 AND c2 GROUP BY ALL HAVING count(*) >= greatest(1, (bl.c2 - bl.c1 + 1) // 3)),
g AS (SELECT bl.*, coalesce((SELECT min(r) FROM up WHERE up.sheet = bl.sheet AND up.r1 = bl.r1 AND up.r2 = bl.r2 AND up.c1 = bl.c1 AND up.c2 = bl.c2), bl.r1) AS new_r1 FROM bl)
SELECT *, c1 - CASE WHEN EXISTS (SELECT 1 FROM cells x WHERE x.sheet = g.sheet AND x.c = g.c1 - 1 AND x.r BETWEEN new_r1 AND r2) THEN 1 ELSE 0 END AS new_c1 FROM g"""
