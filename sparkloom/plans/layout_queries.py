"""Queries of sheet layout: boxes of dilated cells, absorbed boxes, numeric bodies and gaps, over orders laid out as cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid as G
from .inputs import table

QUERIES, ORACLES = {}, {}


def _places(s, d):
    o = table(s, d, "orders")
    at = [F.floor(F.col("o_orderkey") / 100).cast("int").alias("sheet"), (F.col("o_custkey") % 30 + 1).cast("int").alias("r"), (F.floor("o_totalprice") % 24 + 1).cast("int").alias("c")]
    return o.groupBy(*at).agg(F.min("o_orderkey").alias("k"))


def cells(s, d):
    """A sheet for each hundred order keys, a cell for each place an order falls on: a third hold words, some of them bold."""
    text = F.when(F.col("k") % 3 == 0, F.lit("word")).otherwise((F.col("k") % 90).cast("string"))
    return _places(s, d).select("sheet", "r", "c", text.alias("value"), (F.col("k") % 6 == 0).alias("bold"))


def merged(s, d):
    """Ranges of two rows and four columns from each place whose key is one more than a multiple of 40."""
    return _places(s, d).filter("k % 40 = 1").select("sheet", F.col("r").alias("r1"), (F.col("r") + 1).alias("r2"), F.col("c").alias("c1"), (F.col("c") + 3).alias("c2"))


CELLS_SQL = """places AS (SELECT CAST(o_orderkey // 100 AS INTEGER) AS sheet, CAST(o_custkey % 30 + 1 AS INTEGER) AS r, CAST(floor(o_totalprice) % 24 + 1 AS INTEGER) AS c, min(o_orderkey) AS k FROM orders GROUP BY ALL),
ends AS (SELECT sheet, max(c) AS last_c FROM places GROUP BY sheet),
mask AS (SELECT DISTINCT sheet, r, c + d AS c FROM places JOIN ends USING (sheet), (VALUES (-1), (0), (1)) AS t(d) WHERE c + d BETWEEN 1 AND last_c),
walk(sheet, r, c, id) AS (SELECT sheet, r, c, CAST(r AS BIGINT) * 1048576 + c FROM mask UNION
  SELECT m.sheet, m.r, m.c, walk.id FROM walk JOIN mask m ON m.sheet = walk.sheet AND abs(m.r - walk.r) + abs(m.c - walk.c) = 1),
comp AS (SELECT sheet, r, c, min(id) AS component FROM walk GROUP BY ALL),
ranges AS (SELECT sheet, r AS r1, r + 1 AS r2, c AS c1, c + 3 AS c2 FROM places WHERE k % 40 = 1),
edges AS (SELECT sheet, component, r AS r1, r AS r2, c AS c1, c AS c2 FROM comp UNION ALL
  SELECT m.sheet, component, r1, r2, c1, c2 FROM comp JOIN ranges m ON m.sheet = comp.sheet AND r BETWEEN r1 AND r2 AND c BETWEEN c1 AND c2),
wide AS (SELECT sheet, component, min(r1) AS r1, max(r2) AS r2, min(c1) AS c1, max(c2) AS c2 FROM edges GROUP BY ALL),
box AS (SELECT w.sheet, component, min(r) AS r1, max(r) AS r2, min(c) AS c1, max(c) AS c2 FROM wide w JOIN places p ON p.sheet = w.sheet AND r BETWEEN r1 AND r2 AND c BETWEEN c1 AND c2 GROUP BY w.sheet, component),
placed AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY (r2 - r1 + 1) * (c2 - c1 + 1) DESC, r1, c1, component) AS n FROM box),
held AS (SELECT a.sheet, a.component, a.n, b.component AS outer_component, b.n AS outer_n FROM placed a JOIN placed b ON a.sheet = b.sheet AND b.n < a.n AND a.r1 >= b.r1 AND a.r2 <= b.r2 AND a.c1 >= b.c1 AND a.c2 <= b.c2),
kept AS (SELECT * FROM placed p WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.sheet = p.sheet AND h.component = p.component)),
parent AS (SELECT h.sheet, h.component, h.n, arg_min(outer_component, outer_n) AS into_component FROM held h JOIN kept k ON k.sheet = h.sheet AND k.component = h.outer_component GROUP BY ALL)"""


def _absorbed(s, d):
    return G.absorbed(G.layout_boxes(cells(s, d), merged(s, d)))


QUERIES["G2_dilated_boxes"] = lambda s, d: G.layout_boxes(cells(s, d), merged(s, d)).select("sheet", "component", "r1", "r2", "c1", "c2")
ORACLES["G2_dilated_boxes"] = f"WITH RECURSIVE {CELLS_SQL} SELECT sheet, component, r1, r2, c1, c2 FROM box"
QUERIES["G3_absorbed_boxes"] = lambda s, d: _absorbed(s, d).select("sheet", "component", "r1", "r2", "c1", "c2", F.array_join("absorbed", ",").alias("absorbed"))
ORACLES["G3_absorbed_boxes"] = f"""WITH RECURSIVE {CELLS_SQL}, taken AS (SELECT sheet, into_component AS component, string_agg(CAST(component AS VARCHAR), ',' ORDER BY n) AS absorbed FROM parent GROUP BY ALL)
SELECT sheet, component, r1, r2, c1, c2, coalesce(absorbed, '') AS absorbed FROM kept LEFT JOIN taken USING (sheet, component)"""
QUERIES["G4_numeric_bodies"] = lambda s, d: G.numeric_bodies(cells(s, d), _absorbed(s, d))
ORACLES["G4_numeric_bodies"] = f"""WITH RECURSIVE {CELLS_SQL}, blocks AS (SELECT DISTINCT sheet, r1, r2, c1, c2 FROM kept),
inside AS (SELECT b.*, r, c, k FROM blocks b JOIN places p ON p.sheet = b.sheet AND r BETWEEN r1 AND r2 AND c BETWEEN c1 AND c2),
numbers AS (SELECT * FROM inside WHERE k % 3 <> 0),
grow(sheet, r1, r2, c1, c2, r, c, id) AS (SELECT sheet, r1, r2, c1, c2, r, c, CAST(r AS BIGINT) * 1048576 + c FROM numbers UNION
  SELECT m.sheet, m.r1, m.r2, m.c1, m.c2, m.r, m.c, grow.id FROM grow JOIN numbers m ON m.sheet = grow.sheet AND m.r1 = grow.r1 AND m.r2 = grow.r2 AND m.c1 = grow.c1 AND m.c2 = grow.c2 AND abs(m.r - grow.r) + abs(m.c - grow.c) = 1),
least_of AS (SELECT sheet, r1, r2, c1, c2, r, c, min(id) AS id FROM grow GROUP BY ALL),
bodies AS (SELECT sheet, r1, r2, c1, c2, id, min(r) AS body_r1, max(r) AS body_r2, min(c) AS body_c1, max(c) AS body_c2, count(*) AS body_cells FROM least_of GROUP BY ALL),
best AS (SELECT * FROM bodies QUALIFY row_number() OVER (PARTITION BY sheet, r1, r2, c1, c2 ORDER BY body_cells DESC, body_r2 - body_r1 DESC, body_c2 - body_c1 DESC, id) = 1),
top AS (SELECT sheet, r1, r2, c1, c2, bool_or(k % 6 = 0) AS title FROM inside WHERE r = r1 GROUP BY ALL)
SELECT sheet, r1, r2, c1, c2, coalesce(title, false) AS title_row, body_r1, body_r2, body_c1, body_c2, body_cells, body_r1 - r1 AS title_gap, body_c1 - c1 AS left_margin
FROM blocks LEFT JOIN top USING (sheet, r1, r2, c1, c2) LEFT JOIN best USING (sheet, r1, r2, c1, c2)"""
QUERIES["W10_element_gaps"] = lambda s, d: G.element_gaps(cells(s, d), _absorbed(s, d))
ORACLES["W10_element_gaps"] = f"""WITH RECURSIVE {CELLS_SQL}, e AS (SELECT sheet, r1, r2, c1, c2, CAST(row_number() OVER w AS INTEGER) AS place, lag(r1) OVER w AS p_r1, lag(r2) OVER w AS p_r2, lag(c1) OVER w AS p_c1, lag(c2) OVER w AS p_c2,
  lead(r1) OVER w AS after_r1, lead(c1) OVER w AS after_c1 FROM kept WINDOW w AS (PARTITION BY sheet ORDER BY r1, c1, r2, c2)),
down AS (SELECT e.sheet, place, min(r) AS first_r FROM e JOIN places p ON p.sheet = e.sheet AND r > p_r2 AND r < r1 AND c BETWEEN least(c1, p_c1) AND greatest(c2, p_c2) GROUP BY ALL),
side AS (SELECT e.sheet, place, min(c) AS first_c FROM e JOIN places p ON p.sheet = e.sheet AND c > p_c2 AND c < c1 AND r BETWEEN least(r1, p_r1) AND greatest(r2, p_r2) GROUP BY ALL)
SELECT sheet, r1, r2, c1, c2, place, p_r1 AS before_r1, p_c1 AS before_c1, after_r1, after_c1, CASE WHEN place > 1 THEN greatest(0, coalesce(first_r, r1) - p_r2 - 1) END AS gap_rows, CASE WHEN place > 1 THEN greatest(0, coalesce(first_c, c1) - p_c2 - 1) END AS gap_cols
FROM e LEFT JOIN down USING (sheet, place) LEFT JOIN side USING (sheet, place)"""


def _headed(s, d):
    """The places as cells of tables: groups, metrics and titles of figures where words stand, and merged ranges over some."""
    k = F.col("k")
    text = F.when(k % 5 == 0, F.concat(F.lit("Tumour volume "), k % 7)).when(k % 5 == 1, F.concat(F.lit("Fig. "), k % 9)).otherwise(F.concat(F.lit("group "), k % 11))
    return _places(s, d).select("sheet", "r", "c", F.when(k % 3 == 0, text).otherwise((k % 90).cast("string")).alias("value"))


def _header_ranges(s, d):
    return _places(s, d).filter("k % 6 = 0").select("sheet", F.col("r").alias("r1"), F.col("r").alias("r2"), F.col("c").alias("c1"), (F.col("c") + 2).alias("c2"))


QUERIES["W8_column_context"] = lambda s, d: G.column_context(_headed(s, d), _header_ranges(s, d))
ORACLES["W8_column_context"] = """WITH places AS (SELECT CAST(o_orderkey // 100 AS INTEGER) AS sheet, CAST(o_custkey % 30 + 1 AS INTEGER) AS r, CAST(floor(o_totalprice) % 24 + 1 AS INTEGER) AS c, min(o_orderkey) AS k FROM orders GROUP BY ALL),
cells AS (SELECT *, k % 3 <> 0 AS num, false AS carried, CASE WHEN k % 3 <> 0 THEN CAST(k % 90 AS VARCHAR) WHEN k % 5 = 0 THEN 'Tumour volume ' || k % 7 WHEN k % 5 = 1 THEN 'Fig. ' || k % 9 ELSE 'group ' || k % 11 END AS value FROM places),
wide AS (SELECT sheet, r, c + s AS c, arg_max(value, c) AS value FROM cells, (VALUES (1), (2)) AS t(s) WHERE k % 6 = 0 GROUP BY sheet, r, c + s),
everything AS (SELECT sheet, r, c, value, num, carried FROM cells UNION ALL SELECT sheet, r, c, value, false, true FROM wide ANTI JOIN cells USING (sheet, r, c)),
marked AS (SELECT *, CASE WHEN NOT num THEN value END AS t, starts_with(value, 'Fig.') AS title, starts_with(value, 'Tumour') AS metric_like FROM everything),
z AS (SELECT *, first_value(CASE WHEN NOT title AND NOT metric_like THEN t END IGNORE NULLS) OVER w AS g, last_value(CASE WHEN metric_like THEN t END IGNORE NULLS) OVER w AS m, last_value(t IGNORE NULLS) OVER w AS l
  FROM marked WINDOW w AS (PARTITION BY sheet, c ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ax AS (SELECT sheet, r, CASE WHEN num THEN coalesce(l, '') ELSE 'row_label' END AS axis_label, value AS axis_value FROM z WHERE c = 1)
SELECT z.sheet, z.r, z.c, value, coalesce(g, l, '') AS grp, coalesce(m, '') AS metric, coalesce(axis_label, '') AS axis_label, coalesce(axis_value, '') AS axis_value
FROM z LEFT JOIN ax ON ax.sheet = z.sheet AND ax.r = z.r WHERE num"""
