"""Queries of summaries, plan inference, evidence and value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import grid as G
from ..operators import profile as P
from ..sources import files as S
from ..sources.stage import fresh_path
from . import linkage_queries as K
from .grid_queries import BANDS_SQL, sheets
from .inputs import LABELS_SQL, LINES_SQL, labels_of_parts, table

QUERIES, ORACLES = {}, {}


def payloads(s, d):
    p = table(s, d, "part")
    return p.select(F.col("p_brand").alias("partition_key"), F.col("p_partkey").alias("pos"), F.create_map(
        F.lit("Group_Label"), F.split("p_name", " ")[0], F.lit("Mean"), F.col("p_size").cast("string"), F.lit("Type"), F.when(F.col("p_size") % 2 == 0, "").otherwise(F.col("p_type"))).alias("payload"))


CELLS_SQL = """c AS (SELECT p_brand AS k, p_partkey AS pos, 'Group_Label' AS col, split_part(p_name, ' ', 1) AS v FROM part UNION ALL SELECT p_brand, p_partkey, 'Mean', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_brand, p_partkey, 'Type', p_type FROM part WHERE p_size % 2 <> 0)"""
QUERIES["P2_partition_schema"] = lambda s, d: P.partition_schema(payloads(s, d), 4).select("partition_key", "column", "non_empty", "distinct", F.array_join("values", "|").alias("values"))
ORACLES["P2_partition_schema"] = f"""WITH {CELLS_SQL}, f AS (SELECT k, col, lower(v) AS norm, count(*) AS n, min(pos) AS pos, arg_min(v, pos) AS v FROM c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY k, col ORDER BY pos, v) AS rank FROM f) SELECT k AS partition_key, col AS "column", CAST(sum(n) AS BIGINT) AS non_empty, count(*) AS "distinct", string_agg(v, '|' ORDER BY rank) FILTER (rank <= 4) AS "values" FROM r GROUP BY k, col"""
QUERIES["P4_ranked_columns"] = lambda s, d: P.ranked_columns(payloads(s, d), 2).select("partition_key", "column", F.round("score", 2).alias("score"), "rank")
ORACLES["P4_ranked_columns"] = f"""WITH {CELLS_SQL}, t AS (SELECT p_brand AS k, p_partkey AS pos FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) <= 300),
n AS (SELECT k, count(*) AS total FROM t GROUP BY 1), p AS (SELECT c.k, col, count(DISTINCT lower(v)) AS d, count(TRY_CAST(v AS DOUBLE)) AS numbers FROM c JOIN t ON t.k = c.k AND t.pos = c.pos GROUP BY ALL),
z AS (SELECT p.k, col, CASE WHEN col <> 'Mean' THEN 4.0 ELSE 0.0 END - CASE WHEN col = 'Mean' THEN 6.0 ELSE 0 END + CASE WHEN d > 1 AND d <= 80 THEN 2.0 ELSE 0 END - CASE WHEN d > 120 THEN 2.0 ELSE 0 END
  - CASE WHEN numbers / total > 0.8 AND d > 20 THEN 4.0 ELSE 0 END - length(replace(col, '_', '')) / 100 AS score FROM p JOIN n ON n.k = p.k),
q AS (SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, col) AS INTEGER) AS rank FROM z) SELECT k AS partition_key, col AS "column", CAST(round(score, 2) AS DOUBLE) AS score, rank FROM q WHERE rank <= 2"""


def _names(s, d):
    src = payloads(s, d).select("partition_key", F.explode(F.map_keys("payload")).alias("column")).distinct()
    tgt = table(s, d, "part").select(F.col("p_brand").alias("partition_key"), F.explode(F.array(F.lit("group label"), F.lit("TYPE"), F.lit("Readout"))).alias("column")).distinct()
    return P.same_name_relations(src, tgt)


QUERIES["P5_same_name_relations"] = _names
ORACLES["P5_same_name_relations"] = "SELECT DISTINCT p_brand AS partition_key, unnest(['Group_Label', 'Type']) AS source_column, unnest(['group label', 'TYPE']) AS target_column FROM part"


def _greedy(s, d):
    p = table(s, d, "part")
    c = p.groupBy("p_brand", "p_type").agg(F.max("p_size").cast("double").alias("score"))
    c = c.select(F.col("p_brand").alias("partition_key"), F.array(F.concat(F.lit("s"), (F.col("score") % 3).cast("int").cast("string"))).alias("source_columns"), F.col("p_type").alias("target_column"), "score")
    return P.disjoint_relations(c).select("partition_key", F.col("source_columns")[0].alias("source_column"), "target_column", "score")


QUERIES["P7_disjoint_relations"] = _greedy
ORACLES["P7_disjoint_relations"] = """WITH RECURSIVE c AS (SELECT *, 's' || (score % 3) AS s, row_number() OVER (PARTITION BY k ORDER BY score DESC, t) AS n FROM (SELECT p_brand AS k, p_type AS t, CAST(max(p_size) AS INTEGER) AS score FROM part GROUP BY ALL)),
g(k, n, us, ut, took, s, t, score) AS (SELECT DISTINCT k, CAST(0 AS BIGINT), []::VARCHAR[], []::VARCHAR[], false, '', '', 0 FROM c UNION ALL
  SELECT c.k, c.n, CASE WHEN free THEN list_append(us, c.s) ELSE us END, CASE WHEN free THEN list_append(ut, c.t) ELSE ut END, free, c.s, c.t, c.score
  FROM (SELECT g.k, g.n, g.us, g.ut, c.n AS cn, NOT list_contains(us, c.s) AND NOT list_contains(ut, c.t) AS free FROM g JOIN c ON c.k = g.k AND c.n = g.n + 1) x JOIN c ON c.k = x.k AND c.n = x.cn)
SELECT k AS partition_key, s AS source_column, t AS target_column, CAST(score AS DOUBLE) AS score FROM g WHERE took"""


def _checked(s, d):
    plans = K.plans(s, d)
    names = plans.select("partition_key", F.array(F.lit("X_Label"), F.lit("Size"), F.lit("Value")).alias("known_source"), F.array(F.lit("Name"), F.lit("Size"), F.lit("Group")).alias("known_target"))
    return P.plan_summary(P.checked_plans(plans, names))


QUERIES["P8_P9_checked_plans"] = _checked
ORACLES["P8_P9_checked_plans"] = "SELECT DISTINCT lower(p_brand) AS partition_key, 1 AS relations, 'high' AS confidence, lower(p_brand) = 'brand#5' AS needs_review FROM part WHERE lower(p_brand) <> 'brand#7'"


def _evidence(s, d):
    l = table(s, d, "lineitem")
    cells = l.select(F.col("l_orderkey").alias("row_id"), F.col("l_suppkey").alias("item_id"), F.when(F.col("l_linenumber") % 2 == 0, "Dose").otherwise("Route").alias("column")).distinct()
    ev = l.filter("l_partkey % 50 = 0").groupBy(F.col("l_suppkey").alias("item_id")).agg(F.array_sort(F.collect_set("l_orderkey")).alias("rows"))
    ev = ev.select(F.concat(F.lit("E"), "item_id").alias("evidence_id"), "item_id", F.array(F.lit("Dose")).alias("columns"), "rows", F.when(F.col("item_id") % 10 == 0, "item").otherwise("row").alias("scope"))
    return P.cell_evidence(cells, ev)


QUERIES["J17_cell_evidence"] = _evidence
ORACLES["J17_cell_evidence"] = """WITH e AS (SELECT DISTINCT l_suppkey AS item_id, l_orderkey AS row_id FROM lineitem WHERE l_partkey % 50 = 0)
SELECT DISTINCT l.l_orderkey AS row_id, l.l_suppkey AS item_id, 'Dose' AS "column", 'E' || l.l_suppkey AS evidence_id FROM lineitem l WHERE l_linenumber % 2 = 0
  AND ((l_suppkey % 10 = 0 AND l_suppkey IN (SELECT item_id FROM e)) OR EXISTS (SELECT 1 FROM e WHERE e.item_id = l_suppkey AND e.row_id = l_orderkey))"""
QUERIES["W10_W11_element_groups"] = lambda s, d: P.grouped_elements(P.columns_by_position(G.bands(sheets(s, d)))).select("sheet", "r1", "c1", "place", "rows_between", F.col("grp").cast("int").alias("grp"))
ORACLES["W10_W11_element_groups"] = f"""WITH {BANDS_SQL}, b AS (SELECT sheet, r1, r2, c1, c2, count_if(NOT starts_with(value, 'w')) AS numbers FROM cb JOIN cx USING (sheet, r1, c) GROUP BY ALL),
p AS (SELECT *, CAST(row_number() OVER w AS INTEGER) AS place, r1 - lag(r2) OVER w - 1 AS g, lag(numbers) OVER w AS before FROM b WINDOW w AS (PARTITION BY sheet ORDER BY r1, c1)),
q AS (SELECT *, CASE WHEN g IS NOT NULL THEN greatest(0, g) END AS rows_between FROM p)
SELECT sheet, r1, c1, place, CAST(rows_between AS INTEGER) AS rows_between, CAST(sum(CASE WHEN rows_between <= 2 AND numbers > 0 AND before > 0 THEN 0 ELSE 1 END) OVER (PARTITION BY sheet ORDER BY place) AS INTEGER) AS grp FROM q"""


def _pixels(s, d):
    e = table(s, d, "events").select(F.col("event_type").alias("figure"), (F.col("event_id") % 100).alias("x"), (F.col("event_id") % 60).alias("y"), F.round(F.col("value") * 100).cast("long").alias("value"))
    c = table(s, d, "events").select(F.col("event_type").alias("figure")).distinct().select("figure", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("cell"))
    c = c.select("figure", "cell", (F.col("cell") * 15).alias("x1"), (F.col("cell") * 15 + 10).alias("x2"), (F.col("cell") * 8).alias("y1"), (F.col("cell") * 8 + 15).alias("y2"))
    return P.mean_by_cell(e, c).select("figure", "cell", "pixels", F.round("mean", 3).alias("mean"))


QUERIES["A17_cell_means"] = _pixels
ORACLES["A17_cell_means"] = """WITH e AS (SELECT event_type AS figure, event_id % 100 AS x, event_id % 60 AS y, CAST(round(value * 100) AS BIGINT) AS v FROM events), c AS (SELECT CAST(unnest(range(0, 6)) AS INTEGER) AS cell)
SELECT figure, cell, count(*) AS pixels, round(avg(v), 3) AS mean FROM e, c WHERE x BETWEEN cell * 15 + 2 AND cell * 15 + 8 AND y BETWEEN cell * 8 + 3 AND cell * 8 + 12 GROUP BY ALL"""
QUERIES["T11_block_keys"] = lambda s, d: table(s, d, "pages").select("page_id", F.array_join(V.block_keys(F.concat("url", F.lit("/Block_1.CSV"))), " ").alias("keys"))
ORACLES["T11_block_keys"] = "SELECT page_id, lower(trim(url)) || '/block_1.csv block_1.csv block_1' AS keys FROM pages"


def _axis(s, d):
    p = table(s, d, "part")
    k, n = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    raw = F.when(k == 0, n).when(k == 1, F.concat(F.lit("10"), F.translate((F.col("p_size") % 7).cast("string"), "0123456", "⁰¹²³⁴⁵⁶"))).when(k == 2, F.concat(n, F.lit(".5 × 10^-2"))).when(k == 3, F.concat(F.lit("1,"), F.lpad(n, 3, "0"))).otherwise("n.d.")
    return p.select("p_partkey", F.round(V.axis_number(raw), 6).alias("value"))


QUERIES["T14_axis_numbers"] = _axis
ORACLES["T14_axis_numbers"] = "SELECT p_partkey, round(CASE p_partkey % 5 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN pow(10.0, p_size % 7) WHEN 2 THEN (p_size + 0.5::DOUBLE) * 0.01::DOUBLE WHEN 3 THEN CAST(1000 + p_size AS DOUBLE) END, 6) AS value FROM part"


def _titles(s, d):
    t = F.concat(F.lit("Abstract of it all\n\n# "), F.col("text"), F.lit("\nsee doi 10.1234/ab.c-"), F.col("doc_id").cast("string"), F.lit(" now"))
    title, doi = V.title_and_doi(t, 10_000_000)
    return table(s, d, "documents").select("doc_id", F.left(title, F.lit(40)).alias("title"), doi.alias("doi"))


QUERIES["T22_title_and_doi"] = _titles
ORACLES["T22_title_and_doi"] = rf"""WITH n AS (SELECT doc_id, unnest(range(0, len(p))) AS i, unnest(p) AS x FROM (SELECT doc_id, string_split('# ' || text || chr(10) || 'see doi', chr(10)) AS p FROM documents)),
c AS (SELECT doc_id, i, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '!\[[^\]]*\]\([^)]+\)', ' ', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '[`*_>#]+', ' ', 'g'), '\s+', ' ', 'g')) AS x FROM n),
f AS (SELECT doc_id, arg_min(x, i) AS t FROM c WHERE len(string_split(x, ' ')) >= 3 AND NOT regexp_matches(lower(x), '^(abstract|figure|fig\.)') GROUP BY 1)
SELECT d.doc_id, coalesce(left(left(t, 220), 40), left('see doi 10.1234/ab.c-' || d.doc_id || ' now', 40)) AS title, '10.1234/ab.c-' || d.doc_id AS doi FROM documents d LEFT JOIN f ON f.doc_id = d.doc_id"""
QUERIES["T26_group_labels"] = lambda s, d: labels_of_parts(s, d).select("id", F.array_join(V.group_labels(F.col("label"), [(1, r"[A-Z]{3,}"), (2, r"[a-z]{4,}"), (3, r"[0-9]+")]), "|").alias("labels"))
ORACLES["T26_group_labels"] = f"""WITH {LABELS_SQL}, u AS (SELECT id, unnest(range(0, len(a))) AS i, unnest(a) AS s FROM (SELECT id, list_concat(list_concat(regexp_extract_all(label, '[A-Z]{{3,}}'), regexp_extract_all(label, '[a-z]{{4,}}')), regexp_extract_all(label, '[0-9]+')) AS a FROM m)),
n AS (SELECT id, s, min(i) AS i FROM u GROUP BY ALL) SELECT m.id, coalesce(string_agg(s, '|' ORDER BY i), '') AS labels FROM m LEFT JOIN n ON n.id = m.id GROUP BY m.id"""
QUERIES["T27_rule_table"] = lambda s, d: labels_of_parts(s, d).groupBy(V.first_rule(F.col("label"), [("suppl", "supplement"), ("fig", "figure"), ("tbl", "table"), ("table", "table")], "other").alias("kind")).agg(F.count("*").alias("n"))
ORACLES["T27_rule_table"] = f"WITH {LABELS_SQL} SELECT CASE WHEN lower(label) LIKE '%suppl%' THEN 'supplement' WHEN lower(label) LIKE '%fig%' THEN 'figure' WHEN lower(label) LIKE '%tbl%' OR lower(label) LIKE '%table%' THEN 'table' ELSE 'other' END AS kind, count(*) AS n FROM m GROUP BY 1"
QUERIES["T28_caption_lookup"] = lambda s, d: table(s, d, "documents").select("doc_id", V.caption(F.col("text"), [F.lit("\nThe "), F.lit(". De "), F.lit(" und ")], 60).alias("caption"))
ORACLES["T28_caption_lookup"] = "WITH p AS (SELECT doc_id, text, strpos(text, chr(10) || 'The ') AS a, strpos(text, '. De ') AS b, strpos(text, ' und ') AS c FROM documents) SELECT doc_id, CASE WHEN a > 0 THEN trim(substr(text, a, 60), ' ') WHEN b > 0 THEN trim(substr(text, b, 60), ' ') WHEN c > 0 THEN trim(substr(text, c, 60), ' ') ELSE '' END AS caption FROM p"
QUERIES["T31_numeric_masking"] = lambda s, d: V.without_numbers(table(s, d, "part").select("p_partkey", "p_name", "p_size", "p_brand"), ["p_partkey"])
ORACLES["T31_numeric_masking"] = "SELECT p_partkey, p_name, '' AS p_size, p_brand FROM part"


def _box(s, d):
    p = table(s, d, "part")
    b = V.box(F.col("p_size"), F.col("p_partkey") % 50, F.lit(3), F.lit(1))
    near = V.overlap(b["r1"], b["r2"], F.lit(10), F.lit(20)), V.gap(b["r1"], b["r2"], F.lit(30), F.lit(40))
    return p.select("p_partkey", b["r1"].alias("r1"), b["r2"].alias("r2"), near[0].alias("shared"), near[1].alias("gap"))


QUERIES["T32_box_algebra"] = _box
ORACLES["T32_box_algebra"] = "WITH b AS (SELECT p_partkey, least(p_size, p_partkey % 50) AS r1, greatest(p_size, p_partkey % 50) AS r2 FROM part) SELECT p_partkey, r1, r2, greatest(0, least(r2, 20) - greatest(r1, 10) + 1) AS shared, greatest(0, greatest(r1, 30) - least(r2, 40) - 1) AS gap FROM b"


def _csv(s, d):
    """Parts written as CSV in the shared folder and scanned as text."""
    path = fresh_path(s)
    S.write_table(table(s, d, "part").withColumn("p_type", F.when(F.col("p_partkey") % 3 == 0, "NA").otherwise(F.col("p_type"))), path, ["p_partkey", "p_type", "unit", "p_name"])
    return S.text_table(s, path, na_as_blank=True)


QUERIES["S2_S10_csv_scan_and_sink"] = _csv
ORACLES["S2_S10_csv_scan_and_sink"] = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS p_type, '' AS unit, p_name FROM part"
QUERIES["S3_union_with_source"] = lambda s, d: S.union_with_source([("customer", table(s, d, "customer").select(F.col("c_name").alias("name"), "c_mktsegment")), ("supplier", table(s, d, "supplier").select(F.col("s_name").alias("name")))])
ORACLES["S3_union_with_source"] = "SELECT c_name AS name, c_mktsegment, 'customer' AS source_file FROM customer UNION ALL SELECT s_name, '', 'supplier' FROM supplier"
QUERIES["S8_numbered_lines"] = lambda s, d: S.numbered_lines(table(s, d, "documents").select("doc_id", "text"))
ORACLES["S8_numbered_lines"] = rf"WITH {LINES_SQL} SELECT doc_id, line_no, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line FROM l WHERE trim(regexp_replace(line, '\s+', ' ', 'g')) <> ''"


def _mapping(s, d):
    e = table(s, d, "events").groupBy("event_type").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat(F.when(F.col("event_id") % 2 == 0, "_").otherwise("i"), F.col("event_id")), F.col("props"))))).alias("items"))
    return S.mapping_entries(e.select(F.to_json(F.create_map("event_type", F.from_json("items", "map<string,string>"))).alias("body")), "body").select("folder", "item")


QUERIES["S5_mapping_entries"] = _mapping
ORACLES["S5_mapping_entries"] = "SELECT event_type AS folder, 'i' || event_id AS item FROM events WHERE event_id % 2 <> 0"
