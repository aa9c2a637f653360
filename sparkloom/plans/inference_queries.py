"""Queries of plan inference and of the merge that follows from it: rows of part against target rows that name them another way."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import natural_key
from ..operators import inference as I
from ..operators import linkage as L
from .inputs import table

QUERIES, ORACLES = {}, {}


def source_rows(s, d):
    p = table(s, d, "part")
    word = F.split("p_name", " ")
    payload = F.create_map(F.lit("X_Label"), F.upper(word[0]), F.lit("Kind"), F.concat(F.lit(" "), "p_type"), F.lit("Item"), word[1], F.lit("x_pixel"), F.lit("7"), F.lit("Value"), F.col("p_retailprice").cast("string"))
    return p.select(F.lower("p_brand").alias("partition_key"), F.col("p_partkey").alias("pos"), F.col("p_partkey").cast("string").alias("id"), payload.alias("payload"))


def target_rows(s, d):
    """One row for each kind of part of a brand, without values."""
    p = table(s, d, "part").groupBy("p_brand", "p_name", "p_type").agg(F.min("p_partkey").alias("pos"))
    word = F.split("p_name", " ")
    payload = F.create_map(F.lit("TreatmentName"), F.concat_ws("_", word[0], F.lower("p_type")), F.lit("Readout"), F.initcap(word[1]), F.lit("experimental_value"), F.lit(""))
    return p.select(F.lower("p_brand").alias("partition_key"), "pos", F.concat(F.lit("T"), "pos").alias("id"), payload.alias("payload"))


def _pools(s, d):
    sf, tf = I.column_facts(source_rows(s, d)), I.column_facts(target_rows(s, d))
    return I.usable_columns(sf, I.value_columns(sf, "source"), "source"), I.usable_columns(tf, I.value_columns(tf, "target"), "target")


def _coverage(s, d):
    out = I.tuple_coverage(source_rows(s, d), target_rows(s, d), *_pools(s, d), I.LIMITED.tuples, I.LIMITED.values).filter(F.col("coverage") >= I.LEAST_COVERAGE)
    return out.select("partition_key", F.array_join("source_columns", "+").alias("source_columns"), "target_column", "matched", "observed", "coverage", F.size("pairs").alias("pairs"))


def _relations(s, d):
    each = I.plan_review(I.inferred_plans(source_rows(s, d), target_rows(s, d), I.LIMITED))
    return each.select("partition_key", "relation", "source_columns", "target_columns", "mode", "value_pairs", "confidence", "needs_review")


def _links(s, d):
    plans = I.inferred_plans(source_rows(s, d), target_rows(s, d), I.LIMITED)
    return L.linked_pairs(source_rows(s, d), target_rows(s, d), plans).select("partition_key", "source_id", "target_id", "score")


def _progress(s, d):
    _, _, merged = I.inferred_merge(source_rows(s, d), target_rows(s, d), natural_key(F.col("partition_key")))
    return L.merge_progress(merged).select("step", "partition_key", "inserted", "inserted_so_far")


FIRST_VALUES_SQL = " QUALIFY row_number() OVER (PARTITION BY k, col ORDER BY pos) <= 40"
FOUND_SQL = f"""b AS (SELECT lower(p_brand) AS k, p_partkey AS pos, [lower(split_part(p_name, ' ', 1)), lower(p_type), lower(split_part(p_name, ' ', 2))] AS v FROM part),
x(i, j) AS (VALUES (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)),
st AS (SELECT DISTINCT k, i, j, v[i] AS p, v[j] AS q FROM b, x),
t AS (SELECT k, v[1] || ' ' || v[2] AS treatment, v[3] AS readout, min(pos) AS pos FROM b GROUP BY ALL),
tv AS (SELECT k, 1 AS col, treatment AS norm, min(pos) AS pos FROM t GROUP BY ALL UNION ALL SELECT k, 2, readout, min(pos) FROM t GROUP BY ALL),
firsts AS (SELECT * FROM tv{FIRST_VALUES_SQL}),
h AS (SELECT st.k, i, j, p, q, col, min(norm) AS norm FROM st JOIN firsts ON firsts.k = st.k AND contains(norm, p) AND contains(norm, q) GROUP BY ALL HAVING count(*) = 1),
o AS (SELECT k, i, j, count(*) AS observed FROM st GROUP BY ALL),
c AS (SELECT h.k, h.i, h.j, col, count(*) AS matched, any_value(observed) AS observed, count(*) / any_value(observed) AS coverage FROM h JOIN o ON o.k = h.k AND o.i = h.i AND o.j = h.j GROUP BY ALL HAVING count(*) / any_value(observed) >= 0.6),
ranked AS (SELECT *, coverage + CASE WHEN i = j THEN 0.01::DOUBLE ELSE 0.02::DOUBLE END AS score FROM c),
one AS (SELECT * FROM ranked QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, col, i <> j, i, j) = 1),
two AS (SELECT r.* FROM ranked r JOIN one ON one.k = r.k AND r.col <> one.col AND r.i NOT IN (one.i, one.j) AND r.j NOT IN (one.i, one.j) QUALIFY row_number() OVER (PARTITION BY r.k ORDER BY r.score DESC, r.col, r.i <> r.j, r.i, r.j) = 1),
rel AS (SELECT *, 1 AS n FROM one UNION ALL SELECT *, 2 FROM two)"""
WHOLE_SQL = FOUND_SQL.replace(FIRST_VALUES_SQL, "")
NAMES_SQL = "['X_Label', 'Kind', 'Item'][i] || CASE WHEN i = j THEN '' ELSE '+' || ['X_Label', 'Kind', 'Item'][j] END AS source_columns, ['TreatmentName', 'Readout'][col]"
LINKS_SQL = """met AS (SELECT b.k, b.pos AS s, t.pos AS t, count(*) AS met FROM b JOIN t ON t.k = b.k JOIN rel ON rel.k = b.k JOIN h ON h.k = b.k AND h.i = rel.i AND h.j = rel.j AND h.col = rel.col AND h.p = b.v[rel.i] AND h.q = b.v[rel.j]
  AND h.norm = CASE rel.col WHEN 1 THEN t.treatment ELSE t.readout END GROUP BY b.k, b.pos, t.pos),
links AS (SELECT met.k, s, t FROM met JOIN (SELECT k, count(*) AS rels FROM rel GROUP BY k) r ON r.k = met.k AND met.met = r.rels)"""

QUERIES["P6_tuple_coverage"] = _coverage
ORACLES["P6_tuple_coverage"] = f"""WITH {FOUND_SQL} SELECT k AS partition_key, {NAMES_SQL} AS target_column, matched, observed, coverage, CAST(matched AS INTEGER) AS pairs FROM c"""
QUERIES["P7_P8_inferred_relations"] = _relations
ORACLES["P7_P8_inferred_relations"] = f"""WITH {FOUND_SQL} SELECT k AS partition_key, n AS relation, {NAMES_SQL} AS target_columns, 'value_map' AS mode, CAST(matched AS INTEGER) AS value_pairs, 'high' AS confidence, false AS needs_review FROM rel
UNION ALL SELECT DISTINCT k, 0, '', '', '', 0, 'low', true FROM b WHERE k NOT IN (SELECT k FROM rel)"""
QUERIES["J2_inferred_linkage"] = _links
ORACLES["J2_inferred_linkage"] = f"""WITH {FOUND_SQL}, {LINKS_SQL} SELECT k AS partition_key, CAST(s AS VARCHAR) AS source_id, 'T' || t AS target_id, 100 AS score FROM links"""
QUERIES["W12_inferred_merge"] = _progress
ORACLES["W12_inferred_merge"] = f"""WITH {WHOLE_SQL}, {LINKS_SQL}, single AS (SELECT k, s, min(t) AS t FROM links GROUP BY ALL HAVING count(*) = 1), taken AS (SELECT k, t FROM single GROUP BY ALL HAVING count(*) = 1),
p AS (SELECT k, count(taken.t) AS inserted FROM (SELECT DISTINCT k FROM b) d LEFT JOIN taken USING (k) GROUP BY k), z AS (SELECT *, CAST(row_number() OVER (ORDER BY CAST(split_part(k, '#', 2) AS INTEGER)) AS INTEGER) AS step FROM p)
SELECT step, k AS partition_key, inserted, CAST(sum(inserted) OVER (ORDER BY step) AS BIGINT) AS inserted_so_far FROM z"""
