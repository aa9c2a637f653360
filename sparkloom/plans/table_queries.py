"""Queries of selection, de-duplication, reshape, profile and report operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import tables as T
from .inputs import LABELS_SQL, NUMBERS_SQL, labels_of_parts, number_texts, table
from .text_queries import item_sql

QUERIES, ORACLES = {}, {}


def _resolved(s, d):
    """Columns of two tables found by loose names, and the kind of table they make."""
    o = table(s, d, "orders")
    price, status = T.find_column(o.columns, ["Total Price", "o_totalprice"]), T.find_column(o.columns, ["O-OrderStatus"])
    return o.groupBy(F.col(status).alias("status")).agg(F.count(price).alias("n")).withColumn("kind", F.lit(T.table_type(["X_Label", price])))


QUERIES["F1_F2_columns"] = _resolved
ORACLES["F1_F2_columns"] = "SELECT o_orderstatus AS status, count(o_totalprice) AS n, 'bar_plot' AS kind FROM orders GROUP BY 1"
QUERIES["F5_schema_conformance"] = lambda s, d: T.conform(table(s, d, "part"), {"p_partkey": "", "p_name": "none", "unit": "mg", "p_type": "other"})
ORACLES["F5_schema_conformance"] = "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, coalesce(nullif(trim(p_name), ''), 'none') AS p_name, 'mg' AS unit, coalesce(nullif(trim(p_type), ''), 'other') AS p_type FROM part"


def _override(s, d):
    """Labels are the manual word, length the automatic rule."""
    docs = table(s, d, "documents").select("doc_id", "n_chars").join(table(s, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return T.select_with_override(docs, F.col("quality").cast("string"), F.col("n_chars") > 2000)


QUERIES["F6_manual_override"] = _override
ORACLES["F6_manual_override"] = "SELECT d.doc_id, d.n_chars, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.quality = 1, d.n_chars > 2000)"


def _covered(s, d):
    p = table(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, "[]").otherwise(F.col("p_type")).alias("m1"), F.when(F.col("p_size") % 2 == 0, " ").otherwise("NaN").alias("m2"))
    return T.split_covered(p, ["m1", "m2"]).select("p_partkey", "covered")


QUERIES["F7_covered_rows"] = _covered
ORACLES["F7_covered_rows"] = "SELECT p_partkey, p_size % 3 <> 0 AS covered FROM part"
QUERIES["F8_faceted_filter"] = lambda s, d: T.facets(table(s, d, "part"), {"p_type": ["ECONOMY", "PROMO"]}, "Gear-", ["p_name", "p_brand"]).select("p_partkey")
ORACLES["F8_faceted_filter"] = "SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND lower(p_name || ' ' || p_brand) LIKE '%gear%'"
QUERIES["F9_row_slice"] = lambda s, d: T.slice_rows(table(s, d, "orders"), ["o_orderdate", "o_orderkey"], 101, 50).select("o_orderkey")
ORACLES["F9_row_slice"] = "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 100"
QUERIES["W1_sequence_ids"] = lambda s, d: T.sequence_ids(table(s, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], "EV")
ORACLES["W1_sequence_ids"] = "SELECT o_custkey, o_orderkey, 'EV' || lpad(n, CAST(greatest(6, length(n)) AS INTEGER), '0') AS row_id FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (ORDER BY o_custkey, o_orderkey) AS VARCHAR) AS n FROM orders)"
QUERIES["U3_first_by_key"] = lambda s, d: T.first_by_key(table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
ORACLES["U3_first_by_key"] = "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1"


def _experiments(s, d):
    p = table(s, d, "part").select("p_brand", "p_partkey", F.upper("p_name").alias("name"), F.when(F.col("p_size") % 4 == 0, "N/A").otherwise(F.col("p_type")).alias("type"))
    return T.same_experiment(p, "p_brand", ["name", "type"], ["p_partkey"]).select("p_partkey", "experiment_key", "kept")


QUERIES["U4_same_experiment"] = _experiments
ORACLES["U4_same_experiment"] = """WITH k AS (SELECT p_brand, p_partkey, lower(p_name) || '|' || CASE WHEN p_size % 4 = 0 THEN 'NA' ELSE lower(p_type) END AS experiment_key FROM part)
SELECT p_partkey, experiment_key, row_number() OVER (PARTITION BY p_brand, experiment_key ORDER BY p_partkey) = 1 AS kept FROM k"""
QUERIES["T29_experiment_value"] = lambda s, d: number_texts(s, d).select("id", T.experiment_value(F.col("value")).alias("value"))
ORACLES["T29_experiment_value"] = f"WITH {NUMBERS_SQL} SELECT id, CASE WHEN value = 'n/a' THEN 'NA' ELSE lower(trim(value)) END AS value FROM v"
QUERIES["U1_union_differing"] = lambda s, d: table(s, d, "customer").select(F.col("c_name").alias("name"), "c_mktsegment").unionByName(table(s, d, "supplier").select(F.col("s_name").alias("name"), "s_acctbal"), allowMissingColumns=True)
ORACLES["U1_union_differing"] = "SELECT c_name AS name, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier"
QUERIES["U2_full_row_distinct"] = lambda s, d: table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()
ORACLES["U2_full_row_distinct"] = "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem"


def _coverage(s, d):
    """Parts that were sold, not sold, and sold but unknown."""
    known, sold = table(s, d, "part").select(F.col("p_partkey").alias("k")), table(s, d, "lineitem").select(F.col("l_partkey").alias("k")).filter("k % 5 <> 0").distinct()
    return (
        known.join(sold, "k", "left_anti").select("k", F.lit("unsold").alias("what")).unionByName(sold.join(known, "k", "left_anti").select("k", F.lit("unknown").alias("what")))
        .unionByName(known.join(sold, "k", "left_semi").select("k", F.lit("sold").alias("what")))
    )


QUERIES["U5_coverage_sets"] = _coverage
ORACLES["U5_coverage_sets"] = """WITH s AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_partkey % 5 <> 0)
SELECT p_partkey AS k, CASE WHEN s.k IS NULL THEN 'unsold' ELSE 'sold' END AS what FROM part LEFT JOIN s ON s.k = p_partkey UNION ALL SELECT k, 'unknown' FROM s WHERE k NOT IN (SELECT p_partkey FROM part)"""
QUERIES["R1_matrix_to_long"] = lambda s, d: T.matrix_to_long(table(s, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.col("c_mktsegment")).alias("segment")), "c_custkey")
ORACLES["R1_matrix_to_long"] = "SELECT c_custkey, 'c_name' AS col_label, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer WHERE c_custkey % 3 <> 0"
QUERIES["R2_long_to_matrix"] = lambda s, d: T.long_to_matrix(table(s, d, "lineitem").select(F.col("l_suppkey").alias("row"), F.col("l_returnflag").alias("col"), F.col("l_partkey").alias("v")), "row", "col", "v", ["A", "N", "R"])
ORACLES["R2_long_to_matrix"] = 'SELECT l_suppkey AS row, min(l_partkey) FILTER (l_returnflag = \'A\') AS "A", min(l_partkey) FILTER (l_returnflag = \'N\') AS "N", min(l_partkey) FILTER (l_returnflag = \'R\') AS "R" FROM lineitem GROUP BY 1'


def _exploded(s, d):
    p = table(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.concat(F.lit("fig "), F.col("p_size").cast("string"), F.lit(", ,"), F.col("p_type"))).alias("items"))
    return T.explode_list(p, "items")


QUERIES["R3_item_list_explode"] = _exploded
ORACLES["R3_item_list_explode"] = "SELECT p_partkey, unnest(CASE WHEN p_size % 5 = 0 THEN [''] ELSE ['fig ' || p_size, p_type] END) AS items FROM part"


def _product(s, d):
    p = table(s, d, "part").select("p_partkey", "p_name", "p_type")
    return T.explode_product(p, {"p_name": F.split("p_name", " "), "p_type": X.split_list(F.concat(F.col("p_type"), F.lit(";x|"), F.col("p_type")))})


QUERIES["R4_cartesian_explode"] = _product
ORACLES["R4_cartesian_explode"] = "SELECT DISTINCT p_partkey, a.w AS p_name, b.w AS p_type FROM part, LATERAL (SELECT unnest(string_split(p_name, ' ')) AS w) a, LATERAL (SELECT unnest([p_type, 'x']) AS w) b"


def _label_table(s, d):
    b = table(s, d, "part").groupBy("p_brand").agg(F.collect_set("p_type").alias("types"), F.collect_set((F.col("p_size") % 4).cast("string")).alias("groups"))
    return b.select("p_brand", F.explode("types").alias("x_label"), "groups").select("p_brand", "x_label", F.explode("groups").alias("group"))


QUERIES["R5_label_groups"] = _label_table
ORACLES["R5_label_groups"] = """SELECT a.p_brand, x_label, "group" FROM (SELECT DISTINCT p_brand, p_type AS x_label FROM part) a JOIN (SELECT DISTINCT p_brand, CAST(p_size % 4 AS VARCHAR) AS "group" FROM part) b ON a.p_brand = b.p_brand"""


def _payload(s, d):
    e = table(s, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    back = F.from_json(F.to_json(F.map_concat("m", F.create_map(F.lit("id"), F.col("event_id").cast("string")))), "map<string,string>")
    return e.select("event_id", back["k"].alias("k"), back["id"].alias("id"))


QUERIES["R6_json_payload"] = _payload
ORACLES["R6_json_payload"] = "SELECT event_id, props ->> '$.k' AS k, CAST(event_id AS VARCHAR) AS id FROM events"
QUERIES["R8_grid_edges"] = lambda s, d: table(s, d, "supplier").select("s_suppkey", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.col("s_suppkey") * 10 + i * 2.5 + 1.25)).alias("i", "centre"))
ORACLES["R8_grid_edges"] = "SELECT s_suppkey, CAST(i AS INTEGER) AS i, s_suppkey * 10 + i * 2.5 + 1.25 AS centre FROM (SELECT s_suppkey, unnest(range(0, 5)) AS i FROM supplier)"
ORACLES["R8_grid_edges"] = "SELECT s_suppkey, CAST(i AS INTEGER) AS i, CAST(s_suppkey * 10 AS DOUBLE) + CAST(i AS DOUBLE) * 2.5 + 1.25 AS centre FROM (SELECT s_suppkey, unnest(range(0, 5)) AS i FROM supplier)"
QUERIES["P1_column_profile"] = lambda s, d: T.column_profile(table(s, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", F.col("p_size").cast("string").alias("p_size")), ["p_partkey"])
ORACLES["P1_column_profile"] = """WITH c AS (UNPIVOT (SELECT p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part) ON COLUMNS(*) INTO NAME "column" VALUE v),
n AS (SELECT "column", v, count(*) AS n FROM c WHERE trim(v) <> '' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS k FROM n)
SELECT "column", CAST(sum(n) AS BIGINT) AS non_empty, count(*) AS "distinct", string_agg(v || '=' || n, '|' ORDER BY k) FILTER (k <= 3) AS top FROM r GROUP BY 1"""


def _numeric(s, d):
    p = table(s, d, "part")
    m = F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("name"), F.col("p_name"), F.lit("key"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey").cast("string")).otherwise("x"), F.lit("x_pixel"), F.lit("1"))
    return T.numeric_column(p.select(F.col("p_brand").alias("partition_key"), m.alias("payload")), ["x_pixel"])


QUERIES["P3_value_column"] = _numeric
ORACLES["P3_value_column"] = "SELECT p_brand AS partition_key, 'size' AS value_column, count(*) AS numbers FROM part GROUP BY 1"


def _overlap(s, d):
    p = table(s, d, "part")
    src = p.filter("p_partkey % 2 = 0").select(F.lower("p_type").alias("partition_key"), F.explode(F.create_map(F.lit("word"), F.split("p_name", " ")[0], F.lit("brand"), F.col("p_brand"))).alias("column", "value"), F.col("p_partkey").alias("pos"))
    tgt = p.filter("p_partkey % 2 = 1").select(F.lower("p_type").alias("partition_key"), F.explode(F.create_map(F.lit("name"), F.col("p_name"), F.lit("label"), F.concat_ws(" ", "p_brand", "p_type"))).alias("column", "value"), F.col("p_partkey").alias("pos"))
    return T.overlap_coverage(src, tgt)


QUERIES["P6_overlap_coverage"] = _overlap
ORACLES["P6_overlap_coverage"] = r"""WITH s0 AS (SELECT lower(p_type) AS k, 'word' AS c, split_part(p_name, ' ', 1) AS v, p_partkey AS pos FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT lower(p_type), 'brand', p_brand, p_partkey FROM part WHERE p_partkey % 2 = 0),
t0 AS (SELECT lower(p_type) AS k, 'name' AS c, p_name AS v, p_partkey AS pos FROM part WHERE p_partkey % 2 = 1 UNION ALL SELECT lower(p_type), 'label', p_brand || ' ' || p_type, p_partkey FROM part WHERE p_partkey % 2 = 1),
s1 AS (SELECT k, c, replace(lower(v), '#', ' ') AS v, min(pos) AS pos FROM s0 GROUP BY ALL), t1 AS (SELECT k, c, replace(lower(v), '#', ' ') AS v, min(pos) AS pos FROM t0 GROUP BY ALL),
s AS (SELECT k, c, v, row_number() OVER (PARTITION BY k, c ORDER BY pos, v) AS n FROM s1), t AS (SELECT k, c, v FROM t1 QUALIFY row_number() OVER (PARTITION BY k, c ORDER BY pos, v) <= 40),
o AS (SELECT k, c, least(count(*), 251) AS observed FROM s GROUP BY ALL),
h AS (SELECT s.k, s.c, t.c AS tc, s.v FROM s JOIN t ON s.k = t.k AND contains(t.v, s.v) WHERE s.n <= 250 GROUP BY ALL HAVING count(*) = 1)
SELECT h.k AS partition_key, h.c AS "column", h.tc AS target_column, count(*) AS matched, observed, count(*) / observed AS coverage FROM h JOIN o ON o.k = h.k AND o.c = h.c GROUP BY h.k, h.c, h.tc, observed"""


def _items(s, d):
    return labels_of_parts(s, d).select("id", X.item_id(F.col("label")).alias("item"))


QUERIES["A1_base_groups"] = lambda s, d: T.base_groups(_items(s, d).filter("item rlike '^(figure|table) '"), F.regexp_extract("item", r"^((?:figure|table) [a-z]?[0-9]+)", 1), F.col("item"))
ORACLES["A1_base_groups"] = rf"""WITH {LABELS_SQL}, t AS (SELECT {item_sql('label')} AS item FROM m)
SELECT regexp_extract(item, '^((?:figure|table) [a-z]?[0-9]+)', 1) AS base, string_agg(DISTINCT item, '|' ORDER BY item) AS panels FROM t WHERE regexp_matches(item, '^(figure|table) ') GROUP BY 1"""


def _parents(s, d):
    items = _items(s, d).filter("item rlike '^figure [0-9]+'").select(F.regexp_extract("item", "^figure [0-9]+[a-z]?", 0).alias("item"))
    return T.without_parents(items, "item")


QUERIES["A2_hierarchy_filter"] = _parents
ORACLES["A2_hierarchy_filter"] = rf"""WITH {LABELS_SQL}, t AS (SELECT DISTINCT regexp_extract(x, '^figure [0-9]+[a-z]?', 0) AS item FROM (SELECT {item_sql('label')} AS x FROM m) WHERE regexp_matches(x, '^figure [0-9]+'))
SELECT item FROM t WHERE item NOT IN (SELECT rtrim(regexp_replace(item, '[a-z]$', '')) FROM t WHERE regexp_matches(item, '[a-z]$'))"""
QUERIES["A3_replicates"] = lambda s, d: T.replicates(number_texts(s, d).withColumn("label", F.col("id") % 40), ["label"], "value", "id").select("label", "replicates", F.round("mean", 3).alias("mean"), "original_values", "replicate_type")
ORACLES["A3_replicates"] = f"""WITH {NUMBERS_SQL}, p AS (SELECT id, value, id % 40 AS label, TRY_CAST(replace(value, ',', '') AS DOUBLE) AS x FROM v)
SELECT label, count(*) AS replicates, round(avg(x), 3) AS mean, string_agg(value, '|' ORDER BY id) AS original_values, CASE WHEN count(*) > 1 THEN 'replicate_mean' ELSE 'single_value' END AS replicate_type FROM p WHERE x IS NOT NULL GROUP BY 1"""


def _diagnostics(s, d):
    expected = table(s, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 6).alias("expected"))
    actual = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("actual"))
    return T.count_diagnostics(actual, expected, "o_orderkey")


QUERIES["A6_count_diagnostics"] = _diagnostics
ORACLES["A6_count_diagnostics"] = """WITH e AS (SELECT o_orderkey, o_orderkey % 6 AS expected, coalesce(n, 0) AS actual FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)
SELECT *, CASE WHEN expected = 0 THEN 'unknown' WHEN actual = expected THEN 'match' WHEN abs(actual - expected) / expected <= 0.1 THEN 'near' WHEN actual < expected THEN 'short' ELSE 'over' END AS verdict FROM e"""
QUERIES["A15_usage_totals"] = lambda s, d: table(s, d, "events").rollup("event_type").agg(F.count("*").alias("calls"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
ORACLES["A15_usage_totals"] = "SELECT event_type, count(*) AS calls, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ROLLUP (event_type)"
QUERIES["A16_distinct_options"] = lambda s, d: table(s, d, "documents").select(F.trim("source").alias("option")).distinct().filter("option <> ''").orderBy("option")
ORACLES["A16_distinct_options"] = "SELECT DISTINCT trim(source) AS option FROM documents WHERE trim(source) <> ''"


def _output_check(s, d):
    l, o = table(s, d, "lineitem"), table(s, d, "orders")
    n, m = l.agg(F.countDistinct("l_orderkey").alias("out_rows")), o.agg(F.count("*").alias("in_rows"))
    missing = [c for c in ("o_orderkey", "o_note") if c not in o.columns]
    return n.crossJoin(F.broadcast(m)).select("out_rows", "in_rows", (F.col("out_rows") == F.col("in_rows")).alias("same"), F.lit(",".join(missing)).alias("missing"))


QUERIES["A18_output_contract"] = _output_check
ORACLES["A18_output_contract"] = "SELECT a AS out_rows, b AS in_rows, a = b AS same, 'o_note' AS missing FROM (SELECT count(DISTINCT l_orderkey) AS a FROM lineitem), (SELECT count(*) AS b FROM orders)"
QUERIES["A19_non_empty_cells"] = lambda s, d: table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left").agg(F.sum(sum(F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != ""), 1).otherwise(0) for c in ("text", "lang", "quality", "toxic"))).alias("cells"))
ORACLES["A19_non_empty_cells"] = "SELECT CAST(sum((trim(text) <> '')::INT + (trim(lang) <> '')::INT + (quality IS NOT NULL)::INT + (toxic IS NOT NULL)::INT) AS BIGINT) AS cells FROM documents LEFT JOIN labels USING (doc_id)"


def _integrity(s, d):
    """Duplicate keys, lines without an order, orders without lines."""
    l, o, p = table(s, d, "lineitem"), table(s, d, "orders"), table(s, d, "part")
    dup = l.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("n")).select(F.lit("duplicate_lines").alias("check"), "n")
    lost = o.join(l, o.o_orderkey == l.l_orderkey, "left_anti").agg(F.count("*").alias("n")).select(F.lit("orders_without_lines").alias("check"), "n")
    free = l.join(p, l.l_partkey == p.p_partkey, "left_anti").agg(F.count("*").alias("n")).select(F.lit("lines_without_part").alias("check"), "n")
    return dup.unionByName(lost).unionByName(free)


QUERIES["A11_referential_integrity"] = _integrity
ORACLES["A11_referential_integrity"] = """SELECT 'duplicate_lines' AS "check", (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS n
UNION ALL SELECT 'orders_without_lines', (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) UNION ALL SELECT 'lines_without_part', (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))"""


def _violations(s, d):
    o = table(s, d, "orders")
    return o.agg(F.count_if(F.col("o_totalprice") < 1000).alias("cheap"), F.count_if(~F.col("o_orderstatus").isin("F", "O")).alias("status"), F.count_if(~F.col("o_orderpriority").rlike("^[1-5]-")).alias("priority"), F.count_distinct("o_custkey").alias("customers"))


QUERIES["A10_rule_violations"] = _violations
ORACLES["A10_rule_violations"] = "SELECT count_if(o_totalprice < 1000) AS cheap, count_if(o_orderstatus NOT IN ('F', 'O')) AS status, count_if(NOT regexp_matches(o_orderpriority, '^[1-5]-')) AS priority, count(DISTINCT o_custkey) AS customers FROM orders"


def _rollup(s, d):
    """Sources of each language as one bar-separated list, joined onto all languages."""
    docs = table(s, d, "documents")
    lists = docs.select("lang", "source").distinct().groupBy("lang").agg(F.array_join(F.array_sort(F.collect_list("source")), "|").alias("sources"), F.count("*").alias("n"))
    return docs.select("doc_id", "lang").join(lists, "lang", "left").select("doc_id", "sources", F.col("n").alias("n_sources"))


QUERIES["A5_match_rollup"] = _rollup
ORACLES["A5_match_rollup"] = "SELECT doc_id, sources, n AS n_sources FROM documents JOIN (SELECT lang, string_agg(DISTINCT source, '|' ORDER BY source) AS sources, count(DISTINCT source) AS n FROM documents GROUP BY lang) USING (lang)"
QUERIES["O1_natural_sort"] = lambda s, d: labels_of_parts(s, d).select("id", X.item_key(F.col("label")).alias("k")).filter("k <> ''").groupBy("k").agg(F.count("*").alias("n")).withColumn("place", F.row_number().over(Window.orderBy(X.natural_key(F.col("k"))))).select("k", "n", "place")
from .text_queries import ITEM_KEY_SQL  # noqa: E402

ORACLES["O1_natural_sort"] = rf"""WITH {LABELS_SQL}, {ITEM_KEY_SQL} SELECT item_key AS k, count(*) AS n, CAST(row_number() OVER (ORDER BY item_key LIKE 'supp%', item_key LIKE '%table%', CAST(regexp_extract(item_key, '[0-9]+', 0) AS INTEGER), item_key) AS INTEGER) AS place
FROM i WHERE item_key <> '' GROUP BY item_key"""
QUERIES["O2_ordinal_sort"] = lambda s, d: table(s, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("place", F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "F", 2).otherwise(9)).orderBy("place", "o_orderstatus")
ORACLES["O2_ordinal_sort"] = "SELECT o_orderstatus, count(*) AS n, CAST(CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 9 END AS INTEGER) AS place FROM orders GROUP BY 1"
QUERIES["O3_top_k"] = lambda s, d: table(s, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice").withColumn("k", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))).filter("k <= 3")
ORACLES["O3_top_k"] = "SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS k FROM orders QUALIFY k <= 3"
QUERIES["O4_case_insensitive_sort"] = lambda s, d: table(s, d, "part").orderBy(F.lower("p_name"), "p_partkey").select("p_partkey")
ORACLES["O4_case_insensitive_sort"] = "SELECT p_partkey FROM part ORDER BY lower(p_name), p_partkey"
