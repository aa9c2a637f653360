"""Queries of the text and identifier functions, over labels, numbers and lines that the tables give."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import literals as L
from ..functions import text as T
from ..operators.tables import experiment_value
from .inputs import LABELS_SQL, LINES_SQL, NUMBERS_SQL, labels_of_parts, lines_of_documents, number_texts, table

QUERIES, ORACLES = {}, {}


def _label(name, *columns):
    """A query of named column functions of the labels."""

    def run(spark, sf_dir):
        rows = labels_of_parts(spark, sf_dir)
        return rows.select("id", *[f(F.col("label")).alias(out) for out, f in columns])

    QUERIES[name] = run


def _line(name, *columns):
    def run(spark, sf_dir):
        return lines_of_documents(spark, sf_dir).select("doc_id", "line_no", *[f(F.col("line")).alias(out) for out, f in columns])

    QUERIES[name] = run


def _number(name, *columns):
    def run(spark, sf_dir):
        return number_texts(spark, sf_dir).select("id", *[f(F.col("value")).alias(out) for out, f in columns])

    QUERIES[name] = run


# SQL macros that the oracles share, written for RE2: no look-around, classes spelt out.
_COMPARE = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  translate(lower(trim({0})), '−×', '-x'),
  '\\bsuppl(?:ementary)?\\.?\\s*(?:fig\\.?|figure)\\b', 'supplementary figure', 'g'),
  '\\bsuppl(?:ementary)?\\.?\\s*(?:tbl\\.?|table)\\b', 'supplementary table', 'g'),
  '\\bfig\\.', 'figure', 'g'), '[_\\-]+', ' ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s.+/%()^-]', ' ', 'g'), '\\s+', ' ', 'g'))"""
_MATCHER = """trim(regexp_replace(regexp_replace(regexp_replace(
  translate(lower(trim({0})), '−×', '-x'), '[_\\-]+', ' ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s.+/%()]', ' ', 'g'), '\\s+', ' ', 'g'))"""
_ITEM = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  translate(lower(trim({0})), '–—−', '---'), '\\s+', ' ', 'g'),
  '\\bextended\\s+data\\s+fig\\.?\\b', 'extended data figure', 'g'), '\\bsupplementary\\s+fig\\.?\\b', 'supplementary figure', 'g'),
  '\\bsupp\\.?\\s+fig\\.?\\b', 'supplementary figure', 'g'), '\\bsupp\\.?\\s+table\\.?\\b', 'supplementary table', 'g'),
  '\\bfig\\.?\\b', 'figure', 'g'), '\\s+', ' ', 'g'), ' .;,')"""


def compare_sql(c: str) -> str:
    return _COMPARE.format(c).replace("\\\\", "\\")


def matcher_sql(c: str) -> str:
    return _MATCHER.format(c).replace("\\\\", "\\")


def item_sql(c: str) -> str:
    return _ITEM.format(c).replace("\\\\", "\\")


ITEM_KEY_SQL = r"""t AS (SELECT id, %s AS x FROM m),
k AS (
  SELECT id, x,
    regexp_extract(x, '(supplementary figure|supplementary table|figure|table)\s*([s]?[0-9]{1,3}[a-z]?)\b', 1) AS n1,
    regexp_extract(x, '(supplementary figure|supplementary table|figure|table)\s*([s]?[0-9]{1,3}[a-z]?)\b', 2) AS i1,
    regexp_extract(x, '\b(fig(?:ure)?|table)\s*([s]?[0-9]{1,3}[a-z]?)\b', 1) AS n2,
    regexp_extract(x, '\b(fig(?:ure)?|table)\s*([s]?[0-9]{1,3}[a-z]?)\b', 2) AS i2,
    regexp_extract(x, '\bsupp(?:lementary)?\s*(?:fig(?:ure)?|table)?\s*([s]?[0-9]{1,3}[a-z]?)\b', 1) AS i3,
    regexp_extract(x, '\b(?:fg|fig|figure)?\s*s\s*([0-9]{1,3}[a-z]?)(?:[^0-9]|$)', 1) AS i4,
    regexp_extract(x, '\b(?:tbl|table)\s*s?\s*([0-9]{1,3}[a-z]?)(?:[^0-9]|$)', 1) AS i5
  FROM t),
i AS (
  SELECT id, CASE
    WHEN i1 <> '' THEN (CASE WHEN starts_with(n1, 'supp') OR starts_with(i1, 's') THEN 'supplementary ' ELSE '' END)
      || (CASE WHEN n1 LIKE '%%table' THEN 'table ' ELSE 'figure ' END) || ltrim(i1, 's')
    WHEN i2 <> '' THEN (CASE WHEN starts_with(i2, 's') THEN 'supplementary ' ELSE '' END)
      || (CASE WHEN n2 = 'table' THEN 'table ' ELSE 'figure ' END) || ltrim(i2, 's')
    WHEN i3 <> '' THEN 'supplementary figure ' || ltrim(i3, 's')
    WHEN i4 <> '' THEN 'supplementary figure ' || i4
    WHEN i5 <> '' THEN 'supplementary table ' || i5 ELSE '' END AS item_key
  FROM k)""" % compare_sql("label")

_label("T1_comparison_text", ("normalized", T.comparison_text))
ORACLES["T1_comparison_text"] = f"WITH {LABELS_SQL} SELECT id, {compare_sql('label')} AS normalized FROM m"
_line("T2_matcher_text", ("normalized", T.matcher_text))
ORACLES["T2_matcher_text"] = f"WITH {LINES_SQL} SELECT doc_id, line_no, {matcher_sql('line')} AS normalized FROM l"
_label("T3_compact_key", ("compact", T.compact_key))
ORACLES["T3_compact_key"] = f"WITH {LABELS_SQL} SELECT id, regexp_replace({compare_sql('label')}, '[^a-z0-9]+', '', 'g') AS compact FROM m"
_label("T4_item_key", ("item_key", T.item_key))
ORACLES["T4_item_key"] = f"WITH {LABELS_SQL}, {ITEM_KEY_SQL} SELECT id, item_key FROM i"
_label("T5_panel_letter", ("panel", T.panel_letter))
ORACLES["T5_panel_letter"] = f"WITH {LABELS_SQL}, {ITEM_KEY_SQL} SELECT id, regexp_extract(item_key, '[0-9]+([a-z])$', 1) AS panel FROM i"
_label("T6_item_id", ("item_id", T.item_id))
ORACLES["T6_item_id"] = f"WITH {LABELS_SQL} SELECT id, {item_sql('label')} AS item_id FROM m"
_label("T7_item_kind", ("kind", T.item_kind), ("supplementary", T.is_supplementary))
ORACLES["T7_item_kind"] = f"""WITH {LABELS_SQL}, t AS (SELECT id, {item_sql('label')} AS x FROM m)
SELECT id, CASE WHEN x LIKE '%table%' THEN 'table' WHEN x LIKE '%figure%' THEN 'figure' ELSE 'unknown' END AS kind,
  x LIKE '%supplementary%' OR regexp_matches(x, '\\bfigure\\s+s\\d+') OR regexp_matches(x, '\\btable\\s+s\\d+') AS supplementary FROM t"""
_label("T8_item_mentions", ("mentions", lambda c: F.array_join(T.item_mentions(c), "|")))
ORACLES["T8_item_mentions"] = (
    f"WITH {LABELS_SQL}, f AS (SELECT id, list_concat("
    + ", list_concat(".join(f"regexp_extract_all(label, '{p}', 1)" for p in T.MENTIONS[:-1])
    + f", regexp_extract_all(label, '{T.MENTIONS[-1]}', 1)"
    + ")" * (len(T.MENTIONS) - 1)
    + f""" AS a FROM m),
u AS (SELECT id, unnest(range(1, len(a) + 1)) AS i, unnest(a) AS s FROM f),
n AS (SELECT id, {item_sql('s')} AS s, min(i) AS i FROM u GROUP BY 1, 2)
SELECT m.id, coalesce(string_agg(s, '|' ORDER BY i), '') AS mentions FROM m LEFT JOIN n ON n.id = m.id AND s <> '' GROUP BY m.id"""
)
_label("T9_search_terms", ("terms", lambda c: F.array_join(T.search_terms(T.item_key(c)), "|")))
ORACLES["T9_search_terms"] = f"""WITH {LABELS_SQL}, {ITEM_KEY_SQL}, z AS (SELECT id, item_key AS k, regexp_extract(item_key, '([0-9]+[a-z]?)$', 1) AS n FROM i)
SELECT id, CASE WHEN k = '' THEN '' WHEN k LIKE 'supplementary table%' THEN k || '|table s' || n
  WHEN k LIKE 'supplementary%' THEN k || '|supplementary fig ' || n || '|supplementary fig. ' || n || '|figure s' || n || '|fig s' || n || '|fig. s' || n
  WHEN k LIKE 'table%' THEN k ELSE k || '|fig ' || n || '|fig. ' || n END AS terms FROM z"""
_label("T10_path_component", ("component", T.path_component))
ORACLES["T10_path_component"] = f"WITH {LABELS_SQL} SELECT id, coalesce(nullif(left(trim(regexp_replace({compare_sql('label')}, '[^a-z0-9]+', '_', 'g'), '_'), 120), ''), 'unknown') AS component FROM m"
_number("T12_numbers", ("number", T.number), ("percent", T.percent_number), ("numeric_like", T.numeric_like))
_PLAIN = "^[-+]?(?:[0-9]+(?:\\.[0-9]*)?|\\.[0-9]+)(?:[eE][-+]?[0-9]+)?$"
ORACLES["T12_numbers"] = f"""WITH {NUMBERS_SQL}, p AS (SELECT id, value, replace(trim(value), ',', '') AS x FROM v)
SELECT id, CASE WHEN regexp_matches(x, '{_PLAIN}') THEN TRY_CAST(x AS DOUBLE) END AS number,
  CASE WHEN regexp_matches(regexp_replace(x, '%$', ''), '{_PLAIN}') THEN regexp_replace(x, '%$', '') ELSE '' END AS percent,
  lower(trim(value)) IN ('nan', 'na', 'n/a', 'none', 'null', 'inf', '-inf') OR regexp_matches(regexp_replace(x, '%$', ''), '{_PLAIN}')
    OR regexp_matches(x, '^[+-]?[0-9]+\\s*/\\s*[+-]?[0-9]+$') AS numeric_like FROM p"""


def _equal(spark, sf_dir):
    rows = number_texts(spark, sf_dir)
    again = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("other"))
    return rows.join(again, "id").select("id", T.numbers_equal(F.col("value"), F.concat(F.lit(" "), F.col("other"))).alias("same"))


QUERIES["T13_numbers_equal"] = _equal
ORACLES["T13_numbers_equal"] = f"""WITH {NUMBERS_SQL}, p AS (SELECT v.id, value, replace(trim(value), ',', '') AS x, o_totalprice AS y FROM v JOIN orders ON o_orderkey = v.id)
SELECT id, coalesce(abs(CASE WHEN regexp_matches(x, '{_PLAIN}') THEN TRY_CAST(x AS DOUBLE) END - CAST(CAST(y AS DECIMAL(18,2)) AS DOUBLE)) <= 1e-9, false) AS same FROM p"""


def _bools(spark, sf_dir):
    o = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"))
    return o.groupBy("flag").agg(F.count("*").alias("n")).select("flag", "n", T.bool_text(F.col("flag")).alias("as_bool"))


QUERIES["T15_bool_text"] = _bools
ORACLES["T15_bool_text"] = """SELECT l_returnflag AS flag, count(*) AS n, CASE WHEN lower(trim(l_returnflag)) IN ('0','false','no','n') THEN 'false'
  WHEN trim(l_returnflag) = '' THEN '' ELSE 'true' END AS as_bool FROM lineitem GROUP BY l_returnflag"""


def _context(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    payload = F.create_map(F.lit("Brand"), F.col("p_brand"), F.lit("Name"), F.col("p_name"), F.lit("Item_Value"), F.col("p_size").cast("string"), F.lit("Type"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type")))
    return p.select("p_partkey", T.context_text(payload, ("item value",)).alias("context"))


QUERIES["T16_context_text"] = _context
ORACLES["T16_context_text"] = "SELECT p_partkey, concat_ws(' | ', p_brand, p_name, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END) AS context FROM part"


def _split(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    listed = F.concat(F.col("p_name"), F.lit(" | "), F.col("p_type"), F.lit(";; "), F.col("p_brand"))
    nested = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(", "), F.col("p_brand"), F.lit("); [a;b], "), F.col("p_size").cast("string"))
    return p.select("p_partkey", F.array_join(T.split_list(listed), "/").alias("listed"), F.array_join(T.split_outside_brackets(nested), "/").alias("nested"))


QUERIES["T17_list_splitting"] = _split
ORACLES["T17_list_splitting"] = "SELECT p_partkey, p_name || '/' || p_type || '/' || p_brand AS listed, p_name || ' (' || p_type || ', ' || p_brand || ')/[a;b]/' || p_size AS nested FROM part"
_line("T18_sentence_text", ("sentence", lambda c: T.sentence_text(F.concat(F.lit("> "), c, F.lit(" [see](http://x.y) ![i](z) **end**")))))
ORACLES["T18_sentence_text"] = rf"""WITH {LINES_SQL} SELECT doc_id, line_no, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  '> ' || line || ' [see](http://x.y) ![i](z) **end**', '!\[[^\]]*\]\([^)]+\)', ' ', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '[`*_>#]+', ' ', 'g'), '\s+', ' ', 'g')) AS sentence FROM l"""
_label("T19_item_hint", ("hint", lambda c: T.item_hint(c, F.lit("none"))))
ORACLES["T19_item_hint"] = rf"""WITH {LABELS_SQL} SELECT id, coalesce(trim(regexp_replace(coalesce(nullif(regexp_extract(label, '(?i)\b(?:Fig\.?|Figure)\s*S?[0-9]+[A-Za-z]?(?:[-,]\s*[A-Za-z])?', 0), ''),
  nullif(regexp_extract(label, '(?i)\bSupplementary\s+(?:Fig\.?|Figure)\s*[0-9]+[A-Za-z]?', 0), ''), nullif(regexp_extract(label, '(?i)\bfigure\s+[0-9]+[a-z]\b', 0), '')), '\s+', ' ', 'g')), 'none') AS hint FROM m"""


def _kinds(spark, sf_dir):
    rows = labels_of_parts(spark, sf_dir)
    heading = F.when(F.col("id") % 4 == 0, "Materials and Methods").otherwise("Results")
    return rows.select("id", T.sentence_kind(F.col("label"), heading, F.lit("supplement_1")).alias("kind"))


QUERIES["T20_sentence_kind"] = _kinds
ORACLES["T20_sentence_kind"] = rf"""WITH {LABELS_SQL}, t AS (SELECT id, trim(label) AS x FROM m)
SELECT id, CASE WHEN starts_with(x, '#') THEN 'section'
  WHEN regexp_matches(lower(x), '^(fig\.?|figure|supplementary fig\.?|supplementary figure)\b') THEN CASE WHEN lower(x) LIKE '%supplementary%' THEN 'supplementary_caption' ELSE 'caption' END
  WHEN id % 4 = 0 THEN 'methods'
  WHEN len(list_filter(regexp_split_to_array(x, '\s+'), lambda w: w <> '')) <= 12 AND regexp_matches(x, '\p{{L}}') AND NOT regexp_matches(x, '\p{{L}}\p{{Lu}}') AND NOT regexp_matches(x, '(^|[^\p{{L}}])\p{{Ll}}') THEN 'title'
  WHEN lower(x) LIKE '%fig%' THEN 'supplementary_caption' WHEN length(x) > 30 THEN 'body' ELSE 'unknown' END AS kind FROM t"""


def _doc_types(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 5
    path = F.concat(F.lit("/p/"), F.when(k == 0, "Source_Data").when(k == 1, "x MOESM1").when(k == 2, "Reporting Summary").when(k == 3, "supplemental").otherwise("main"), F.lit("/"), F.col("source"))
    kind = T.document_type(path)
    return d.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).withColumn("priority", T.document_priority(F.col("kind")))


QUERIES["T21_document_type"] = _doc_types
ORACLES["T21_document_type"] = """SELECT kind, count(*) AS n, CAST(CASE kind WHEN 'main_article' THEN 1 WHEN 'supplementary_information' THEN 2 WHEN 'source_data' THEN 3 ELSE 4 END AS INTEGER) AS priority
FROM (SELECT CASE doc_id % 5 WHEN 0 THEN 'source_data' WHEN 1 THEN 'supplementary_information' WHEN 2 THEN 'reporting_summary' WHEN 3 THEN 'supplementary_information' ELSE 'main_article' END AS kind FROM documents) GROUP BY kind"""


def _phrase(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.phrase_around(F.col("text"), F.lit("thendst-edst"), ("es", "que", "und")).alias("phrase"))


QUERIES["T23_evidence_phrase"] = _phrase
ORACLES["T23_evidence_phrase"] = r"""WITH t AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS x FROM documents),
h AS (SELECT doc_id, x, list_filter(list_transform(['thendst-edst', 'thendst', 'edst', 'es', 'que', 'und'], lambda w: strpos(lower(x), w)), lambda i: i > 0) AS hit FROM t)
SELECT doc_id, CASE WHEN x = '' THEN '' WHEN len(hit) > 0 THEN trim(substr(x, greatest(0, hit[1] - 1 - 160) + 1, 320), ' ;,.') ELSE left(x, 320) END AS phrase FROM h"""


def _compacted(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.head_middle_tail(F.col("text"), 900).alias("compacted"))


QUERIES["T24_compacted_text"] = _compacted
ORACLES["T24_compacted_text"] = """SELECT doc_id, CASE WHEN length(text) <= 900 THEN text ELSE left(text, 300) || chr(10) || '...' || chr(10)
  || substr(text, CAST(floor(length(text) / 2) AS BIGINT) - 150 + 1, 300) || chr(10) || '...' || chr(10) || right(text, 300) END AS compacted FROM documents"""
_label("T25_keywords", ("words", lambda c: F.array_join(F.array_sort(T.keywords(c)), " ")))
ORACLES["T25_keywords"] = f"""WITH {LABELS_SQL} SELECT id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(label), '[a-z0-9]+'),
  lambda w: length(w) >= 3 AND w NOT IN {T.STOP_WORDS}))), ' ') AS words FROM m"""
_label("T30_page_number", ("page", lambda c: T.page_number(F.concat(F.lit("doc_page-"), F.regexp_extract(c, "[0-9]+", 0), F.lit("_7.png")))))
ORACLES["T30_page_number"] = f"WITH {LABELS_SQL} SELECT id, CAST(coalesce(nullif(regexp_extract(label, '[0-9]+', 0), ''), '7') AS INTEGER) AS page FROM m"
_line("F10_line_predicates", ("table_line", T.table_line), ("useful", T.useful_line))
ORACLES["F10_line_predicates"] = rf"""WITH {LINES_SQL}, t AS (SELECT doc_id, line_no, trim(line) AS x FROM l),
q AS (SELECT *, (starts_with(x, '|') AND x LIKE '%|' AND length(x) - length(replace(x, '|', '')) >= 2) OR regexp_matches(x, '^\|?\s*:?-{{3,}}:?\s*(\|\s*:?-{{3,}}:?\s*)+\|?$') AS table_line FROM t)
SELECT doc_id, line_no, table_line, x <> '' AND NOT table_line AND NOT regexp_matches(x, '^!\[[^\]]*\]\([^)]+\)\s*$')
  AND NOT (length(x) > 2000 AND length(regexp_replace(x, '[^\p{{L}}]', '', 'g')) < length(x) * 0.25) AS useful FROM q"""


def _literals(spark, sf_dir):
    """Cells as literals of names and types: a list with a tuple and a dict in it, a dict, a broken list, and no literal."""
    # small rows of much work, which a file of few bytes would leave to one task
    p = table(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    q = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    name, kind, size = F.col("p_name"), F.col("p_type"), F.col("p_size").cast("string")
    listed = F.concat(F.lit("["), q(name), F.lit(", ("), size, F.lit(", \"it\\'s\",), {'b': None, 'a': "), q(kind), F.lit("}, True, ' ']"))
    mapped = F.concat(F.lit("{'z': ["), size, F.lit(", ["), q(name), F.lit("]], 'k': "), q(kind), F.lit("}"))
    broken = F.concat(F.lit("["), q(name), F.lit(", "), q(kind))
    which = F.col("p_partkey") % 4
    return p.select("p_partkey", F.when(which == 0, listed).when(which == 1, mapped).when(which == 2, broken).otherwise(F.concat(name, F.lit("; "), kind)).alias("cell"))


_TUPLE = "'[' || p_size || ',\"it''s\"]'"
_DICT = "'{\"a\":\"' || p_type || '\",\"b\":null}'"
_MAPPED = "'{\"k\":\"' || p_type || '\",\"z\":[' || p_size || ',[\"' || p_name || '\"]]}'"
_BROKEN = "'[''' || p_name || ''', ''' || p_type"
QUERIES["T17_literal_items"] = lambda s, d: _literals(s, d).select("p_partkey", F.array_join(L.split_cell(F.col("cell")), "/").alias("parts"))
ORACLES["T17_literal_items"] = f"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || '/' || {_TUPLE} || '/' || {_DICT} || '/True'
  WHEN 1 THEN '{{''z'': [' || p_size || ', [''' || p_name || ''']]/k'': ''' || p_type || '''}}' WHEN 2 THEN {_BROKEN} ELSE p_name || '/' || p_type END AS parts FROM part"""
QUERIES["T29_nested_text"] = lambda s, d: _literals(s, d).select("p_partkey", experiment_value(L.nested_text(F.col("cell"))).alias("value"))
ORACLES["T29_nested_text"] = f"""SELECT p_partkey, lower(CASE p_partkey % 4 WHEN 0 THEN p_name || '; ' || {_TUPLE} || '; ' || {_DICT} || '; True'
  WHEN 1 THEN {_MAPPED} WHEN 2 THEN {_BROKEN} || '''' ELSE p_name || '; ' || p_type END) AS value FROM part"""
