"""Queries of the sentence index and of evidence located in documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import keywords
from ..operators import documents as D
from ..operators import fuzzy as Z
from ..operators.support import supporting_sentences
from .inputs import table

QUERIES, ORACLES = {}, {}


def articles(s, d):
    """Documents with headings and table lines: each seventh line is a heading, each eleventh after the fifth a table row."""
    t = table(s, d, "documents")
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 7 == 0, F.concat(F.lit("## Fig. "), (i + 1).cast("string"), F.lit(" "), x)).when(i % 11 == 5, F.lit("| a | b |")).otherwise(x))
    return t.select("doc_id", F.array_join(lines, "\n").alias("text"), F.concat(F.lit("/p/"), F.col("source"), F.lit("/"), F.when(F.col("doc_id") % 3 == 0, "supplementary.md").otherwise("main.md")).alias("path"))


ARTICLES_SQL = r"""a0 AS (SELECT doc_id, unnest(range(0, len(p))) AS n, unnest(p) AS x FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
a AS (SELECT doc_id, n, CASE WHEN n % 7 = 0 THEN '## Fig. ' || (n + 1) || ' ' || x WHEN n % 11 = 5 THEN '| a | b |' ELSE x END AS line FROM a0),
b AS (SELECT *, trim(line) AS st, starts_with(trim(line), '#') AS hd, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n) - length(line) - 1 AS start FROM a),
c AS (SELECT *, NOT hd AND st <> '' AND NOT ((starts_with(st, '|') AND st LIKE '%|' AND length(st) - length(replace(st, '|', '')) >= 2) OR regexp_matches(st, '^\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?$'))
  AND NOT (length(st) > 2000 AND length(regexp_replace(st, '[^\p{L}]', '', 'g')) < length(st) * 0.25) AS useful FROM b),
e AS (SELECT *, nullif(regexp_extract(st, '(?i)\b(?:Fig\.?|Figure)\s*S?[0-9]+[A-Za-z]?(?:[-,]\s*[A-Za-z])?', 0), '') AS own,
  CASE WHEN hd THEN trim(regexp_replace(st, '^#+', '')) END AS name, lag(useful, 1, false) OVER (PARTITION BY doc_id ORDER BY n) AS prev FROM c),
f AS (SELECT *, coalesce(CASE WHEN hd THEN own END, last_value(CASE WHEN useful THEN own END IGNORE NULLS) OVER w, '') AS hint, coalesce(last_value(name IGNORE NULLS) OVER w, '') AS heading,
  last_value(CASE WHEN hd OR (useful AND NOT prev) THEN n END IGNORE NULLS) OVER w AS seg FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT doc_id, seg, trim(string_agg(CASE WHEN hd THEN heading ELSE st END, ' ' ORDER BY n)) AS text, arg_min(start, n) AS start, arg_min(heading, n) AS heading, arg_min(hint, n) AS hint FROM f WHERE hd OR useful GROUP BY ALL)"""
QUERIES["W3_heading_carry"] = lambda s, d: D.marked_lines(articles(s, d)).select("doc_id", "n", "heading", "hint", "start", "useful")
ORACLES["W3_heading_carry"] = f"WITH {ARTICLES_SQL} SELECT doc_id, CAST(n AS INTEGER) AS n, heading, hint, CAST(start AS BIGINT) AS start, useful FROM f"
QUERIES["W4_paragraphs"] = lambda s, d: D.segments(articles(s, d)).select("doc_id", "seg", "start", "text", "heading", "hint")
ORACLES["W4_paragraphs"] = f"WITH {ARTICLES_SQL} SELECT doc_id, CAST(seg AS INTEGER) AS seg, CAST(start AS BIGINT) AS start, text, heading, hint FROM g"
QUERIES["W6_sentence_index"] = lambda s, d: D.sentence_index(articles(s, d)).select("doc_id", "sentence_no", "heading", "hint", "sentence")
ORACLES["W6_sentence_index"] = rf"""WITH {ARTICLES_SQL},
h AS (SELECT *, string_split(regexp_replace(replace(replace(replace(replace(replace(replace(text, 'Fig.', 'Fig§'), 'fig.', 'fig§'), 'Dr.', 'Dr§'), 'e.g.', 'e§g§'), 'i.e.', 'i§e§'), 'et al.', 'et al§'),
  '([.!?])\s+([A-Z0-9\[])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS p FROM g),
i AS (SELECT doc_id, seg, heading, hint, unnest(range(1, len(p) + 1)) AS i, trim(unnest(p)) AS raw FROM h),
j AS (SELECT *, sum(CASE WHEN length(raw) >= 25 OR i = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, seg ORDER BY i) AS chunk FROM i WHERE raw <> ''),
k AS (SELECT doc_id, seg, heading, hint, chunk, string_agg(raw, ' ' ORDER BY i) AS raw FROM j GROUP BY ALL),
l AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(raw, '§', '.'), '!\[[^\]]*\]\([^)]+\)', ' ', 'g'), '\[([^\]]+)\]\([^)]+\)', '\1', 'g'), '[`*_>#]+', ' ', 'g'), '\s+', ' ', 'g')) AS sentence FROM k)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY seg, chunk) AS INTEGER) AS sentence_no, heading, hint, sentence FROM l WHERE length(sentence) >= 8"""
QUERIES["W7_unique_names"] = lambda s, d: D.unique_names(table(s, d, "part").select("p_partkey", "p_name"), "p_name", "p_partkey").select("p_partkey", "unique_name")
ORACLES["W7_unique_names"] = "SELECT p_partkey, p_name || CASE WHEN n = 1 THEN '' ELSE '_' || n END AS unique_name FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part)"
QUERIES["A14_document_context"] = lambda s, d: D.document_context(articles(s, d))
ORACLES["A14_document_context"] = "SELECT CASE WHEN doc_id % 3 = 0 THEN 'supplementary_information' ELSE 'main_article' END AS kind, count(*) AS documents, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS lines, CAST(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS priority FROM documents GROUP BY ALL"


def _located(s, d):
    items = table(s, d, "benchmark")
    needle = F.when(F.col("item_id") % 2 == 0, F.regexp_replace(F.left("text", F.lit(60)), "e", "E")).otherwise(F.regexp_replace(F.left("text", F.lit(60)), " ", "  "))
    return D.located(items.select(F.col("item_id").alias("id"), F.trim(F.regexp_replace(needle, r"\S+$", "")).alias("needle")), table(s, d, "documents").select("doc_id", "text"))


QUERIES["J18_text_location"] = _located
ORACLES["J18_text_location"] = r"""WITH n AS (SELECT item_id AS id, trim(regexp_replace(CASE WHEN item_id % 2 = 0 THEN replace(left(text, 60), 'e', 'E') ELSE replace(left(text, 60), ' ', '  ') END, '\S+$', '')) AS needle FROM benchmark),
h AS (SELECT id, doc_id, strpos(text, needle) AS e, strpos(lower(text), lower(needle)) AS l, strpos(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), trim(regexp_replace(lower(needle), '\s+', ' ', 'g'))) AS p FROM n, documents),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS k FROM h WHERE e > 0 OR l > 0 OR p > 0)
SELECT id, doc_id, CAST(CASE WHEN e > 0 THEN 1 WHEN l > 0 THEN 2 ELSE 3 END AS INTEGER) AS tier, CAST(CASE WHEN e > 0 THEN e WHEN l > 0 THEN l ELSE p END AS INTEGER) AS "at" FROM b WHERE k = 1"""


def _near(s, d):
    """A third of the test items as they are, the others with letters changed, so that no document holds them literally."""
    items = table(s, d, "benchmark")
    needle = F.when(F.col("item_id") % 3 == 0, F.col("text")).when(F.col("item_id") % 3 == 1, F.regexp_replace("text", "th", "ht")).otherwise(F.translate("text", "sm", "mn"))
    return Z.located_or_near(items.select(F.col("item_id").alias("id"), needle.alias("needle")), table(s, d, "documents")).withColumn("score", F.round("score", 6))


QUERIES["J18_fuzzy_location"] = _near


def _groups(s, d):
    lines = table(s, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("sentence_no"), F.col("text").alias("sentence"))
    rules = s.sql("SELECT * FROM VALUES ('en', array('the ', 'that')), ('de', array('und', 'der', 'die')), ('fr', array('les ', 'qui')) AS g(grp, terms)")
    return D.first_with_all(lines, rules)


QUERIES["J16_all_terms_sentences"] = _groups
ORACLES["J16_all_terms_sentences"] = """WITH g(grp, a, b, c) AS (VALUES ('en', 'the ', 'that', ''), ('de', 'und', 'der', 'die'), ('fr', 'les ', 'qui', '')),
h AS (SELECT grp, conv_id, turn FROM g, conversations WHERE contains(lower(text), a) AND contains(lower(text), b) AND contains(lower(text), c)),
k AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY conv_id, turn) AS n, count(*) OVER (PARTITION BY grp) AS hits FROM h) SELECT grp, conv_id AS doc_id, turn AS sentence_no, hits FROM k WHERE n = 1"""


def _turns(s, d):
    return table(s, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("sid"), F.col("text").alias("sentence"), (F.col("conv_id") % 40).cast("string").alias("hint"), "role")


def _support(s, d):
    items = table(s, d, "benchmark").select(F.col("item_id").alias("id"), (F.col("item_id") % 40).cast("string").alias("item"), keywords(F.col("text")).alias("words"))
    return supporting_sentences(items, _turns(s, d).select("sid", "hint", keywords(F.col("sentence")).alias("words"))).select("id", "sid", "score", "rank")


QUERIES["J14_supporting_sentences"] = _support
_WORDS = "list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: length(w) >= 3 AND w NOT IN ('figure', 'fig', 'table', 'the', 'and', 'with', 'from', 'that', 'this', 'for', 'lnpdb')))"
ORACLES["J14_supporting_sentences"] = f"""WITH i AS (SELECT item_id AS id, unnest({_WORDS}) AS w FROM benchmark), t AS (SELECT conv_id * 1000 + turn AS sid, unnest({_WORDS}) AS w FROM conversations),
z AS (SELECT id, sid, sum(CASE WHEN length(w) >= 5 THEN 3 ELSE 1 END) AS score FROM i JOIN t USING (w) GROUP BY ALL UNION ALL SELECT item_id, conv_id * 1000 + turn, 8 FROM benchmark JOIN conversations ON item_id % 40 = conv_id % 40),
y AS (SELECT id, sid, CAST(sum(score) AS BIGINT) AS score FROM z GROUP BY ALL HAVING sum(score) >= 6)
SELECT id, sid, score, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, sid) AS INTEGER) AS rank FROM y QUALIFY rank <= 3"""


_ORDERED = _WORDS.removeprefix('list_distinct(').removesuffix(')')


def _tiered(s, d):
    """Items of which half are named by no turn, one in seven blank; common words stand in more than a fifth of the turns."""
    k = F.col("item_id")
    items = table(s, d, "benchmark").select(k.alias("id"), F.when(k % 7 == 0, "").otherwise((k % 40).cast("string")).alias("item"), keywords(F.col("text")).alias("words"))
    turns = _turns(s, d).select("sid", F.when(F.col("hint").cast("int") < 20, F.col("hint")).otherwise("").alias("hint"), keywords(F.col("sentence")).alias("words"))
    return supporting_sentences(items, turns, tiers=True, common=0.2)


QUERIES["J14_tiered_support"] = _tiered
ORACLES["J14_tiered_support"] = f"""WITH i AS (SELECT item_id AS id, CASE WHEN item_id % 7 = 0 THEN '' ELSE CAST(item_id % 40 AS VARCHAR) END AS item, {_ORDERED} AS ws FROM benchmark),
t AS (SELECT conv_id * 1000 + turn AS sid, CASE WHEN conv_id % 40 < 20 THEN CAST(conv_id % 40 AS VARCHAR) ELSE '' END AS hint, {_WORDS} AS ws FROM conversations),
raw AS (SELECT id, item, unnest(ws) AS w, unnest(range(len(ws))) AS spot FROM i),
iw AS (SELECT id, item, w, row_number() OVER (PARTITION BY id ORDER BY min(spot)) - 1 AS place FROM raw GROUP BY id, item, w), tw AS (SELECT sid, unnest(ws) AS w FROM t), seen AS (SELECT DISTINCT w FROM tw),
tier AS (SELECT id, item, CASE WHEN item <> '' AND item IN (SELECT hint FROM t) THEN 1 WHEN item <> '' AND id IN (SELECT id FROM iw JOIN seen USING (w) WHERE place < 20) THEN 2 ELSE 3 END AS tier FROM i),
z AS (SELECT id, sid, sum(CASE WHEN length(w) >= 5 THEN 3 ELSE 1 END) AS score, min(place) AS place FROM iw JOIN tw USING (w) GROUP BY ALL
  UNION ALL SELECT id, sid, 8, NULL FROM tier JOIN t ON item = hint WHERE item <> ''),
y AS (SELECT id, sid, CAST(sum(score) AS BIGINT) AS score, min(place) AS place FROM z GROUP BY ALL)
SELECT y.id, y.sid, score, CAST(row_number() OVER (PARTITION BY y.id ORDER BY score DESC, y.sid) AS INTEGER) AS rank, tier FROM y JOIN tier USING (id) JOIN t USING (sid)
WHERE score >= 6 AND (tier = 3 OR (tier = 1 AND item = hint) OR (tier = 2 AND place < 20)) QUALIFY rank <= 3"""
QUERIES["J15_required_term_sentences"] = lambda s, d: D.dose_sentences(_turns(s, d), "the", ("ing", "tion"), {"erly": 5, "ble": 3}, ["role"]).select("role", "sid", "score", "rank")
ORACLES["J15_required_term_sentences"] = """WITH h AS (SELECT role, conv_id * 1000 + turn AS sid, CAST(10 + CASE WHEN contains(lower(text), 'erly') THEN 5 ELSE 0 END + CASE WHEN contains(lower(text), 'ble') THEN 3 ELSE 0 END AS INTEGER) AS score
  FROM conversations WHERE contains(lower(text), 'the') AND (contains(lower(text), 'ing') OR contains(lower(text), 'tion')))
SELECT *, CAST(row_number() OVER (PARTITION BY role ORDER BY score DESC, sid) AS INTEGER) AS rank FROM h QUALIFY rank <= 2"""
