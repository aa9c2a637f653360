"""Queries of resolution joins and the windows that go with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import padded
from ..operators import resolve as R
from .inputs import table

QUERIES, ORACLES = {}, {}


def _best(s, d):
    p = table(s, d, "part")
    items = p.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_brand").alias("text"), F.when(F.col("p_size") < 10, F.concat(F.lit("figure "), F.col("p_size"))).otherwise("").alias("item_key"))
    blocks = p.select(F.col("p_partkey").alias("block"), F.concat_ws(" ", "p_name", "p_type").alias("text"), F.concat(F.lit("figure "), F.col("p_size")).alias("item_key"))
    return R.best_by_keywords(items, blocks)


QUERIES["J12_best_block"] = _best
ORACLES["J12_best_block"] = """WITH i AS (SELECT p_partkey AS id, unnest(list_distinct(list_filter(regexp_extract_all(lower(p_name || ' ' || p_brand), '[a-z0-9]+'), lambda w: length(w) >= 3))) AS w FROM part),
b AS (SELECT p_partkey AS block, unnest(list_distinct(list_filter(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z0-9]+'), lambda w: length(w) >= 3))) AS w FROM part),
z AS (SELECT id, block, count(*) AS score FROM i JOIN b USING (w) GROUP BY ALL UNION ALL SELECT a.p_partkey, c.p_partkey, 5 FROM part a JOIN part c ON a.p_size = c.p_size WHERE a.p_size < 10),
t AS (SELECT id, block, CAST(sum(score) AS BIGINT) AS score FROM z GROUP BY ALL) SELECT id, block, score FROM t QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, block) = 1"""


def _contained(s, d):
    p = table(s, d, "part")
    items = p.select("p_type", F.col("p_partkey").alias("item"), F.split("p_name", " ")[0].alias("item_token"))
    files = p.select("p_type", F.col("p_partkey").alias("file"), F.regexp_replace("p_name", " ", "").alias("file_token"))
    return R.best_by_containment(items, files, "p_type")


QUERIES["J13_best_file"] = _contained
ORACLES["J13_best_file"] = """WITH j AS (SELECT a.p_partkey AS item, b.p_partkey AS file, CAST(least(length(split_part(a.p_name, ' ', 1)), length(replace(b.p_name, ' ', ''))) AS INTEGER) AS overlap
  FROM part a JOIN part b ON a.p_type = b.p_type AND (contains(split_part(a.p_name, ' ', 1), replace(b.p_name, ' ', '')) OR contains(replace(b.p_name, ' ', ''), split_part(a.p_name, ' ', 1))))
SELECT item, file, overlap FROM j QUALIFY row_number() OVER (PARTITION BY item ORDER BY overlap DESC, file) = 1"""


def _lookup(s, d):
    p, c = table(s, d, "part"), table(s, d, "supplier")
    rows = p.select("p_partkey", F.upper(F.regexp_replace("p_name", " ", "-")).alias("name"))
    first = p.filter("p_size < 12").select(F.col("p_name").alias("name"), F.concat(F.lit("A"), F.col("p_partkey")).alias("value"), F.col("p_partkey").alias("pos"))
    second = p.select(F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("B"), F.col("p_partkey"))).alias("value"), F.col("p_partkey").alias("pos"))
    return R.reference_lookup(rows, "name", [("curated", first), ("catalogue", second)]).select("p_partkey", "value", "source")


QUERIES["J19_reference_lookup"] = _lookup
ORACLES["J19_reference_lookup"] = """WITH a AS (SELECT p_name, 'A' || max(p_partkey) AS v FROM part WHERE p_size < 12 GROUP BY 1), b AS (SELECT p_name, 'B' || max(p_partkey) AS v FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1)
SELECT p_partkey, coalesce(a.v, b.v, '') AS value, CASE WHEN a.v IS NOT NULL THEN 'curated' WHEN b.v IS NOT NULL THEN 'catalogue' ELSE 'none' END AS source FROM part p LEFT JOIN a ON a.p_name = p.p_name LEFT JOIN b ON b.p_name = p.p_name"""


def _novel(s, d):
    """Curated values of every part's name but one in five, a catalogue of all; parts of three sizes are new."""
    p = table(s, d, "part")
    rows = p.select("p_partkey", F.upper(F.regexp_replace("p_name", " ", "-")).alias("name"), F.when(F.col("p_size") % 3 == 0, " Novel").when(F.col("p_size") % 3 == 1, "known").alias("novelty"))
    of = lambda mark, blank: p.select(F.col("p_name").alias("name"), F.when(F.col("p_partkey") % blank == 0, "").otherwise(F.concat(F.lit(mark), F.col("p_partkey"))).alias("value"), F.col("p_partkey").alias("pos"))
    return R.reference_lookup(rows, "name", [("curated", of("A", 5)), ("catalogue", of("B", 3))], "novelty").select("p_partkey", "value", "source")


QUERIES["J19_novel_lookup"] = _novel
ORACLES["J19_novel_lookup"] = """WITH a AS (SELECT p_name, 'A' || max(p_partkey) AS v FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1), b AS (SELECT p_name, 'B' || max(p_partkey) AS v FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1)
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN coalesce(b.v, '') ELSE coalesce(a.v, b.v, '') END AS value,
CASE WHEN p_size % 3 <> 0 AND a.v IS NOT NULL THEN 'curated' WHEN b.v IS NOT NULL THEN 'catalogue' ELSE 'none' END AS source FROM part p LEFT JOIN a ON a.p_name = p.p_name LEFT JOIN b ON b.p_name = p.p_name"""
QUERIES["J21_enrichment"] = lambda s, d: R.enrich(table(s, d, "documents").select("doc_id", "lang"), table(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic")), "doc_id", {"quality": "unknown", "toxic": "unknown"})
ORACLES["J21_enrichment"] = "SELECT doc_id, lang, coalesce(CAST(quality AS VARCHAR), 'unknown') AS quality, coalesce(CAST(toxic AS VARCHAR), 'unknown') AS toxic FROM documents LEFT JOIN labels USING (doc_id)"


def _prioritised(s, d):
    p = table(s, d, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    meta = table(s, d, "part").groupBy(F.col("p_name").alias("key")).agg(F.count("*").cast("string").alias("value")).filter("value = '1'").unionByName(table(s, d, "part").filter("p_brand < 'Brand#2'").groupBy(F.col("p_brand").alias("key")).agg(F.count("*").cast("string").alias("value")))
    return R.prioritised(p, [F.col("p_name"), F.col("p_brand"), F.col("p_type")], meta, "p_partkey").select("p_partkey", "key", "value", "priority")


QUERIES["J22_prioritised_metadata"] = _prioritised
ORACLES["J22_prioritised_metadata"] = """WITH n AS (SELECT p_name FROM part GROUP BY 1 HAVING count(*) = 1), b AS (SELECT p_brand, CAST(count(*) AS VARCHAR) AS v FROM part WHERE p_brand < 'Brand#2' GROUP BY 1)
SELECT p_partkey, coalesce(n.p_name, b.p_brand) AS key, CASE WHEN n.p_name IS NOT NULL THEN '1' ELSE b.v END AS value, CASE WHEN n.p_name IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 END AS priority
FROM part p LEFT JOIN n ON n.p_name = p.p_name LEFT JOIN b ON b.p_brand = p.p_brand"""


def _mutual(s, d):
    p = table(s, d, "part")
    values = p.select("p_brand", F.col("p_partkey").alias("value_id"), F.split("p_name", " ")[1].alias("group"))
    entities = p.select("p_brand", F.col("p_partkey").alias("pos"), F.initcap("p_name").alias("entity"))
    return R.first_mutual(values, entities, "p_brand")


QUERIES["J24_value_group_match"] = _mutual
ORACLES["J24_value_group_match"] = """WITH j AS (SELECT a.p_partkey AS value_id, b.p_partkey AS pos, b.p_name AS e FROM part a JOIN part b ON a.p_brand = b.p_brand WHERE (contains(replace(b.p_name, ' ', ''), split_part(a.p_name, ' ', 2)) OR contains(split_part(a.p_name, ' ', 2), replace(b.p_name, ' ', ''))))
SELECT value_id, upper(left(split_part(e, ' ', 1), 1)) || substr(split_part(e, ' ', 1), 2) || ' ' || upper(left(split_part(e, ' ', 2), 1)) || substr(split_part(e, ' ', 2), 2) AS entity FROM j QUALIFY row_number() OVER (PARTITION BY value_id ORDER BY pos) = 1"""


def _fallback(s, d):
    l, o = table(s, d, "labels"), table(s, d, "documents")
    return R.with_fallback(l.select("doc_id", F.col("quality").cast("string").alias("v")), o.select("doc_id", F.col("lang").alias("v")), "doc_id")


QUERIES["J25_fallback_mapping"] = _fallback
ORACLES["J25_fallback_mapping"] = "SELECT doc_id, CAST(quality AS VARCHAR) AS v FROM labels UNION ALL SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"


def _colours(s, d):
    single = lambda n: F.lit(n).cast("float")  # noqa: E731 - with whole numbers Spark would go on in double precision, where 0.01 gives 9 and not 10
    shade = lambda c: F.when(F.isnan(c), c.cast("double")).otherwise(F.floor(c).cast("double"))  # noqa: E731 - floor makes 0 of what is no number
    e = table(s, d, "embeddings").select("vec_id", *[shade(F.abs(F.get("embedding", F.lit(i)).cast("float")) * single(1000) % single(256)).alias(c) for i, c in enumerate("xyz")])
    L, a, b = R.lab(F.col("x"), F.col("y"), F.col("z"))
    rows = e.select("vec_id", L.alias("L"), a.alias("a"), b.alias("b"))
    bar = table(s, d, "region").select(F.col("r_regionkey").alias("value"), (F.col("r_regionkey") * 60).cast("double").alias("g"))
    pL, pa, pb = R.lab(F.col("g"), F.lit(80.0), 255.0 - F.col("g"))
    return R.nearest_colour(rows, bar.select("value", pL.alias("L"), pa.alias("a"), pb.alias("b")), "vec_id").select("vec_id", "value", F.round("distance", 3).alias("distance"))


def _lab_sql(r, g, b):
    lin = [f"(CASE WHEN {c} / 255.0::DOUBLE > 0.04045 THEN pow(({c} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) ELSE {c} / 255.0::DOUBLE / 12.92 END)" for c in (r, g, b)]
    rows = ((0.4124564, 0.3575761, 0.1804375, 0.95047), (0.2126729, 0.7151522, 0.0721750, 1.0), (0.0193339, 0.1191920, 0.9503041, 1.08883))
    xyz = [f"(({lin[0]} * {x} + {lin[1]} * {y} + {lin[2]} * {z}) / {w})" for x, y, z, w in rows]
    f = [f"(CASE WHEN {t} > 0.008856 THEN pow({t}, 1.0::DOUBLE / 3) ELSE 7.787 * {t} + 16.0::DOUBLE / 116.0 END)" for t in xyz]
    return f"116.0 * {f[1]} - 16.0", f"500.0 * ({f[0]} - {f[1]})", f"200.0 * ({f[1]} - {f[2]})"


QUERIES["J28_nearest_colour"] = _colours
_c, _p = _lab_sql("x", "y", "z"), _lab_sql("g", "80.0::DOUBLE", "(255.0 - g)")
ORACLES["J28_nearest_colour"] = f"""WITH e AS (SELECT vec_id, {', '.join(f'CAST(floor(abs(embedding[{i + 1}]::FLOAT) * 1000 % 256) AS DOUBLE) AS {c}' for i, c in enumerate('xyz'))} FROM embeddings),
r AS (SELECT vec_id, {_c[0]} AS L, {_c[1]} AS a, {_c[2]} AS b FROM e), q AS (SELECT r_regionkey AS value, CAST(r_regionkey * 60 AS DOUBLE) AS g FROM region), p AS (SELECT value, {_p[0]} AS L, {_p[1]} AS a, {_p[2]} AS b FROM q),
j AS (SELECT vec_id, value, sqrt((p.L - r.L) ** 2 + (p.a - r.a) ** 2 + (p.b - r.b) ** 2) AS distance FROM r, p)
SELECT vec_id, value, round(distance, 3) AS distance FROM j QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, value) = 1"""


def _calibration(s, d):
    """Calibration points on a parabola, so that other neighbours give other values."""
    e = table(s, d, "events").select("event_type", F.col("event_id").alias("point"), F.floor("value").alias("pixel"))
    cal = table(s, d, "events").groupBy("event_type", F.floor(F.col("value") / 10).alias("k")).agg(F.min(F.floor("value")).alias("cal_pixel")).select("event_type", "cal_pixel", (F.col("cal_pixel") * F.col("cal_pixel") + 7).cast("double").alias("cal_value"))
    return R.calibrated(e, cal, "event_type").select("event_type", "point", F.round("value", 4).alias("value"))


QUERIES["J29_calibration"] = _calibration
ORACLES["J29_calibration"] = """WITH c AS (SELECT event_type, min(floor(value)) AS x FROM events GROUP BY event_type, floor(value / 10)),
p AS (SELECT DISTINCT event_type, floor(value) AS px FROM events), j AS (SELECT p.*, x, row_number() OVER (PARTITION BY p.event_type, px ORDER BY abs(x - px), x) AS n FROM p JOIN c ON c.event_type = p.event_type),
t AS (SELECT event_type, px, min(x) AS a, max(x) AS b FROM j WHERE n <= 2 GROUP BY ALL)
SELECT e.event_type, event_id AS point, CASE WHEN a <> b THEN round(CAST(a * a + 7 + (px - a) * (a + b) AS DOUBLE), 4) END AS value FROM events e JOIN t ON t.event_type = e.event_type AND px = floor(e.value)"""


def _ingest(s, d):
    e = table(s, d, "events").filter("event_id % 4 <> 3")
    k = F.col("event_id") % 7
    body = F.when(k == 0, "oops").when(k == 1, F.concat(F.lit('{"id": '), F.col("event_id") + 1, F.lit(', "v": 1}'))).when(k == 2, F.concat(F.lit('{"id": '), F.col("event_id"), F.lit(', "v": " "}'))).otherwise(F.concat(F.lit('{"id": '), F.col("event_id"), F.lit(', "v": 2}')))
    return R.ingest_results(table(s, d, "events").select(F.col("event_id").alias("id")), e.select(F.col("event_id").alias("id"), body.alias("body")), ["v"]).groupBy("state").agg(F.count("*").alias("n"))


QUERIES["J30_result_ingestion"] = _ingest
ORACLES["J30_result_ingestion"] = "SELECT CASE WHEN event_id % 4 = 3 THEN 'no result' WHEN event_id % 7 = 0 THEN 'not an object' WHEN event_id % 7 = 1 THEN 'another id' WHEN event_id % 7 = 2 THEN 'missing v' ELSE 'ok' END AS state, count(*) AS n FROM events GROUP BY 1"


def _ids(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("R"), padded(F.floor(F.col("o_orderkey") / 2), 6))).otherwise(F.lit("")).alias("row_id"))
    return R.complete_ids(o, "row_id", "o_orderkey", "R").select("o_orderkey", "new_id")


QUERIES["W2_row_id_completion"] = _ids
ORACLES["W2_row_id_completion"] = """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'R' || lpad(CAST(o_orderkey // 2 AS VARCHAR), CAST(greatest(6, length(CAST(o_orderkey // 2 AS VARCHAR))) AS INTEGER), '0') ELSE '' END AS row_id FROM orders),
k AS (SELECT *, row_id <> '' AND row_number() OVER (PARTITION BY row_id ORDER BY o_orderkey) = 1 AS keep, 'R' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(6, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS made FROM o)
SELECT o_orderkey, CASE WHEN keep THEN row_id WHEN made IN (SELECT row_id FROM k WHERE keep) THEN made || 'x' ELSE made END AS new_id FROM k"""
QUERIES["W9_replicate_index"] = lambda s, d: R.same_entity_replicate(table(s, d, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min("l_returnflag").alias("grp")), ["l_orderkey", "grp"], "l_partkey").select("l_orderkey", "l_partkey", "replicate")
ORACLES["W9_replicate_index"] = "SELECT l_orderkey, l_partkey, count(*) OVER (PARTITION BY l_orderkey, min(l_returnflag) ORDER BY l_partkey) AS replicate FROM lineitem GROUP BY l_orderkey, l_partkey"
ORACLES["W9_replicate_index"] = "SELECT l_orderkey, l_partkey, count(*) OVER (PARTITION BY l_orderkey, grp ORDER BY l_partkey ROWS UNBOUNDED PRECEDING) AS replicate FROM (SELECT l_orderkey, l_partkey, min(l_returnflag) AS grp FROM lineitem GROUP BY 1, 2)"


def _grouping(s, d):
    l = table(s, d, "lineitem")
    groups = l.groupBy(F.col("l_suppkey").alias("grp")).agg(F.collect_set("l_partkey").alias("members"))
    return R.keep_first_grouping(groups, table(s, d, "part").select(F.col("p_partkey").alias("element")))


QUERIES["A20_grouping_normalisation"] = _grouping
ORACLES["A20_grouping_normalisation"] = "SELECT p_partkey AS element, coalesce(CAST(min(l_suppkey) AS VARCHAR), 'single:' || p_partkey) AS grp FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey"


def _alias(s, d):
    p = table(s, d, "part")
    entries = p.filter("p_size < 20").select(F.col("p_partkey").alias("pos"), F.array(F.col("p_name"), F.concat_ws("-", F.split("p_name", " ")[1], F.split("p_name", " ")[0])).alias("aliases"), F.concat(F.lit("V"), F.col("p_partkey")).alias("value"))
    return R.alias_lookup(p.select("p_partkey", F.upper(F.regexp_replace("p_name", " ", "_")).alias("name")), "name", entries).select("p_partkey", "value")


QUERIES["J20_alias_lookup"] = _alias
ORACLES["J20_alias_lookup"] = """WITH a AS (SELECT replace(p_name, ' ', '') AS k, p_partkey AS pos FROM part WHERE p_size < 20 UNION ALL SELECT split_part(p_name, ' ', 2) || split_part(p_name, ' ', 1), p_partkey FROM part WHERE p_size < 20),
f AS (SELECT k, min(pos) AS pos FROM a GROUP BY 1) SELECT p_partkey, coalesce('V' || pos, '') AS value FROM part LEFT JOIN f ON k = replace(p_name, ' ', '')"""


def _status(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("source_quality"), F.lit("high").alias("confidence"), F.when(F.col("o_orderkey") % 2 == 0, "").otherwise("seen").alias("reason"))
    return R.mapping_status(o, ["P"])


QUERIES["F14_mapping_status"] = _status
ORACLES["F14_mapping_status"] = """SELECT o_orderkey, o_orderstatus AS source_quality, CASE WHEN o_orderstatus = 'P' THEN 'low' ELSE 'high' END AS confidence,
  CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'fallback source' ELSE 'seen; fallback source' END WHEN o_orderkey % 2 = 0 THEN '' ELSE 'seen' END AS reason,
  o_orderstatus = 'P' AS needs_review, CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'not_separated' END AS status FROM orders"""


def _counts(s, d):
    o, l = table(s, d, "orders"), table(s, d, "lineitem")
    rows = o.select(F.col("o_orderkey").alias("row_id"), F.when(F.col("o_orderstatus") == "P", " ").otherwise("1").alias("value"))
    return R.finalisation_counts(rows, l.select(F.col("l_partkey").alias("item_id")), l.select(F.col("l_orderkey").alias("row_id")))


QUERIES["A9_finalisation_counts"] = _counts
ORACLES["A9_finalisation_counts"] = """WITH x AS (SELECT count(*) AS "rows", count(DISTINCT o_orderkey) AS distinct_rows, count_if(o_orderstatus <> 'P') AS rows_with_value, count_if(o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS rows_without_evidence FROM orders),
y AS (SELECT count(*) AS evidence, count(DISTINCT l_partkey) AS items_with_evidence, count(*) AS links, count(DISTINCT l_orderkey) AS rows_with_evidence FROM lineitem) UNPIVOT (SELECT * FROM x, y) ON COLUMNS(*) INTO NAME counter VALUE n"""
