"""Source divergence audit: hash-consed segment trees over term ids, and a traversal of two trees that prices equal pairs of nodes once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import save
from .words import chunks, flat

#: Scale of a probability, documents that a term must stand in, and ranks of terms that are told.
SCALE, LEAST_DOCS, TOP = 1_000_000_000, 3, 200
#: About so many terms make a tree, and so many sources of a language meet in one task.
BLOCK, TILE = 1 << 12, 48
#: Rows that a task gathers before it adds them up.
_HELD = 400_000

_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)
_COUNTS = "lang string, source string, term string, n long, docs long"


def _terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of a text column in order, lower-cased in A-Z, and the text that each is in."""
    data, offsets = flat(texts)
    part = np.zeros(len(data) + 2, bool)
    part[1:-1] = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(part[1:] & (~part[:-1] | edge))
    end = np.flatnonzero(part[:-1] & (~part[1:] | edge))
    ends = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=ends[1:])
    letters = _LOWER[data[part[1:-1]]]
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(letters))
    return terms, np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, offsets)))


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences, and documents, of each term by lang and source."""
    terms, doc = _terms(batch.column("text"))
    coded = pc.dictionary_encode(terms)
    size = max(1, len(coded.dictionary))
    each, n = np.unique(doc * size + coded.indices.to_numpy(), return_counts=True)
    kinds = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
    names, of_doc = {}, np.empty(len(kinds), np.int64)
    for i, kind in enumerate(kinds.to_pylist()):
        of_doc[i] = names.setdefault((kind["lang"], kind["source"]), len(names))
    keys, at = np.unique(of_doc[each // size] * size + each % size, return_inverse=True)
    group = pa.array(keys // size)
    langs, sources = (pa.array([k[i] for k in names], pa.string()).take(group) for i in (0, 1))
    return pa.table({
        "lang": langs, "source": sources, "term": coded.dictionary.take(pa.array(keys % size)).cast(pa.string()),
        "n": np.bincount(at, n, len(keys)).astype(np.int64), "docs": np.bincount(at, minlength=len(keys)).astype(np.int64),
    })


def _added(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences of each term in a group, and documents of the group that hold it; added up in the tasks first."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for part in chunks(batch):
                held.append(_counted(part))
                rows += len(held[-1])
                if rows > _HELD:
                    held = [_added(held)]
                    rows = len(held[0])
                    if rows > _HELD // 2:
                        yield from held[0].combine_chunks().to_batches()
                        held, rows = [], 0
        if held:
            yield from _added(held).combine_chunks().to_batches()

    parts = docs.select("lang", "source", "text").mapInArrow(tasks, _COUNTS)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)) as a whole number."""
    wide = F.lit(SCALE).cast("decimal(19,0)") * (n + 1).cast("decimal(19,0)")
    return F.call_function("div", wide, (total + kept).cast("decimal(19,0)")) + 1


def _prices(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    if not len(n) or int(n.max()) < (1 << 62) // SCALE:
        return 1 + SCALE * (n + 1) // (total + kept)
    return np.array([1 + SCALE * (int(v) + 1) // (total + kept) for v in n], np.int64)


def consed(counts: np.ndarray) -> list[np.ndarray]:
    """Segment trees over the columns of an array of counts, one for each row, that share all equal nodes.

    The first of the returned arrays holds the counts of the leaves, one for each distinct count. Each further
    one holds the two children of the nodes of its level; the last holds the roots by row. Columns are filled
    up to a power of two with leaves of -1, which stand for no term.
    """
    width = 1 << max(0, counts.shape[1] - 1).bit_length()
    whole = np.full((len(counts), width), -1, np.int64)
    whole[:, : counts.shape[1]] = counts
    values, ids = np.unique(whole, return_inverse=True)
    ids = ids.reshape(whole.shape)
    levels = [values]
    while ids.shape[1] > 1:
        size = len(levels[-1])
        pairs, at = np.unique(ids[:, 0::2] * size + ids[:, 1::2], return_inverse=True)
        ids = at.reshape(len(counts), -1)
        levels.append(np.stack([pairs // size, pairs % size], 1))
    return [*levels, ids[:, 0]]


def leaf_pairs(levels: list[np.ndarray], one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row in ``others``, counts of both leaves, and how often they face each other, from the trees of one row and others walked down together.

    A pair of nodes is opened once for each two trees, however often it is met: what stands below it is remembered with its number.
    """
    roots = levels[-1]
    other, a, b = np.arange(len(others)), np.full(len(others), roots[one]), roots[others]
    times = np.ones(len(others), np.int64)
    for children in levels[-2:0:-1]:
        size = int(children.max()) + 1
        left, right = children[a], children[b]
        key = (np.concatenate([other, other]) * size + left.T.ravel()) * size + right.T.ravel()
        key, at = np.unique(key, return_inverse=True)
        times = np.bincount(at, np.concatenate([times, times]), len(key)).astype(np.int64)
        other, rest = np.divmod(key, size * size)
        a, b = np.divmod(rest, size)
    n, m = levels[0][a], levels[0][b]
    real = n >= 0
    return other[real], n[real], m[real], times[real]


def _compared(key: tuple, table: pa.Table) -> pa.Table:
    """lang, source, item, value, seen: the priced part of one block of terms for each two sources of one or two tiles."""
    kept = table.column("kept")[0].as_py()
    mine = table.filter(pc.is_null(table.column("term")))
    sources = mine.column("source").to_pylist()
    tiles, totals = mine.column("tile").to_numpy(), mine.column("total").to_pylist()
    low, high = (k.as_py() for k in key[2:4])
    rows = table.filter(pc.is_valid(table.column("term")))
    terms = pc.dictionary_encode(rows.column("term").combine_chunks())
    at = {s: i for i, s in enumerate(sources)}
    of_row = np.array([at[s] for s in rows.column("source").to_pylist()], np.int64)
    width = len(terms.dictionary)
    counts = np.zeros((len(sources), width), np.int64)
    counts[of_row, terms.indices.to_numpy()] = rows.column("n").to_numpy()
    levels = consed(counts[:, np.argsort(-counts.sum(0), kind="stable")]) if width else []
    out: list[tuple[str, str, int]] = []
    for i in range(len(sources)):
        if low == high:
            others = np.arange(i + 1, len(sources))
        else:
            others = np.flatnonzero(tiles == high) if tiles[i] == low else np.zeros(0, np.int64)
        if not len(others):
            continue
        there, back = np.zeros(len(others), np.int64), np.zeros(len(others), np.int64)
        if width:
            other, n, m, times = leaf_pairs(levels, i, others)
            ends = np.searchsorted(other, np.arange(len(others) + 1))
            for j, o in enumerate(others):
                a, b = ends[j], ends[j + 1]
                p, q = _prices(n[a:b], totals[i], kept), _prices(m[a:b], totals[o], kept)
                square = (p - q) * (p - q)
                there[j], back[j] = (square // q * times[a:b]).sum(), (square // p * times[a:b]).sum()
        for j, o in enumerate(others):
            out += [(sources[i], sources[o], int(there[j])), (sources[o], sources[i], int(back[j]))]
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(out), pa.string()), "source": pa.array([r[0] for r in out], pa.string()), "item": pa.array([r[1] for r in out], pa.string()),
        "value": pa.array([r[2] for r in out], pa.int64()), "seen": pa.array([width] * len(out), pa.int64()),
    })


def _pairs(counts: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """lang, source, item, value for each two sources of a language.

    Terms are cut into blocks by hash, each the ground of one tree, and sources into tiles; a task holds one
    block of terms for two tiles. The upper part of the trees, where hardly two are alike, is the sum over blocks.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") / block)).cast("long")
    tiles = F.ceil(F.col("sources") / tile).cast("long")
    places = groups.select("lang", "source", "total", "kept", blocks.alias("blocks"), tiles.alias("tiles"), F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile"))
    marks = places.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"))
    rows = counts.join(places, ["lang", "source"]).select(*places.columns, F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "term", "n")
    both = marks.unionByName(rows).withColumn("with", F.explode(F.sequence(F.lit(0), (F.col("tiles") - 1).cast("int"))))
    both = both.select("lang", "block", F.least("tile", "with").alias("low"), F.greatest("tile", "with").alias("high"), "tile", "source", "total", "kept", "term", "n")
    parts = both.groupBy("lang", "block", "low", "high").applyInArrow(_compared, "lang string, source string, item string, value long, seen long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))


def audited(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", block: int = BLOCK, tile: int = TILE, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language stands from each other one, and the terms that set it off from the language.

    Null lang, source and text count as empty; an empty lang or source is a group like any other. All rows
    count as documents, repeated ones too. A group without terms is compared with all counts zero, and one
    whose language keeps no term has the value 0; a language with one source has no pairs. Ties go to the
    lesser item. Other columns are not looked at; an empty table gives no rows. All numbers are exact.
    """
    whole = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    all_counts = save(term_counts(whole))
    terms = all_counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= LEAST_DOCS)
    counts = save(all_counts.drop("docs").join(terms.drop("docs"), ["lang", "term"]))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("of_lang").alias("of_lang_total"))
    groups = whole.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    groups = groups.join(groups.groupBy("lang").agg(F.count("*").alias("sources")), "lang").join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
    groups = save(groups.join(langs, "lang", "left").fillna(0, ["total", "kept", "of_lang_total"]))

    ends = groups.select("lang", "source", "total", "kept")
    found = _pairs(counts.select("lang", "source", "term", "n"), groups, block, tile).join(ends, ["lang", "source"])
    found = found.join(ends.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total")), ["lang", "item"])
    none = F.lit(0).cast("long")
    p, q = price(none, F.col("total"), F.col("kept")), price(none, F.col("item_total"), F.col("kept"))
    value = F.when(F.col("kept") == 0, none).otherwise(F.col("value") + F.call_function("div", (p - q) * (p - q), q) * (F.col("kept") - F.col("seen")))
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = found.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", F.row_number().over(by))

    p, q = price(F.col("n"), F.col("total"), F.col("kept")), price(F.col("of_lang"), F.col("of_lang_total"), F.col("kept"))
    priced = counts.join(groups.drop("rows", "sources"), ["lang", "source"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    marked = priced.select("lang", "source", "part", "item", F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q")).alias("value"))
    return pairs.unionByName(marked.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of documents, by language."""
    return audited(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), w AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), c AS (
    SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
    SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
), g AS (
    SELECT s.lang, s.source, coalesce(t.total, 0)::HUGEINT AS total, coalesce(langs.v, 0)::HUGEINT AS v
    FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) t ON t.lang = s.lang AND t.source = s.source
), p AS (
    SELECT g.lang, g.source, kept.term, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.total + g.v) AS p
    FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), all_pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
), q AS (
    SELECT kept.lang, kept.term, 1 + 1000000000 * (kept.n + 1) // (langs.total + langs.v) AS q FROM kept JOIN langs USING (lang)
), terms AS (
    SELECT c.lang, c.source, 'term' AS part, c.term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
    FROM c JOIN p ON p.lang = c.lang AND p.source = c.source AND p.term = c.term JOIN q ON q.lang = c.lang AND q.term = c.term WHERE p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
