"""Removal of word sequences that occur more than once: winnowed seeds, extended to whole windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .scratch import save
from .words import chunks, grams, words

WINDOW = 35
SEED = 20
#: So many of the most frequent seeds are dealt out in parts, so that no task gathers one; and in how many parts.
HOT_SEEDS, PARTS = 1000, 64
#: Seeds that occur no more often than this go to a task whole.
HOT_FROM = 1000


def anchors(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start, where its anchor begins; and the seeds' hashes.

    The anchor of a window is the smallest of the seeds inside it, the rightmost of equals: it depends on
    the window's words alone, so equal windows have equal anchors at equal offsets, wherever they occur.
    """
    g = grams(hashes, seed)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), g
    span = window - seed + 1
    low, at = g, np.arange(len(g))
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        a, b = low[: len(low) - step], low[step:]
        right = b <= a
        at = np.where(right, at[step:], at[: len(at) - step])
        low = np.where(right, b, a)
        reach += step
    return at[:n], g


def _of_batch(batch: pa.RecordBatch, window: int, seed: int) -> Iterator[tuple]:
    """For each slice: the slice, word hashes, pointers, starts of windows inside one document, their document, anchors and seeds."""
    for part in chunks(batch):
        w = words(part.column("text"), lower=False)
        at, g = anchors(w.hash, window, seed)
        doc = w.of_words()
        inside = np.flatnonzero(doc[: len(at)] == doc[window - 1 :][: len(at)]) if len(at) else np.zeros(0, np.int64)
        yield part, w, inside, doc[inside], at[inside], g


def repeated_windows(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """id, h, pos, mask: window starts of (id, h = hash of the text) that are repeated: bit i of mask stands for pos + i."""
    spark = docs.sparkSession

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, inside, _, at, g in _of_batch(batch, window, seed):
                if len(inside):
                    keys, counts = np.unique(g[np.unique(at)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], ["seed", "n"])

    counted = docs.select("text").mapInArrow(seeds, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    repeated = save(counted.filter("n > 1"))
    table = spark.sparkContext.broadcast(bloom.gather(repeated, "seed"))
    hot = np.sort(np.array([r.seed for r in repeated.filter(F.col("n") > HOT_FROM).orderBy(F.desc("n"), "seed").limit(HOT_SEEDS).collect()], np.int64).view(np.uint64))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w, inside, doc, at, g in _of_batch(batch, window, seed):
                if not len(inside):
                    continue
                keys = g[at]
                maybe = bloom.may_hold(table.value, keys)
                inside, doc, at, keys = inside[maybe], doc[maybe], at[maybe], keys[maybe]
                if not len(inside):
                    continue
                whole = grams(w.hash, window)[inside]
                common = np.isin(keys, hot)
                pos = inside - w.ptr[doc]
                ids, hs = part.column("id"), part.column("h")
                # windows that follow one another on one anchor make one row
                first = np.ones(len(inside), bool)
                first[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1) | (doc[1:] != doc[:-1])
                rows = np.flatnonzero(first)
                ends = np.append(rows[1:], len(inside)).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.append(np.int32(0), ends * 8).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(whole))])
                take = pa.array(doc[rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(common[rows]), pa.array(keys[rows].view(np.int64)), ids.take(take), hs.take(take), pa.array(pos[rows].astype(np.int32)), packed],
                    ["hot", "key", "id", "h", "pos", "windows"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    found = save(docs.select("id", "h", "text").mapInArrow(extend, f"hot boolean, key long, id {kind}, h long, pos int, windows binary"))

    names = ["kind", "id", "h", "pos", "mask", "window", "n"]

    def settle(batches: Iterator[pa.RecordBatch], part: bool) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by seed; those of a seed are compared window by window.

        Kind 0: window starts that are repeated. Of a part of a seed's rows, also kind 1: a window met once
        here, which other parts may hold; and kind 2: a window met more than once, for those.
        """
        held: pa.Table | None = None

        def judged(t: pa.Table) -> Iterator[pa.RecordBatch]:
            t = t.combine_chunks()
            sizes = pc.binary_length(t["windows"]).to_numpy() // 8
            flat = np.frombuffer(b"".join(t["windows"].to_pylist()), np.uint64)
            distinct, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
            again = counts[back] > 1
            start = np.cumsum(sizes) - sizes
            bit = np.arange(len(flat)) - np.repeat(start, sizes)
            mask = np.bitwise_or.reduceat(again.astype(np.int64) << bit, start)
            hit = np.flatnonzero(mask)
            ids, hs, pos = (t[c].combine_chunks() for c in ("id", "h", "pos"))

            def rows(kind, at, mask, pos, window, n):
                none = [None] * n if at is None else None
                where = None if at is None else pa.array(at)
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, kind, np.int32)), pa.array(none, ids.type) if at is None else ids.take(where), pa.array(none, pa.int64()) if at is None else hs.take(where),
                        pa.array(pos, pa.int32()), pa.array(mask, pa.int64()), pa.array(window, pa.int64()), pa.array(np.full(n, 2 if kind == 2 else 1, np.int64)),
                    ],
                    names,
                )

            zeros = np.zeros(len(flat), np.int64)
            yield rows(0, hit, mask[hit], pos.to_numpy()[hit], zeros[: len(hit)], len(hit))
            if part:
                single = np.flatnonzero(~again)
                own = np.repeat(np.arange(len(sizes)), sizes)[single]
                yield rows(1, own, np.ones(len(single), np.int64), (pos.to_numpy()[own] + bit[single]).astype(np.int32), flat[single].view(np.int64), len(single))
                many = distinct[counts > 1].view(np.int64)
                yield rows(2, None, zeros[: len(many)], zeros[: len(many)].astype(np.int32), many, len(many))

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            t = t if held is None else pa.concat_tables([held, t])
            keys = t["key"].to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from judged(t.slice(0, last))
            held = t.slice(last)
        if held is not None and held.num_rows:
            yield from judged(held)

    shape = f"kind int, id {kind}, h long, pos int, mask long, window long, n long"
    rows = found.select("hot", "key", "id", "h", "pos", "windows")
    cold = rows.filter("not hot").drop("hot").repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: settle(b, False), shape)
    # a window is open in a part only if it was met there once, so that it has PARTS open rows at most
    dealt = rows.filter("hot").drop("hot").repartition("key", F.pmod(F.xxhash64("id", "h"), F.lit(PARTS))).sortWithinPartitions("key")
    warm = save(dealt.mapInArrow(lambda b: settle(b, True), shape))
    met = warm.filter("kind > 0").groupBy("window").agg(F.sum("n").alias("met")).filter("met > 1")
    late = warm.filter("kind = 1").join(met, "window")
    columns = ["id", "h", "pos", "mask"]
    return cold.select(columns).unionByName(warm.filter("kind = 0").select(columns)).unionByName(late.select(columns))


def _flat_docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text) for every row of docs.

    A word goes when it lies in a run of ``window`` words that also begins anywhere else in the table, the
    same document and repeated rows included. Null and empty texts have no words. Every occurrence goes,
    the first as well; runs are judged on the texts as given. Other columns of docs are not read.
    """
    flat = _flat_docs(docs, id_col, text_col)
    hits = (
        repeated_windows(flat, window, seed)
        .groupBy("id", "h").agg(F.collect_list("pos").alias("pos"), F.collect_list("mask").alias("mask"))
        .select(F.col("id").alias("_id"), F.col("h").alias("_h"), "pos", "mask")
    )
    joined = flat.join(hits, (F.col("h") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_id")), "left").select("id", "text", "pos", "mask")
    bits = window - seed + 1

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for text, pos, mask in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2), batch.column(3)):
                every = kept = text.split()
                if pos.is_valid:
                    p, m = np.asarray(pos.values), np.asarray(mask.values)
                    on, bit = np.nonzero((m[:, None] >> np.arange(bits)) & 1)
                    starts = p[on] + bit
                    depth = np.zeros(len(every) + 1, np.int32)
                    np.add.at(depth, starts, 1)
                    np.add.at(depth, starts + window, -1)
                    kept = list(compress(every, (np.cumsum(depth[:-1]) == 0).tolist()))
                joined = b" ".join(kept)
                for column, x in zip(out, (len(every), len(every) - len(kept), hashlib.sha256(joined).hexdigest(), joined)):
                    column.append(x)
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                columns, names = [*columns, pa.array(out[3], pa.binary()).cast(pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(finish, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", text string" * texts)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, i FROM s WHERE win IN (SELECT win FROM s GROUP BY win HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
k AS (
  SELECT u.doc_id, u.j, u.word FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM d) AS u
  ANTI JOIN c ON c.doc_id = u.doc_id AND c.j = u.j),
t AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
