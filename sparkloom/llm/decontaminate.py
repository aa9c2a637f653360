"""Benchmark decontamination: BM25 posting lists of test items with block maxima, asked with every passage of the corpus."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import save, tidy
from .words import Words, chunks, grams, words

K1, B = 1.2, 0.75
#: Items in a block, which has one maximum in each posting list.
BLOCK = 4
#: Lists whose bounds add up to less than this share of the threshold wait until few blocks are left.
WAITING = 0.5
#: Sums of passages by blocks that are held at a time.
CELLS = 1 << 18
#: Words of the items that are broadcast together, about; more items make more passes over the documents.
SHARD_WORDS = 400_000
#: A passage is compared on words when its score is this share, at least, of what the item itself would score.
THRESHOLD = 0.6
#: Shares of the question's and of the answer's word triples that must stand in the passage.
QUESTION, ANSWER = 0.6, 0.6
#: The answer is a third of the item's words, and so many at least: one changed word spoils three of eight triples.
LEAST_ANSWER = 10
#: Words of a passage's half; items that are longer have passages of their own length, in powers of two.
LEAST_PASSAGE = 64
_ROUNDING = 1e-9
_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")  # as words() takes them when bare
_STOP = re.compile(r"[.?!:](?=[ \n])")


@dataclass
class Index:
    """Posting lists of items that share a passage length; terms are numbered by their bounds, smallest first.

    terms, number: sorted hashes and the number of each. bound: the largest weight of a term's list, by number.
    posting, weight: number * items + item, sorted. cell, top: number * blocks + block of items, sorted, with the
    largest weight of that block in the list; the list of a number is cell[first[number] : first[number + 1]].
    """

    terms: np.ndarray
    number: np.ndarray
    bound: np.ndarray
    posting: np.ndarray
    weight: np.ndarray
    cell: np.ndarray
    top: np.ndarray
    first: np.ndarray
    blocks: int
    span: int
    item_ids: list
    parts: list[tuple[np.ndarray, np.ndarray, int, int]]  # word triples of question and answer, and their lengths


def question_and_answer(text: str) -> tuple[str, str]:
    """Trailing sentences that hold enough words are the answer; where they leave too few, the last words are."""
    body = text.rstrip()
    starts = [m.start() for m in _WORD.finditer(body)]
    n = len(starts)
    least = min(max(LEAST_ANSWER, -(-n // 3)), n - n // 2)
    for cut in reversed([m.end() for m in _STOP.finditer(body)]):
        after = n - bisect_left(starts, cut)
        if after >= least:
            if n - after >= min(least, n // 2):
                return body[:cut], body[cut:]
            break
    cut = starts[n - least] if n else len(body)
    return body[:cut], body[cut:]


def _triples(text: str) -> tuple[np.ndarray, int]:
    w = words(pa.array([text]), lower=True, bare=True).hash
    k = min(3, len(w))
    return (grams(w, k) if k else w), k


def postings(items: DataFrame) -> DataFrame:
    """key, term, tf, len for each term of each item (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words(batch.column(1), lower=True, bare=True)
            pairs, tf = np.unique(np.stack([w.of_words().astype(np.uint64), w.hash]), axis=1, return_counts=True)
            at = pairs[0].astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(pairs[1].view(np.int64)), pa.array(tf, pa.int64()), pa.array(np.diff(w.ptr)[at])], ["key", "term", "tf", "len"])

    return items.select("key", "text").mapInArrow(tidy(run), "key long, term long, tf long, len long")


def indexes(items: DataFrame, shard_words: int = SHARD_WORDS) -> Iterator[list[Index]]:
    """Lists of indexes that together hold every item with words; the items of a list have about shard_words words.

    Weights come from all items. An item's passages are as long as its own length asks, so that the items of a
    list make one index for each doubling of length.
    """
    items = save(items.filter("text is not null").distinct().withColumn("key", F.xxhash64("item_id", "text")))
    posts = save(postings(items))
    lengths = save(posts.groupBy("key").agg(F.first("len").alias("len")))
    n, mean, total = lengths.agg(F.count("*"), F.avg("len"), F.sum("len")).first()
    if not n:
        return
    df = posts.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    scored = posts.join(df, "term").withColumn("w", idf * tf)
    own = scored.groupBy("key").agg(F.sum("w").alias("self"))
    scored = save(scored.join(own, "key").select("key", "term", (F.col("w") / F.col("self")).alias("w")))
    shards = math.ceil(total / shard_words)
    for shard in range(shards):
        of = F.pmod("key", F.lit(shards)) == shard
        texts = items.join(lengths, "key").filter(of).orderBy("key").toPandas()
        part = scored.filter(of).toPandas()
        texts["span"] = [max(LEAST_PASSAGE, 1 << int(x - 1).bit_length()) for x in texts["len"]]
        found = []
        for span, group in texts.groupby("span"):
            found.append(_index(group, part[part["key"].isin(group["key"])], int(span)))
        if found:
            yield found


def _index(texts: pd.DataFrame, part: pd.DataFrame, span: int) -> Index:
    keys, weight = texts["key"].to_numpy(), part["w"].to_numpy()
    terms, at = np.unique(part["term"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    bound = np.zeros(len(terms))
    np.maximum.at(bound, at, weight)
    by_bound = np.lexsort((terms, bound))
    number = np.empty(len(terms), np.int64)
    number[by_bound] = np.arange(len(terms))
    posting = number[at] * len(keys) + np.searchsorted(keys, part["key"].to_numpy())
    order = np.argsort(posting)
    posting, weight = posting[order], weight[order]
    blocks = -(-len(keys) // BLOCK)
    cell = posting // len(keys) * blocks + posting % len(keys) // BLOCK
    new = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    first = np.searchsorted(cell[new], np.arange(len(terms) + 1) * blocks)
    parts = []
    for t in texts["text"]:
        (q, kq), (a, ka) = map(_triples, question_and_answer(t))
        parts.append((q, a, kq, ka))
    return Index(terms, number, bound[by_bound], posting, weight, cell[new], np.maximum.reduceat(weight, new), first, blocks, span, texts["item_id"].tolist(), parts)


def _ranges(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """start[i] .. start[i] + count[i] - 1 for each i, one after another; and i for each of them."""
    owner = np.repeat(np.arange(len(start)), count)
    return start[owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner], owner


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, values[at], 0.0)


def retrieved(w: Words, index: Index, threshold: float) -> Iterator[tuple[int, int, float, float, float]]:
    """(document, item, score, question, answer) of each passage and item at or above the threshold.

    Passages are two neighbouring segments of ``span`` words, so that an item of up to span words lies
    whole in one. The passages of a batch go through block-max WAND's tests together. A passage whose terms'
    bounds do not add up to the threshold has no pivot. Of the others, the lists of small bounds, which are the
    long ones, wait; the block maxima of the rest add up, and a block goes on if it can reach the threshold with
    all that waits. Its maxima in the waiting lists replace their bounds, and only the items of blocks that still
    can reach the threshold are scored, exactly.
    """
    doc = w.of_words()
    piece = (np.arange(len(doc)) - w.ptr[doc]) // index.span
    pieces = -(-np.diff(w.ptr) // index.span)
    passages = np.where(pieces > 0, np.maximum(pieces - 1, 1), 0)
    base = np.append(0, np.cumsum(passages))
    at = np.searchsorted(index.terms, w.hash)
    at[at == len(index.terms)] = 0
    known = index.terms[at] == w.hash
    doc, piece, term = doc[known], piece[known], index.number[at[known]]
    n, items, place = len(index.terms), len(index.item_ids), base[doc] + piece
    own, before = piece < passages[doc], piece > 0
    key = np.unique(np.concatenate([place[own] * n + term[own], (place[before] - 1) * n + term[before]]))
    passage, term = key // n, key % n  # in a passage from the smallest bound to the largest

    begin = np.searchsorted(passage, np.arange(base[-1] + 1))
    count = np.diff(begin)
    total = np.append(0, np.cumsum(index.bound[term]))
    low = threshold - _ROUNDING
    waits = total[1:] - total[begin[passage]] < low * WAITING
    waiting = np.bincount(passage[waits], minlength=base[-1])
    bound_waiting = total[begin[:-1] + waiting] - total[begin[:-1]]
    pivot = np.flatnonzero(total[begin[1:]] - total[begin[:-1]] >= low)
    step = max(1, CELLS // index.blocks)
    for i in range(0, len(pivot), step):
        p = pivot[i : i + step]
        at, owner = _ranges(begin[p] + waiting[p], count[p] - waiting[p])
        lists = term[at]
        at, of = _ranges(index.first[lists], index.first[lists + 1] - index.first[lists])
        sums = np.bincount(owner[of] * index.blocks + index.cell[at] % index.blocks, index.top[at], len(p) * index.blocks)
        cells = np.flatnonzero(sums >= np.repeat(low - bound_waiting[p], index.blocks))
        q, block = p[cells // index.blocks], cells % index.blocks
        at, owner = _ranges(begin[q], waiting[q])
        rest = np.bincount(owner, _looked_up(index.cell, index.top, term[at] * index.blocks + block[owner]), len(q))
        keep = sums[cells] + rest >= low
        q, block = q[keep], block[keep]
        at, owner = _ranges(begin[q], count[q])
        for item in (block * BLOCK + k for k in range(BLOCK)):
            inside = (item < items)[owner]
            scores = np.bincount(owner[inside], _looked_up(index.posting, index.weight, (term[at] * items + item[owner])[inside]), len(q))
            for hit in np.flatnonzero(scores >= threshold):
                d = int(np.searchsorted(base, q[hit], "right")) - 1
                start = w.ptr[d] + (q[hit] - base[d]) * index.span
                text = w.hash[start : min(start + 2 * index.span, w.ptr[d + 1])]
                question, answer, kq, ka = index.parts[item[hit]]
                share = [np.isin(g, grams(text, k)).mean() if k and len(text) >= k else float(k == 0) for g, k in ((question, kq), (answer, ka))]
                yield d, int(item[hit]), float(scores[hit]), float(share[0]), float(share[1])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: documents that hold a test item.

    Words are runs of letters and digits after lower-casing. Every passage of every document is asked;
    what scores ``threshold`` of an item's own score or more is a hit when enough of both the item's question
    and its answer stand in it, and each document and item have one row with the best values. Null and
    empty texts, and items without words, match nothing; repeated items count once; rows that repeat an id
    are one document. Other columns are not read.
    """
    flat = docs.select(F.col(id_col).alias("doc_id"), F.lower(text_col).alias("text"))
    kinds = f"doc_id {flat.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}"
    shape = f"{kinds}, score double, question_overlap double, answer_overlap double"
    out = docs.sparkSession.createDataFrame([], shape)
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    item_type = pa.int64() if items.schema["item_id"].dataType.simpleString() == "bigint" else None
    for shard in indexes(items.select("item_id", F.lower("text").alias("text"))):
        shared = docs.sparkSession.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch):
                    w = words(part.column("text"), lower=True, bare=True)
                    hits = [(d, index.item_ids[i], *rest) for index in shared.value for d, i, *rest in retrieved(w, index, threshold)]
                    if hits:
                        d, i, *rest = zip(*hits)
                        yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(d)), pa.array(i, item_type), *(pa.array(x, pa.float64()) for x in rest)], names)

        out = out.unionByName(flat.mapInArrow(tidy(run), shape))
    hit = out.filter((F.col("question_overlap") >= QUESTION) & (F.col("answer_overlap") >= ANSWER))
    return hit.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max("question_overlap").alias("question_overlap"), F.max("answer_overlap").alias("answer_overlap"))


def without_test_items(spark, docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the rows that hold a test item; all columns stay.

    Rows are judged one by one, also those that repeat an id or have none: what goes is known by id and text
    together. Null and empty texts stay, and so do all rows when there is no item with words. An empty table
    gives an empty one.
    """
    told = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    hit = contamination(told, items).select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.h").alias("_h")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["_h"]), "left_anti").select(docs.columns)


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
