"""The best sentences for a row, found from its rarest words and in tiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from ..sources.stage import written

#: What a word of LONG characters or more counts, what a shorter one counts, and what the row's item counts.
LONG, LONG_SCORE, SHORT_SCORE, ITEM_SCORE = 5, 3, 1, 8
#: Fixed value: how many of a row's words, in their order, make the second tier.
FIRST = 20
#: Rarest words of a row whose sentences give a first bound of its scores.
PROBES = 4
#: Rows, and words of all rows together, up to which rows are sent to where the sentences lie.
FEW_ROWS, FEW_WORDS = 4096, 1 << 18
#: Scores of a task at a time, and words met by rows at a time.
_CELLS, _MET = 1 << 20, 1 << 21
_KNOWN = "array<struct<word:string,common:boolean,place:int,score:int,rest:int>>"


def _score(word: Column) -> Column:
    return F.when(F.char_length(word) >= LONG, LONG_SCORE).otherwise(SHORT_SCORE)


def _pair(a: Column, b: Column) -> Column:
    return F.concat(F.least(a, b), F.lit("\n"), F.greatest(a, b))


def _best(scored: DataFrame, most: int) -> DataFrame:
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "sid")))
    return ranked.filter(F.col("rank") <= most)


def word_counts(rows: DataFrame, words: DataFrame, common: float) -> DataFrame:
    """word, df, common: in how many sentences a word of any row stands, and whether they are more than that share of all.

    words: sid, word, each pair once.
    """
    asked = rows.select(F.explode("words").alias("word")).distinct()
    counts = words.groupBy("word").agg(F.count("*").alias("df")).join(asked, "word", "left_semi")
    total = words.agg(F.count_distinct("sid").alias("n"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("word", "df", (F.col("df") > F.col("n") * common).alias("common"))


def _known(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """id, known: the row's words that stand in some sentence, rarest first, each with the score of itself and all commoner ones."""
    each = rows.select("id", F.posexplode("words").alias("place", "word")).join(counts, "word")
    entry = F.struct("df", "word", "common", "place", _score(F.col("word")).alias("score"))
    listed = each.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("w"))
    rest = lambda i: F.aggregate(F.slice("w", i + 1, F.size("w")), F.lit(0), lambda n, x: n + x["score"])
    known = F.transform("w", lambda x, i: F.struct(x["word"].alias("word"), x["common"].alias("common"), x["place"].alias("place"), x["score"].alias("score"), rest(i).alias("rest")))
    return listed.select("id", known.alias("known"))


def _floors(rows: DataFrame, words: DataFrame, most: int, least: int) -> DataFrame:
    """id, floor: a score that at least ``most`` of the row's sentences reach, from its rarest words alone; ``least`` at the least."""
    probes = F.slice(F.filter("known", lambda x: ~x["common"] & (~F.col("early") | (x["place"] < FIRST))), 1, PROBES)
    met = rows.select("id", F.explode(probes).alias("p")).select("id", "p.word", "p.score").join(words, "word")
    reached = _best(met.groupBy("id", "sid").agg(F.sum("score").alias("score")), most)
    return reached.groupBy("id").agg(F.when(F.count("*") == most, F.greatest(F.min("score"), F.lit(least))).otherwise(least).alias("floor"))


def _word_pairs(rows: DataFrame, words: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """id, sid of all pairs whose shared words reach the row's floor.

    Let w be the rarest word a pair shares: all it shares is w and commoner words, so w and these together reach the
    floor, or w is no key. Where w is common and does not reach the floor alone, the pair shares a second word, common
    too, and meets at both.
    """
    usable = F.filter("known", lambda x: x["rest"] >= F.col("floor"))
    alone = lambda x: ~x["common"] | (x["score"] >= F.col("floor"))
    single = F.transform(F.filter(usable, alone), lambda x: x["word"])
    after = lambda i: F.slice("known", i + 2, F.size("known"))
    double = F.flatten(F.transform(usable, lambda x, i: F.when(alone(x), F.array().cast("array<string>")).otherwise(F.transform(after(i), lambda y: _pair(x["word"], y["word"])))))
    asked = rows.select("id", F.explode(F.array_distinct(F.concat(single, double))).alias("key"))
    marked = words.join(counts, "word")
    ones = marked if least <= LONG_SCORE else marked.filter("not common")
    lists = marked.filter("common").groupBy("sid").agg(F.array_sort(F.collect_list("word")).alias("c"))
    twos = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.size("c")), lambda y: _pair(x, y))))
    held = ones.select(F.col("word").alias("key"), "sid").unionByName(lists.select(F.explode(twos).alias("key"), "sid"))
    return asked.join(held, "key").select("id", "sid")


def _postings(rows: list, tiers: list[int]) -> dict:
    """Of rows (id, item, words): the words, and for each the rows that hold it, with its score and whether it is one of the row's first."""
    at: dict[str, list[tuple[int, int, bool]]] = {}
    for n, row in enumerate(rows):
        for place, word in enumerate(row["words"]):
            at.setdefault(word, []).append((n, LONG_SCORE if len(word) >= LONG else SHORT_SCORE, place < FIRST))
    entries = np.array([x for found in at.values() for x in found], np.int64).reshape(-1, 3)
    return {"words": list(at), "ptr": np.cumsum([0, *map(len, at.values())]), "row": entries[:, 0], "score": entries[:, 1], "front": entries[:, 2], "items": [row["item"] for row in rows], "tier": np.array(tiers, np.int64)}


def _scores(part: pa.RecordBatch, p: dict) -> np.ndarray:
    """Scores of sentences (hint, s_words) for all rows; -1 where the row's tier leaves the sentence out."""
    n, m = len(part), len(p["items"])
    lists = part.column("s_words")
    flat = lists.flatten()
    of = np.repeat(np.arange(n), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    word = pc.fill_null(pc.index_in(flat, value_set=pa.array(p["words"], flat.type)), -1).to_numpy(zero_copy_only=False)
    of, word = of[word >= 0], word[word >= 0].astype(np.int64)
    met = p["ptr"][word + 1] - p["ptr"][word]
    upto = np.append(0, np.cumsum(met))
    score, front = np.zeros(n * m), np.zeros(n * m)
    a = 0
    while a < len(word):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + _MET, "right")) - 1)
        at = np.repeat(p["ptr"][word[a:b]] - (upto[a:b] - upto[a]), met[a:b]) + np.arange(upto[b] - upto[a])
        cell = np.repeat(of[a:b], met[a:b]) * m + p["row"][at]
        score += np.bincount(cell, p["score"][at], n * m)
        if (p["tier"] == 2).any():
            front += np.bincount(cell, p["front"][at], n * m)
        a = b
    names = list(dict.fromkeys(x for x in p["items"] if x != ""))
    code = {x: k for k, x in enumerate(names)}
    hint = part.column("hint")
    hint = pc.fill_null(pc.index_in(hint, value_set=pa.array(names, hint.type)), -1).to_numpy(zero_copy_only=False)
    has = hint[:, None] == np.array([code.get(x, -2) for x in p["items"]])[None, :]
    out = score.reshape(n, m) + ITEM_SCORE * has
    out[~has & (p["tier"] == 1)] = -1
    out[(front.reshape(n, m) == 0) & (p["tier"] == 2)] = -1
    return out


def _first(found: pa.Table, most: int) -> pa.Table:
    """The best ``most`` of each row; equals by sid."""
    found = found.take(pc.sort_indices(found, [("row", "ascending"), ("score", "descending"), ("sid", "ascending")]))
    row = found.column("row").to_numpy()
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, np.int64)
    nth = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
    return found.filter(pa.array(nth < most))


def _of_few(r: DataFrame, s: DataFrame, most: int, least: int, tiers: bool) -> DataFrame:
    """supporting_sentences of few rows: tasks score their sentences for all rows and hand on the best of each row only."""
    rows = r.filter("id is not null").collect()  # FEW_ROWS and FEW_WORDS at most
    tier = [0] * len(rows)
    if tiers:
        named = s.select(F.col("hint").alias("item")).join(F.broadcast(r.filter("item <> ''").select("item").distinct()), "item", "left_semi").distinct()
        asked = r.select(F.explode(F.slice("words", 1, FIRST)).alias("word")).distinct()
        seen = s.select(F.explode("s_words").alias("word")).join(F.broadcast(asked), "word", "left_semi").distinct()
        named, seen = {x[0] for x in named.collect()}, {x[0] for x in seen.collect()}
        tier = [1 if x["item"] in named else 2 if x["item"] != "" and not seen.isdisjoint(x["words"][:FIRST]) else 3 for x in rows]
    shared = s.sparkSession.sparkContext.broadcast(_postings(rows, tier))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        m = len(p["items"])
        best, floor = None, np.full(m, least)
        for batch in batches:
            for part in (batch.slice(a, max(1, _CELLS // m)) for a in range(0, len(batch) if m else 0, max(1, _CELLS // max(1, m)))):
                scores = _scores(part, p)
                if len(part) > most:
                    floor = np.maximum(floor, np.partition(scores, len(part) - most, axis=0)[len(part) - most])  # so many reach it
                at, row = np.nonzero(scores >= floor)
                found = pa.table([pa.array(row.astype(np.int32)), part.column("sid").take(pa.array(at)), pa.array(scores[at, row].astype(np.int64))], ["row", "sid", "score"])
                best = _first(found if best is None else pa.concat_tables([best, found]), most)
        if best is not None:
            yield from best.to_batches()

    sid = s.schema["sid"].dataType.simpleString()
    found = s.filter("sid is not null").select("sid", "hint", "s_words").mapInArrow(run, f"row int, sid {sid}, score long")
    ids = s.sparkSession.createDataFrame([(n, x["id"], t) for n, (x, t) in enumerate(zip(rows, tier))], f"row int, id {r.schema['id'].dataType.simpleString()}, tier int")
    return _best(found.join(F.broadcast(ids), "row").select("id", "sid", "score", "tier"), most).select("id", "sid", "score", "rank", "tier")


def supporting_sentences(rows: DataFrame, sentences: DataFrame, most: int = 3, least: int = 6, tiers: bool = False, common: float = 0.01) -> DataFrame:
    """Per row (id, item, words) its best sentences (sid, hint, words): 8 for the item in the hint, 3 or 1 for each shared word.

    A shared word of five characters or more counts 3. Sentences under ``least`` are left out; equals go by sid. With
    ``tiers``, a row whose item any sentence names has such sentences only; else, if it has an item and one of its first
    twenty words stands anywhere, sentences with one of these; else any. Null and blank items and hints name nothing; words
    that repeat count once. id, sid, score, rank, tier (1, 2, 3; 0 where tiers are off).

    Words that stand in more than the share ``common`` of the sentences are never join keys by themselves (but where such
    a word alone reaches ``least``). Of the sentences that only name an item, the first few by sid are enough. Up to FEW_ROWS rows of
    FEW_WORDS words together need no keys: they are sent to the sentences, and no pair of a row and a sentence is shuffled.
    """
    clean = lambda c: F.coalesce(F.trim(c.cast("string")), F.lit(""))
    bag = lambda c: F.array_distinct(F.array_compact(F.coalesce(c, F.array().cast("array<string>"))))
    r = rows.select("id", clean(F.col("item")).alias("item"), bag(F.col("words")).alias("words"))
    s = sentences.select("sid", clean(F.col("hint")).alias("hint"), bag(F.col("words")).alias("s_words"))
    r = written(r)
    size = r.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words")).first()
    if size["rows"] <= FEW_ROWS and size["words"] <= FEW_WORDS and not isinstance(s.schema["sid"].dataType, (ArrayType, MapType, StructType, VariantType)):
        return _of_few(r, written(s) if tiers else s, most, least, tiers)
    s = written(s)  # read several times
    words = s.select("sid", F.explode("s_words").alias("word"))
    counts = written(word_counts(r, words, common))
    hinted = s.filter("hint <> ''").select(F.col("hint").alias("item")).distinct().withColumn("named", F.lit(True))
    r = r.join(hinted, "item", "left").join(_known(r, counts), "id", "left").withColumn("named", F.coalesce("named", F.lit(False)))
    r = r.withColumn("known", F.coalesce("known", F.array().cast(_KNOWN)))
    second = (F.col("item") != "") & F.exists("known", lambda x: x["place"] < FIRST)
    tier = F.when(F.col("named"), 1).when(second, 2).otherwise(3) if tiers else F.lit(0)
    r = r.withColumn("tier", tier).withColumn("early", F.col("tier") == 2)
    r = written(r)

    free = r.filter("tier <> 1")
    floors = _floors(free, words, most, least)
    by_word = _word_pairs(free.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(least))), words, counts, least)
    named = r.filter("named")
    own = named.select("id", "item", F.explode("known").alias("k")).select("id", "item", "k.word")
    theirs = s.filter("hint <> ''").select("sid", F.col("hint").alias("item"), F.explode("s_words").alias("word"))
    both = own.join(theirs, ["item", "word"]).select("id", "sid")
    ahead = F.row_number().over(Window.partitionBy("hint").orderBy("sid"))
    some = s.filter("hint <> ''").select(F.col("hint").alias("item"), "sid", ahead.alias("n")).filter(F.col("n") <= most)
    pairs = by_word.unionByName(both).unionByName(named.select("id", "item").join(some, "item").select("id", "sid")).distinct()

    asked = r.select("id", "item", "tier", F.transform("known", lambda x: x["word"]).alias("own"), F.transform(F.filter("known", lambda x: x["place"] < FIRST), lambda x: x["word"]).alias("front"))
    full = pairs.join(asked, "id").join(s, "sid").withColumn("has_item", (F.col("item") != "") & (F.col("item") == F.col("hint")))
    full = full.filter(F.when(F.col("tier") == 1, F.col("has_item")).when(F.col("tier") == 2, F.arrays_overlap("front", "s_words")).otherwise(True))
    score = F.aggregate(F.array_intersect("own", "s_words"), F.when(F.col("has_item"), ITEM_SCORE).otherwise(0), lambda n, w: n + _score(w)).cast("long")
    return _best(full.select("id", "sid", score.alias("score"), "tier").filter(F.col("score") >= least), most).select("id", "sid", "score", "rank", "tier")
