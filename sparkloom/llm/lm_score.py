"""Language-model scores: a hashed maximum-entropy model, class by softmax and word of the class by a tree of decisions, trained by gradient steps in all partitions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import Shelf
from .scratch import held, save, tidy, to_arrays
from .words import _LOWER, U, chunks, mix, words

CLASSES = 48
#: Rows of the hashed weight table; each has a weight for every class.
ROWS = 1 << 14
FEATURES = 4
#: Tasks that train side by side at most; their weights are averaged after each round.
LEARNERS = 64
ROUNDS = 2
#: Words whose counts are sent to the tasks at most: the most frequent. Counts of the others are joined.
COMMON = 1 << 20
BATCH = 8192
RATE = 0.1
#: Tokens that are scored at a time, so that their classes stay in the processor's cache.
_SCORED = 2048
#: Rows that a batch meets up to so often are summed together.
_AT_ONCE = 16
_BLOCKS = 32
#: Decisions that lead from a class to a leaf, which are the first bits of the word's hash; words that share a leaf have their smoothed counts there.
LEVELS = 8
#: Places of the hashed table of the decisions' weights.
PLACES = 1 << 18
#: Tokens whose decisions are taken at a time, and the largest prior odds of a decision, as a logarithm: a side without words.
_DECIDED, _SURE = 2048, 30.0
_BEGIN, _END, _LEAF = U(0x0B5E55ED), U(0xE4D0F7E7), U(0x1EAF1EAF)


def _prefixes(w) -> np.ndarray:
    """The first three bytes of each word, A-Z lower-cased, as one number; by it classes are cut."""
    out = np.zeros(len(w.start), np.int64)
    for k in range(3):
        at = w.start + k
        inside = at < w.end
        b = np.zeros(len(at), np.int64)
        b[inside] = _LOWER[w.data[at[inside]]]
        out = out << 8 | b
    return out


def _word_counts(train: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                w = words(part.column("text"), lower=True)
                h, first, c = np.unique(w.hash, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(_prefixes(w)[first]), pa.array(c, pa.int64())], ["h", "prefix", "c"])

    return train.select("text").mapInArrow(tidy(run), "h long, prefix long, c long").groupBy("h", "prefix").agg(F.sum("c").alias("c"))


def class_bounds(counts: DataFrame, classes: int = CLASSES) -> np.ndarray:
    """Prefixes that begin a class: runs of prefixes, in order, of about equal mass, from the 4096 heaviest prefixes."""
    heavy = to_arrays(counts.groupBy("prefix").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "prefix").limit(4096))
    order = np.argsort(heavy["prefix"])
    prefix, own = heavy["prefix"][order], heavy["c"][order].astype(np.float64)
    if not len(prefix):
        return np.zeros(0, np.int64)
    mass = own.cumsum()
    bin_ = np.minimum((mass - own / 2) / mass[-1] * classes, classes - 1).astype(int)
    start = np.append(True, bin_[1:] != bin_[:-1])
    return prefix[start][1:]


def leaf_codes(hashes: np.ndarray) -> np.ndarray:
    """The leaf of its class that each word is in."""
    return (mix(hashes ^ _LEAF) >> U(64 - LEVELS)).astype(np.int32)


def leaf_masses(counts: DataFrame, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """label, code, c, v: tokens and words of each leaf of each class, as many rows as leaves at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, prefix, c = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("h", "prefix", "c"))
            leaf, at, v = np.unique(np.searchsorted(bounds, prefix, "right") << LEVELS | leaf_codes(h.view(np.uint64)), return_inverse=True, return_counts=True)
            total = np.zeros(len(leaf), np.int64)
            np.add.at(total, at, c)
            yield pa.RecordBatch.from_arrays([pa.array(leaf >> LEVELS, pa.int64()), pa.array(leaf & ((1 << LEVELS) - 1), pa.int64()), pa.array(total), pa.array(v, pa.int64())], ["label", "code", "c", "v"])

    each = counts.select("h", "prefix", "c").mapInArrow(tidy(run), "label long, code long, c long, v long")
    return to_arrays(each.groupBy("label", "code").agg(F.sum("c").alias("c"), F.sum("v").alias("v")))


class Tokens:
    """Tokens of a slice of documents, one end after each: hash, class, leaf of the class, what is known of the history, and where documents begin."""

    def __init__(self, part: pa.RecordBatch, bounds: np.ndarray):
        w = words(part.column("text"), lower=True)
        docs = len(w.ptr) - 1
        n = len(w.hash) + docs
        self.ptr = w.ptr + np.arange(docs + 1)
        self.is_end = np.zeros(n, bool)
        self.is_end[self.ptr[1:] - 1] = True
        self.hash = np.empty(n, np.uint64)
        self.hash[~self.is_end] = w.hash
        self.hash[self.is_end] = _END
        self.label = np.full(n, len(bounds) + 1, np.int64)
        self.label[~self.is_end] = np.searchsorted(bounds, _prefixes(w), "right")
        place = np.arange(n) - np.repeat(self.ptr[:-1], np.diff(self.ptr))
        back = []
        for k in (1, 2, 3):
            b = np.full(n, _BEGIN)
            b[k:] = self.hash[: n - k]
            b[place < k] = _BEGIN
            back.append(b)
        one, two, three = back
        mask = U(ROWS - 1)
        features = np.stack([mix(one + U(1)), mix(mix(two) ^ (one + U(2))), mix(two + U(3)), mix(three + U(4))], 1)
        self.rows = (features & mask).astype(np.int32)
        self.places = (features >> U(32)).astype(np.uint32)
        self.code = leaf_codes(self.hash)


def _levels(weights: np.ndarray, prior: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Prior plus the weights of its features, of each token and class, less the largest of the token."""
    z = weights.take(rows[:, 0], axis=0)
    z += prior
    for f in range(1, FEATURES):
        z += weights.take(rows[:, f], axis=0)
    z -= z.max(axis=1, keepdims=True)
    return z


def log_classes(weights: np.ndarray, prior: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """log p(class | history) of each token: prior plus the weights of its features, normalised over classes."""
    z = _levels(weights, prior, rows)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def log_labels(weights: np.ndarray, prior: np.ndarray, rows: np.ndarray, label: np.ndarray) -> np.ndarray:
    """log_classes of each token's own class only."""
    out = np.empty(len(label), np.float32)
    for a in range(0, len(label), _SCORED):
        z = _levels(weights, prior, rows[a : a + _SCORED])
        own = z[np.arange(len(z)), label[a : a + _SCORED]]
        out[a : a + _SCORED] = own - np.log(np.exp(z, out=z).sum(axis=1))
    return out


def summed_by_row(g: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows, those met most often first, how often each was met, and the sum of its lines of g.

    Most rows of a batch are met a few times only: their first lines are added at once, then their second ones, and
    so on; only rows met more often than that are summed one by one.
    """
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # a radix sort, as ROWS is less than 2**16
    own = rows[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    times = np.diff(np.append(first, len(order)))
    by = np.argsort((len(rows) - times).astype(np.uint16), kind="stable")
    first, times = first[by], times[by]
    total = g.take(order[first], axis=0)
    often = int(np.searchsorted(-times, -_AT_ONCE))
    for k in range(1, _AT_ONCE):
        most = int(np.searchsorted(-times, -k))
        total[often:most] += g.take(order[first[often:most] + k], axis=0)
    for i in range(often):
        total[i] = g.take(order[first[i] : first[i] + times[i]], axis=0).sum(axis=0)
    return own[first].astype(np.int64), times.astype(np.float32), total


def prior_odds(mass: np.ndarray) -> np.ndarray:
    """Logarithm of the odds of the second side of each decision before anything is learnt, from the masses of leaves (classes, leaves).

    The decisions of a class are numbered from 1, those after decision i are 2 i and 2 i + 1; classes lie one after another.
    """
    odds = np.zeros(mass.shape, np.float32)
    for k in reversed(range(LEVELS)):
        with np.errstate(divide="ignore", invalid="ignore"):
            odds[:, 1 << k : 2 << k] = np.clip(np.nan_to_num(np.log(mass[:, 1::2]) - np.log(mass[:, ::2]), nan=0.0, posinf=_SURE, neginf=-_SURE), -_SURE, _SURE)
        mass = mass[:, ::2] + mass[:, 1::2]
    return odds.reshape(-1)


class Inside:
    """Which word of its class a token is: the decisions from the class to the word's leaf, each by the features of the history.

    A decision's odds are those of the words' counts times what the weights at (feature, decision) say; so the
    leaves of a class add up to 1 whatever the weights are.
    """

    def __init__(self, weights: np.ndarray, mass: np.ndarray):
        self.weights, self.odds = weights.copy(), prior_odds(mass)
        self.log_mass = np.log(np.maximum(mass, 1e-300)) - np.log(np.maximum(mass.sum(axis=1, keepdims=True), 1e-300))
        self.salt = (mix(np.arange(len(self.odds), dtype=np.uint64) + U(5)) >> U(32)).astype(np.int64)
        self.power = np.full(len(weights), 1e-2, np.float32)
        self.met = np.zeros(len(weights), np.float32)

    def _decisions(self, t: Tokens, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Of each level and token: places of the weights by feature, odds of the word's side, and 1 or -1 for that side."""
        code = t.code[at].astype(np.int64)
        first = t.label[at] << LEVELS
        node = np.stack([first + ((1 << k) | (code >> (LEVELS - k))) for k in range(LEVELS)])
        side = np.stack([(code >> (LEVELS - 1 - k)) & 1 for k in range(LEVELS)]).astype(np.float32) * 2 - 1
        salt, z, places = self.salt.take(node), self.odds.take(node), []
        for f in range(FEATURES):
            places.append((salt ^ t.places[at, f].astype(np.int64)) & (len(self.weights) - 1))
            z += self.weights.take(places[f])
        z *= side
        return places, z, side

    def learn(self, t: Tokens, begin: int, end: int) -> None:
        """One step on a mini-batch, as of the class weights; ends of documents are a class of one and decide nothing."""
        at = begin + np.flatnonzero(t.label[begin:end] < len(self.log_mass))
        if not len(at):
            return
        places, z, side = self._decisions(t, at)
        g = np.exp(z, out=z)
        g += 1
        np.divide(side, g, out=g)
        flat = np.concatenate([p.ravel() for p in places])
        times = np.bincount(flat, minlength=len(self.weights)).astype(np.float32)
        total = np.bincount(flat, np.tile(g.ravel().astype(np.float64), FEATURES), len(self.weights)).astype(np.float32)
        total /= np.sqrt(np.maximum(times, 1))
        self.power += total * total
        total *= RATE
        total /= np.sqrt(self.power)
        self.weights += total
        self.met += times

    def log_leaves(self, t: Tokens) -> np.ndarray:
        """log p(leaf | class, history) of each token; 0 for ends of documents."""
        out = np.zeros(len(t.label))
        inner = np.flatnonzero(t.label < len(self.log_mass))
        for a in range(0, len(inner), _DECIDED):
            at = inner[a : a + _DECIDED]
            p = np.exp(-self._decisions(t, at)[1])
            p += 1
            out[at] = -np.log(np.multiply.reduce(p, axis=0, dtype=np.float64))
        return out

    def gains(self, t: Tokens) -> np.ndarray:
        """By how much the decisions change the logarithm of each token's probability in its class, against counts alone."""
        inner = t.label < len(self.log_mass)
        return self.log_leaves(t) - np.where(inner, self.log_mass[np.where(inner, t.label, 0), t.code], 0)


def train_on(slices: Iterator[Tokens], weights: np.ndarray, prior: np.ndarray, inside: Inside | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One pass of AdaGrad steps on mini-batches; returns the weights and how often each row was met. ``inside`` learns along."""
    weights = np.ascontiguousarray(weights).copy()
    whole = weights.view(np.dtype((np.void, weights.strides[0])))[:, 0]  # a row as one item, which is fast to put
    power = np.full(ROWS, 1e-2, np.float32)
    met = np.zeros(ROWS, np.float32)
    for t in slices:
        for a in range(0, len(t.label), BATCH):
            rows, label = t.rows[a : a + BATCH], t.label[a : a + BATCH]
            g = _levels(weights, prior, rows)
            np.exp(g, out=g)
            g /= g.sum(axis=1, keepdims=True)
            g[np.arange(len(label)), label] -= 1
            for f in range(FEATURES):
                own, times, total = summed_by_row(g, rows[:, f])
                total /= np.sqrt(times)[:, None]
                power[own] += np.einsum("ij,ij->i", total, total) / total.shape[1]
                total *= (RATE / np.sqrt(power[own]))[:, None]
                moved = np.subtract(weights.take(own, axis=0), total, out=total)
                whole[own] = moved.view(whole.dtype)[:, 0]
                met[own] += times
            if inside is not None:
                inside.learn(t, a, a + len(label))
    return weights, met


def _round(train: DataFrame, bounds: np.ndarray, weights: np.ndarray, prior: np.ndarray, decided: np.ndarray, mass: np.ndarray, learners: int) -> tuple[np.ndarray, np.ndarray]:
    """All partitions train from the same weights, of classes and of decisions; each becomes the mean of theirs, by how often each met it."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast((bounds, weights, prior, decided, mass))
    classes = weights.shape[1]
    per, places = ROWS // _BLOCKS, PLACES // _BLOCKS

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, weights, prior, decided, mass = shared.value
        slices = (Tokens(part, bounds) for batch in batches for part in chunks(batch))
        inside = Inside(decided, mass)
        w, met = train_on(slices, weights, prior, inside)
        if met.any():
            w, d = (w - weights).astype(np.float16), (inside.weights - decided).astype(np.float16)
            for b in range(_BLOCKS):
                at, own = slice(b * per, (b + 1) * per), slice(b * places, (b + 1) * places)
                packed = [w[at], met[at], d[own], inside.met[own]]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in packed]], ["block", "w", "met", "d", "d_met"])

    def mean(frame):
        import pandas as pd

        def one(moved, met, wide):
            top, bottom = np.zeros((len(met.iloc[0]) // 4, wide)), np.full((len(met.iloc[0]) // 4, 1), 1e-9)
            for w, m in zip(moved, met):
                m = np.frombuffer(m, np.float32)[:, None]
                top += m * np.frombuffer(w, np.float16).reshape(-1, wide)
                bottom += m
            return [(top / bottom).astype(np.float32).tobytes()]

        return pd.DataFrame({"block": frame["block"][:1], "w": one(frame["w"], frame["met"], classes), "d": one(frame["d"], frame["d_met"], 1)})

    moved = train.select("text").coalesce(learners).mapInArrow(tidy(learn), "block int, w binary, met binary, d binary, d_met binary").groupBy("block").applyInPandas(mean, "block int, w binary, d binary")
    out, decided = weights.copy(), decided.copy()
    for row in moved.collect():  # a model of fixed size
        out[row.block * per : (row.block + 1) * per] += np.frombuffer(row.w, np.float32).reshape(per, classes)
        decided[row.block * places : (row.block + 1) * places] += np.frombuffer(row.d, np.float32)
    return out, decided


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", learners: int = LEARNERS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    Documents whose crc32(id) mod 10 is not 0 are learnt from. p(token | history) is p(class | history)
    times p(token | class, history): both from hashed features of the three words before (a 1-gram, a 2-gram
    and two skips). The second is that of the word's leaf in its class, by decisions that begin at the odds of
    the counts, times its share of the leaf's counts plus 0.1. Each class keeps 0.1 for words it has not met.
    So the probabilities over the known words, one unknown in each class and the end add up to 1.
    Null and empty texts are one end token. Rows that repeat are scored one by one and learnt from as often
    as they stand there; null ids count as learnt from. Other columns of docs are not read.
    """
    spark = docs.sparkSession
    flat = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.crc32(F.col(id_col).cast("string")) % 10 == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text")
    )
    train = flat.filter("not held_out")
    counts = save(_word_counts(train))
    ends = train.count()
    bounds = class_bounds(counts)
    classes = len(bounds) + 2
    leaves = leaf_masses(counts, bounds)
    inner = np.zeros((classes - 1, 1 << LEVELS))
    inner[leaves["label"], leaves["code"]] = leaves["c"] + 0.1 * leaves["v"]
    mass = np.append(inner.sum(axis=1), ends) + 0.1
    n = int(leaves["c"].sum()) + ends
    v = int(leaves["v"].sum()) + (ends > 0)
    prior = np.log(mass / mass.sum()).astype(np.float32)

    weights, decided = np.zeros((ROWS, classes), np.float32), np.zeros(PLACES, np.float32)
    for r in range(ROUNDS):
        part = train.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == r)
        weights, decided = _round(part, bounds, weights, prior, decided, inner, learners)

    # the least count of a common word, so that no more than COMMON words are common
    sizes = counts.groupBy("c").agg(F.count("*").alias("v")).orderBy(F.desc("c")).collect()
    least, met = 1 << 62, 0
    for row in sizes:
        met += row.v
        if met > COMMON:
            break
        least = row.c
    common = to_arrays(counts.filter(F.col("c") >= least).select("h", "c"))
    shared = spark.sparkContext.broadcast((bounds, weights, prior, decided, inner, np.log10(mass), common["h"], common["c"].astype(np.float64), ends))
    stamp = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, weights, prior, decided, inner, log_mass, keys, values, ends = shared.value
        inside = Inside(decided, inner)
        shelf = held(("lm", stamp), lambda: Shelf(keys, values, 0.0, np.float64))
        for batch in batches:
            for part in chunks(batch):
                t = Tokens(part, bounds)
                docs = len(t.ptr) - 1
                doc = np.repeat(np.arange(docs), np.diff(t.ptr))
                own = log_labels(weights, prior, t.rows, t.label).astype(np.float64) / np.log(10) - log_mass[t.label]
                gain = inside.gains(t) / np.log(10)
                count, found = shelf.find(t.hash.view(np.int64))
                count[t.is_end], found[t.is_end] = ends, True
                known = np.bincount(doc, found & (count > 0), docs).astype(np.int64)
                head = np.bincount(doc, np.where(found, np.log10(count + 0.1), 0), docs)
                rare = np.flatnonzero(~found)
                rest = np.append(0, np.cumsum(np.bincount(doc[rare], minlength=docs)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("held_out"), pa.array(np.diff(t.ptr)), pa.array(known), pa.array(head), pa.array(np.bincount(doc, own + np.where(found, gain, 0), docs)),
                        pa.ListArray.from_arrays(pa.array(rest.astype(np.int32)), pa.array(t.hash[rare].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(rest.astype(np.int32)), pa.array(gain[rare])),
                    ],
                    ["id", "held_out", "n_tokens", "known", "head", "model", "rare", "gain"],
                )

    kind = flat.schema["id"].dataType.simpleString()
    scored = flat.mapInArrow(tidy(score, model=True), f"id {kind}, held_out boolean, n_tokens long, known long, head double, model double, rare array<long>, gain array<double>")
    scored = save(scored.withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "gain")).alias("x")).groupBy("row", F.col("x.rare").alias("h")).agg(F.count("*").alias("n"), F.sum("x.gain").alias("gain"))
    rare = rare.join(counts.filter(F.col("c") < least).select("h", "c"), "h", "left")
    rest = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("tail"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.when(F.col("c") > 0, F.col("gain")).otherwise(0.0)).alias("tail_gain"),
    )
    whole = float(np.log10(n + 0.1 * (v + 1)))
    out = scored.drop("rare", "gain").join(rest, "row", "left")
    words_sum = F.col("head") + F.coalesce("tail", F.lit(0.0))
    return out.select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (words_sum - F.col("n_tokens") * whole).alias("base_score"), (words_sum + F.col("model") + F.coalesce("tail_gain", F.lit(0.0))).alias("score"),
    )


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
