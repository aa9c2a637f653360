"""Toxicity: a factorization machine over hashed terms, learnt on a bounded sample and scored where the texts lie."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import save

#: Labelled documents to learn from at most, taken in the order of a hash of their ids.
SAMPLE = 24_000
#: Terms are hashed to so many places.
PLACES = 1 << 20
FACTORS = 4
#: Terms that the machine weighs, beside those of pairs: those whose classes differ most in the sample.
TERMS = 4096
#: So many of the terms nearest to standing in half of the sample are tried in pairs; a pair's own gain, beyond
#: that of its terms, must be this much for the two to be weighed. The figures come from the sample, not the corpus.
PAIRED, PAIR_GAIN = 1024, 20.0
_STRIP = "\"'.,;:!?()[]{}<>*&%$#|«»“”¡¿-_/\\"


def terms_of(word: str) -> tuple[str, ...]:
    """A word and its beginnings, which stand for its inflected forms."""
    w = word.strip(_STRIP)
    return (w, *("^" + w[:k] for k in (3, 4, 5, 6) if len(w) > k)) if w else ()


def place(term: str) -> int:
    """FNV-1a of the UTF-8 bytes: the same in every process."""
    h = 0x811C9DC5
    for b in term.encode():
        h = (h ^ b) * 0x01000193 & 0xFFFFFFFF
    return (h ^ h >> 15) * 0x2C1B3C6D % 0x100000000 % PLACES


class Hasher:
    """Places of a document's terms. Words met are remembered, up to a fixed number, for the rest of a task."""

    def __init__(self, wanted: np.ndarray | None = None, kept: int = 100_000):
        self.wanted, self.kept, self.known = wanted, kept, {}

    def of(self, word: str) -> tuple[int, ...]:
        places = tuple({place(t) for t in terms_of(word)})
        if self.wanted is not None:
            places = tuple(int(x) for x in self.wanted[list(places)] if x >= 0)
        if len(self.known) < self.kept:
            self.known[word] = places
        return places

    def __call__(self, text: str) -> set[int]:
        known, out = self.known, set()
        for word in set(text.lower().split()):
            p = known.get(word)
            if p is None:
                p = self.of(word)
            if p:
                out.update(p)
        return out


def machine_scores(rows: np.ndarray, cols: np.ndarray, n: int, bias: float, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    """bias + sum w + pairwise sum <v_i, v_j> of each of n documents, from (row, col) pairs of present terms."""
    linear = np.bincount(rows, w[cols], n)
    total = np.stack([np.bincount(rows, v[cols, f], n) for f in range(v.shape[1])], 1)
    squares = np.bincount(rows, (v * v).sum(1)[cols], n)
    return bias + linear + 0.5 * ((total * total).sum(1) - squares)


def telling_pairs(docs: list[np.ndarray], toxic: np.ndarray, all_: np.ndarray) -> np.ndarray:
    """Terms of pairs whose four cases tell the classes apart by more than the two terms do each for itself."""
    n = len(docs)
    tried = np.sort(np.argsort(-all_ * (n - all_), kind="stable")[:PAIRED])
    tried = tried[(all_[tried] >= 3) & (all_[tried] < n)]
    column = np.full(PLACES, -1, np.int32)
    column[tried] = np.arange(len(tried))
    both = {1: np.zeros((len(tried), len(tried))), 0: np.zeros((len(tried), len(tried)))}
    for kind in both:
        at = np.flatnonzero(toxic == kind)
        for i in range(0, len(at), 1000):
            x = np.zeros((len(at[i : i + 1000]), len(tried)), np.float32)
            for k, d in enumerate(at[i : i + 1000]):
                c = column[docs[d]]
                x[k, c[c >= 0]] = 1
            both[kind] += x.T @ x
    sizes = {1: toxic.sum(), 0: n - toxic.sum()}

    def likelihood(on: np.ndarray, off: np.ndarray) -> np.ndarray:
        total = np.maximum(on + off, 1e-9)
        return on * np.log(np.maximum(on, 1e-9) / total) + off * np.log(np.maximum(off, 1e-9) / total)

    def cases(m: np.ndarray, size: float) -> list[np.ndarray]:
        a = np.diag(m)
        return [m, a[:, None] - m, a[None, :] - m, size - a[:, None] - a[None, :] + m]

    joint = sum(likelihood(on, off) for on, off in zip(cases(both[1], sizes[1]), cases(both[0], sizes[0])))
    on, off = np.diag(both[1]), np.diag(both[0])
    single = likelihood(on, off) + likelihood(sizes[1] - on, sizes[0] - off)
    own = joint - single[:, None] - single[None, :] + likelihood(sizes[1], sizes[0])
    np.fill_diagonal(own, 0)
    return tried[(own > PAIR_GAIN).any(axis=1)]


def fit(docs: list[np.ndarray], toxic: np.ndarray, epochs: int = 12, seed: int = 7) -> dict:
    """Choose terms that tell, alone or in pairs, then fit weights and factors by AdaGrad on mini-batches. Learns nothing from no rows."""
    n = len(docs)
    if n == 0 or toxic.min() == toxic.max():
        rate = (toxic.sum() + 0.5) / (n + 1)
        return {"bias": float(np.log(rate / (1 - rate))) if n else -3.0, "wanted": np.full(PLACES, -1, np.int32), "w": np.zeros(1), "v": np.zeros((1, FACTORS))}
    on, all_ = np.zeros(PLACES), np.zeros(PLACES)
    for i in range(0, n, 1000):
        part = docs[i : i + 1000]
        cols = np.concatenate(part)
        on += np.bincount(cols, np.repeat(toxic[i : i + 1000], [len(d) for d in part]), PLACES)
        all_ += np.bincount(cols, minlength=PLACES)
    off = all_ - on
    pos, neg = toxic.sum(), n - toxic.sum()
    # signed root of the log-likelihood gain of knowing a term
    p1, p0 = (on + 0.01) / (pos + 0.02), (off + 0.01) / (neg + 0.02)
    p = (all_ + 0.01) / (n + 0.02)
    gain = on * np.log(p1 / p) + off * np.log(p0 / p) + (pos - on) * np.log((1 - p1).clip(1e-9) / (1 - p).clip(1e-9)) + (neg - off) * np.log((1 - p0).clip(1e-9) / (1 - p).clip(1e-9))
    gain[all_ < 3] = 0
    chosen = np.sort(np.argsort(-gain, kind="stable")[:TERMS])
    chosen = np.union1d(chosen[gain[chosen] > 4], telling_pairs(docs, toxic, all_))
    wanted = np.full(PLACES, -1, np.int32)
    wanted[chosen] = np.arange(len(chosen))
    m = max(1, len(chosen))
    few = [wanted[d][wanted[d] >= 0] for d in docs]
    ptr = np.append(0, np.cumsum([len(d) for d in few]))
    cols = np.concatenate(few).astype(np.int64)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(m), rng.normal(0, 0.02, (m, FACTORS))
    bias = float(np.log((pos + 0.5) / (neg + 0.5)))
    gw, gv, gb = np.full(m, 1e-6), np.full((m, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, 256):
            part = order[a : a + 256]
            counts = ptr[part + 1] - ptr[part]
            r = np.repeat(np.arange(len(part)), counts)
            at = np.arange(len(r)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(ptr[part], counts)
            c = cols[at]
            z = machine_scores(r, c, len(part), bias, w, v)
            g = (1 / (1 + np.exp(-z)) - toxic[part]) / len(part) * 16
            total = np.stack([np.bincount(r, v[c, f], len(part)) for f in range(FACTORS)], 1)
            dw = np.bincount(c, g[r], m) + 1e-4 * w
            dv = np.stack([np.bincount(c, g[r] * (total[r, f] - v[c, f]), m) for f in range(FACTORS)], 1) + 1e-3 * v
            gw += dw * dw
            gv += dv * dv
            gb += g.sum() ** 2
            w -= 0.3 * dw / np.sqrt(gw)
            v -= 0.03 * dv / np.sqrt(gv)
            bias -= 0.05 * float(g.sum()) / np.sqrt(gb)
    return {"bias": bias, "wanted": wanted, "w": w, "v": v}


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Fit on at most ``sample`` labelled documents whose crc32(id) mod 5 is not 0. Terms are hashed in the tasks; one task fits."""
    ids = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    chosen = save(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    few = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sets = [np.fromiter(hasher(t or ""), np.int32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), batch.column(1).cast(pa.int32())], ["terms", "toxic"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, toxic = [], []
        for batch in batches:
            docs += [np.sort(np.frombuffer(b, np.int32)) for b in batch.column(0).to_pylist()]
            toxic += batch.column(1).to_pylist()
        # rows may come in any order: learning starts from one that depends on their content
        order = sorted(range(len(docs)), key=lambda i: (len(docs[i]), zlib.crc32(docs[i].tobytes()), toxic[i]))
        model = fit([docs[i] for i in order], np.array([toxic[i] for i in order], float))
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (np.float64(model["bias"]).tobytes(), model["wanted"].tobytes(), model["w"].tobytes(), model["v"].tobytes())], ["bias", "wanted", "w", "v"])

    terms = save(few.mapInArrow(hashed, "terms binary, toxic int"))  # hashed where the texts lie
    row = terms.coalesce(1).mapInArrow(fitted, "bias binary, wanted binary, w binary, v binary").first()
    return {
        "bias": float(np.frombuffer(row.bias, np.float64)[0]),
        "wanted": np.frombuffer(row.wanted, np.int32),
        "w": np.frombuffer(row.w, np.float64),
        "v": np.frombuffer(row.v, np.float64).reshape(-1, FACTORS),
    }


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    The machine weighs the set of a whole text's words and word beginnings, alone and in pairs. Scores do
    not depend on ids, labels or other columns. Null and empty texts get the score of no terms. A document
    labelled more than once is toxic if one label says so. With no labels, or labels of one kind only,
    all get the base rate. Rows with a null id are scored, and count as learnt from (held_out false).
    """
    flat = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(learn(flat, labels.select("doc_id", "toxic"), sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        hasher = Hasher(model["wanted"])
        for batch in batches:
            sets = [hasher(t or "") for t in batch.column(2).to_pylist()]
            rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.int64)
            cols = np.fromiter((c for s in sets for c in sorted(s)), np.int64, len(rows))
            z = machine_scores(rows, cols, len(sets), model["bias"], model["w"], model["v"])
            score = 1 / (1 + np.exp(-z.clip(-500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")
    kind = flat.schema["doc_id"].dataType.simpleString()
    return flat.select("doc_id", held, "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
