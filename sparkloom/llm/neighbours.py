"""Approximate nearest neighbours by a hash-prefix forest: sorted arrays of long hash strings, one for each tree.

A row's hash string in a tree tells the sides of many hyperplanes that it lies on. Rows that share a long
prefix with a query lie close to it. A query descends to its longest match in every tree, then ascends in all
trees together, one bit at a time, until the rows under its prefixes are as many as wanted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import save
from .vectors import finite, matrix, not_zero, padded

TREES, BITS = 12, 52
#: The forest is fitted on about so many rows, of so many bytes at most, with so many of them as queries.
SAMPLE, SAMPLE_BYTES, PROBES = 1 << 14, 1 << 25, 256
#: Share of the sample's true neighbours that the wanted number of candidates would find; what is added to that number, as ascents are by
#: whole bits; and to the power by which it grows with the table, which is measured on few probes.
TARGET, MARGIN, POWER_MARGIN = 0.96, 1 / 16, 0.1
#: A sorted array holds about so many rows; larger ones are dealt out in parts.
SHARD, SHARDS = 1 << 12, 512
NEAREST, EVERY = 20, 20
_SLACK = 1e-9


@dataclass(frozen=True)
class Forest:
    """planes, medians: of each tree and bit; radius: the longest vector; starts: the least hash of each array of a tree; wanted: candidates of a query."""

    planes: np.ndarray
    medians: np.ndarray
    radius: float
    starts: list[np.ndarray]
    wanted: int

    def hashes(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Hash strings by tree, as integers. Rows are lifted to the sphere of the longest vector, which makes the nearest by angle that of the largest inner product."""
        lifted = _lifted(x, self.radius, query)
        out = np.empty((len(x), len(self.planes)), np.int64)
        weights = 2.0 ** np.arange(BITS - 1, -1, -1)
        for t, (planes, medians) in enumerate(zip(self.planes, self.medians)):
            out[:, t] = (lifted @ planes > medians) @ weights
        return out


def _lifted(x: np.ndarray, radius: float, query: bool) -> np.ndarray:
    if query:
        size = np.abs(x).max(1, keepdims=True)
        x = x / np.where(size > 0, size, 1)
        return np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True)), np.zeros((len(x), 1))])
    x = x / radius
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))])


def common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of two hash strings."""
    return BITS - np.frexp((a ^ b).astype(np.float64))[1]


def _needed(x: np.ndarray, data: np.ndarray, queries: np.ndarray, probes: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates before and after the ascent that finds each true neighbour of the probes, when all trees are ascended together."""
    before, after = [], []
    for i in probes:
        scores = x @ x[i]
        scores[i] = -np.inf
        k = min(nearest, len(x) - 1)
        true = np.argpartition(-scores, k - 1)[:k]
        shared = common_bits(data, queries[i])
        at_least = np.bincount(shared.ravel(), minlength=BITS + 2)[::-1].cumsum()[::-1]
        depth = shared[true].max(1)
        before.append(at_least[depth + 1] + 1)
        after.append(at_least[depth])
    return np.concatenate(before), np.concatenate(after)


def _starts(hashes: np.ndarray, limit: float) -> np.ndarray:
    """Least hash of each prefix that at most ``limit`` of the sorted hashes share: longer prefixes where rows are dense."""
    out, todo = [], [(0, 0, 0, len(hashes))]
    while todo:
        first, depth, low, high = todo.pop()
        if high - low <= limit or depth == BITS:
            out.append(first)
            continue
        half = first + (1 << (BITS - depth - 1))
        mid = low + int(np.searchsorted(hashes[low:high], half))
        todo += [(half, depth + 1, mid, high), (first, depth + 1, low, mid)]
    return np.array(out, np.int64)


def fitted(sample: np.ndarray, rows: int, radius: float, nearest: int = NEAREST, trees: int = TREES) -> Forest:
    """A forest for a table of ``rows`` rows, of which the sample is a random part.

    Hyperplanes of a tree stand at right angles to one another as far as there are dimensions, and halve
    the sample. How many candidates a query wants is found on the sample and on a quarter of it, where
    true neighbours are known, and carried on to all rows by the power that leads from one to the other,
    at most in proportion.
    """
    rng = np.random.Generator(np.random.PCG64(11))
    d = sample.shape[1] + 1
    planes = np.empty((trees, d, BITS))
    for t in range(trees):
        for b in range(0, BITS, d):
            planes[t, :, b : b + d] = np.linalg.qr(rng.standard_normal((d, d)))[0][:, : BITS - b]
    lifted = _lifted(sample, radius, False)
    medians = np.stack([np.median(lifted @ p, axis=0) for p in planes])
    plain = Forest(planes, medians, radius, [], 0)
    data, queries = plain.hashes(sample, False), plain.hashes(sample, True)
    s = len(sample)
    wanted, power, quarter = float(s), 1.0, s // 4
    if s > 1:
        need = _needed(sample, data, queries, rng.permutation(s)[:PROBES], nearest)
        if quarter > 4 * nearest:
            fewer = _needed(sample[:quarter], data[:quarter], queries[:quarter], rng.permutation(quarter)[:PROBES], nearest)
            # an ascent doubles the candidates; somewhere on its way lies what was needed
            smooth = [np.quantile(a * (b / a) ** rng.random(len(a)), TARGET) for a, b in (need, fewer)]
            power = np.log(smooth[0] / smooth[1]) / np.log(s / quarter)
        wanted = float(np.quantile(need[0], TARGET)) * (1 + MARGIN) * max(1.0, rows / s) ** min(1.0, max(0.0, power) + POWER_MARGIN)
    limit = max(SHARD * s / max(rows, 1), s / (SHARDS / 2))
    starts = [_starts(np.sort(data[:, t]), limit) for t in range(trees)]
    return Forest(planes, medians, radius, starts, int(np.ceil(wanted)))


def _classes(df: DataFrame, id_col: str, vector_col: str, query: Column, keep: int) -> tuple[DataFrame, DataFrame, int]:
    """Distinct vectors (cls, vec, ids: the smallest ``keep`` of their ids), the queries (query_id, cls), and the number of dimensions."""
    rows = df.filter(finite(vector_col) & not_zero(vector_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
    rows, dims = padded(rows, "vec")
    rows = save(rows.distinct())
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= keep)
    each = few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = save(each.select(F.monotonically_increasing_id().alias("cls"), "vec", "ids"))
    asked = rows.filter(query).select(F.col("id").alias("query_id"), "vec")
    return classes, save(asked.join(classes.select("vec", "cls"), "vec").select("query_id", "cls")), dims


def _fit(classes: DataFrame, dims: int, nearest: int) -> Forest | None:
    rows, radius = classes.agg(F.count("*"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))))).first()
    if not rows:
        return None
    bound = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))
    share = min(1.0, bound / rows)
    chance = F.pmod(F.xxhash64("vec"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)) if rows > bound else 1 << 40)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([matrix(batch.column(0), dims).tobytes()], pa.binary())], ["x"])

    parts = classes.filter(chance).select("vec").limit(2 * bound).mapInArrow(packed, "x binary").collect()
    sample = np.frombuffer(b"".join(r.x for r in parts), np.float64).reshape(-1, dims)
    sample = sample[np.lexsort(sample.T[::-1])]
    return fitted(np.random.Generator(np.random.PCG64(3)).permutation(sample), rows, radius, nearest)


def _hashed(rows: DataFrame, forest: Forest, dims: int, query: bool) -> DataFrame:
    """rows with their hash strings and the arrays that these are in, by tree."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = forest.hashes(matrix(batch.column(1), dims), query)
            shard = np.stack([np.searchsorted(s, h[:, t], "right") - 1 for t, s in enumerate(forest.starts)], 1).astype(np.int32)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), len(forest.starts)) for v in (h, shard)]
            yield pa.RecordBatch.from_arrays([*batch.columns, lists[0].cast(pa.list_(pa.int64())), lists[1].cast(pa.list_(pa.int32()))], [*batch.schema.names, "hash", "shard"])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(each, f"{kinds}, hash array<long>, shard array<int>")


def _by_tree(rows: DataFrame, *carried: str) -> DataFrame:
    """A row for each tree."""
    pairs = rows.select(*carried, F.posexplode(F.arrays_zip("hash", "shard")).alias("tree", "at"))
    return pairs.select(*carried, "tree", F.col("at.shard").alias("shard"), F.col("at.hash").alias("hash"))


def _in_groups(batches: Iterator[pa.RecordBatch], key: str, kind: str) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of rows of one key and kind, in order; a run may come in several pieces."""
    for batch in batches:
        keys, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in (key, kind))
        cuts = [0, *(np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield int(keys[a]), int(kinds[a]), batch.slice(a, b - a)


def _levels(index: DataFrame, queries: DataFrame, forest: Forest, totals: dict[tuple[int, int], int]) -> DataFrame:
    """q, depth: the prefix length at which a query has, over all trees, the candidates it wants, or no longer prefix to give up.

    A sorted array counts the rows under each prefix of the queries in it; prefixes that span several
    arrays are summed from the arrays' own counts.
    """
    trees = len(forest.starts)
    ups = np.arange(BITS + 1)
    sizes = [np.array([0, *np.cumsum([totals.get((t, s), 0) for s in range(len(starts))])]) for t, starts in enumerate(forest.starts)]
    ends = [np.append(s[1:], 1 << BITS) for s in forest.starts]
    parts = {k: -(-n // (1 << 20)) for k, n in totals.items() if n > 1 << 20}

    def dealt(rows: DataFrame, kind: int) -> DataFrame:
        slot = (F.col("tree") * SHARDS * 4 + F.col("shard")).cast("long")
        out = rows.select("tree", "shard", "hash", "id", "n", F.lit(kind).alias("kind"), slot.alias("slot"))
        if not parts:
            return out.withColumn("part", F.lit(0))
        count = F.coalesce(F.create_map(*(F.lit(v) for (t, s), p in parts.items() for v in (t * SHARDS * 4 + s, p)))[F.col("slot")], F.lit(1))
        if kind == 0:
            return out.withColumn("part", F.pmod(F.xxhash64("hash"), count).cast("int"))
        return out.withColumn("part", F.explode(F.sequence(F.lit(0), count - 1)))

    data = _by_tree(index).groupBy("tree", "shard", "hash").agg(F.count("*").alias("n")).withColumn("id", F.lit(0).cast("long"))
    asked = _by_tree(queries, "cls").withColumnRenamed("cls", "id").withColumn("n", F.lit(0).cast("long"))
    mixed = dealt(data, 0).unionByName(dealt(asked, 1)).select("id", "tree", "shard", "hash", "n", "kind", (F.col("slot") * (1 << 24) + F.col("part")).alias("slot"))
    mixed = mixed.repartition("slot").sortWithinPartitions("slot", "kind", "hash")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, sums = -1, [], None
        for key, kind, run in _in_groups(batches, "slot", "kind"):
            if key != slot:
                slot, held, sums = key, [], None
            if kind == 0:
                held.append(run.select(["hash", "n"]))
                continue
            if sums is None:
                stored = np.concatenate([np.zeros(0, np.int64), *(r.column("hash").to_numpy() for r in held)])
                sums = np.concatenate([[0], *(r.column("n").to_numpy() for r in held)]).cumsum()
            tree, shard = run.column("tree")[0].as_py(), run.column("shard")[0].as_py()
            h = run.column("hash").to_numpy()
            low = (h[:, None] >> (BITS - ups)) << (BITS - ups)
            high = low + (np.int64(1) << (BITS - ups))
            inside = (low >= forest.starts[tree][shard]) & (high <= ends[tree][shard])
            found = sums[np.searchsorted(stored, high)] - sums[np.searchsorted(stored, low)]
            if key % (1 << 24) == 0:  # one part of an array adds what spans several
                a, b = np.searchsorted(forest.starts[tree], low), np.searchsorted(forest.starts[tree], high)
                found = np.where(inside, found, sizes[tree][b] - sizes[tree][a])
            else:
                found = np.where(inside, found, 0)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), BITS + 1).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([run.column("id"), lists], ["q", "found"])

    counts = mixed.mapInArrow(count, "q long, found array<long>")
    each = counts.select("q", F.posexplode("found").alias("depth", "n")).groupBy("q", "depth").agg(F.sum("n").alias("n"))
    enough = F.max(F.when(F.col("n") >= forest.wanted, F.col("depth")))
    return each.groupBy("q").agg(F.coalesce(enough, F.lit(0)).alias("depth"))


def _scored(index: DataFrame, queries: DataFrame, forest: Forest, totals: dict[tuple[int, int], int], dims: int, keep: int) -> DataFrame:
    """q, cls, ids, score: of every query and part of a sorted array, the best of the candidates that share the query's prefix there."""
    element = index.schema["vec"].dataType.elementType.simpleString()
    layout = f"slot long, kind int, id long, hash long, high long, vec array<{element}>, ids array<long>"
    trees = range(len(forest.starts))
    parts = [np.array([max(1, -(-totals.get((t, s), 0) // (2 * SHARD))) for s in range(len(forest.starts[t]))]) for t in trees]
    first, n = [], 0
    for t in trees:
        first.append(n + np.concatenate([[0], parts[t].cumsum()]))
        n = int(first[-1][-1])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("cls")
            h, shard = (batch.column(c).flatten().to_numpy().reshape(len(batch), -1) for c in ("hash", "shard"))
            chance = (ids.to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            for t in trees:
                slot = first[t][shard[:, t]] + (chance % parts[t][shard[:, t]].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.zeros(len(ids), np.int32)), ids, pa.array(h[:, t]), pa.array(h[:, t]), batch.column("vec"), batch.column("ids")], names)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("hash").flatten().to_numpy().reshape(len(batch), -1)
            up = BITS - batch.column("depth").to_numpy().astype(np.int64)
            for t in trees:
                low = (h[:, t] >> up) << up
                high = low + (np.int64(1) << up)
                a = first[t][np.searchsorted(forest.starts[t], low, "right") - 1]
                b = first[t][np.searchsorted(forest.starts[t], high - 1, "right")]
                for i in range(0, len(h), 256):
                    count = (b - a)[i : i + 256]
                    at = np.repeat(np.arange(i, i + len(count)), count)
                    slot = np.arange(count.sum()) - np.repeat(count.cumsum() - count, count) + a[at]
                    pick = batch.take(pa.array(at))
                    none = pa.nulls(len(at), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.ones(len(at), np.int32)), pick.column("cls"), pa.array(low[at]), pa.array(high[at]), pick.column("vec"), none], names)

    names = ["slot", "kind", "id", "hash", "high", "vec", "ids"]
    data = index.select("cls", "vec", "ids", "hash", "shard").mapInArrow(rows_of, layout)
    mixed = data.unionByName(queries.select("cls", "vec", "hash", "depth").mapInArrow(asked, layout))
    mixed = mixed.repartition("slot").sortWithinPartitions("slot", "kind", "hash")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, x = -1, [], None
        for key, kind, run in _in_groups(batches, "slot", "kind"):
            if key != slot:
                slot, held, x = key, [], None
            if kind == 0:
                held.append(run)
                continue
            if not held:
                continue
            if x is None:
                stored = np.concatenate([r.column("hash").to_numpy() for r in held])
                x = np.concatenate([matrix(r.column("vec"), dims) for r in held])
                cls = np.concatenate([r.column("id").to_numpy() for r in held])
                ids = pa.concat_arrays([r.column("ids") for r in held])
            low, high = np.searchsorted(stored, run.column("hash").to_numpy()), np.searchsorted(stored, run.column("high").to_numpy())
            q, qid = matrix(run.column("vec"), dims), run.column("id").to_numpy()
            for at in _blocks(low, high):
                a, b = int(low[at[0]]), int(high[at[0]])
                if b == a:
                    continue
                i, j = _best(q[at], x[a:b], keep)
                exact = np.zeros(len(i))
                for k in range(dims):  # in one order, so that a pair has one score wherever it is met
                    exact += q[at[i], k] * x[a + j, k]
                yield pa.RecordBatch.from_arrays([pa.array(qid[at[i]]), pa.array(cls[a + j]), ids.take(pa.array(a + j)), pa.array(exact)], ["q", "cls", "ids", "score"])

    return mixed.mapInArrow(score, "q long, cls long, ids array<long>, score double")


def _blocks(low: np.ndarray, high: np.ndarray) -> Iterator[np.ndarray]:
    """Queries, at most 256 together, that have the same candidates."""
    order = np.lexsort((high, low))
    a, b = low[order], high[order]
    cuts = [0, *(np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1).tolist(), len(order)]
    for s, e in zip(cuts, cuts[1:]):
        for i in range(s, e, 256):
            yield order[i : min(e, i + 256)]


def _best(q: np.ndarray, x: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of queries and rows whose score is not below the query's keep-th best, give or take rounding: all that tie with it too."""
    scores = q @ x.T
    if len(x) > keep:
        least = np.partition(scores, len(x) - keep, axis=1)[:, len(x) - keep]
        return np.nonzero(scores >= (least - _SLACK * (np.abs(least) + np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()))[:, None])
    return np.nonzero(np.ones(scores.shape, bool))


def nearest(df: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding", count: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``query`` (a condition on ``id``) picks, the rows of largest inner product that the forest finds.

    Equal vectors are one row of the forest, with the count + 1 smallest of their ids, as more cannot be
    among the nearest. Every vector is indexed; hyperplanes, bounds of sorted arrays and the number of
    candidates come from a sample (SAMPLE, SAMPLE_BYTES). Where fewer than count + 1 rows share prefixes
    with a query, it ascends to the root, where all rows do.

    Rows whose id or vector is null, or whose vector is all zeros (or empty) or holds a null, a NaN or an
    infinity, take no part. Shorter vectors get zeros behind. Equal rows (id and vector) count once; rows
    that share an id but not the vector are different rows, and each is a query of its own. Ties go to the
    smaller id. Other columns are not looked at; an empty table gives no rows.
    """
    spark = df.sparkSession
    classes, asked, dims = _classes(df, id_col, vector_col, query, count + 1)
    forest = _fit(classes, dims, count)
    if forest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if forest.wanted < count + 1:
        forest = Forest(forest.planes, forest.medians, forest.radius, forest.starts, count + 1)
    index = save(_hashed(classes, forest, dims, query=False))
    totals = {(r.tree, r.shard): r["count"] for r in _by_tree(index).groupBy("tree", "shard").count().collect()}
    queries = save(_hashed(classes.join(asked.select("cls").distinct(), "cls", "left_semi"), forest, dims, query=True))
    depths = _levels(index, queries, forest, totals)
    found = _scored(index, queries.join(depths.withColumnRenamed("q", "cls"), "cls"), forest, totals, dims, count + 1)

    pairs = found.groupBy("q", "cls").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    rows = pairs.select("q", "cls", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "cls")
    few = rows.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= count + 1)
    listed = few.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "cls", "score"))).alias("found"))
    whole = asked.join(listed, asked.cls == listed.q).select("query_id", asked.cls.alias("own"), "found")
    others = F.slice(F.filter("found", lambda r: (r["vec_id"] != F.col("query_id")) | (r["cls"] != F.col("own"))), 1, count)
    each = whole.select("query_id", F.posexplode(others).alias("at", "r"))
    return each.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"), F.col("r.score").alias("score"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest rows of embeddings to each of those whose id is divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % EVERY == 0)
