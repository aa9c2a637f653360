"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union of links."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bloom
from .components import connected
from .scratch import join_counted, save, tidy
from .words import U, chunks, grams, mix, words

SHINGLE = 5
SLOTS = 125
BANDS = 25
#: Pairs that the pipeline drops one of overlap in so many % of their union; op6 has its own, higher share.
PIPELINE_PERCENT = 80
#: A further hub round comes first when the join of those still apart would make more pairs for each of its rows.
ROUND = 16
_POSITIVE = (1 << 63) - 1
_ROW = "_row_of_near_duplicates"


def most_bits(percent: int) -> int:
    """Signature bits that a pair linked at percent differs in on average, and seven deviations: more rule a link out."""
    mean = SLOTS * (100 - percent) / 200
    return math.ceil(mean + 7 * math.sqrt(mean * (1 - mean / SLOTS)))


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each text's begin."""
    w = words(texts, lower=True)
    count = np.diff(w.ptr)
    n = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    ptr = np.append(0, np.cumsum(n))
    out = np.empty(ptr[-1], np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(ptr[-1]) - ptr[doc] + w.ptr[doc]
    full = count[doc] >= size
    out[full] = grams(w.hash, size)[at[full]]
    for k in range(1, size):
        few = count[doc] == k
        if few.any():
            out[few] = grams(w.hash, k)[at[few]]
    for a, b in zip(ptr.tolist(), ptr[1:].tolist()):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[new], np.append(0, np.cumsum(np.bincount(doc[new], minlength=len(n))))


def super_minhash(elements: np.ndarray, ptr: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures of many sets at once, one row each; a row of an empty set is all ones.

    In step j each element draws the next place of its own random permutation of the slots, and offers
    that slot the value (j, random). A set is finished, and its elements stop drawing, once no slot
    is left that a later step could lower.
    """
    sets = len(ptr) - 1
    h = np.full(sets * slots, ~U(0))
    doc = np.repeat(np.arange(sets), np.diff(ptr))
    el, order = elements, None
    for j in range(slots):
        draw = mix(el + U((j + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        k = (j + (draw >> U(40)) % U(slots - j)).astype(np.int64)
        if j == 0:
            slot = k
        else:
            rows = np.arange(len(el))
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
        np.minimum.at(h, doc * slots + slot, (U(j) << U(32)) | (draw & U(0xFFFFFFFF)))
        open_ = h.reshape(sets, slots).max(axis=1) >= U(j + 1) << U(32)
        live = open_[doc]
        if not live.any():
            break
        if j == 0:
            el, doc, k = el[live], doc[live], k[live]
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(el), 1))
            order[np.arange(len(el)), k] = 0
        elif live.mean() < 0.7:
            el, doc, order = el[live], doc[live], order[live]
    return h.reshape(sets, slots)


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signatures.shape[1] // bands
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * U(0xD1342543DE82EF95), parts.shape[:2])
    for c in range(rows):
        acc = mix(acc ^ parts[:, :, c])
    return acc


def _lists(flat: np.ndarray, ptr: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(np.ascontiguousarray(flat).view(np.int64)))


def sketches(docs: DataFrame) -> DataFrame:
    """id, n_shingles, print (two hashes of the whole set), bands and 128 bits of the signature, for each row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                sets, ptr = shingle_sets(part.column("text"))
                signatures = super_minhash(sets, ptr)
                bits = np.zeros((len(signatures), 128), bool)
                bits[:, : signatures.shape[1]] = signatures & U(1)
                bits = np.packbits(bits, axis=1).view(np.int64)
                total = np.append(U(0), np.cumsum(mix(sets))), np.append(U(0), np.cumsum(mix(sets ^ U(0xA5A5A5A5A5A5A5A5))))
                prints = [pa.array((t[ptr[1:]] - t[ptr[:-1]]).view(np.int64)) for t in total]
                keys = band_keys(signatures)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(ptr), pa.int64()), *prints, _lists(keys.ravel(), np.arange(len(keys) + 1) * BANDS), pa.array(bits[:, 0]), pa.array(bits[:, 1])],
                    ["id", "n_shingles", "p1", "p2", "bands", "b1", "b2"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(tidy(run), f"id {kind}, n_shingles long, p1 long, p2 long, bands array<long>, b1 long, b2 long")


def _sets_of(docs: DataFrame, table) -> DataFrame:
    """id, shingles: whole sets of the documents that the filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = mix(batch.column("id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            batch = batch.filter(pa.array(bloom.may_hold(table.value, key)))
            for part in chunks(batch):
                sets, ptr = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), _lists(sets, ptr)], ["id", "shingles"])

    return docs.select("id", "text").mapInArrow(tidy(run), "id long, shingles array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs.

    Words are runs outside white space after lower-casing A-Z; a text with fewer than five words is one
    shingle, one without words (or null) is linked with nothing. Documents whose sets overlap in at least
    ``percent`` % of their union are linked, and component_id is the smallest id that can be reached. Rows
    that repeat an id count as one document for linking; rows with a null id are linked with nothing and
    kept. Other columns of docs are not read.

    Members of a band bucket meet the bucket's hub. Those still apart are narrowed down by exact bounds, and
    then joined on what sets them off from the hub. Where that join would be large, as a cluster of its own
    lies around another document, a further hub round comes first; rounds end when they no longer halve it.
    Nothing is dropped at any size.
    """
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    drawn = save(sketches(flat))
    live = drawn.filter("n_shingles > 0 and id is not null")

    # texts with one and the same set are one class, and its smallest id stands for it
    classes = live.groupBy("n_shingles", "p1", "p2").agg(
        F.min("id").alias("rep"), F.min_by(F.struct("bands", "b1", "b2"), "id").alias("s"), F.count("*").alias("n")
    )
    classes = save(classes.withColumn("key", F.xxhash64("n_shingles", "p1", "p2").bitwiseAND(F.lit(_POSITIVE))))
    rest = save(_buckets(classes))
    sets = save(_sets_of_members(flat, rest))
    links, before = None, None
    while True:
        hubs = save(_with_hubs(rest))
        confirmed = save(_verified(sets, _hub_pairs(hubs, percent), percent))
        links = confirmed if links is None else links.unionByName(confirmed)
        rest = save(_still_apart(hubs, sets, _labels(links), percent))
        index = save(_index(rest, sets, percent))
        met, rows = _meetings(index)
        if met <= ROUND * rows or before is not None and 2 * met > before:
            break
        before, rest = met, rest.drop("hub", "common")
    links = links.unionByName(save(_verified(sets, _matches(index, percent), percent)))
    found = connected(links, "a", "b")
    component = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    facts = component.groupBy("key").agg(
        F.collect_list(F.struct("n_shingles", "p1", "p2", F.coalesce("component", "rep").alias("c"))).alias("all"), F.sum("n").alias("n")
    )
    rows = drawn.select("id", "n_shingles", "p1", "p2", F.xxhash64("n_shingles", "p1", "p2").bitwiseAND(F.lit(_POSITIVE)).alias("key"))
    own = F.filter("all", lambda x: (x["p1"] == F.col("p1")) & (x["p2"] == F.col("p2")) & (x["n_shingles"] == F.col("n_shingles")))[0]["c"]
    joined = join_counted(rows, facts, "key", "n").select(
        F.col("id").alias("doc_id"), "n_shingles", F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), own).otherwise(F.col("id")).alias("component_id")
    )
    return joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _buckets(classes: DataFrame) -> DataFrame:
    """key, rep, b1, b2, n_shingles, component: members of band buckets that hold more than one class; each its own component."""
    each = classes.select(F.explode("s.bands").alias("key"), "rep", "s.b1", "s.b2", "n_shingles")
    each = each.withColumn("key", F.col("key").bitwiseAND(F.lit(_POSITIVE)))
    facts = each.groupBy("key").agg(F.count("*").alias("n"), F.lit(True).alias("shared")).filter("n > 1")
    return join_counted(each, facts, "key", "n").filter("shared").select("key", "rep", "b1", "b2", "n_shingles", F.col("rep").alias("component"))


def _with_hubs(members: DataFrame) -> DataFrame:
    """members with their bucket's hub: the member whose buckets are the largest, as edits have changed it least."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.count("*").alias("size"))
    sized = join_counted(members, sizes, "key", "n")
    by_rep = Window.partitionBy("rep")  # a document is in as many buckets as there are bands, at most
    ranked = save(sized.withColumn("rank", F.sum("size").over(by_rep)))
    hubs = ranked.groupBy("key").agg(F.max(F.struct("rank", "rep", "b1", "b2", "n_shingles", "component")).alias("hub"), F.count("*").alias("n"))
    return join_counted(ranked.drop("size", "rank"), hubs, "key", "n")


def _close(a: str, b: str, percent: int) -> F.Column:
    """Neither the sets' sizes nor the signature bits rule a link out."""
    differ = F.bit_count(F.col(f"{a}b1").bitwiseXOR(F.col(f"{b}b1"))) + F.bit_count(F.col(f"{a}b2").bitwiseXOR(F.col(f"{b}b2")))
    sizes = 100 * F.least(f"{a}n_shingles", f"{b}n_shingles") >= percent * F.greatest(f"{a}n_shingles", f"{b}n_shingles")
    return sizes & (differ <= most_bits(percent))


def _hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b): a member of a bucket and its hub b, where they are of different components; rank tells hubs apart."""
    pairs = members.filter((F.col("component") != F.col("hub.component")) & _close("", "hub.", percent))
    return pairs.groupBy(F.col("rep").alias("a"), F.col("hub.rep").alias("b")).agg(F.max("hub.rank").alias("rank"))


def _labels(links: DataFrame) -> DataFrame:
    """node, component: where four steps along each node's link to its highest hub lead. One label means one component, not the reverse."""
    to = save(links.groupBy(F.col("a").alias("node")).agg(F.max_by("b", F.struct("rank", "b")).alias("component")))
    for _ in range(2):
        far = to.select(F.col("node").alias("component"), F.col("component").alias("next"))
        to = save(to.join(far, "component", "left").select("node", F.coalesce("next", "component").alias("component")))
    return to


def _still_apart(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Members but hubs, of buckets that still hold several components, unless their shingles rule every link out.

    A shingle that only one of these documents has is in no intersection. With common the number of a
    document's other shingles, an exact bound leaves out members of groups that they are linked with nowhere.
    """
    members = members.filter("rep <> hub.rep").drop("component")
    members = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    rest = save(_of_several(members))
    ids = rest.select(F.col("rep").alias("id")).distinct()
    shown = sets.join(ids, "id", "left_semi").select("id", F.explode("shingles").alias("shingle"))
    own = shown.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("other")).filter("id = other")
    own = own.groupBy("id").agg(F.count("*").alias("own")).withColumnRenamed("id", "rep")
    rest = rest.join(own, "rep", "left").withColumn("common", F.col("n_shingles") - F.coalesce("own", F.lit(0)))
    return _of_several(rest.filter(100 * F.col("common") >= percent * F.col("n_shingles")).drop("own"))


def _of_several(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    split = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    split = split.filter("lo < hi").select("key", "n", F.lit(True).alias("split"))
    return join_counted(members, split, "key", "n").filter("split").drop("split")


def _index(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """hub, el, rep, component, n, d, at: for members of a hub's buckets, the elements that a link would have to share.

    Let D be what a set and the hub's do not share, and d its size. Two sets x and y differ in as many
    elements as their D do, so they are linked if, and only if, D of x and D of y share
    (d + d' - (100 - percent) / (100 + percent) * (n + n')) / 2 elements or more. With the elements of every D
    in one order, rarest of the hub first, and at least ``least`` of them shared, one is among the first
    d - least + 1 of either: only these are kept, and of these none that occurs once. ``least`` is taken over
    all members of other components. Where a pair need share nothing, both of its sets are linked with the
    hub, and so with each other: if one were not, its d would be over share * (n + hub's), the other's d is
    share * (n' - hub's) or more, and the sum above zero.
    """
    share = (100 - percent) / (100 + percent)
    of = members.select("rep", "component", F.col("hub.rep").alias("hub")).distinct()
    own = of.join(sets.select(F.col("id").alias("rep"), F.col("shingles").alias("s")), "rep")
    both = own.join(sets.select(F.col("id").alias("hub"), F.col("shingles").alias("t")), "hub")
    apart = both.select("hub", "rep", "component", F.size("s").alias("n"), F.concat(F.array_except("s", "t"), F.array_except("t", "s")).alias("diff"))
    apart = save(apart.withColumn("slack", F.size("diff") - share * F.col("n")))
    # the smallest slack of a hub's components, and the second smallest for those of the first itself
    per = apart.groupBy("hub", "component").agg(F.min("slack").alias("slack"))
    order = F.row_number().over(Window.partitionBy("hub").orderBy("slack", "component"))
    two = per.withColumn("nth", order).filter("nth <= 2").groupBy("hub").agg(
        F.min(F.struct("nth", "component", "slack")).alias("low"), F.max(F.struct("nth", "component", "slack")).alias("next")
    )
    each = apart.select("hub", "rep", F.explode("diff").alias("el"))
    often = each.groupBy("hub", "el").agg(F.count("*").alias("times")).filter("times > 1")
    placed = each.join(often, ["hub", "el"], "left").groupBy("hub", "rep").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("times", F.lit(1)).alias("times"), "el"))).alias("els")
    )
    other = F.when(F.col("component") == F.col("low.component"), F.col("next.slack")).otherwise(F.col("low.slack"))
    least = F.greatest(F.lit(1), F.ceil((F.col("slack") + other) / 2 - 1e-6))
    facts = apart.join(two.filter("low.component <> next.component"), "hub").select("hub", "rep", "component", "n", F.size("diff").alias("d"), (F.size("diff") - least + 1).alias("first"))
    full = placed.join(facts, ["hub", "rep"])
    rows = full.select("hub", "rep", "component", "n", "d", "first", F.posexplode("els").alias("at", "e"))
    return rows.filter("at < first and e.times > 1").select("hub", "e.el", "rep", "component", "n", "d", "at")


def _meetings(index: DataFrame) -> tuple[int, int]:
    """Pairs of rows with one key in different components, and rows."""
    per = index.groupBy("hub", "el", "component").agg(F.count("*").cast("double").alias("n"))
    per = per.groupBy("hub", "el").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
    pairs, rows = per.agg(F.sum((F.col("n") * F.col("n") - F.col("same")) / 2), F.sum("n")).first()
    return int(pairs or 0), int(rows or 0)


def _matches(index: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share an element early enough to be able to share as many as a link needs."""
    other = index.select("hub", "el", *[F.col(c).alias(f"o_{c}") for c in ("rep", "component", "n", "d", "at")])
    needs = (F.col("d") + F.col("o_d") - (100 - percent) / (100 + percent) * (F.col("n") + F.col("o_n"))) / 2 - 1e-6
    able = F.least(F.col("d") - F.col("at"), F.col("o_d") - F.col("o_at")) >= needs
    sizes = 100 * F.least("n", "o_n") >= percent * F.greatest("n", "o_n")
    pairs = index.join(other, ["hub", "el"]).filter((F.col("rep") < F.col("o_rep")) & (F.col("component") != F.col("o_component")) & able & sizes)
    return pairs.groupBy(F.col("rep").alias("a"), F.col("o_rep").alias("b")).agg(F.lit(0).cast("long").alias("rank"))


def _sets_of_members(flat: DataFrame, members: DataFrame) -> DataFrame:
    """id, shingles: whole sets of all members; of rows that repeat an id, one is taken."""
    ids = members.select(F.col("rep").alias("id")).distinct()
    table = flat.sparkSession.sparkContext.broadcast(bloom.gather(_hashed_ids(ids), "h"))
    return _sets_of(flat.filter("id is not null"), table).join(ids, "id", "left_semi").groupBy("id").agg(F.min("shingles").alias("shingles"))


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), with their rank, whose whole sets overlap enough. Spark can split a b of very many pairs, as each row meets one set."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    enough = 100 * F.col("shared") >= percent * (F.size("sa") + F.size("sb") - F.col("shared"))
    return both.filter(enough).select("a", "b", "rank")


def _hashed_ids(ids: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mix(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))], ["h"])

    return ids.mapInArrow(tidy(run), "h long")


def one_of_each(spark, docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near duplicates, that of the smallest doc_id (a null one last); all columns stay.

    Every row counts for itself: of rows that repeat an id and a text one stays, and rows with a null id are
    compared like others. Rows without words (or text) all stay, as they are linked with nothing. An empty
    table gives an empty one.
    """
    numbered = save(docs.withColumn(_ROW, F.monotonically_increasing_id()))
    of = near_duplicates(numbered, _ROW, percent=PIPELINE_PERCENT).select(F.col("doc_id").alias(_ROW), "component_id")
    at = numbered.select(_ROW, "doc_id").join(of, _ROW)
    first = F.min_by(_ROW, F.struct(F.col("doc_id").isNull(), "doc_id", _ROW))
    stays = at.groupBy("component_id").agg(first.alias(_ROW))
    return numbered.join(stays.select(_ROW), _ROW, "left_semi").select(docs.columns)


def op6_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
