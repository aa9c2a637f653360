"""Near-duplicate lines by a segment-partition join on edit distance, and removal of all but the first of each class."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .components import connected
from .scratch import join_counted, save, tidy
from .words import chunks, mix, powers

#: Edits (insert, delete, replace one character) that two lines may differ by.
EDITS = 2
#: Shorter lines take no part: only empty lines are kept wherever they stand.
LEAST = 1
#: Shorter lines are of a class only when they are equal: two edits would change too much of them.
LEAST_NEAR = 24
#: Characters that are counted to tell lines apart before they are compared; all others count as the 16th.
COUNTED = "etaoinsrhldcum "
#: Members of a key's group that meet its indexed lines in one task at most, about, when links are counted.
DEAL = 256
_MULT = 0xC2B2AE3D27D4EB4F | 1
_MASK = (1 << 63) - 1
U = np.uint64


class Spans:
    """Hashes of any spans of one array of characters, from prefix sums of mixed character * base**i."""

    def __init__(self, chars: np.ndarray):
        n = len(chars)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(chars.astype(np.uint64) + U(1)) * powers(_MULT, n + 1)[:n], out=self.total[1:])
        self.down = powers(pow(_MULT, -1, 1 << 64), n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))


def lines_of(text: str | None) -> list[str]:
    return text.split("\n") if text else []


def segments(length: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of each of edits + 1 even segments of lines: arrays (lines, edits + 1); the last are the longer."""
    k = edits + 1
    short = length // k
    extra = length - short * k
    i = np.arange(k)
    size = short[:, None] + (i[None, :] >= (k - extra)[:, None])
    begin = np.cumsum(size, axis=1) - size
    return begin, size


def probes(length: np.ndarray, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]]:
    """(rows, indexed length, segment number, begin, size): substrings of a line that may equal a segment of a shorter or equal one.

    Multi-match-aware choice: for segment i of a line shorter by d, begins from p - i to p + i and from
    p + d - (edits - i) to p + d + (edits - i), where p is the segment's begin there and i counts from 0.
    """
    for d in range(edits + 1):
        other = length - d
        begin, size = segments(other, edits)
        for i in range(edits + 1):
            for shift in range(max(-i, d - (edits - i)), min(i, d + (edits - i)) + 1):
                start = begin[:, i] + shift
                ok = (start >= 0) & (start + size[:, i] <= length) & (size[:, i] > 0) & (other >= edits + 1)
                yield np.flatnonzero(ok), other[ok], i, start[ok], size[ok, i]


def banded_distance(a: str, b: str, most: int) -> int:
    """Edit distance up to ``most``, else most + 1: Hyyrö's bit vectors on the band of 2 * most + 1 diagonals."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    n = min(len(a), len(b))
    i = 0
    while i < n and a[-1 - i] == b[-1 - i]:
        i += 1
    a, b = a[: len(a) - i], b[: len(b) - i]
    if not a or not b:
        return min(most + 1, max(len(a), len(b)))
    # bit r of column j stands for row j - most + r of the matrix, rows being characters of a; the vertical
    # differences that a column begins with are those of the column before, on the same rows
    width = 2 * most + 1
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for r in range(min(most, len(a))):
        where[a[r]] = where.get(a[r], 0) | 1 << (r + most)
    up, down = full & ~((1 << most) - 1), (1 << most) - 1
    score = most  # on the band's lowest diagonal
    for j, c in enumerate(b):
        row = j + most
        if row < len(a):
            where[a[row]] = where.get(a[row], 0) | 1 << (row + most)
        eq = (where.get(c, 0) >> j) & full
        zero = (((eq & up) + up) ^ up | eq | down) & full
        right, left = (down | ~(zero | up)) & full, zero & up
        score += 1 - (zero >> (width - 1))
        up, down = (left | ~(zero >> 1 | right)) & full, right & zero >> 1
    below = (1 << 2 * most) - (1 << (len(a) - len(b) + most))  # rows under the last of a, down to that diagonal
    return min(most + 1, score - (up & below).bit_count() + (down & below).bit_count())


def _flat(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """id (the row's id and a hash of its text, so that rows that share an id are told apart), text, and columns to carry."""
    own = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("h"))
    return docs.select(own.alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"carry_{c}") for c in carry])


def _cut(part: pa.RecordBatch, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Spans]:
    """For the lines of at least so many characters, of a slice of documents: document, line number, begin, end in characters; and their hashes."""
    texts = part.column("text").to_pylist()
    chars = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t or "") for t in texts], np.int64)
    ends = np.cumsum(sizes)
    cut = np.flatnonzero(chars == 10)
    of_cut = np.searchsorted(ends, cut, "right")  # a newline's document, by its own position
    filled = np.flatnonzero(sizes)
    # each document's first line begins with it, and its last ends with it; all others begin after or end at its newlines
    doc = np.concatenate([filled, of_cut])
    begin = np.concatenate([(ends - sizes)[filled], cut + 1])
    end = np.concatenate([ends[filled], cut])
    begin, end = begin[np.lexsort((begin, doc))], end[np.lexsort((end, doc))]
    doc = np.sort(doc)
    first = np.searchsorted(doc, doc)
    number = np.arange(len(doc)) - first
    keep = end - begin >= least
    return doc[keep], number[keep], begin[keep], end[keep], Spans(chars)


def _hash_pair(spans: Spans, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = spans.hash(begin, end)
    return h, mix((spans.total[end] - spans.total[begin]) * spans.down[begin] * U(_MULT) + U(0x5851F42D4C957F2D))


def _segment_key(length: np.ndarray, i: int, content: np.ndarray) -> np.ndarray:
    return mix(content ^ mix(length.astype(np.uint64) * U(64) + U(i + 1)))


def occurrences(flat: DataFrame) -> DataFrame:
    """id, line, l1, size for each line that takes part: where it stands and which distinct line it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                doc, number, begin, end, spans = _cut(part, LEAST)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(doc)), pa.array(number.astype(np.int32)), pa.array((spans.hash(begin, end) & U(_MASK)).view(np.int64)), pa.array((end - begin).astype(np.int32))], ["id", "line", "l1", "size"])

    return flat.mapInArrow(tidy(run), f"id {flat.schema['id'].dataType.simpleString()}, line int, l1 long, size int")


def _segment_rows(flat: DataFrame, edits: int, table=None) -> DataFrame:
    """key, l1, size, indexed: a line's own segments; with a filter, also its probes that may meet a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                _, _, begin, end, spans = _cut(part, LEAST_NEAR)
                own = (spans.hash(begin, end) & U(_MASK)).view(np.int64)
                _, once = np.unique(own, return_index=True)
                begin, end, own = begin[once], end[once], own[once]
                length = end - begin
                seg_begin, seg_size = segments(length, edits)
                keys, lines, sizes, kinds = [], [], [], []
                for i in range(edits + 1):
                    s = begin + seg_begin[:, i]
                    keys.append(_segment_key(length, i, spans.hash(s, s + seg_size[:, i])))
                    lines.append(own)
                    sizes.append(length)
                    kinds.append(np.ones(len(own), bool))
                if table is not None:
                    for rows, other, i, start, size in probes(length, edits):
                        s = begin[rows] + start
                        key = _segment_key(other, i, spans.hash(s, s + size))
                        may = bloom.may_hold(table.value, key)
                        keys.append(key[may])
                        lines.append(own[rows[may]])
                        sizes.append(length[rows[may]])
                        kinds.append(np.zeros(int(may.sum()), bool))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(lines)), pa.array(np.concatenate(sizes).astype(np.int32)), pa.array(np.concatenate(kinds))], ["key", "l1", "size", "indexed"])

    return flat.select("text").mapInArrow(tidy(run), "key long, l1 long, size int, indexed boolean")


def _texts(flat: DataFrame, table) -> DataFrame:
    """l1, line: texts of the lines that the filter lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                doc, number, begin, end, spans = _cut(part, LEAST_NEAR)
                own = spans.hash(begin, end) & U(_MASK)
                may = np.flatnonzero(bloom.may_hold(table.value, own))
                _, once = np.unique(own[may], return_index=True)
                may = may[once]
                split: dict[int, list[str]] = {}
                texts = part.column("text")
                lines = []
                for d, k in zip(doc[may].tolist(), number[may].tolist()):
                    if d not in split:
                        split[d] = lines_of(texts[d].as_py())
                    lines.append(split[d][k])
                yield pa.RecordBatch.from_arrays([pa.array(own[may].view(np.int64)), pa.array(lines, pa.string())], ["l1", "line"])

    return flat.select("text").mapInArrow(tidy(run), "l1 long, line string").dropDuplicates(["l1"])


def _character_counts(texts: DataFrame) -> DataFrame:
    """l1, c0, c1, c2: how often each counted character, and any other, stands in the line; a byte each, modulo 256."""
    each = [F.char_length("line") - F.char_length(F.replace("line", F.lit(c), F.lit(""))) for c in COUNTED]
    each.append(F.char_length("line") - sum(each[1:], each[0]))
    packed = [sum((F.shiftleft(n.cast("long").bitwiseAND(F.lit(255)), 8 * i) for i, n in enumerate(half)), F.lit(0).cast("long")) for half in (each[:7], each[7:14], each[14:])]
    return texts.select("l1", *[c.alias(f"c{i}") for i, c in enumerate(packed)])


def _count_differences(a: str, b: str) -> F.Column:
    """At most the sum of the differences of all counts, as each is taken modulo 256: so it rules out no pair that the counts allow."""
    total = F.lit(0)
    for i in range(3):
        for k in range(7 if i < 2 else 2):
            d = (F.shiftright(f"{a}c{i}", 8 * k) - F.shiftright(f"{b}c{i}", 8 * k)).bitwiseAND(F.lit(255))
            total += F.least(d, 256 - d)
    return total


def _verified(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [banded_distance(x, y, edits) <= edits for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    both = pairs.join(texts.select(F.col("l1").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("l1").alias("b"), F.col("line").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def _texts_of(flat: DataFrame, members: DataFrame) -> DataFrame:
    """l1, line: texts of all members, and of the lines that the filter lets pass besides."""
    ends = members.select(F.col("l1").alias("h")).distinct()
    return save(_texts(flat, flat.sparkSession.sparkContext.broadcast(bloom.gather(ends, "h"))))


def _others(rows: DataFrame, more: str, edits: int) -> tuple[DataFrame, F.Column]:
    """The indexed rows, renamed to meet the others; and whether lengths and numbers of characters allow a link."""
    other = rows.filter("indexed").select("key", F.col("l1").alias("o"), *[F.col(c).alias(f"o_{c}") for c in ("size", more, "c0", "c1", "c2")])
    return other, (F.abs(F.col("size") - F.col("o_size")) <= edits) & (_count_differences("", "o_") <= 2 * edits)


def _all_links(flat: DataFrame, members: DataFrame, edits: int) -> tuple[DataFrame, DataFrame]:
    """Numbers of links and components from all pairs of members of a key; large groups are dealt out in parts."""
    texts = _texts_of(flat, members)
    deal = F.ceil(F.col("members") / DEAL).cast("int")
    rows = save(members.select("key", "l1", "size", "indexed", deal.alias("deal")).join(_character_counts(texts), "l1"))
    other, near = _others(rows, "deal", edits)
    other = other.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("o_deal") - 1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("l1"), F.col("deal")).cast("int"))
    # two indexed lines meet twice
    pairs = rows.join(other, ["key", "part"]).filter((F.col("l1") != F.col("o")) & (~F.col("indexed") | (F.col("l1") < F.col("o"))) & near)
    pairs = pairs.select(F.least("l1", "o").alias("a"), F.greatest("l1", "o").alias("b")).distinct()
    links = save(_verified(pairs, texts, edits))
    degree = links.select(F.explode(F.array("a", "b")).alias("l1")).groupBy("l1").agg(F.count("*").alias("links"))
    return degree, connected(links, "a", "b")


def line_links(flat: DataFrame, edits: int = EDITS, counted: bool = True) -> tuple[DataFrame | None, DataFrame]:
    """(numbers of links l1, links, or None; components node, component) for all lines of LEAST_NEAR characters or more within ``edits`` of each other, as classes.

    Every line's segments are keyed by (length, number, content). A line probes the keys of its own and
    shorter lengths; probes that no segment can answer are dropped by a bit filter before the shuffle.
    In each key's group, members are compared with the indexed ones, where their lengths and numbers of
    characters allow it: an edit changes these numbers by two in all at most, so none is lost. To count
    links, all such pairs are compared. Components alone need fewer: members are first compared with one
    indexed line, then those that are still in different components with the others.
    """
    spark = flat.sparkSession
    keys = _segment_rows(flat, edits).select("key")
    table = spark.sparkContext.broadcast(bloom.gather(keys, "key"))
    rows = _segment_rows(flat, edits, table).groupBy("key", "l1", "size").agg(F.max("indexed").alias("indexed"))
    rows = save(rows.withColumn("key", F.col("key").bitwiseAND(F.lit(_MASK))))
    facts = rows.groupBy("key").agg(F.count("*").alias("n"), F.count("*").alias("members"), F.min(F.when(F.col("indexed"), F.col("l1"))).alias("hub")).filter("n > 1 and hub is not null")
    members = save(join_counted(rows, facts, "key", "n").filter("members is not null"))
    if counted:
        return _all_links(flat, members, edits)
    pairs = save(members.filter("l1 <> hub").select(F.least("l1", "hub").alias("a"), F.greatest("l1", "hub").alias("b")).distinct())
    texts = _texts_of(flat, members)
    links = save(_verified(pairs, texts, edits))
    found = connected(links, "a", "b")
    apart = members.join(found.withColumnRenamed("node", "l1"), "l1", "left").withColumn("component", F.coalesce("component", "l1"))
    split = apart.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    rest = apart.join(split, "key", "left_semi").select("key", "l1", "size", "indexed", "component").join(_character_counts(texts), "l1")
    rest = save(rest)
    other, near = _others(rest, "component", edits)
    more = rest.join(other, "key").filter((F.col("component") != F.col("o_component")) & near)
    more = more.select(F.least("l1", "o").alias("a"), F.greatest("l1", "o").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    return None, connected(save(links.unionByName(_verified(more, texts, edits))), "a", "b")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, counted: bool = True) -> DataFrame:
    """(id, line, first_id, first_line, links) for every line that has an equal or near one, ids as _flat makes them; links is null when not counted."""
    flat = _flat(docs, id_col, text_col)
    where = save(occurrences(flat))
    degree, found = line_links(flat, edits, counted)
    lines = where.groupBy("l1").agg(F.min(F.struct("id", "line")).alias("at"), F.count("*").alias("n"))
    lines = lines.join(found.withColumnRenamed("node", "l1"), "l1", "left").withColumn("component", F.coalesce("component", "l1"))
    lines = lines.join(degree, "l1", "left") if counted else lines.withColumn("links", F.lit(None).cast("long"))
    lines = save(lines.select("l1", "component", "at", "n", F.coalesce("links", F.lit(0 if counted else None)).cast("long").alias("links")))
    classes = lines.groupBy("component").agg(F.min("at").alias("first"), F.sum("n").alias("in_class")).filter("in_class > 1")
    facts = lines.join(classes, "component").select("l1", "first", "links", "n")
    told = join_counted(where, facts, "l1", "n").filter("first is not null")
    return told.select("id", "line", F.col("first.id").alias("first_id"), F.col("first.line").alias("first_line"), "links")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, carry: tuple[str, ...] = (), counted: bool = True) -> DataFrame:
    """doc_id, n_lines, n_removed, n_links, removed (line numbers), classes, text for every row of docs.

    Lines are what newlines part. Lines that are equal and not empty, and lines of at least LEAST_NEAR
    characters within ``edits`` edits of each other directly or through others, are one class; the one with
    the smallest (id, text hash, line) stays and the others go. Empty lines always stay. classes has, for each line in a class of two or
    more, its number and the class's first place; n_links counts, for those lines, the other distinct lines
    within ``edits`` of each (null when not ``counted``, which compares fewer pairs). Null texts stay null, with no lines; documents stay, even when no line is left. Rows that
    share an id, null or not, are documents of their own unless their texts are equal too; rows that are equal in both are alike, and a line that stays in one stays in each.
    Null ids sort first. The columns named in carry come along as carry_<name>; others are not read. An empty table gives no rows.
    """
    told, flat = line_classes(docs, id_col, text_col, edits, counted), _flat(docs, id_col, text_col, carry)
    goes = (F.col("id") != F.col("first_id")) | (F.col("line") != F.col("first_line"))
    told = told.select(F.col("id.id").alias("_id"), F.col("id.h").alias("_h"), F.struct("line", F.col("first_id.id").alias("first_id"), "first_line", "links", goes.alias("goes")).alias("of"))
    per = told.groupBy("_id", "_h").agg(F.collect_list("of").alias("of"))
    joined = flat.join(per, (F.col("id.h") == F.col("_h")) & F.col("id.id").eqNullSafe(F.col("_id")), "left")
    links = F.aggregate("of", F.lit(0).cast("long"), lambda n, x: n + x["links"])
    removed = F.array_sort(F.transform(F.filter("of", lambda x: x["goes"]), lambda x: x["line"]))
    joined = joined.select(F.col("id.id").alias("doc_id"), "text", links.alias("n_links"), removed.alias("removed"), F.transform("of", lambda x: x.dropFields("goes")).alias("classes"), *[f"carry_{c}" for c in carry])
    kind = joined.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, lost, kept = [], [], []
            for text, removed in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                lines, gone = lines_of(text), set(removed or ())
                count.append(len(lines))
                lost.append(len(gone))
                kept.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
            links = pc.fill_null(batch.column(2), 0) if counted else batch.column(2)
            removed = pc.if_else(pc.is_null(batch.column(3)), pa.scalar([], batch.column(3).type), batch.column(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(lost, pa.int64()), links, removed, pa.array(kept, pa.string()), *batch.columns[4:]], ["doc_id", "n_lines", "n_removed", "n_links", "removed", "text", *batch.schema.names[4:]])

    carried = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[5:])
    return joined.mapInArrow(tidy(run), f"doc_id {kind}, n_lines long, n_removed long, n_links long, removed array<int>, text string, classes array<struct<line:int,first_id:{kind},first_line:int,links:long>>{carried}")


def without_repeated_lines(spark, docs: DataFrame) -> DataFrame:
    """docs with the lines that stay as their texts, and n_chars to match where there is such a column; all rows stay.

    Null texts stay null. Rows with a null or a repeated id are documents of their own; of rows that are equal in
    id and text, each keeps what one keeps. An empty table gives an empty one; columns may have any names.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = line_dedup(docs, carry=others, counted=False)
    back = {c: F.col(f"carry_{c}") for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in others:
        back["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[back[c].alias(c) for c in docs.columns])


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """One row per document: its counts, the numbers of its lines that go, their classes, and a hash of what stays."""
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_removed", "n_links", F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed_lines"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), "classes")
