"""Paragraphs that resemble a needle: exact upper bounds first, the similarity of what they leave after."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .documents import located

#: Marks that do not count, the least similarity of a hit, the shortest text that is compared.
IMAGE, LINK, MARKS = r"!\[[^\]]*\]\([^)]+\)", r"\[(?=[^\]])\[*([^\]]*)\]\([^)]+\)", r"[`*_#>\-|]+"
BREAK = r"(?U)\n\s*\n"
LEAST, SHORTEST = 0.55, 200

#: Needles and paragraphs that meet in one task, and bytes of the latter; more are dealt out to more tasks.
NEEDLES, PARAGRAPHS, BYTES = 1024, 1024, 8 << 20
LETTERS, MARKED = 64, 1 << 15  # places that hashes of characters are counted in, and of runs of one to three are marked in
FOUND = "id string, doc_id long, paragraph int, score double"


def match_text(c: Column) -> Column:
    """Text without marks, images and addresses, runs of white space as one blank; null counts as empty."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), IMAGE, " "), LINK, "$1")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, MARKS, " "), r"(?U)\s+", " "))


def paragraphs(docs: DataFrame, by: list[str]) -> DataFrame:
    """Texts between blank lines: the columns of ``by``, doc_id, paragraph (from 0, blank ones counted) and chunk, not empty."""
    cut = docs.select(*by, "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), BREAK)).alias("paragraph", "chunk"))
    return cut.withColumn("chunk", match_text(F.col("chunk"))).filter("chunk <> ''")


def _codes(texts: list[str], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts cut to ``most``, one row each, -1 behind the end; and the lengths."""
    cut = [t[:most] for t in texts]
    sizes = np.array([len(t) for t in cut], np.int64)
    out = np.full((len(cut), max(int(sizes.max(initial=0)), 3)), -1, np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer("".join(cut).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, sizes


def _counts(keys: np.ndarray, held: np.ndarray, places: int) -> np.ndarray:
    row = np.broadcast_to(np.arange(len(keys))[:, None], keys.shape)[held]
    return np.bincount(row * places + keys[held] % places, minlength=len(keys) * places).reshape(len(keys), places).astype(np.float32)


def _profile(texts: list[str], most: int) -> np.ndarray:
    """Counts of letters, hashed: places shared by several can only raise what two texts have in common."""
    code, _ = _codes(texts, most)
    return _counts(code, code >= 0, LETTERS)


def _places(code: np.ndarray, back: int) -> np.ndarray:
    """Where a run of ``back`` + 1 characters is marked in a table; runs that share a place can only raise what two texts have in common."""
    if not back:
        return code & (MARKED - 1)
    key = code[back:].astype(np.uint64)
    for n in range(1, back + 1):
        key = key * np.uint64(0x9E3779B97F4A7C15) + code[back - n : len(code) - n].astype(np.uint64)
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MARKED.bit_length() + 1)).astype(np.int64)


class _Needles:
    """Needles side by side, with a gap of two behind each, in which no run begins or ends."""

    def __init__(self, heads: list[str]):
        code, sizes = _codes(heads, max(map(len, heads)))
        code = np.pad(code[:, : int(sizes.max())], ((0, 0), (0, 2)), constant_values=-1)
        keep = np.arange(code.shape[1]) < (sizes + 2)[:, None]
        self.owner = np.append(np.flatnonzero(keep) // code.shape[1], len(heads))
        self.ends = np.cumsum(sizes + 2)
        flat = code[keep]
        self.held = flat >= 0
        flat = np.where(self.held, flat, 0)
        self.one, self.two, self.three = flat & (MARKED - 1), np.append(_places(flat, 1), 0), np.append(_places(flat, 2), [0, 0])
        self.pair = self.held & np.append(self.held[1:], False)
        self.triple = self.pair & np.append(self.pair[1:], False)
        self.n = len(heads)

    def covered(self, ones: np.ndarray, twos: np.ndarray, threes: np.ndarray) -> np.ndarray:
        """For each needle, the most of its characters that blocks can hold, which are runs of the marked ones.

        A block holds a character of ``ones`` or is a common beginning. One of three characters or more lies where
        every three in a row are marked; a shorter one is its character and one beside it.
        """
        rare, pair = ones[self.one] & self.held, twos[self.two] & self.pair
        run = threes[self.three] & self.triple
        step = np.diff(run.view(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1) + 1  # of the characters of each unbroken row of runs
        before = np.append(0, np.cumsum(rare))
        begins = np.append(True, self.owner[1:-1] != self.owner[:-2])
        good = (before[last + 1] > before[first]) | begins[first]
        first, last = first[good], last[good]
        size = last - first + 1.0
        if len(first) > 1:
            size[1:] -= np.maximum(last[:-1] - first[1:] + 1, 0)
        beside = np.append(False, pair[:-1])  # the character before goes along with this one
        size += (rare[last] & pair[last]).astype(float) + (rare[first] & beside[first])
        inside = run.copy()
        inside[1:] |= run[:-1]
        inside[2:] |= run[:-2]
        alone = np.flatnonzero(rare & ~inside)
        out = np.bincount(self.owner[first], size, minlength=self.n)
        return out + np.bincount(self.owner[alone], 1.0 + (pair[alone] | beside[alone]), minlength=self.n) + 2


class _Marks:
    """What blocks can hold of a paragraph: its characters, those rare in it, and runs of two and three, of any beginning of it."""

    def __init__(self, text: str):
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.keys, self.at = np.unique(code, return_inverse=True)
        self.two, self.three = _places(code, 1), _places(code, 2)

    def rare(self, low: int, most: int) -> np.ndarray:
        """Places of the characters that a block can start from, over all cuts from low to ``most`` = low + 99.

        In a text of 200 characters or more, those that make up over a hundredth of it start no block.
        """
        count = lambda end: np.bincount(self.at[:end], minlength=len(self.keys))
        return _places(self.keys[(count(low) <= min(len(self.at), low) // 100 + 1) & (count(most) > 0)], 0)

    def until(self, low: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.rare(low, most), self.two[: most - 1], self.three[: most - 2]


def _bounds(heads: list[str], chunks: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """For each needle, no less than its similarity to every paragraph.

    Blocks of the similarity are disjoint and in order, so they hold no more characters than both texts have in
    common. In long paragraphs each block but a common beginning holds a rare character, so that no more of the
    needle counts than stands in runs of the paragraph around these.
    """
    of = np.array([len(h) for h in heads])
    size = np.array([len(c) for c in chunks])
    marks = [np.zeros(MARKED, bool) for _ in range(3)]
    band = np.maximum(2 * of, SHORTEST) // 100 * 100
    held = [_Marks(c[: int(band.max()) + 99]) if len(c) >= SHORTEST else None for c in chunks]
    for low in np.unique(band):
        here = np.flatnonzero(band == low)
        most = int(low) + 99
        letters, own = _profile(chunks, most), _profile([heads[i] for i in here], int(of.max()))
        side = _Needles([heads[i] for i in here])
        covered = np.empty((len(chunks), len(here)))
        for p, of_text in enumerate(held):
            if of_text is None:
                covered[p] = most
                continue
            at = of_text.until(int(low), most)
            for m, places in zip(marks, at):
                m[places] = True
            covered[p] = side.covered(*marks)
            for m, places in zip(marks, at):
                m[places] = False
        for k, i in enumerate(here):
            n = np.minimum(size, max(2 * of[i], SHORTEST))
            common = np.minimum(np.minimum(letters, own[k]).sum(1), np.minimum(n, of[i]))
            yield int(i), 2.0 * np.minimum(common, covered[:, k]) / (of[i] + n)


def _ratio(a: str, b: str, least: float) -> float:
    """The similarity of two texts, or 0 as soon as what its blocks leave between them cannot bring it to ``least``."""
    found, whole = SequenceMatcher(None, a, b), len(a) + len(b)
    matched, left = 0, min(len(a), len(b))
    rest = [(0, len(a), 0, len(b))]
    while rest:
        alo, ahi, blo, bhi = rest.pop()
        i, j, k = found.find_longest_match(alo, ahi, blo, bhi)
        left -= min(ahi - alo, bhi - blo)
        if k:
            matched += k
            for r in ((alo, i, blo, j), (i + k, ahi, j + k, bhi)):
                if r[0] < r[1] and r[2] < r[3]:
                    rest.append(r)
                    left += min(r[1] - r[0], r[3] - r[2])
        if 2.0 * (matched + left) / whole < least - 1e-12:
            return 0.0
    return 2.0 * matched / whole


def _nearest(_key, needles: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    """Each needle's best paragraph of a group, taken in the order of the bounds until none left can be better."""
    heads, out = [h.casefold() for h in needles["head"]], []
    found = found.sort_values(["doc_id", "paragraph"]).reset_index(drop=True)
    chunks = [c.casefold() for c in found["chunk"]]
    if not heads or not chunks:
        return pd.DataFrame(out, columns=["id", "doc_id", "paragraph", "score"])
    for i, bound in _bounds(heads, chunks):
        best, at = LEAST, None
        for p in np.argsort(-bound, kind="stable"):
            if bound[p] < best - 1e-12:
                break
            score = _ratio(heads[i], chunks[p][: max(len(heads[i]) * 2, SHORTEST)], best)
            if score > best or (score == best and (at is None or p < at)):
                best, at = score, p
        if at is not None:
            out.append((needles["id"].iloc[i], found["doc_id"].iloc[at], found["paragraph"].iloc[at], best))
    return pd.DataFrame(out, columns=["id", "doc_id", "paragraph", "score"])


def nearest_paragraphs(needles: DataFrame, docs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """J18, fuzzy tier: per needle (id, needle) the paragraph of docs (doc_id, a number, and text) most like it, from 0.55 on.

    Equals go to the first document, then the first paragraph. Needles meet the documents with the same values in
    the columns of ``by`` (nulls are one value), all of them where it is empty. A key's needles and paragraphs are dealt
    out in groups of bounded size, so that a key with most of the rows is spread over many tasks; a group passes on
    one row a needle. Blank needles and documents find nothing; of rows that share an id the best hit counts.
    Other columns are left aside.
    """
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    asks = needles.select(key.alias("k"), F.col("id").cast("string").alias("id"), match_text(F.col("needle")).alias("head")).filter("head <> ''")
    p = paragraphs(docs.select(*by, "doc_id", "text"), list(by)).select(key.alias("k"), "doc_id", "paragraph", "chunk")
    asked = asks.groupBy("k").agg(F.ceil(F.count("*") / NEEDLES).alias("blocks"), F.greatest(F.max(F.char_length("head")) * 6, F.lit(SHORTEST)).alias("most"))
    given = p.join(asked.select("k", "most"), "k").withColumn("chunk", F.expr("left(chunk, most)")).drop("most")
    parts = given.groupBy("k").agg(F.greatest(F.ceil(F.count("*") / PARAGRAPHS), F.ceil(F.sum(F.octet_length("chunk")) / BYTES)).alias("parts"))
    deal = asked.join(parts, "k").select("k", "blocks", "parts")
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    left = asks.join(deal, "k").select("k", F.pmod(F.xxhash64("id"), "blocks").alias("block"), every("parts").alias("part"), "id", "head")
    right = given.join(deal, "k").select("k", F.pmod(F.xxhash64("doc_id", "paragraph"), "parts").alias("part"), every("blocks").alias("block"), "doc_id", "paragraph", "chunk")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # groups are work rather than bytes: not to be coalesced
    left, right = left.repartition(n, "k", "block", "part"), right.repartition(n, "k", "block", "part")
    best = left.groupBy("k", "block", "part").cogroup(right.groupBy("k", "block", "part")).applyInPandas(_nearest, FOUND)
    top = best.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("s"), "doc_id", "paragraph")).alias("b"))
    return top.select("id", "b.doc_id", "b.paragraph", (-F.col("b.s")).alias("score"))


def located_or_near(needles: DataFrame, docs: DataFrame) -> DataFrame:
    """J18 whole: id (as text), doc_id, tier 1 to 3 as ``located``, else 4 with paragraph and score of the nearest one."""
    hits = located(needles.select("id", "needle"), docs).select(F.col("id").cast("string").alias("id"), "doc_id", "tier")
    rest = needles.withColumn("id", F.col("id").cast("string")).join(hits.select("id"), "id", "left_anti")
    near = nearest_paragraphs(rest, docs).withColumn("tier", F.lit(4))
    return hits.unionByName(near, allowMissingColumns=True).select("id", "doc_id", "tier", "paragraph", "score")
