import hashlib
import random
import re
from collections import Counter

import pytest

from sparkloom.llm import exact_dedup, line_dedup, minhash, substring_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_exact_groups_of_odd_documents(odd_docs):
    for block in (4, 2048):
        out = rows(exact_dedup.exact_dedup(odd_docs, block=block))
        texts = [((r.doc_id), (r.text or "").translate(LOW)) for r in odd_docs.collect()]
        want = []
        for i, t in texts:
            same = [j for j, u in texts if u == t]
            top = max((j for j in same if j is not None), default=None)
            want.append((i, top, len(same), i == top, hashlib.sha256(t.encode()).hexdigest()))
        assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])) for r in out)


def test_names_do_not_collide(spark):
    """All texts of up to six of two letters: as many identities as texts."""
    texts = [""] + [format(n, f"0{k}b") for k in range(1, 7) for n in range(2**k)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = exact_dedup.block_identities(docs, block=1)
    assert out.select("blocks", "name").distinct().count() == len(texts) - 1 + 1 == out.count()


def test_empty_tables(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert minhash.near_duplicates(no_docs).count() == 0
    assert substring_dedup.substring_dedup(no_docs).count() == 0
    assert line_dedup.line_dedup(no_docs).count() == 0


def brute_components(texts, percent=85):
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    reach = {i: {i} for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                whole = reach[a] | reach[b]
                for x in whole:
                    reach[x] = whole
    return {i: (len(sets[i]), min(reach[i])) for i in sets}


def test_near_duplicates_of_odd_documents(odd_docs):
    out = {r["doc_id"]: r for r in rows(minhash.near_duplicates(odd_docs))}
    want = brute_components([(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None])
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in out.items() if i is not None} == want
    assert out[None]["kept"] and out[None]["component_id"] is None


def test_near_duplicates_of_edited_copies(spark):
    """Copies of one text with different edits, some linked only through others, some with none."""
    r = random.Random(4)
    base = [f"w{r.randrange(400)}" for _ in range(120)]
    texts = []
    for i in range(60):
        w = list(base)
        for _ in range(i % 6):
            w[r.randrange(len(w))] = f"x{i}_{r.randrange(10**6)}"
        texts.append((i, " ".join(w)))
    texts = texts[1:]  # some links go through the plain copies only
    out = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == brute_components(texts)


@pytest.mark.parametrize("meetings", [16, 0])
def test_near_duplicates_in_one_large_group(spark, monkeypatch, meetings):
    """1,000 copies of a text, two clusters of it, words for edits out of a few: a third and more is linked with nothing."""
    monkeypatch.setattr(minhash, "ROUND", meetings)
    r = random.Random(12)
    base = [f"w{k}" for k in range(150)]
    second = [f"v{k}" if k % 11 == 0 and k < 60 else w for k, w in enumerate(base)]
    texts = []
    for i in range(1000):
        w = list(base if i % 3 else second)
        for _ in range(r.choice((0, 1, 1, 2, 3, 4, 5))):
            w[r.randrange(150)] = f"x{r.randrange(4)}"
        texts.append((i, " ".join(w)))
    want = brute_components(texts)
    sizes = Counter(c for _, c in want.values())
    assert sum(n for n in sizes.values() if n == 1) > 333 and max(sizes.values()) > 200
    out = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == want


def test_near_duplicate_stage_on_odd_rows(spark, odd_docs, no_docs):
    """Rows count for themselves: one of each group stays, with or without an id; rows without words all stay."""
    docs = odd_docs.unionByName(spark.createDataFrame([(None, "Two words", "en", 1, "x", -3), (None, "NO id here", "en", 1, "x", -3)], odd_docs.schema))
    out = minhash.one_of_each(spark, docs)
    assert out.columns == docs.columns
    assert sorted((str(x.doc_id), (x.text or "")[:9]) for x in out.collect()) == sorted([("1", docs.filter("doc_id = 1").first().text[:9]), ("4", ""), ("5", ""), ("6", " \n\t "), ("7", "Two words"), ("8", docs.filter("doc_id = 8").first().text[:9]), ("None", out.filter("doc_id is null").first().text[:9]), ("10", "é" * 9)])
    assert minhash.one_of_each(spark, no_docs).count() == 0


def test_signatures_estimate_similarity():
    import numpy as np

    r = np.random.default_rng(1)
    pool = r.integers(1, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    s = minhash.super_minhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 125)
    assert abs((s[0] == s[1]).mean() - 1 / 3) < 0.15
    one = minhash.super_minhash(a[:1], np.array([0, 1]), 125)
    assert (one < 2**63).all()


def brute_windows(texts, n=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(texts, words):
        gone = {j for k in range(len(w) - n + 1) if seen[tuple(w[k : k + n])] > 1 for j in range(k, k + n)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("hot_from", [1000, 1])
def test_repeated_windows(spark, odd_docs, monkeypatch, hot_from):
    """Hot seeds are dealt out in parts; results are the same."""
    monkeypatch.setattr(substring_dedup, "HOT_FROM", hot_from)
    r = random.Random(2)
    common = " ".join(f"c{k}" for k in range(50))
    own = [(100 + i, " ".join(f"q{r.randrange(10**6)}" for _ in range(20)) + " " + common[: 60 + 2 * i] + " " + " ".join("The" for _ in range(i * 4))) for i in range(30)]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(own, "doc_id long, text string"))
    texts = [(x.doc_id, x.text) for x in docs.collect()]
    out = substring_dedup.substring_dedup(docs.withColumnRenamed("text", "t"), text_col="t").collect()
    assert sorted(str((x.doc_id, x.n_words, x.n_removed, x.kept_sha256)) for x in out) == brute_windows(texts)


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_banded_distance_is_edit_distance_up_to_the_limit():
    r = random.Random(3)
    for _ in range(3000):
        a = "".join(r.choice("ab") for _ in range(r.randrange(9)))
        b = "".join(r.choice("abc") for _ in range(r.randrange(9)))
        for most in (1, 2, 3):
            assert line_dedup.banded_distance(a, b, most) == min(distance(a, b), most + 1)


def test_lines_that_nearly_repeat_go(spark):
    r = random.Random(5)
    bases = ["".join(r.choice("abcdefgh éñ") for _ in range(40)) for _ in range(12)]
    texts = []
    for i in range(25):
        lines = []
        for base in r.sample(bases, 4):
            w = list(base)
            for _ in range(r.randrange(4)):
                k = r.randrange(len(w))
                w[k : k + 1] = r.choice(["", "zz", "y"])
            lines.append("".join(w))
        texts.append((i, "\n".join([*lines, "short", "", "short"])))
    texts += [(30, None), (31, ""), (32, "\n\n"), (33, bases[0] * 400)]
    out = {x.doc_id: x for x in line_dedup.line_dedup(spark.createDataFrame(texts, "doc_id long, text string").withColumnRenamed("doc_id", "line").select("line", "text"), id_col="line").collect()}
    every = sorted({l for _, t in texts for l in (t or "").split("\n") if len(l) >= line_dedup.LEAST})
    root = {l: l for l in every}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in every:
        for y in every:
            if x < y and abs(len(x) - len(y)) <= 2 and distance(x, y) <= 2:
                root[find(x)] = find(y)
    first, want = {}, {}
    for i, t in texts:
        kept = []
        for n, l in enumerate(t.split("\n") if t else []):
            if len(l) < line_dedup.LEAST or first.setdefault(find(l), (i, n)) == (i, n):
                kept.append(l)
        want[i] = None if t is None else "\n".join(kept)
    assert {i: x.text for i, x in out.items()} == want


def test_line_stage_keeps_rows_and_columns(spark, odd_docs, no_docs):
    out = line_dedup.without_repeated_lines(spark, odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert line_dedup.without_repeated_lines(spark, no_docs).collect() == []


def _kept_lines(rows):
    """rows (id, text): texts without lines that stand before, by (id with null first, row); texts equal in id and text are one."""
    first, out = {}, {}
    for at, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0], r[1] is not None, hash_of(r[1]))):
        kept = [l for n, l in enumerate((text or "").split("\n")) if not l or first.setdefault(l, (at, text, n)) == (at, text, n)]
        out[at, text] = None if text is None else "\n".join(kept)
    return sorted((str(i), str(out[i, t])) for i, t in rows)


def hash_of(text):
    import xxhash

    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def test_unique_lines_of_rows_that_share_an_id_stay(spark):
    """A line of one row is not removed for what another row of the same id, or without one, holds in its place."""
    cases = [
        [(0, "a line that stands twice"), (1, "first\na line that stands twice"), (1, "other\nunique and must stay")],
        [(None, "dup line of text\nunique A"), (None, "u\ndup line of text"), (None, "v\nunique B")],
    ]
    r = random.Random(3)
    cases.append([(r.choice([None, 1, 2, 3]), "\n".join(r.choice("abcdefgh") * r.choice([1, 2]) for _ in range(r.randrange(1, 6)))) for _ in range(60)] + [(2, None), (None, ""), (2, "a"), (2, "a")])
    for rows in cases:
        docs = spark.createDataFrame([(i, t, 1, "x", -1, i, 7) for i, t in rows], "doc_id long, text string, line int, removed string, classes int, carry_x long, id int")
        out = line_dedup.without_repeated_lines(spark, docs)
        assert out.columns == docs.columns
        assert sorted((str(x.doc_id), str(x.text)) for x in out.collect()) == _kept_lines(rows)


def test_short_lines_that_repeat_go(spark):
    """Equal lines of any length are one class; short lines that only resemble each other are not."""
    texts = [(1, "All rights reserved.\na\n\nAll rights reserved!"), (2, "a\n\nAll rights reserved."), (3, "b\na\nb")]
    out = {x.doc_id: (x.n_removed, x.text) for x in line_dedup.line_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert out == {1: (0, texts[0][1]), 2: (2, ""), 3: (2, "b")}


def test_lines_of_neighbours_that_end_and_begin_with_newlines():
    """Lines are cut as split() cuts them, whatever document stands next in the slice."""
    import numpy as np
    import pyarrow as pa

    r = random.Random(8)
    slices = [["aaa\n", "\nbbb"], ["\n", "\n", "\n\n"], ["a\n", None, "", "\nb"], ["", None], ["x", "y\n\n", "\n\nz"]]
    slices += [["".join(r.choice("a\n") for _ in range(r.randrange(5))) for _ in range(6)] for _ in range(200)]
    for texts in slices:
        chars = "".join(t or "" for t in texts)
        doc, number, begin, end, _ = line_dedup._cut(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())}), 0)
        got = [(d, n, chars[b:e]) for d, n, b, e in zip(*(np.asarray(x).tolist() for x in (doc, number, begin, end)))]
        assert got == [(d, n, l) for d, t in enumerate(texts) for n, l in enumerate(line_dedup.lines_of(t))]


@pytest.mark.parametrize("deal", [256, 3])
def test_all_near_links_are_counted(spark, monkeypatch, deal):
    """Variants of one line: each counts all lines within two edits of it, not only one hub; classes stay the same without counts."""
    monkeypatch.setattr(line_dedup, "DEAL", deal)
    r = random.Random(9)
    base = "".join(r.choice("abcdefgh ") for _ in range(45))
    lines = [base[:k] + c + base[k + 1 :] for k in (0, 20, 44) for c in "xyz"] + [base[:5] + "uv" + base[7:], base[1:-1], base[:30], base[:30] + "q", "short", base + "12345"]
    docs = spark.createDataFrame([*enumerate(lines), (99, "\n".join([lines[0], lines[3], "short"]))], "doc_id long, text string")
    links = {x: sum(x != y and min(len(x), len(y)) >= line_dedup.LEAST_NEAR and distance(x, y) <= 2 for y in lines) for x in lines}
    out = line_dedup.line_dedup(docs).collect()
    assert {x.doc_id: x.n_links for x in out} == {d.doc_id: sum(links[l] for l in d.text.split("\n")) for d in docs.collect()}
    plain = line_dedup.line_dedup(docs, counted=False).collect()
    assert {(x.doc_id, x.text, str(x.removed)) for x in plain} == {(x.doc_id, x.text, str(x.removed)) for x in out}
    assert all(x.n_links is None for x in plain)


def test_near_duplicate_stage_links_from_80_percent(spark):
    """Up to three of 100 words are changed: some pairs lie between 0.80 and 0.85, and one of each stays."""
    r = random.Random(10)
    texts = []
    for i in range(40):
        base = [f"b{i}_{k}" for k in range(100)]
        texts.append((2 * i, " ".join(base)))
        for k in r.sample(range(5, 95), i % 4):
            base[k] = "new"
        texts.append((2 * i + 1, " ".join(base)))
    of = {percent: {i for i, (_, c) in brute_components(texts, percent).items() if i == c} for percent in (80, 85)}
    assert of[80] < of[85]
    out = minhash.one_of_each(spark, spark.createDataFrame(texts, "doc_id long, text string"))
    assert {x.doc_id for x in out.collect()} == of[80]
