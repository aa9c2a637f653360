"""The fuzzy tier of text location against a plain loop over all paragraphs."""

import re
from difflib import SequenceMatcher

import pytest

from sparkloom import queries as library
from sparkloom.operators import fuzzy as Z

from .helpers import SMALL, connection


def _plain(text):
    text = re.sub(r"!\[[^\]]*\]\([^)]+\)", " ", text or "")
    text = re.sub(r"\[([^\]]+)\]\([^)]+\)", lambda m: m.group(1).lstrip("["), text)
    return re.sub(r"\s+", " ", re.sub(r"[`*_#>\-|]+", " ", text)).strip()


def by_loops(needles, docs):
    """(id, needle), (doc_id, text) -> id: (doc_id, paragraph, score)."""
    out = {}
    for i, needle in needles:
        a, best = _plain(needle).casefold(), None
        for doc, text in sorted(docs):
            for n, chunk in enumerate(re.split(r"\n\s*\n", text or "")):
                b = _plain(chunk).casefold()
                if a and b:
                    score = SequenceMatcher(None, a, b[: max(len(a) * 2, 200)]).ratio()
                    if score >= 0.55 and (best is None or score > best[2]):
                        best = (doc, n, score)
        if best:
            out[str(i)] = (*best[:2], round(best[2], 9))
    return out


def by_spark(df):
    return {r.id: (r.doc_id, r.paragraph, round(r.score, 9)) for r in df.collect()}


@pytest.fixture(scope="module")
def texts():
    con = connection()
    docs = con.sql("SELECT doc_id, left(text, 700) FROM documents WHERE doc_id < 30").fetchall()
    docs += [(1000 + i, t.replace(". ", ".\n\n")) for i, (t,) in enumerate(con.sql("SELECT left(text, 900) FROM documents WHERE doc_id BETWEEN 60 AND 72").fetchall())]
    needles = [(d, t[5:300].replace("th", "t h")) for d, t in docs[:12]] + [(100 + d, t.split("\n\n")[1].replace("e", "a", 2)) for d, t in docs[-8:] if "\n\n" in t]
    return needles + con.sql("SELECT 5000 + item_id, text FROM benchmark LIMIT 6").fetchall(), docs


def test_nearest_paragraphs_equal_plain_loops(spark, texts, monkeypatch):
    needles, docs = texts
    expected = by_loops(needles, docs)
    assert len(expected) >= 12  # a fixture of hits
    n, d = spark.createDataFrame(needles, "id long, needle string"), spark.createDataFrame(docs, "doc_id long, text string")
    assert by_spark(Z.nearest_paragraphs(n, d)) == expected
    monkeypatch.setattr(Z, "NEEDLES", 5)
    monkeypatch.setattr(Z, "PARAGRAPHS", 40)
    assert by_spark(Z.nearest_paragraphs(n, d)) == expected  # however they are dealt out


def test_bounds_are_never_below_the_similarity(texts):
    needles, docs = texts
    heads = [_plain(t).casefold() for _, t in needles]
    chunks = [_plain(c).casefold() for _, t in docs for c in t.split("\n\n") if _plain(c)]
    chunks += ["", "ab" * 150, "x" * 99, "x" * 450, "한국어 문장 " * 30, heads[0] + " tail", "0123456789" * 20]
    heads += ["ab" * 120, "x" * 60, "한국어 문장 " * 20]
    seen = cut = 0
    for i, bound in Z._bounds(heads, chunks):
        for j, c in enumerate(chunks):
            score = SequenceMatcher(None, heads[i], c[: max(len(heads[i]) * 2, 200)]).ratio()
            assert bound[j] >= score - 1e-12
            seen, cut = seen + (len(c) >= 200), cut + (len(c) >= 200 and bound[j] < 0.55)
    assert cut > 0.5 * seen  # long paragraphs are mostly ruled out without a look


def test_bounds_rule_out_nearly_all_long_paragraphs(texts):
    con = connection()
    heads = [_plain(t).casefold() for (t,) in con.sql("SELECT text FROM benchmark LIMIT 40").fetchall()]
    chunks = [c for c in (_plain(t).casefold() for (t,) in con.sql("SELECT text FROM documents").fetchall()) if len(c) >= 200]
    passed = sum(int((bound >= Z.LEAST).sum()) for _, bound in Z._bounds(heads, chunks))
    assert passed < 0.01 * len(heads) * len(chunks)  # 19 in a hundred with counts of runs alone


def test_a_similarity_that_is_cut_short_is_below_the_least(texts):
    needles, docs = texts
    heads, chunks = [_plain(t).casefold() for _, t in needles], [_plain(t).casefold() for _, t in docs]
    chunks += [c[:n] for c in chunks for n in (20, 120, 199)]
    for a in heads[:8]:
        for b in chunks:
            b = b[: max(len(a) * 2, 200)]
            score = SequenceMatcher(None, a, b).ratio()
            assert Z._ratio(a, b, 0.0) == score
            assert Z._ratio(a, b, 0.55) == (score if score >= 0.55 else 0.0) or score < 0.55


def test_keys_nulls_ties_and_empty_tables(spark):
    docs = [(3, "p", "the same words stand here"), (2, "p", "intro\n \n\nthe same words stand here"), (1, "q", "the same words stand here"), (4, "p", None), (5, "p", ""), (6, None, "alone among nulls")]
    needles = [(1, "p", "The *same* wordz stand here"), (2, "r", "the same words stand here"), (3, "p", None), (4, "p", " "), (5, None, "alone among nullz"), (6, "p", "[the same](http://x) words stand hare"), (7, "p", "1234567890")]
    d = spark.createDataFrame(docs, "doc_id long, paper string, text string").selectExpr("*", "1 AS k", "2 AS chunk", "3 AS score")
    n = spark.createDataFrame(needles, "id long, paper string, needle string").selectExpr("*", "1 AS head", "2 AS block", "3 AS part")
    out = {r.id: (r.doc_id, r.paragraph) for r in Z.nearest_paragraphs(n, d, ("paper",)).collect()}
    assert out == {"1": (2, 1), "5": (6, 0), "6": (2, 1)}
    assert Z.nearest_paragraphs(n.limit(0), d).count() == Z.nearest_paragraphs(n, d.limit(0)).count() == 0


def test_literal_hits_come_first(spark):
    docs = spark.createDataFrame([(1, "a sentence that is nearly the one asked for"), (2, "x a sentence that is clearly the one asked for y")], "doc_id long, text string")
    needles = spark.createDataFrame([(1, "a sentence that is clearly the one asked for"), (2, "a sentence that was nearly the one asked four")], "id long, needle string")
    out = {r.id: (r.doc_id, r.tier, r.paragraph) for r in Z.located_or_near(needles, docs).collect()}
    assert out == {"1": (2, 1, None), "2": (1, 4, 0)}


def test_the_query_equals_loops_over_its_tables(spark, tmp_path):
    con = connection()
    con.sql(f"COPY (SELECT item_id, text FROM benchmark LIMIT 9) TO '{tmp_path}/benchmark.parquet' (FORMAT parquet)")
    con.sql(f"COPY (SELECT item_id AS doc_id, text || chr(10) || chr(10) || reverse(text) AS text FROM benchmark LIMIT 20) TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    texts = con.sql("SELECT item_id, text FROM benchmark LIMIT 20").fetchall()
    change = [lambda t: t, lambda t: t.replace("th", "ht"), lambda t: t.translate(str.maketrans("sm", "mn"))]
    needles, docs = [(i, change[i % 3](t)) for i, t in texts[:9]], [(i, t + "\n\n" + t[::-1]) for i, t in texts]
    literal = {str(i) for i, n in needles if any(n.strip() in t for _, t in docs)}
    near = {i: (d, n, round(s, 6)) for i, (d, n, s) in by_loops(needles, docs).items() if i not in literal}
    out = {r.id: r for r in library.QUERIES["J18_fuzzy_location"](spark, str(tmp_path)).collect()}
    assert {i for i, r in out.items() if r.tier < 4} == literal
    found = {i: (r.doc_id, r.paragraph, r.score) for i, r in out.items() if r.tier == 4}
    assert found and found == near
