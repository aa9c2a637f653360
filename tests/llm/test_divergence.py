"""The divergence audit against plain loops; its query is held against SQL in test_contracts."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkloom.llm import divergence

from .conftest import prose


def plain(rows, top=200):
    langs = defaultdict(lambda: defaultdict(list))
    for lang, source, text in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        langs[lang or ""][source or ""].append(Counter(words))
    out = []
    price = lambda c, total, v: 1 + 1_000_000_000 * (c + 1) // (total + v)
    for lang, sources in langs.items():
        docs = Counter(t for group in sources.values() for d in group for t in d)
        kept = sorted(t for t, n in docs.items() if n >= 3)
        counts = {s: {t: sum(d[t] for d in group) for t in kept} for s, group in sources.items()}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}
        v, total = len(kept), sum(whole.values())
        for s, own in counts.items():
            n = sum(own.values())
            parts = {"pair": [], "term": []}
            for o, other in counts.items():
                if o != s:
                    value = 0
                    for t in kept:
                        p, q = price(own[t], n, v), price(other[t], sum(other.values()), v)
                        value += (p - q) ** 2 // q
                    parts["pair"].append((o, value))
            for t in kept:
                p, q = price(own[t], n, v), price(whole[t], total, v)
                if own[t] and p > q:
                    parts["term"].append((t, (p - q) ** 2 // q))
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, value, k + 1) for k, (i, value) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def found(df, **options):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in divergence.audited(df, **options).collect())


@pytest.fixture(scope="module")
def rows():
    out = [("en", f"s{i % 7}", prose(60, i) + " shared Éa été") for i in range(40)]
    out += [("de", None, "a a b"), ("de", "x", "A-b_c1b"), (None, "x", "one\0one ONE"), (None, None, None), ("", "y", ""), ("fr", "only", "un un"), ("de", "x", "b a"), ("de", "z", "B b 1"), ("de", "empty", "12 !")]
    return out + [("en", "s1", "zz " * 3000 + prose(3, 5))] * 3


def test_audit_equals_plain_loops(spark, rows):
    frame = spark.createDataFrame([(i, *r, "k", 1, 2) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, term string, n int, kept int")
    want = plain(rows)
    assert found(frame) == want
    assert found(frame, block=8, tile=2) == want  # many blocks and tiles


def test_ranks_of_terms_end(spark, rows):
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    assert found(frame, top=3) == plain(rows, top=3)


def test_empty_table(spark, no_docs):
    assert found(no_docs) == []


def test_equal_subtrees_are_one_node_and_pairs_are_opened_once():
    counts = np.array([[5, 0, 0, 0, 5, 0, 0], [5, 0, 0, 0, 5, 0, 1]])
    levels = divergence.consed(counts)
    assert levels[0].tolist() == [-1, 0, 1, 5]
    assert len(levels[1]) == 4  # (5 0), (0 0), (0 none), (1 none)
    other, n, m, times = divergence.leaf_pairs(levels, 0, np.array([1]))
    assert other.tolist() == [0, 0, 0] and sorted(zip(n, m, times)) == [(0, 0, 4), (0, 1, 1), (5, 5, 2)]
