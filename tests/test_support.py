"""Supporting sentences in tiers against plain loops over all pairs."""

import random

import pytest

from sparkloom.operators import support
from sparkloom.operators.support import supporting_sentences

ROWS, TURNS = "id int, item string, words array<string>", "sid int, hint string, words array<string>"


def _plain(rows, turns, tiers, most=3, least=6):
    out = set()
    for i, item, words in rows:
        item = (item or "").strip()
        words = list(dict.fromkeys(w for w in words or [] if w is not None))
        scored = []
        for sid, hint, theirs in turns:
            shared = [w for w in words if w in set(theirs or [])]
            has = item != "" and item == (hint or "").strip()
            scored.append((8 * has + sum(3 if len(w) >= 5 else 1 for w in shared), sid, has, any(words.index(w) < 20 for w in shared)))
        tier = 0
        if tiers:
            tier = 1 if any(x[2] for x in scored) else 2 if item and any(x[3] for x in scored) else 3
        keep = [x for x in scored if tier in (0, 3) or (tier == 1 and x[2]) or (tier == 2 and x[3])]
        best = sorted((x for x in keep if x[0] >= least), key=lambda x: (-x[0], x[1]))[:most]
        out |= {(i, x[1], x[0], n, tier) for n, x in enumerate(best, 1)}
    return out


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(11)
    common = [f"common{i}" for i in range(4)] + [f"c{i}" for i in range(4)]
    rare = [f"rareword{i}" for i in range(60)] + [f"r{i}" for i in range(60)]
    draw = lambda n, share: [rng.choice(common) if rng.random() < share else rng.choice(rare) for _ in range(n)]
    items = ["", None, " ", "fig 1", "fig 2", "fig 9"]
    rows = [(i, rng.choice(items), draw(rng.randint(0, 40), rng.choice([0.1, 0.5, 1.0]))) for i in range(80)]
    rows += [(80, "fig 9", [f"none{i}" for i in range(20)] + ["common0", "common1", "rareword3"]), (81, "fig 9", [f"none{i}" for i in range(20)]), (82, "fig 1", None), (83, "fig 1", [None, "c0"])]
    turns = [(i, rng.choice(["", "", None, "fig 1", "fig 2"]), draw(rng.randint(0, 12), 0.6)) for i in range(300)] + [(300, "fig 1", None), (301, None, ["c0", "c0", None])]
    return rows, turns


@pytest.mark.parametrize("tiers", [False, True])
@pytest.mark.parametrize("common", [0.0, 0.05, 1.0])
@pytest.mark.parametrize("least", [6, 2])
def test_equals_plain_loops(spark, tables, tiers, common, least):
    rows, turns = tables
    got = supporting_sentences(spark.createDataFrame(rows, ROWS), spark.createDataFrame(turns, TURNS), least=least, tiers=tiers, common=common)
    assert {tuple(x) for x in got.collect()} == _plain(rows, turns, tiers, least=least)


@pytest.mark.parametrize("tiers", [False, True])
@pytest.mark.parametrize("common", [0.0, 0.05, 1.0])
@pytest.mark.parametrize("least", [6, 2])
def test_many_rows_meet_by_keys(spark, tables, tiers, common, least, monkeypatch):
    monkeypatch.setattr(support, "FEW_ROWS", 10)
    rows, turns = tables
    got = supporting_sentences(spark.createDataFrame(rows, ROWS), spark.createDataFrame(turns, TURNS), least=least, tiers=tiers, common=common)
    assert {tuple(x) for x in got.collect()} == _plain(rows, turns, tiers, least=least)


@pytest.mark.parametrize("tiers", [False, True])
def test_parts_of_sentences_and_words(spark, tables, tiers, monkeypatch):
    """Few rows are scored in tasks, a few sentences and words at a time; what a task hands on does not grow with the sentences."""
    monkeypatch.setattr(support, "_CELLS", 500)
    monkeypatch.setattr(support, "_MET", 50)
    rows, turns = tables
    some = spark.createDataFrame(turns, TURNS).repartition(3)
    got = supporting_sentences(spark.createDataFrame(rows, ROWS), some, tiers=tiers)
    assert {tuple(x) for x in got.collect()} == _plain(rows, turns, tiers)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan


def test_empty_tables(spark, tables):
    rows, turns = tables
    none = spark.createDataFrame([], TURNS)
    assert supporting_sentences(spark.createDataFrame(rows, ROWS), none, tiers=True).count() == 0
    assert supporting_sentences(spark.createDataFrame([], ROWS), spark.createDataFrame(turns, TURNS)).count() == 0
