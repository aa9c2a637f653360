"""Linkage by classes of equal rows: copies are compared once, and no link is lost."""

import random

from sparkloom.operators import keys as K
from sparkloom.operators import linkage as L

from .test_linkage import plan, rows

WORDS = ["ab", "abc", "bc", "b c", "c", "", "abcd e", "e"]


def sides(spark, copies=3):
    r = random.Random(4)
    make = lambda tag, columns: [("figure 1", f"{tag}{i}", {c: r.choice(WORDS) for c in columns} | {"Value": str(i), "Experiment_value": ""}) for i in range(25)]
    again = lambda data: [(p, f"{i}.{n}", m) for p, i, m in data for n in range(copies)]
    return again(make("s", ["A", "B"])), again(make("t", ["N"]))


def met(mode, a, b):
    if not all(a) or not all(b):
        return False
    ja, jb = " ".join(a), " ".join(b)
    if mode == "contains":
        return all(x in jb for x in a) or all(x in ja for x in b)
    p, q = set(ja.split(" ")), set(jb.split(" "))
    return len(p & q) >= 0.8 * len(p | q)


def linked_once(spark, mode):
    s, t = sides(spark)
    links = (rows(spark, "s", s), rows(spark, "t", t), plan(spark, [(["A", "B"], ["N"], mode, True, None)]))
    got = sorted((x.source_id, x.target_id) for x in L.linked_pairs(*links).collect())
    want = sorted((i, j) for _, i, a in s for _, j, b in t if met(mode, [a["A"], a["B"]], [b["N"]]))
    assert want and got == want
    classes = L.linked_classes(*links).met
    assert classes.count() == classes.distinct().count() <= len(want) / 9  # copies are compared once


def test_copies_are_compared_once_in_contains(spark):
    linked_once(spark, "contains")


def test_keys_of_rows_are_never_sent_whole(spark):
    left = spark.createDataFrame([(1, 1, "abc")], "k int, i int, a string")
    right = spark.createDataFrame([(1, 1, "xabcx")], "k int, j int, b string")
    both = K.mutually_contained(left, right, ["k"], "a", "b")
    assert "BroadcastHashJoin" not in both._jdf.queryExecution().executedPlan().toString() and both.count() == 1


def test_copies_are_compared_once_in_token_overlap(spark):
    linked_once(spark, "token_overlap")


def refused_and_accepted(spark):
    """Two targets of a source, filled targets, empty sources, several takers, repeated and missing ids, in three partitions."""
    cells = [("s1", "a", "1"), ("s2", "b", "1"), ("s3", "b", "2"), ("s4", "c", "1"), ("s5", "d", ""), ("s6", "e", "1"), ("s7", "v", "4")]
    s = [(p, f"{p}{i}", {"A": x, "Value": v}) for p in ("p", "q", "r") for i, x, v in cells] + [(p, "twice", {"A": "g", "Value": "5"}) for p in ("p", "r")] + [("q", None, {"A": "h", "Value": "6"})]
    slots = [("t1", "a", ""), ("t2", "b", ""), ("t3", "c", "7"), ("t4", "d", ""), ("t5", "e", ""), ("t6", "e", ""), ("t7", "g", "")]
    t = [(p, f"{p}{i}", {"N": x, "K": "l" if i == "t2" else "k", "Experiment_value": v}) for p in ("p", "q", "r") for i, x, v in slots] + [("q", None, {"N": "h", "Experiment_value": ""})]
    of = lambda p, mode, review, fixed=None: (p, "Value", "Experiment_value", [(["A"], ["N"], mode, True, [(["v"], ["a"])])], fixed, "low", review)
    return rows(spark, "s", s), rows(spark, "t", t), spark.createDataFrame([of("p", "exact", True), of("q", "contains", False), of("r", "exact", False, [("K", "k")])], L.PLAN)


def test_judging_by_classes_equals_judging_pairs(spark):
    links = refused_and_accepted(spark)
    pairs = L.resolve_conflicts(L.linked_pairs(*links))
    j = L.judged(*links)
    plain = lambda df: sorted(map(str, df.select(pairs.columns).collect()))
    want = plain(pairs)
    assert plain(L.resolved_pairs(j)) == want and len({r.conflict_reason for r in pairs.collect()}) == 5
    ids = lambda df: sorted((str(r.source_id), str(r.target_id), r.extracted) for r in df.collect())
    assert ids(j.accepted) == ids(pairs.filter("accepted")) != []
    row = pairs.collect()
    assert tuple(L.pair_counts(j).first()) == (len(row), sum(r.accepted for r in row), sum(r.conflict_reason != "" for r in row), sum(r.manual_required for r in row))


def test_scored_pairs_of_copies_are_compared_once(spark):
    kinds = [("k", "x", "p", 1), ("k", "x", "q", 1), ("k", "x", "p", 2), ("k", None, "p", 1), ("k", "", "p", 1), (None, "x", "p", 1)]
    copies = [(i * 50 + n, *kind) for i, kind in enumerate(kinds) for n in range(50)]
    a, b = (spark.createDataFrame(copies, f"{n} int, block string, s1 string, s2 string, s3 int") for n in "ab")
    found = L.scored_linkage(a, b, "block", {"s1": 15, "s2": 15, "s3": 5}, 55, 75)
    hit = lambda x, y: x[0] is not None and x[0] == y[0] and 15 * (bool(x[1]) and x[1] == y[1]) + 15 * (x[2] == y[2]) + 5 * (x[3] == y[3]) >= 20
    want = sum(hit(x, y) for x in kinds for y in kinds)
    assert found.count() == found.distinct().count() == want * 2500
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan  # classes of rows, not rows, are compared
