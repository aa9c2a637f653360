from pyspark.sql import functions as F

from sparkloom.operators import linkage as L
from sparkloom.operators import tables as T


def rows(spark, name, data):
    return spark.createDataFrame([(p, i, m) for p, i, m in data], "partition_key string, id string, payload map<string,string>")


def plan(spark, relations, fixed=None):
    return spark.createDataFrame([("figure 1", "Value", "Experiment_value", relations, fixed, "low", True)], L.PLAN)


PAIRS = [((["A", "C10"]), ["A-C10"]), (["MC3", "C10"], ["DLin-MC3-DMA"]), (["MC3", "C12"], ["DLin-MC3-DMA"])]


def partial(spark):
    s = rows(spark, "s", [("figure 1", f"EV{n}", {"X_Label": x, "Group": g, "Value": v}) for n, (x, g, v) in enumerate([("A", "C10", "1.1"), ("MC3", "C10", "2.2"), ("MC3", "C12", "3.3")], 1)])
    t = rows(spark, "t", [("figure 1", "LN1", {"IL_name": "A-C10", "Experiment_value": ""}), ("figure 1", "LN2", {"IL_name": "DLin-MC3-DMA", "Experiment_value": ""})])
    p = plan(spark, [(["X_Label", "Group"], ["IL_name"], "value_map", True, PAIRS)])
    return s, t, p


def test_one_source_is_accepted_and_two_that_share_a_target_are_not(spark):
    s, t, p = partial(spark)
    out = {r.source_id: r for r in L.resolve_conflicts(L.linked_pairs(s, t, p)).collect()}
    assert {k for k, r in out.items() if r.accepted} == {"EV1"}
    assert {out[k].conflict_reason for k in ("EV2", "EV3")} == {L.REASONS[3]}


def test_candidates_and_unmatched_cover_every_row_and_matches_are_one_to_one(spark):
    s, t, p = partial(spark)
    c = L.resolve_conflicts(L.linked_pairs(s, t, p))
    good = c.filter("accepted")
    assert good.count() == good.select("source_id").distinct().count() == good.select("target_id").distinct().count()
    assert L.unmatched(s, c, "source_id").count() + good.count() == s.count()


def test_two_source_columns_to_one_target_and_one_to_three(spark):
    s = rows(spark, "s", [("figure 1", "a", {"Condition": "mouse liver IV", "Value": "8.2"})])
    t = rows(spark, "t", [("figure 1", "b", {"Model": "Mouse", "Target": "liver", "Route": "iv", "Experiment_value": ""})])
    p = plan(spark, [(["Condition"], ["Model", "Target", "Route"], "contains", True, None)])
    assert L.linked_pairs(s, t, p).count() == 1


def test_a_met_optional_relation_spoils_the_score_only_when_strict(spark):
    s = rows(spark, "s", [("figure 1", "a", {"X": "one", "Y": "two", "Value": "1"})])
    t = rows(spark, "t", [("figure 1", "b", {"X": "One", "Y": "TWO", "Experiment_value": ""})])
    p = plan(spark, [(["X"], ["X"], "exact", True, None), (["Y"], ["Y"], "exact", False, None)])
    assert L.linked_pairs(s, t, p).count() == 0
    assert L.linked_pairs(s, t, p, strict=False).count() == 1


def test_a_fixed_value_and_blanks_decide(spark):
    s = rows(spark, "s", [("figure 1", "a", {"X": "one", "Value": "1"}), ("figure 1", "c", {"X": "", "Value": "1"})])
    t = rows(spark, "t", [("figure 1", "b", {"X": "One", "K": "no", "Experiment_value": ""}), ("figure 1", "d", {"X": "", "K": "yes", "Experiment_value": ""})])
    assert L.linked_pairs(s, t, plan(spark, [(["X"], ["X"], "exact", True, None)], [("K", "YES")])).count() == 0
    assert L.linked_pairs(s, t, plan(spark, [(["X"], ["X"], "exact", True, None)])).count() == 1


def test_matrix_and_long_form_are_inverse(spark):
    m = spark.createDataFrame([("r1", "1", "2"), ("r2", "", "4")], "label string, a string, b string")
    back = T.long_to_matrix(T.matrix_to_long(m, "label"), "label", "col_label", "value", ["a", "b"])
    assert sorted(map(tuple, back.select("label", F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).collect())) == [("r1", "1", "2"), ("r2", "", "4")]


def test_columns_are_found_by_loose_names():
    assert T.find_column(["X_Label", "xlabel", "Value"], ["X Label"]) == "xlabel"
    assert T.find_column(["my_value_col"], ["value"]) == "my_value_col"
    assert T.find_column(["a"], ["b"]) is None


def test_substring_and_token_keys_lose_no_pair(spark):
    """Keyed joins give what comparing all pairs gives, for short, blank and repeated texts."""
    import random

    from pyspark.sql import functions as F

    from sparkloom.operators import keys as K

    r = random.Random(6)
    texts = ["", "a", "ab", "abc", "abcd"] + ["".join(r.choice("ab c") for _ in range(r.randrange(1, 9))).strip() for _ in range(60)]
    left = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "k int, i int, a string")
    right = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts[::-1])], "k int, j int, b string")
    got = [(x.i, x.j) for x in K.mutually_contained(left, right, ["k"], "a", "b").collect()]
    want = {(i, j) for i, x in enumerate(texts) for j, y in enumerate(texts[::-1]) if x and y and (x in y or y in x)}
    assert len(got) == len(want) and set(got) == want
    words = [" ".join(r.choice("pqrst") for _ in range(r.randrange(1, 8))) for _ in range(60)]
    prefix = dict(spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").select("i", K.token_prefix(F.col("w"), 0.8)).collect())
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            p, q = set(x.split()), set(y.split())
            if len(p & q) >= 0.8 * len(p | q):
                assert set(prefix[i]) & set(prefix[j])


def test_scored_linkage_equals_all_pairs(spark):
    import itertools

    from sparkloom.operators import linkage as L

    rows = [("k", i, a, b, c) for i, (a, b, c) in enumerate(itertools.product(["x", "y", "", None], ["p", "q"], ["1", ""]))]
    sides = [spark.createDataFrame(rows, f"block string, {n} int, s1 string, s2 string, s3 string") for n in "ab"]
    points = {"s1": 15, "s2": 15, "s3": 5}
    for least in (60, 70, 75, 90):
        out = {(r.a, r.b): r.score for r in L.scored_linkage(*sides, "block", points, 55, least).collect()}
        score = lambda x, y: 55 + sum(n for n, p, q in zip(points.values(), x[2:], y[2:]) if p and p == q)
        assert out == {(x[1], y[1]): score(x, y) for x in rows for y in rows if score(x, y) >= least}
