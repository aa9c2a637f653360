"""Inputs beyond what the small tables hold: long numbers, deep sheets, short needles, and edge cases of assembly."""

import random

from pyspark.sql import functions as F

from sparkloom.operators import assembly as A
from sparkloom.operators import canonical as C
from sparkloom.operators import documents as D
from sparkloom.operators import grid as G
from sparkloom.operators import profile as P
from sparkloom.operators import resolve as R
from sparkloom.operators import tables as T


def test_ids_of_long_numbers_stay_whole(spark):
    many = T.sequence_ids(spark.range(1_000_020), ["id"], "EV")
    assert many.select("row_id").distinct().count() == 1_000_020
    assert many.filter("id = 1000019").first().row_id == "EV1000020" and many.filter("id = 4").first().row_id == "EV000005"
    one = spark.createDataFrame([("a", "1", "f", 123456789), ("b", "2", "f", 7)], "Figure string, Value string, src string, row long")
    assert {r.expval_id for r in C.value_rows(one, "Value", "src", "row").collect()} == {"EV123456789", "EV00000007"}
    assert {r.target_row_id for r in C.target_rows(one, "Value", "src", "row").collect()} == {"LN123456789", "LN00000007"}


def test_completed_ids_never_collide(spark):
    rows = spark.createDataFrame([(1, ""), (2, "R000001"), (3, "R000001x"), (4, "R000001"), (1234567, ""), (1234568, "R1234567"), (7, "R000001xxx")], "at long, row_id string")
    out = {r["at"]: r.new_id for r in R.complete_ids(rows, "row_id", "at", "R").collect()}
    assert out[2] == "R000001" and out[3] == "R000001x" and out[1] == "R000001xx" and out[1234567] == "R1234567x" and out[4] == "R000004"
    assert len(set(out.values())) == len(out)


def test_deep_sheets_and_long_components(spark):
    cells = spark.createDataFrame([("s", 3000, 5, "x"), ("s", 3001, 5, "1"), ("s", 9, 1, "y")], "sheet string, r int, c int, value string")
    assert {(r.r1, r.r2, r.cells) for r in G.boxes(G.components(cells)).collect()} == {(3000, 3001, 2), (9, 9, 1)}
    path = [(r, c) for r in range(0, 60, 2) for c in range(20)] + [(r + 1, 19 if r % 4 == 0 else 0) for r in range(0, 58, 2)]
    snake = spark.createDataFrame([("s", r, c, "1") for r, c in path], cells.schema)
    assert [r.cells for r in G.boxes(G.components(snake)).collect()] == [len(path)]


def test_needles_of_one_or_two_words_are_found_inside_words(spark):
    docs = spark.createDataFrame([(1, "nothing here"), (2, "the bobCAT  satin"), (3, "a b")], "doc_id long, text string")
    needles = spark.createDataFrame([(1, "cat sat"), (2, "at"), (3, "a b"), (4, "zzz"), (5, " "), (6, "the bobcat satin")], "id long, needle string")
    out = {r.id: (r.doc_id, r.tier) for r in D.located(needles, docs).collect()}
    assert out == {1: (2, 3), 2: (2, 1), 3: (3, 1), 6: (2, 3)}


def test_greedy_choice_shares_no_column(spark):
    rows = [("p", ["a", "b"], "x", 5.0), ("p", ["b"], "y", 4.0), ("p", ["c"], "x", 3.0), ("p", ["c"], "y", 2.0), ("q", ["b"], "y", 1.0)]
    out = P.disjoint_relations(spark.createDataFrame(rows, "partition_key string, source_columns array<string>, target_column string, score double")).collect()
    assert {(r.partition_key, tuple(r.source_columns), r.target_column) for r in out} == {("p", ("a", "b"), "x"), ("p", ("c",), "y"), ("q", ("b",), "y")}


def test_calibration_by_logarithms_and_beyond_the_ends(spark):
    cal = spark.createDataFrame([("f", 0.0, 1.0), ("f", 10.0, 10.0), ("f", 20.0, 1000.0), ("g", 5.0, 2.0)], "fig string, cal_pixel double, cal_value double")
    points = spark.createDataFrame([("f", 1, 5.0), ("f", 2, 30.0), ("f", 3, 16.0), ("g", 4, 5.0), ("f", 5, 10.0)], "fig string, point long, pixel double")
    out = {r.point: r.value for r in R.calibrated(points, cal, "fig", log10=True).select("point", F.round("value", 6).alias("value")).collect()}
    assert out == {1: round(10**0.5, 6), 2: 100_000.0, 3: round(10**2.2, 6), 4: None, 5: 10.0}
    straight = {r.point: r.value for r in R.calibrated(points, cal, "fig").collect()}
    assert straight[1] == 5.5 and straight[2] == 1990.0


def test_assembly_takes_each_item_once_and_flags_what_is_missing(spark):
    items = spark.createDataFrame([(1, "PBS and MC3", "i.png"), (2, "nothing", ""), (3, None, None), (4, "PBS", "")], "item_id long, caption string, image string")
    matches = spark.createDataFrame([(1, "b1", False, ["l"]), (2, "b2", True, ["l", "m"]), (2, "b3", False, ["l"]), (9, "b9", True, ["l"])], "item_id long, block string, readable boolean, context array<string>")
    labels = F.filter(F.array(F.when(F.contains("caption", F.lit("PBS")), "PBS"), F.when(F.contains("caption", F.lit("MC3")), "MC3")), lambda x: x.isNotNull())
    rows, flags = A.unified_rows(items, matches, labels)
    assert {(r.item_id, r.source_type, r.block, r.label) for r in rows.collect()} == {
        (1, A.IMAGE_CAPTION, "", "PBS"), (1, A.IMAGE_CAPTION, "", "MC3"), (2, A.BLOCK, "b2", ""), (3, A.PLACEHOLDER, "", ""), (4, A.CAPTION, "", "PBS")}
    assert {(r.item_id, r.block, r.severity) for r in flags.collect()} == {(1, "b1", "high"), (2, "b3", "high"), (1, "", "medium"), (4, "", "medium"), (3, "", "high")}
    none, no_flags = A.unified_rows(items.limit(0), matches, labels)
    assert none.count() == no_flags.count() == 0


def test_table_spans_end_where_text_begins(spark):
    text = "Table 1. A\n\n| a | b |\n| 1 | 2 |\none line\ntwo lines\nTable 2. B\nno rows\n# End"
    lines = spark.createDataFrame([(1, i, l) for i, l in enumerate(text.split("\n"))], "doc_id long, line_no int, line string")
    hits = spark.createDataFrame([("table 1", 1, 0), ("table 2", 1, 6)], "item string, doc_id long, line_no int")
    out = {r["item"]: (r.is_table, r.snippet) for r in A.table_spans(lines, hits, F.col("line").startswith("|"), F.col("line").rlike("^(#|Table [0-9])")).collect()}
    assert out["table 1"] == (True, "Table 1. A\n\n| a | b |\n| 1 | 2 |\none line")
    assert out["table 2"][0] is False and "no rows" in out["table 2"][1]


def _plain_span(lines, hit):
    """What a hit's span and surroundings are, line by line, and how many table lines are in the span."""
    span, last, tables = [], None, 0
    for no, line in ((n, x) for n, x in lines if n >= hit):
        blank, table = line.strip(" ") == "", line.startswith("|") and no > hit
        text = not blank and not table and no > hit
        if last and not table:
            last = (last[0], last[1] + blank, last[2] + text)
        if no > hit and ((line.startswith("#") and not blank) or (text and last and (last[1] > 0 or (last[0] and last[2] >= 2)))):
            break
        if table:
            last, tables = (line.count("|") >= 2, 0, 0), tables + 1
        span.append(line)
    near = [x for n, x in lines if hit - 20 // 3 <= n <= hit + 40 // 3]
    whole = "\n".join(span).strip(" \n\t\r")
    good = tables >= 2 or len(whole) >= 500
    return good, whole if good else "\n".join(near).strip(" \n\t\r")


def test_table_spans_equal_plain_loops_and_sort_nothing(spark):
    """Each hit by itself, also where an item has two in one document; no window and no join carries the lines."""
    r = random.Random(5)
    docs = {d: [(n, r.choice(["| a | b |", "| a | b |", "|c", "", "", "text", "more text", "# Head", "x" * 300])) for n in range(40)] for d in range(60)}
    lines = spark.createDataFrame([(d, n, x) for d, found in docs.items() for n, x in found], "doc_id long, line_no int, line string")
    hits = [("one", d, r.randrange(40)) for d in docs] + [("two", d, n) for d in docs for n in r.sample(range(40), 2)]
    got = A.table_spans(lines, spark.createDataFrame(hits, "item string, doc_id long, line_no int"), F.col("line").startswith("|"), F.col("line").startswith("#"))
    want = sorted((item, d, *_plain_span(docs[d], n)) for item, d, n in hits)
    assert sorted(tuple(x) for x in got.collect()) == want and {x[2] for x in want} == {True, False}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_a_value_rows_key_is_told_once_a_row(spark):
    df = spark.createDataFrame([("Fig. 2b", "1", "f.csv", 1)], "Figure string, Value string, src string, row long")
    rows = C.value_rows(df, "Value", "src", "row").select("item_id", "figure_key", "partition_key")
    plan, one = (x._jdf.queryExecution().optimizedPlan().toString() for x in (rows, rows.select("item_id")))
    assert tuple(rows.first()) == ("figure 2b",) * 3 and plan.count("transform(") == one.count("transform(") > 0


def test_sentences_are_sorted_without_lines_and_gaps_twice(spark):
    from sparkloom.operators.documents import sentence_index

    docs = spark.createDataFrame([(1, "# A heading\n  A first sentence that is long enough.  Another one that is long too. ")], "doc_id long, text string")
    found = sentence_index(docs).select("doc_id", "sentence_no", "sentence")
    assert [r.sentence for r in found.orderBy("sentence_no").collect()] == ["A heading", "A first sentence that is long enough.", "Another one that is long too."]
    plan = found._jdf.queryExecution().optimizedPlan()
    windows = [x for x in plan.toString().split("\n") if "Window [" in x]
    assert windows and not any("gaps#" in x for x in windows)
    joined = plan.toString().index("Join Inner")
    whole = sentence_index(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert joined >= 0 and whole.index("Join Inner") < whole.index("Window [")  # headings join after all windows
