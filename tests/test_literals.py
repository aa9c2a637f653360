"""Nested literals as text: quotes, escapes, nesting, and literals that are broken."""

import ast
import json

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import literals as L

GOOD = [
    "[]", "['a', 'b']", '["a", "b"]', "('a', 'b',)", "['it\\'s', \"say \\\"x\\\"\", 'a \"quoted\" b']", "[1, 2.5, -3, None, True, False]", "[['a', ['b', 1]], {'k': 'v', 'a': [1]}]",
    "{'b': 1, 'a': {'d': None, 'c': 'x, y'}}", "{}", "['a, b; c', '(d', 'e]']", "[ 'x' ,\n 'y' ]", "['tab\\tin', 'back\\\\slash', 'end\\\\']", "((1, 2), 'x')", "('only',)", "()", "['ü', '日本']",
]
BROKEN = ["['a', 'b'", "['a' 'b']", "['a', b']", "[,]", "[1,,2]", "{'a'}", "{'a': }", "('lone')", "(1)", "plain", "", None, "[a, b]", "'x'", "{1, 2}", "['a']]", "[(]) ]", "[(])", "['a'], ['b']", "[1] [2]", "[{]}"]


def _text(v):
    return json.dumps(v, ensure_ascii=False, sort_keys=True, separators=(",", ":")) if isinstance(v, (list, dict, tuple)) else str(v)


def test_literals_read_as_python_reads_them(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(GOOD)], "i int, t string")
    got = {r.i: r for r in rows.select("i", L.literal_json(F.col("t")).alias("j"), L.literal_items(F.col("t")).alias("items")).collect()}
    for i, t in enumerate(GOOD):
        v = ast.literal_eval(t)
        assert json.loads(got[i].j) == json.loads(json.dumps(v)), t
        assert got[i]["items"] == (None if isinstance(v, dict) else [_text(x) for x in v]), t


def test_broken_literals_are_none(spark):
    rows = spark.createDataFrame([(t,) for t in BROKEN], "t string")
    assert [r.t for r in rows.filter(L.literal_json(F.col("t")).isNotNull()).collect()] == []


@pytest.mark.parametrize("text,parts", [
    ("['a (b, c)', 'd']", ["a (b, c)", "d"]), ("[a (b, c); d]", ["a (b, c)", "d"]), ("'x', \"y\"", ["x", "y"]), ("a, [b, c]\nd", ["a", "[b, c]", "d"]),
    ("[None, '', 'z']", ["z"]), ("", []), (None, []), ("[]", []), ("('lone')", ["('lone')"]), ("['a', {'k': [1, 2]}]", ["a", '{"k":[1,2]}']), ("['a', 'b'", ["['a', 'b"]),
])
def test_cells_split(spark, text, parts):
    assert spark.createDataFrame([(text,)], "t string").select(L.split_cell(F.col("t")).alias("p")).first().p == parts


@pytest.mark.parametrize("text,flat", [
    ("['C57BL/6', 'BALB/c', ' ']", "C57BL/6; BALB/c"), ("{'cell': 'HEK293', 'animal': 'mouse'}", '{"animal":"mouse","cell":"HEK293"}'), ("[]", ""), ("{}", ""), (None, ""), ("plain, text", "plain, text"),
])
def test_nested_text(spark, text, flat):
    assert spark.createDataFrame([(text,)], "t string").select(L.nested_text(F.col("t")).alias("p")).first().p == flat


def test_a_literal_is_read_once_a_row(spark):
    """However often its tokens and its JSON are named: inside lambdas Spark works out each mention anew."""
    row = spark.range(1).select(F.lit("['a']").alias("c"))
    plan = lambda c: row.select(c.alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan(L.nested_text(F.col("c"))).count("regexp_extract_all") == plan(L.split_cell(F.col("c"))).count("regexp_extract_all") == 2
