"""Nested list and dict literals as text, without Python workers: a literal is rewritten as JSON and read as a variant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import given, let, split_outside_brackets

# The tokens of literals.
SINGLE = r"'(?:[^'\\\n]|\\[^\n])*+'"
DOUBLE = r'"(?:[^"\\\n]|\\[^\n])*+"'
TOKEN = rf"{SINGLE}|{DOUBLE}|[\[\](){{}},:]|[^\s'\"\[\](){{}},:]++"
WORDS = {"None": "null", "True": "true", "False": "false", "(": "[", ")": "]"}
CLOSES = {")": "(", "]": "[", "}": "{"}


def _string(token: Column) -> Column:
    """A quoted token as a JSON string."""
    inner = F.substring(token, F.lit(2), F.char_length(token) - 2)
    inner = F.regexp_replace(inner, r"(?<!\\)((?:\\\\)*)\\'", "$1'")
    inner = F.regexp_replace(inner, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')
    return F.concat(F.lit('"'), F.replace(inner, F.lit("\t"), F.lit(r"\t")), F.lit('"'))


def _balanced(tokens: Column) -> Column:
    """Whether each bracket closes the last one open, and none stays open."""
    opener = F.create_map(*[F.lit(x) for pair in CLOSES.items() for x in pair])

    def step(open_: Column, t: Column) -> Column:
        closed = F.when(F.right(open_, F.lit(1)) == F.element_at(opener, t), F.left(open_, F.char_length(open_) - 1)).otherwise("x")
        return F.when(open_ == "x", open_).when(t.isin(*CLOSES.values()), F.concat(open_, t)).otherwise(closed)

    return F.aggregate(F.filter(tokens, lambda t: t.isin(*CLOSES, *CLOSES.values())), F.lit(""), step) == ""


def literal_json(c: Column) -> Column:
    """A list, tuple or dict literal, or a JSON array or object, as JSON text; null where it is none or broken.

    Strings in single or double quotes with their escapes, numbers, None, True and False, any nesting, commas before a
    closing bracket. A bracketed single value without a comma is no tuple. Quotes and brackets that do not close, sets,
    and strings side by side are broken.
    """
    def fits(text: Column) -> Column:
        return (text.startswith("[") & text.endswith("]")) | (text.startswith("(") & text.endswith(")")) | (text.startswith("{") & text.endswith("}"))

    return let(F.trim(given(c)), lambda text: F.when(fits(text), let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda tokens: _json_of(text, tokens))))


def _json_of(text: Column, tokens: Column) -> Column:
    """The JSON of a bracketed text with these tokens; null if it is no literal."""
    whole = F.trim(F.regexp_replace(F.regexp_replace(text, TOKEN, ""), r"\s+", "")) == ""
    words = F.create_map(*[F.lit(x) for pair in WORDS.items() for x in pair])
    plain = lambda t: F.when(t.startswith("'") | t.startswith('"'), _string(t)).otherwise(F.coalesce(F.try_element_at(words, t), t))
    closing = lambda t: t.isin("]", ")", "}")
    kept = F.filter(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), F.coalesce(F.get(tokens, i + 1), F.lit("")).alias("next"), F.when(i > 0, F.get(tokens, i - 1)).otherwise("").alias("before"))),
                    lambda x: ~((x["t"] == ",") & closing(x["next"]) & ~x["before"].isin("", ",", "[", "(", "{")))

    def sound(json: Column, lone: Column) -> Column:
        bare = text.startswith("(") & ~F.contains(lone, F.lit(",")) & ~text.rlike(r"^\(\s*\)$|,\s*\)$")
        pairs = F.exists(tokens, lambda t: t == "{") & ~F.forall(F.regexp_extract_all(lone, F.lit(r"\{ *([^ ]+)(?: *:)?"), F.lit(0)), lambda x: x.endswith(":") | x.endswith("}"))
        alone = F.size(F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), json, F.lit("]"))), "$", "array<variant>")) == 1
        return F.when(~bare & ~pairs & alone, json)

    lone = lambda json: F.regexp_replace(json, r'"(?:[^"\\]|\\.)*+"', '""')  # noqa: E731 - a value in round brackets alone
    json = F.array_join(F.transform(kept, lambda x: plain(x["t"])), " ")
    return F.when(whole & _balanced(tokens), let(json, lambda j: let(lone(j), lambda l: sound(j, l))))


def _text_of(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    nested = kind.startswith("ARRAY") | kind.startswith("OBJECT")
    return F.when(F.is_variant_null(v) | v.isNull(), "None").when(nested, F.to_json(v)).when(kind == "BOOLEAN", F.initcap(v.cast("string"))).otherwise(v.cast("string"))


def literal_items(c: Column) -> Column:
    """The items of a list or tuple literal as texts, nested ones as JSON with sorted keys; null for all else."""
    return _items_of(literal_json(c))


def _items_of(json: Column) -> Column:
    return F.transform(F.try_variant_get(F.try_parse_json(json), "$", "array<variant>"), _text_of)


def split_cell(c: Column) -> Column:
    """Items of a list literal, else the parts outside brackets, without outer square brackets and quotes; blanks are dropped.

    A literal's None is blank. What has no parts at all is one part.
    """
    return let(F.trim(given(c)), _split)


def _split(text: Column) -> Column:
    listed = F.filter(F.transform(literal_items(text), lambda x: F.trim(x)), lambda x: ~x.isin("", "None"))
    inner = F.when(text.startswith("[") & text.endswith("]") & (F.char_length(text) > 1), F.trim(F.substring(text, F.lit(2), F.char_length(text) - 2))).otherwise(text)
    unquoted = F.filter(F.transform(split_outside_brackets(inner), lambda x: F.regexp_replace(x, "^['\"]+|['\"]+$", "")), lambda x: x != "")
    return F.coalesce(listed, let(unquoted, lambda parts: F.when(F.size(parts) > 0, parts).when(inner != "", F.array(inner)).otherwise(F.array().cast("array<string>"))))


def nested_text(c: Column) -> Column:
    """One text for a cell that may hold a literal: items that are not blank joined by semicolons, a dict as JSON with sorted keys.

    An empty list or dict is empty; what is no literal stays as it is.
    """

    def of(text: Column, json: Column) -> Column:
        items = F.filter(_items_of(json), lambda x: F.trim(x) != "")
        as_dict = F.when(json.startswith("{"), F.to_json(F.try_parse_json(json)))
        return F.coalesce(F.array_join(items, "; "), F.when(as_dict == "{}", "").otherwise(as_dict), text)

    return let(F.trim(given(c)), lambda text: let(literal_json(text), lambda json: of(text, json)))
