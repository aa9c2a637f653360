"""Column functions for labels, axis numbers, captions, rules and boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import DOI, given, numeric_like, sentence_text

SUPERSCRIPTS = ("⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺", "0123456789-+")


def block_keys(path: Column) -> Column:
    """Spellings by which a block may be named: its path, file name and stem, each once."""
    text = F.lower(F.replace(F.trim(given(path)), F.lit("\\"), F.lit("/")))
    name = F.regexp_extract(text, r"([^/]*)$", 1)
    return F.array_distinct(F.filter(F.array(text, name, F.regexp_replace(name, r"\.[a-z0-9]+$", "")), lambda x: x != ""))


def axis_number(c: Column) -> Column:
    """The number of an axis label: plain, 10^k, or a x 10^k, with superscript digits as exponents."""
    marked = F.regexp_replace(F.trim(given(c)), "(10)([⁰¹²³⁴⁵⁶⁷⁸⁹⁻⁺]+)", "$1^$2")
    text = F.regexp_replace(F.lower(F.translate(F.translate(marked, *SUPERSCRIPTS), "−×·*,", "-xxx")), r"\s+", "")
    plain = F.when(text.rlike(r"^[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:e[-+]?[0-9]+)?$"), text).try_cast("double")
    mantissa = F.regexp_extract(text, r"^([-+]?[0-9.]+)x10\^?([-+]?[0-9]+)$", 1).try_cast("double")
    exponent = F.regexp_extract(text, r"10\^?([-+]?[0-9]+)$", 1).try_cast("int")
    power = F.when(text.rlike(r"^10\^[-+]?[0-9]+$"), F.pow(F.lit(10.0), exponent))
    return F.coalesce(F.when(mantissa.isNotNull() & exponent.isNotNull(), mantissa * F.pow(F.lit(10.0), exponent)), power, plain)


def title_and_doi(text: Column, head: int = 8000) -> tuple[Column, Column]:
    """The first line of three words or more that is no abstract or figure line, and the first DOI, in a text's head."""
    lines = F.filter(F.transform(F.split(F.left(given(text), F.lit(head)), "\n"), sentence_text), lambda x: x != "")
    title = F.filter(lines, lambda x: (F.size(F.split(x, " ")) >= 3) & ~F.lower(x).rlike(r"^(abstract|figure|fig\.)"))
    dois = F.filter(F.transform(lines, lambda x: F.regexp_extract(x, DOI, 0)), lambda x: x != "")
    return F.coalesce(F.left(F.get(title, F.lit(0)), F.lit(220)), F.lit("")), F.coalesce(F.get(dois, F.lit(0)), F.lit(""))


def group_labels(text: Column, patterns: list[tuple[int, str]]) -> Column:
    """What an ordered table of patterns finds in a text, each label once, pattern by pattern."""
    found = F.concat(*[F.regexp_extract_all(given(text), F.lit(p), F.lit(0)) for _, p in sorted(patterns)])
    return F.array_distinct(F.transform(found, lambda x: F.trim(x)))


def first_rule(text: Column, rules: list[tuple[str, str]], default: str = "") -> Column:
    """The value of the first rule whose term the text contains."""
    low, out = F.lower(given(text)), None
    for term, value in rules:
        hit = F.contains(low, F.lit(term))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.lit(default) if out is None else out.otherwise(default)


def caption(text: Column, markers: list[Column], width: int = 500) -> Column:
    """The text from the first marker, in the order given, that stands in it; empty if none does."""
    at = F.filter(F.array(*[F.position(m, text) for m in markers]), lambda i: i > 0)
    return F.when(F.size(at) > 0, F.trim(F.substring(text, F.get(at, F.lit(0)), F.lit(width)))).otherwise("")


def without_numbers(df: DataFrame, keep: list[str]) -> DataFrame:
    """All cells as text, numeric ones blank, but for the columns to keep."""
    return df.select(*[F.col(c) if c in keep else F.when(numeric_like(F.col(c)), "").otherwise(given(F.col(c))).alias(c) for c in df.columns])


def padded(n: Column, width: int) -> Column:
    """A number's digits with zeros before them up to a width; longer numbers stay whole."""
    text = n.cast("string")
    return F.when(F.char_length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def box(r1: Column, r2: Column, c1: Column, c2: Column) -> Column:
    """A box with its bounds in order."""
    return F.struct(F.least(r1, r2).alias("r1"), F.greatest(r1, r2).alias("r2"), F.least(c1, c2).alias("c1"), F.greatest(c1, c2).alias("c2"))


def box_contains(outer: Column, inner: Column) -> Column:
    return (outer["r1"] <= inner["r1"]) & (outer["r2"] >= inner["r2"]) & (outer["c1"] <= inner["c1"]) & (outer["c2"] >= inner["c2"])


def overlap(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """How many positions two intervals share."""
    return F.greatest(F.lit(0), F.least(a2, b2) - F.greatest(a1, b1) + 1)


def gap(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """How many positions lie between two intervals."""
    return F.greatest(F.lit(0), F.greatest(a1, b1) - F.least(a2, b2) - 1)
