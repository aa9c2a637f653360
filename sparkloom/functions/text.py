"""Column functions that normalise identifiers and text. All are built-in expressions; null counts as empty."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and word lists that results depend on.
SUPPLEMENTARY_FIGURE = r"(?U)\bsuppl(?:ementary)?\.?\s*(?:fig\.?|figure)\b"
SUPPLEMENTARY_TABLE = r"(?U)\bsuppl(?:ementary)?\.?\s*(?:tbl\.?|table)\b"
KEY_NAMED = r"(?U)(supplementary figure|supplementary table|figure|table)\s*([s]?[0-9]{1,3}[a-z]?)\b"
KEY_SHORT = r"(?U)\b(fig(?:ure)?|table)\s*([s]?[0-9]{1,3}[a-z]?)\b"
KEY_SUPP = r"(?U)\bsupp(?:lementary)?\s*(?:fig(?:ure)?|table)?\s*([s]?[0-9]{1,3}[a-z]?)\b"
KEY_S_FIGURE = r"(?U)\b(?:fg|fig|figure)?\s*s\s*([0-9]{1,3}[a-z]?)(?![0-9])"
KEY_S_TABLE = r"(?U)\b(?:tbl|table)\s*s?\s*([0-9]{1,3}[a-z]?)(?![0-9])"
ITEM_REWRITES = (
    (r"\bextended\s+data\s+fig\.?\b", "extended data figure"),
    (r"\bsupplementary\s+fig\.?\b", "supplementary figure"),
    (r"\bsupp\.?\s+fig\.?\b", "supplementary figure"),
    (r"\bsupp\.?\s+table\.?\b", "supplementary table"),
    (r"\bfig\.?\b", "figure"),
)
MENTIONS = (
    r"(?i)(extended\s+data\s+(?:fig\.?|figure)\s+\d+[a-z]?)",
    r"(?i)(extended\s+data\s+table\s+\d+[a-z]?)",
    r"(?i)(supplementary\s+figure\s+\d+[a-z]?)",
    r"(?i)(supplementary\s+table\s+\d+[a-z]?)",
    r"(?i)(figure\s+\d+[a-z]?)",
    r"(?i)(fig\.?\s*\d+[a-z]?)",
    r"(?i)(table\s+\d+[a-z]?)",
)
STOP_WORDS = ("figure", "fig", "table", "the", "and", "with", "from", "that", "this", "for", "lnpdb")
TRUE_WORDS, FALSE_WORDS = ("1", "true", "yes", "y"), ("0", "false", "no", "n")
MISSING_NUMBERS = ("nan", "na", "n/a", "none", "null", "inf", "-inf")
PLAIN_NUMBER = r"^[-+]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?$"
FRACTION = r"^[+-]?[0-9]+\s*/\s*[+-]?[0-9]+$"
TABLE_RULE = r"^\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?$"
IMAGE_LINE = r"^!\[[^\]]*\]\([^)]+\)\s*$"
HINTS = (
    r"(?i)\b(?:Fig\.?|Figure)\s*S?[0-9]+[A-Za-z]?(?:[-,]\s*[A-Za-z])?",
    r"(?i)\bSupplementary\s+(?:Fig\.?|Figure)\s*[0-9]+[A-Za-z]?",
    r"(?i)\bfigure\s+[0-9]+[a-z]\b",
)
DOI = r"(?i)\b10\.[0-9]{4,9}/[-._;()/:A-Z0-9]+\b"


def given(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once a row, however often body names it, also inside of lambdas."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def comparison_text(c: Column) -> Column:
    """Lower case, one spelling of figure and table names, separators and other signs as spaces."""
    c = F.translate(F.lower(F.trim(given(c))), "−×", "-x")
    c = F.regexp_replace(c, SUPPLEMENTARY_FIGURE, "supplementary figure")
    c = F.regexp_replace(c, SUPPLEMENTARY_TABLE, "supplementary table")
    c = F.regexp_replace(c, r"(?U)\bfig\.", "figure")
    c = F.regexp_replace(c, r"[_\-]+", " ")
    return _spaces(F.regexp_replace(c, r"(?U)[^\w\s.+/%()^-]", " "))


def matcher_text(c: Column) -> Column:
    """As comparison_text, without rewriting names, and without ^."""
    c = F.translate(F.lower(F.trim(given(c))), "−×", "-x")
    c = F.regexp_replace(c, r"[_\-]+", " ")
    return _spaces(F.regexp_replace(c, r"(?U)[^\w\s.+/%()]", " "))


def compact_key(c: Column) -> Column:
    """Only a-z and 0-9 of the comparison text."""
    return F.regexp_replace(comparison_text(c), "[^a-z0-9]+", "")


def matcher_key(c: Column) -> Column:
    """T3 on the matcher text."""
    return F.regexp_replace(matcher_text(c), "[^a-z0-9]+", "")


def _item_key(supplementary: Column, table: Column, raw: Column) -> Column:
    kind = F.when(table, "table").otherwise("figure")
    name = F.when(supplementary | raw.startswith("s"), F.concat(F.lit("supplementary "), kind)).otherwise(kind)
    return F.concat_ws(" ", name, F.regexp_replace(raw, "^s", ""))


def item_key(*context: Column) -> Column:
    """T4: the figure or table that a text names, as ``[supplementary ]figure N[x]`` or ``... table N[x]``; empty if none.

    Five patterns are tried in order on the joined context; the first that matches decides.
    """
    return let(comparison_text(F.concat_ws(" ", *context)), _first_key)


def _first_key(text: Column) -> Column:
    no = F.lit(False)
    named, named_id = F.regexp_extract(text, KEY_NAMED, 1), F.regexp_extract(text, KEY_NAMED, 2)
    short, short_id = F.regexp_extract(text, KEY_SHORT, 1), F.regexp_extract(text, KEY_SHORT, 2)
    supp, s_figure, s_table = (F.regexp_extract(text, p, 1) for p in (KEY_SUPP, KEY_S_FIGURE, KEY_S_TABLE))
    return (
        F.when(named_id != "", _item_key(named.startswith("supp"), named.endswith("table"), named_id))
        .when(short_id != "", _item_key(no, short == "table", short_id))
        .when(supp != "", _item_key(~no, no, supp))
        .when(s_figure != "", _item_key(~no, no, s_figure))
        .when(s_table != "", _item_key(~no, ~no, s_table))
        .otherwise("")
    )


def panel_letter(*context: Column) -> Column:
    """T5: the letter at the end of the item key."""
    return F.regexp_extract(item_key(*context), "[0-9]+([a-z])$", 1)


def item_id(c: Column) -> Column:
    """An item identifier in a stable lower-case form, extended data and supplementary forms included."""
    c = F.translate(F.lower(F.trim(given(c))), "–—−", "---")
    c = F.regexp_replace(c, r"\s+", " ")
    for pattern, name in ITEM_REWRITES:
        c = F.regexp_replace(c, pattern, name)
    return F.btrim(F.regexp_replace(c, r"\s+", " "), F.lit(" .;,"))


def item_kind(c: Column) -> Column:
    """Table, figure or unknown."""
    text = item_id(c)
    return F.when(text.contains("table"), "table").when(text.contains("figure"), "figure").otherwise("unknown")


def is_supplementary(c: Column) -> Column:
    """Whether an identifier is of supplementary material."""
    text = item_id(c)
    return text.contains("supplementary") | text.rlike(r"\bfigure\s+s\d+") | text.rlike(r"\btable\s+s\d+")


def item_mentions(c: Column) -> Column:
    """Identifiers mentioned in a text: pattern by pattern, in order, each once."""
    found = F.concat(*[F.regexp_extract_all(given(c), F.lit(p), F.lit(1)) for p in MENTIONS])
    return F.array_distinct(F.filter(F.transform(found, item_id), lambda x: x != ""))


def search_terms(key: Column) -> Column:
    """Spellings under which a key may stand in a text."""
    return let(key, _spellings)


def _spellings(key: Column) -> Column:
    number = F.regexp_extract(key, r"([0-9]+[a-z]?)$", 1)
    supplementary, table = key.contains("supplementary"), key.contains("table")
    plain = F.when(table, F.array(F.concat(F.lit("table "), number))).otherwise(
        F.array(F.concat(F.lit("figure "), number), F.concat(F.lit("fig "), number), F.concat(F.lit("fig. "), number))
    )
    with_s = F.transform(plain, lambda x: F.regexp_replace(x, r" (?=[0-9])", " s"))
    named = F.transform(plain, lambda x: F.concat(F.lit("supplementary "), x))
    return F.array_distinct(F.when(key == "", F.array().cast("array<string>")).otherwise(F.concat(F.array(key), F.when(supplementary, F.concat(named, with_s)).otherwise(plain))))


def path_component(c: Column) -> Column:
    """A name that is safe in a path, of 120 characters at most."""
    text = F.btrim(F.regexp_replace(comparison_text(c), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(F.left(text, F.lit(120)), F.lit("")), F.lit("unknown"))


def number(c: Column) -> Column:
    """A finite number from text with thousands separators or a minus sign, else null."""
    text = F.replace(F.replace(F.trim(given(c)), F.lit(","), F.lit("")), F.lit("−"), F.lit("-"))
    value = F.when(text.rlike(PLAIN_NUMBER), F.expr("1")).isNotNull()
    parsed = text.try_cast("double")
    return F.when(value & ~F.isnan(parsed) & (F.abs(parsed) < float("inf")), parsed)


def percent_number(c: Column) -> Column:
    """The text of a number, thousands separators and a percent sign dropped, else empty."""
    text = F.trim(F.regexp_replace(F.replace(F.trim(given(c)), F.lit(","), F.lit("")), r"%$", ""))
    return F.when(text.rlike(PLAIN_NUMBER), text).otherwise("")


def numeric_like(c: Column) -> Column:
    """A number, percentage, fraction or a word for a missing number."""
    text = F.trim(given(c))
    plain = F.regexp_replace(text, ",", "")
    return (text != "") & (F.lower(text).isin(*MISSING_NUMBERS) | F.regexp_replace(plain, "%$", "").rlike(PLAIN_NUMBER) | plain.rlike(FRACTION))


def numbers_equal(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """Equal as text, or as numbers within the tolerance; two blanks are equal."""
    ta, tb = F.trim(given(a)), F.trim(given(b))
    return (ta == tb) | F.coalesce(F.abs(number(ta) - number(tb)) <= tolerance, F.lit(False))


def bool_text(c: Column) -> Column:
    """True, false or empty; other text counts as true."""
    text = F.lower(F.trim(given(c)))
    return F.when(text.isin(*FALSE_WORDS), "false").when(text == "", "").otherwise("true")


def context_text(payload: Column, excluded: tuple[str, ...] = ()) -> Column:
    """The values of a map that are not blank, by key, joined by bars; excluded names compare by compact key."""
    keys = F.array_sort(F.map_keys(payload))
    drop = [F.regexp_replace(F.lower(F.lit(x)), "[^a-z0-9]+", "") for x in excluded]
    if drop:
        keys = F.filter(keys, lambda k: ~compact_key(k).isin(*drop))
    values = F.transform(keys, lambda k: F.coalesce(F.try_element_at(payload, k), F.lit("")))
    return F.array_join(F.filter(values, lambda v: F.trim(v) != ""), " | ")


def split_list(c: Column) -> Column:
    """Parts between bars and semicolons, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(given(c), r"[|;]"), lambda x: F.trim(x)), lambda x: x != "")


def split_outside_brackets(c: Column) -> Column:
    """Parts between commas, semicolons and newlines that stand outside () and []."""
    return let(given(c), lambda text: F.filter(F.transform(F.when(text.rlike(r"[()\[\]]"), _outside_brackets(text)).otherwise(F.split(text, "[,;\n]")), lambda x: F.trim(x)), lambda x: x != ""))


def _outside_brackets(text: Column) -> Column:
    state = F.aggregate(
        F.split(text, ""),
        F.struct(F.lit(0).alias("depth"), F.lit("").alias("part"), F.array().cast("array<string>").alias("out")),
        lambda s, ch: F.when((s["depth"] <= 0) & ch.isin(",", ";", "\n"), F.struct(s["depth"].alias("depth"), F.lit("").alias("part"), F.array_append(s["out"], s["part"]).alias("out"))).otherwise(
            F.struct(
                (s["depth"] + F.when(ch.isin("(", "["), 1).when(ch.isin(")", "]") & (s["depth"] > 0), -1).otherwise(0)).alias("depth"),
                F.concat(s["part"], ch).alias("part"),
                s["out"].alias("out"),
            )
        ),
    )
    return let(state, lambda s: F.array_append(s["out"], s["part"]))


def sentence_text(c: Column) -> Column:
    """Markdown images dropped, links replaced by their text, marks and runs of space by one space."""
    c = F.regexp_replace(given(c), r"!\[[^\]]*\]\([^)]+\)", " ")
    c = F.regexp_replace(c, r"\[([^\]]+)\]\([^)]+\)", "$1")
    return _spaces(F.regexp_replace(c, r"[`*_>#]+", " "))


def item_hint(c: Column, fallback: Column) -> Column:
    """The first mention of a figure, else the fallback."""
    found = [F.nullif(F.regexp_extract(given(c), p, 0), F.lit("")) for p in HINTS]
    return F.coalesce(F.trim(F.regexp_replace(F.coalesce(*found), r"\s+", " ")), fallback)


def sentence_kind(sentence: Column, heading: Column, stem: Column) -> Column:
    """Section, caption, supplementary_caption, methods, title, body or unknown; the first rule that holds."""
    text = F.trim(given(sentence))
    low, head = F.lower(text), F.lower(given(heading))
    words = F.size(F.filter(F.split(text, r"\s+"), lambda x: x != ""))
    return (
        F.when(text.startswith("#"), "section")
        .when(low.rlike(r"^(fig\.?|figure|supplementary fig\.?|supplementary figure)\b"), F.when(low.contains("supplementary"), "supplementary_caption").otherwise("caption"))
        .when(head.rlike("method|materials|experimental"), "methods")
        .when((words <= 12) & title_case(text), "title")
        .when(F.lower(given(stem)).contains("supplement") & low.contains("fig"), "supplementary_caption")
        .when(F.char_length(text) > 30, "body")
        .otherwise("unknown")
    )


def title_case(c: Column) -> Column:
    """Whether each run of letters is a capital followed by small letters, and there is one."""
    return c.rlike(r"\p{L}") & ~c.rlike(r"\p{L}\p{Lu}") & ~c.rlike(r"(?<!\p{L})\p{Ll}")


def document_type(path: Column) -> Column:
    """Source data, reporting summary, supplementary information or main article, from the words of a path."""
    text = F.lower(given(path))
    return (
        F.when(text.rlike("source data|source_data|sourcedata"), "source_data")
        .when(text.rlike("reporting summary|reporting_summary"), "reporting_summary")
        .when(text.rlike("moesm|esm|supplementary|supplemental|supporting information"), "supplementary_information")
        .otherwise("main_article")
    )


def document_priority(kind: Column) -> Column:
    return F.when(kind == "main_article", 1).when(kind == "supplementary_information", 2).when(kind == "source_data", 3).when(kind == "reporting_summary", 4).otherwise(9)


def phrase_around(text: Column, value: Column, keywords: tuple[str, ...] = (), width: int = 320) -> Column:
    """A window of text from before the first hit of a value, of its parts of three characters or more, or of a keyword."""
    text = _spaces(given(text))
    low, value = F.lower(text), F.trim(given(value))
    parts = F.concat(F.array(value), F.filter(F.split(value, r"[_\s/-]+"), lambda p: F.char_length(p) >= 3))
    wanted = F.concat(F.filter(F.transform(parts, lambda p: F.lower(F.trim(p))), lambda p: p != ""), F.array(*[F.lit(k) for k in keywords]).cast("array<string>"))
    hit = F.filter(F.transform(wanted, lambda p: F.position(p, low)), lambda i: i > 0)
    start = F.greatest(F.lit(0), F.get(hit, F.lit(0)) - 1 - width // 2)
    found = F.btrim(F.substring(text, start + 1, F.lit(width)), F.lit(" ;,."))
    return F.when(text == "", "").when(F.size(hit) > 0, found).otherwise(F.left(text, F.lit(width)))


def head_middle_tail(c: Column, most: int) -> Column:
    """A long text's beginning, middle and end, a third of the limit each, with marks between; short texts whole."""
    part = most // 3
    mid = (F.char_length(c) / 2).cast("int") - part // 2
    mark = F.lit("\n...\n")
    cut = F.concat(F.left(c, F.lit(part)), mark, F.substring(c, mid + 1, F.lit(part)), mark, F.right(c, F.lit(part)))
    return F.when(F.char_length(given(c)) <= most, given(c)).otherwise(cut)


def keywords(*values: Column) -> Column:
    """Distinct words of three letters or digits or more, without stop words."""
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", *values)), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: (F.char_length(w) >= 3) & ~w.isin(*STOP_WORDS)))


def page_number(c: Column) -> Column:
    """A page from plain digits, a page mark, or the last number of a file name."""
    text = F.lower(F.trim(given(c)))
    found = [F.regexp_extract(text, p, 1) for p in (r"^([0-9]+)$", r"page[_\s-]*([0-9]+)", r"([0-9]+)[^0-9]*$")]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in found]).try_cast("int")


def table_line(c: Column) -> Column:
    """a row or rule of a markdown table."""
    text = F.trim(given(c))
    bars = F.char_length(text) - F.char_length(F.replace(text, F.lit("|"), F.lit("")))
    return (text.startswith("|") & text.endswith("|") & (bars >= 2)) | text.rlike(TABLE_RULE)


def useful_line(c: Column) -> Column:
    """neither blank, nor a table line or image, nor long with few letters."""
    text = F.trim(given(c))
    letters = F.char_length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return (text != "") & ~table_line(text) & ~text.rlike(IMAGE_LINE) & ~((F.char_length(text) > 2000) & (letters < F.char_length(text) * 0.25))


def natural_key(c: Column) -> Column:
    """O1: sorts by supplementary flag, figure before table before others, then with numbers by value."""
    text = comparison_text(c)
    padded = F.regexp_replace(F.regexp_replace(text, r"([0-9]+)", "00000000$1"), r"0*([0-9]{9})(?![0-9])", "$1")
    return F.concat(F.when(text.contains("supplementary"), "1").otherwise("0"), F.when(text.contains("figure"), "0").when(text.contains("table"), "1").otherwise("2"), padded)
