"""Personal data: fixed patterns, and terms that co-occurrence in the corpus shows to give the found entities away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import join_counted, save

KINDS = ("email", "ip", "card", "phone")
#: The same matches as the plain patterns of these kinds. Possessive loops and a look behind each start keep
#: the time in proportion to the text; \G lets a match begin where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{3,}+"
#: Characters before and after an entity in which its terms are sought.
NEAR = 120
#: Documents in which entity and term must stand near each other before their tie is judged.
SUPPORT = 2
#: Shares of an entity's information that a term may give away: above the first it is generalised, above the second removed.
GENERALISE, REMOVE = 0.75, 0.95

_SPAN = "array<struct<start:int,end:int,value:string>>"
#: Matches that are walked at a time, and characters of a page of text.
_WALK, _PAGE = 128, 1024
_MASK = (1 << 63) - 1


def found_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, value), in code points, end exclusive.

    Places are running sums. An array that grows by one is copied each time, so matches are walked in blocks,
    and only the list of blocks grows: a text of very many matches takes time in proportion.
    """
    empty = F.array().cast(_SPAN)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(found, F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda m, b: F.struct(m.alias("m"), F.char_length(b).alias("gap")))

    def step(acc: Column, x: Column) -> Column:
        start, end = acc["at"] + x["gap"], acc["at"] + x["gap"] + F.char_length(x["m"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"))).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        walked = F.aggregate(part, F.struct(acc["at"].alias("at"), empty.alias("out")), step)
        return F.transform(F.array(walked), lambda w: F.struct(w["at"].alias("at"), F.array_append(acc["outs"], w["out"]).alias("outs")))[0]

    def walk(all_: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / _WALK).cast("int")), lambda i: F.slice(all_, i * _WALK + 1, F.lit(_WALK)))
        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("outs")), block, lambda acc: F.flatten(acc["outs"]))

    return F.when(text.rlike(pattern), F.transform(F.array(pieces), walk)[0]).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit doubled, and nines cast out."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.char_length(digits)),
        F.lit(0),
        lambda acc, i: acc + F.element_at(
            F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(digits, F.char_length(digits) - i + 1, F.lit(1)).cast("int") + 1
        ) * F.pmod(i + 1, F.lit(2)) + F.substring(digits, F.char_length(digits) - i + 1, F.lit(1)).cast("int") * F.pmod(i, F.lit(2)),
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.char_length(part(p)) <= 3) & (F.coalesce(F.try_to_number(F.right(F.concat(F.lit("000"), part(p)), F.lit(3)), F.lit("999")), F.lit(0)) <= 255))
    n = F.char_length(_digits(value))
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(13, 19), luhn(_digits(value))).otherwise(F.lit(False))


def _passing(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _as_kind(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def _of_kind(kind: str, spans: Column | str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind, the spans of its pattern that pass the kind's test."""
    sign = {"email": "@", "phone": "+", "ip": "."}
    out = {}
    for kind in KINDS:
        possible = F.contains(text, F.lit(sign[kind])) if kind in sign else text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")
        out[kind] = F.when(possible, _passing(kind, found_spans(text, PATTERNS[kind]))).otherwise(F.array().cast(_SPAN))
    return out


def contexts(text: Column, base: Column) -> Column:
    """For each base span: kind, value in lower case, what stands around it, where that begins, and the base spans that reach into it.

    What stands around comes from the pages that hold it, and its spans from the blocks of spans that reach
    into it, so that no span is compared with all others of a text.
    """

    def block(part: Column) -> Column:
        spans = F.transform(part, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.struct(F.array_min(F.transform(part, lambda s: s["start"])).alias("low"), F.array_max(F.transform(part, lambda s: s["end"])).alias("high"), spans.alias("spans"))

    pages = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PAGE}}}"), F.lit(0))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(base) - 1) / _WALK).cast("int")), lambda i: block(F.slice(base, i * _WALK + 1, F.lit(_WALK))))

    def one(w: Column, s: Column) -> Column:
        at = F.greatest(s["start"] - NEAR, F.lit(0))
        till = at + s["end"] - s["start"] + 2 * NEAR
        page = F.floor(at / _PAGE).cast("int")
        held = F.array_join(F.slice(w["pages"], page + 1, F.floor(till / _PAGE).cast("int") - page + 1), "")
        reaching = F.flatten(F.transform(F.filter(w["blocks"], lambda b: (b["low"] < till) & (b["high"] > at)), lambda b: F.filter(b["spans"], lambda x: (x["start"] < till) & (x["end"] > at))))
        return F.struct(s["kind"].alias("kind"), F.lower(s["value"]).alias("value"), at.alias("at"), F.substring(held, at - page * _PAGE + 1, till - at).alias("around"), reaching.alias("base"))

    # the array of one names what is worked out once for a text
    return F.transform(F.array(F.struct(pages.alias("pages"), blocks.alias("blocks"))), lambda w: F.transform(base, lambda s: one(w, s)))[0]


def _written(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))


def disclosing_terms(near: DataFrame, texts: DataFrame) -> DataFrame:
    """entity, term, share for ties above GENERALISE, by key with the number of places they occur.

    share = PMI(entity; term) / information of the entity, from numbers of documents: all of them, those
    with the entity, those with the term anywhere, and those where the two stand near each other.
    """
    total = texts.count()
    pairs = near.select("id", "h", "entity", "term").distinct().groupBy("entity", "term").agg(F.count("*").alias("both")).filter(F.col("both") >= SUPPORT)
    entities = near.select("id", "h", "entity").distinct().groupBy("entity").agg(F.count("*").alias("of_entity"))
    words = texts.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("term")).filter(F.char_length("term") >= 3)
    of_term = words.groupBy("term").agg(F.count("*").alias("of_term"))
    pairs = save(pairs)
    tied = pairs.join(entities, "entity").join(of_term, "term")
    pmi = F.log2(F.col("both") * F.lit(float(max(1, total))) / (F.col("of_entity") * F.greatest("of_term", "both")))
    own = F.log2(F.lit(float(max(2, total))) / F.col("of_entity"))
    return save(tied.withColumn("share", F.when(own > 0, pmi / own).otherwise(0.0)).filter(F.col("share") >= GENERALISE).select("entity", "term", "share", "both"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (and the sanitised text) for every row of docs.

    Base spans come from the patterns. Around them, terms (runs of three letters or more) whose tie to the
    entity gives away too much of its information become spans of kind ``general`` or ``removed``; those
    that overlap a base span are left out. Null and empty texts have no spans. Rows that repeat an id and
    its text are alike. In sanitised texts base spans and general terms are replaced by their kind, removed
    terms go. Other columns of docs are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    flat = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    spans = base_spans(F.col("text"))
    every = F.flatten(F.array(*[_as_kind(k, spans[k]) for k in KINDS]))
    marked = flat.select("id", "h", "text", every.alias("base"))
    marked = save(marked.select("id", "h", "base", F.when(F.size("base") > 0, contexts(F.col("text"), F.col("base"))).alias("context")))
    around = marked.select("id", "h", F.explode("context").alias("c"))
    near = around.select(
        "id", "h", "c.base", F.concat_ws(":", "c.kind", "c.value").alias("entity"), F.col("c.at").alias("at"),
        F.explode(found_spans(F.col("c.around"), TERM)).alias("t"),
    ).select(
        "id", "h", "base", "entity", (F.col("at") + F.col("t.start")).alias("start"), (F.col("at") + F.col("t.end")).alias("end"), F.lower("t.value").alias("term")
    ).filter(~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))).drop("base")
    near = save(near)
    ties = disclosing_terms(near, flat)
    key = F.xxhash64("entity", "term").bitwiseAND(F.lit(_MASK)).alias("key")
    facts = ties.select(key, F.struct("entity", "term", "share").alias("one"), "both").groupBy("key").agg(F.collect_list("one").alias("ones"), F.sum("both").alias("n"))
    rows = near.select("id", "h", "entity", "term", "start", "end", key)
    own = F.filter("ones", lambda x: (x["entity"] == F.col("entity")) & (x["term"] == F.col("term")))[0]["share"]
    told = join_counted(rows, facts, "key", "n").withColumn("share", own).filter("share is not null")
    told = told.groupBy("id", "h", "start", "end").agg(F.max("share").alias("share"))
    told = told.groupBy("id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.when(F.col("share") >= REMOVE, "removed").otherwise("general").alias("kind")))).alias("terms"))
    told = told.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "terms")
    joined = marked.select("id", "h", "base").join(told, (F.col("h") == F.col("_h")) & F.col("id").eqNullSafe(F.col("_id")), "left")
    no_terms = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    joined = joined.withColumn("terms", F.coalesce("terms", no_terms))
    base = _written(F.col("base"))
    out = joined.select(
        F.col("id").alias("doc_id"), "h",
        *[F.size(_of_kind(k, "base")).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _written(_of_kind("general", "terms")), _written(_of_kind("removed", "terms"))), ",").alias("spans"),
        F.concat(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))), F.col("terms")).alias("all"),
    )
    if not texts:
        return out.drop("h", "all")
    whole = flat.select(F.col("id").alias("_id"), F.col("h").alias("_h"), "text").distinct()
    out = out.join(whole, (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return out.withColumn("sanitised", sanitised(F.col("text"), F.col("all"))).drop("h", "all", "_id", "_h", "text")


def sanitised(text: Column, spans: Column) -> Column:
    """text with spans replaced by [KIND], those of kind removed left out; of spans that overlap, what the first leaves."""
    built = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))),
            ).alias("out"),
        )),
    )
    return F.concat(built["out"], F.substring(text, built["at"] + 1, F.char_length(text)))


def op10_pii(spark, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
