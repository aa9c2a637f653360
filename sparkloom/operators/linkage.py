"""Plan-driven record linkage inside blocking partitions, conflict rules, and the fill-merge of linked values.

Rows carry ``partition_key``, an id and a payload map of text. A plan is one row per partition: value
columns, relations (source and target columns, mode, required, value pairs), fixed target values,
confidence and needs_review. Plans are exploded to relations; nothing is decided on the driver.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import matcher_text
from ..sources.stage import written
from .keys import all_grams, keyed_join, own_gram, tagged, token_prefix

RELATION = "struct<source_columns:array<string>,target_columns:array<string>,mode:string,required:boolean,value_pairs:array<struct<source_values:array<string>,target_values:array<string>>>>"
PLAN = f"partition_key string, source_value_column string, target_value_column string, relations array<{RELATION}>, fixed array<struct<column:string,value:string>>, confidence string, needs_review boolean"

#: Bands of the additive score.
HIGH, MEDIUM, LOW = 75, 60, 45
OVERLAP = 0.8


def cells(payload: str, columns: str) -> Column:
    """Normalised values of the named columns of a payload map; a missing column is empty."""
    return _cells(payload, F.col(columns))


def _cells(payload: str, columns: Column) -> Column:
    return F.transform(columns, lambda c: matcher_text(F.coalesce(F.try_element_at(F.col(payload), c), F.lit(""))))


def value_of(payload: str, column: str) -> Column:
    return F.coalesce(F.try_element_at(F.col(payload), F.col(column)), F.lit(""))


def token_overlap(a: Column, b: Column) -> Column:
    """Shared over all distinct tokens of two texts."""
    ta, tb = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    both = F.size(F.array_intersect(ta, tb))
    return both / (F.size(ta) + F.size(tb) - both)


def contains_either_way(source: Column, target: Column) -> Column:
    """Every source value in the joined target text, or every target value in the joined source text."""
    joined_s, joined_t = F.array_join(source, " "), F.array_join(target, " ")
    return F.forall(source, lambda v: F.contains(joined_t, v)) | F.forall(target, lambda v: F.contains(joined_s, v))


def _relations(plans: DataFrame) -> DataFrame:
    """partition_key, rel, columns, mode, required, value pairs with normalised sides, and the key mode of the relation."""
    r = plans.select("partition_key", F.posexplode("relations").alias("rel", "r")).select("partition_key", "rel", "r.*")
    clean = F.transform(
        F.coalesce("value_pairs", F.array().cast("array<struct<source_values:array<string>,target_values:array<string>>>")),
        lambda p: F.struct(F.transform(p["source_values"], lambda x: matcher_text(x)).alias("s"), F.transform(p["target_values"], lambda x: matcher_text(x)).alias("t")),
    )
    return r.withColumn("pairs", clean).drop("value_pairs")


def mapped_target(source: Column, pairs: Column) -> Column:
    """What the first pair with these source values maps to; null if none has them."""
    return F.get(F.filter(pairs, lambda p: p["s"] == source), F.lit(0))["t"]


def relation_matches(source: Column, target: Column, mapped: Column, mode: Column) -> Column:
    """J3-J6 for one relation: blanks fail; what a pair with the source values maps to decides; else the mode does."""
    blank = F.exists(F.concat(source, target), lambda v: v == "")
    by_mode = (
        F.when(mode == "exact", source == target)
        .when(mode == "contains", contains_either_way(source, target))
        .when(mode == "token_overlap", token_overlap(F.array_join(source, " "), F.array_join(target, " ")) >= OVERLAP)
        .otherwise(False)
    )
    return ~blank & F.when(mapped.isNotNull(), mapped == target).otherwise(by_mode)


def _longest(values: Column) -> Column:
    return F.array_max(F.transform(values, lambda v: F.struct(F.char_length(v).alias("n"), v.alias("v"))))["v"]


def _source_keys(cells_: Column, mode: Column, mapped: Column) -> Column:
    """Keys under which a source can meet the targets that its plan's first relation allows; none if a cell is blank."""
    joined, whole = F.array_join(cells_, " "), lambda c: tagged("M", F.array(F.array_join(c, "\u0001")))
    none = F.array().cast("array<string>")
    by_mode = (
        F.when(mode == "exact", whole(cells_)).when(mode == "token_overlap", tagged("W", token_prefix(joined, OVERLAP)))
        .when(mode == "contains", F.concat(tagged("S", F.array(own_gram(_longest(cells_)))), tagged("T", all_grams(joined)))).otherwise(none)
    )
    keys = F.when(F.exists(cells_, lambda v: v == ""), none).when(mapped.isNotNull(), whole(mapped)).otherwise(by_mode)
    return F.when(F.col("k").isNull(), F.array(F.lit(""))).otherwise(keys)


def _target_keys(cells_: Column, mode: Column) -> Column:
    joined, none = F.array_join(cells_, " "), F.array().cast("array<string>")
    by_mode = (
        F.when(mode == "token_overlap", tagged("W", token_prefix(joined, OVERLAP)))
        .when(mode == "contains", F.concat(tagged("S", all_grams(joined)), tagged("T", F.array(own_gram(_longest(cells_)))))).otherwise(none)
    )
    keys = F.when(F.exists(cells_, lambda v: v == ""), none).otherwise(F.concat(tagged("M", F.array(F.array_join(cells_, "\u0001"))), by_mode))
    return F.when(F.col("k").isNull(), F.array(F.lit(""))).otherwise(keys)


class Links(NamedTuple):
    """Links of classes, where a class is all rows of a partition and side with the same compared cells.

    sources: partition_key, source_id, extracted, s_cells. targets: partition_key, target_id, existing, t_cells. met:
    partition_key, s_cells, t_cells, score. plans: partition_key and what all links of a partition have.
    """

    sources: DataFrame
    targets: DataFrame
    met: DataFrame
    plans: DataFrame


def _sides(sources: DataFrame, targets: DataFrame, plans: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Plans that can link; sources and targets with their compared cells, as ``Links`` has them; and what all links of a partition have."""
    usable = plans.filter((F.col("source_value_column") != "") & (F.col("target_value_column") != "") & (F.size("relations") > 0))
    fields = F.array_join(F.transform("relations", lambda r: F.concat(F.array_join(r["source_columns"], "+"), F.lit("->"), F.array_join(r["target_columns"], "+"))), "|")
    of_plan = usable.select("partition_key", fields.alias("fields"), "confidence", "needs_review", "source_value_column", "target_value_column")
    fixed = F.coalesce("fixed", F.array().cast("array<struct<column:string,value:string>>"))
    columns = usable.select("partition_key", "source_value_column", "target_value_column", F.transform("relations", lambda r: r["source_columns"]).alias("s_columns"), F.transform("relations", lambda r: r["target_columns"]).alias("t_columns"), fixed.alias("fixed"))

    side = lambda rows, own, payload, id_: rows.select("partition_key", F.col("id").alias(id_), F.col("payload").alias(payload)).join(own, "partition_key")
    s = side(sources, columns.select("partition_key", "source_value_column", "s_columns"), "sp", "source_id")
    s = s.select("partition_key", "source_id", value_of("sp", "source_value_column").alias("extracted"), F.transform("s_columns", lambda c: _cells("sp", c)).alias("s_cells"))
    # Constants that the target must have
    holds = F.forall("fixed", lambda f: matcher_text(F.coalesce(F.try_element_at("tp", f["column"]), F.lit(""))) == matcher_text(f["value"]))
    t = side(targets, columns.select("partition_key", "target_value_column", "t_columns", "fixed"), "tp", "target_id").filter(holds)
    t = t.select("partition_key", "target_id", value_of("tp", "target_value_column").alias("existing"), F.transform("t_columns", lambda c: _cells("tp", c)).alias("t_cells"))
    return usable, s, t, of_plan


def linked_classes(sources: DataFrame, targets: DataFrame, plans: DataFrame, strict: bool = True) -> Links:
    """J2 between classes: whether a plan allows a pair depends on the compared cells alone, so equal rows are compared once.

    The first required relation, one that can be looked up (exact or value map) before others, gives equi-join
    keys beside the partition: its values, the tokens of which two texts that overlap enough share one, or the
    characters that a text shares with one that contains it. Classes with blank cells in it meet nothing. Only
    partitions of plans without a required relation compare all their classes. Value pairs stay with the classes
    of sources; neither they nor keys go along with rows.
    """
    usable, s, t, of_plan = _sides(sources, targets, plans)
    rel = _relations(usable)
    order = F.struct((~F.col("mode").isin("exact", "value_map")).alias("slow"), "rel")
    first = F.min_by("rel", F.when(F.col("required"), order)).alias("k")
    rules = rel.groupBy("partition_key").agg(F.array_sort(F.collect_list(F.struct("rel", "mode", "required", "pairs"))).alias("rels"), first)
    light = rules.select("partition_key", "k", F.transform("rels", lambda r: F.struct(r["mode"].alias("mode"), r["required"].alias("required"))).alias("t_rels"))

    sc = s.select("partition_key", "s_cells").distinct().join(rules, "partition_key")
    sc = sc.withColumn("s_mapped", F.transform("rels", lambda r, i: mapped_target(F.get("s_cells", i), r["pairs"])))
    sc = sc.withColumn("s_keys", _source_keys(F.get("s_cells", F.col("k")), F.get("rels", F.col("k"))["mode"], F.get("s_mapped", F.col("k")))).drop("k", "rels")
    tc = t.select("partition_key", "t_cells").distinct().join(light, "partition_key")
    tc = tc.withColumn("t_keys", _target_keys(F.get("t_cells", F.col("k")), F.get("t_rels", F.col("k"))["mode"])).drop("k")
    both = keyed_join(sc, tc, ["partition_key"], "s_keys", "t_keys")
    met = F.transform(
        "t_rels",
        lambda r, i: F.struct(relation_matches(F.get("s_cells", i), F.get("t_cells", i), F.get("s_mapped", i), r["mode"]).alias("met"), r["required"].alias("required")),
    )
    both = both.select("partition_key", "s_cells", "t_cells", met.alias("met")).filter(F.forall("met", lambda m: m["met"] | ~m["required"]))
    constants = F.size(F.coalesce("fixed", F.array().cast("array<struct<column:string,value:string>>")))
    both = both.join(usable.select("partition_key", constants.alias("constants")), "partition_key")
    need = F.size(F.filter("met", lambda m: m["required"])) + F.col("constants")
    have = F.size(F.filter("met", lambda m: m["met"] & (m["required"] | F.lit(strict)))) + F.col("constants")
    both = both.withColumn("need", need).withColumn("have", have).filter((F.col("need") > 0) & (F.col("have") == F.col("need")))
    return Links(s, t, both.select("partition_key", "s_cells", "t_cells", F.bround(100 * F.col("have") / F.col("need"), 0).cast("int").alias("score")), of_plan)


def looked_up_classes(sources: DataFrame, targets: DataFrame, plans: DataFrame, pairs: DataFrame) -> Links:
    """As ``linked_classes``, for plans whose relations are all required and exact or value maps, with their value pairs in a table.

    pairs: partition_key, rel (the relation's place, from 0), source_values, target_values, once for each compared
    source values. What a class of sources wants of a target follows from its cells and the pairs, so that it is
    looked up whole: no pairs lie in one row, and no classes meet that are not linked.
    """
    usable, s, t, of_plan = _sides(sources, targets, plans)
    s, t = written(s), written(t)
    clean = lambda c: F.transform(c, lambda v: matcher_text(v))
    table = pairs.select("partition_key", "rel", clean("source_values").alias("s"), clean("target_values").alias("mapped"))
    modes = usable.select("partition_key", F.posexplode("relations").alias("rel", "r")).select("partition_key", "rel", "r.mode")
    each = s.select("partition_key", "s_cells").distinct().select("partition_key", "s_cells", F.posexplode("s_cells").alias("rel", "s")).join(modes, ["partition_key", "rel"])
    each = each.join(table.hint("merge"), ["partition_key", "rel", "s"], "left").withColumn("t", F.coalesce("mapped", F.when(F.col("mode") == "exact", F.col("s"))))
    meets = F.col("t").isNotNull() & ~F.exists(F.concat("s", "t"), lambda v: v == "")
    wanted = each.groupBy("partition_key", "s_cells").agg(F.bool_and(meets).alias("meets"), F.transform(F.array_sort(F.collect_list(F.struct("rel", "t"))), lambda x: x["t"]).alias("t_cells"))
    met = wanted.filter("meets").join(t.select("partition_key", "t_cells").distinct().hint("merge"), ["partition_key", "t_cells"])
    return Links(s, t, met.select("partition_key", "s_cells", "t_cells", F.lit(100).alias("score")), of_plan)


def _expanded(links: Links, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """The links of rows; the larger sides are never sent whole, whatever the size of their files suggests."""
    met = links.met.join(links.plans, "partition_key")
    return sources.hint("merge").join(met, ["partition_key", "s_cells"]).join(targets.hint("merge"), ["partition_key", "t_cells"])


LINKED = ("partition_key", "source_id", "target_id", "score", "fields", "confidence", "needs_review", "source_value_column", "target_value_column", "extracted", "existing")


def linked_pairs(sources: DataFrame, targets: DataFrame, plans: DataFrame, strict: bool = True) -> DataFrame:
    """source_id, target_id, score, fields for each pair that every required relation and fixed value of its plan allows.

    sources and targets have partition_key, an id and payload. Classes of equal rows are linked first
    (``linked_classes``), and their rows meet by equi-joins. ``strict`` keeps the rule that a met optional
    relation counts as met, so that a pair that meets one besides all required ones has a score over 100 and is
    not accepted.
    """
    links = linked_classes(sources, targets, plans, strict)
    return _expanded(links, links.sources, links.targets).select(*LINKED)


REASONS = (
    "one source row matches multiple target rows under the mapping plan",
    "target value column already filled: ",
    "source value column is empty: ",
    "multiple source rows map to one target row",
)


def resolve_conflicts(pairs: DataFrame) -> DataFrame:
    """Pairs with accepted, manual_required and conflict_reason.

    A source with several targets is refused first; then targets filled already and empty sources; then all
    sources of a target that would take several, where those refused before do not count.
    """
    per_source = Window.partitionBy("source_id")
    per_target = Window.partitionBy("target_id")
    out = pairs.withColumn("targets", F.count("*").over(per_source)).withColumn("reason", _reason())
    return _verdicts(out.withColumn("takers", F.count_if(F.col("reason").isNull()).over(per_target)), pairs.columns)


def _reason() -> Column:
    """Why a pair is refused, but for targets that several would fill."""
    return (
        F.when(F.col("targets") > 1, REASONS[0])
        .when(F.col("existing") != "", F.concat(F.lit(REASONS[1]), F.col("target_value_column")))
        .when(F.col("extracted") == "", F.concat(F.lit(REASONS[2]), F.col("source_value_column")))
    )


def _verdicts(pairs: DataFrame, columns: list[str]) -> DataFrame:
    crowded = F.col("reason").isNull() & (F.col("takers") > 1)
    out = pairs.withColumn("accepted", F.col("reason").isNull() & ~crowded)
    return out.select(
        *columns, "accepted", (crowded | (F.col("needs_review") & ~F.col("accepted"))).alias("manual_required"),
        F.when(crowded, REASONS[3]).otherwise(F.coalesce("reason", F.lit(""))).alias("conflict_reason"),
    )


class Judged(NamedTuple):
    """What J8 needs to know of rows, without the pairs: links, whose sources have ``n`` and ``targets`` (with how many
    targets a row and its id link; those without any are left out) and whose targets have ``takers`` (how many sources that are not refused would fill a target id);
    accepted: the pairs that are, one at most for each source and target; crowded: those refused for a target that
    several would fill.
    """

    links: Links
    accepted: DataFrame
    crowded: DataFrame


def judged(sources: DataFrame, targets: DataFrame, plans: DataFrame, strict: bool = True, pairs: DataFrame | None = None) -> Judged:
    """J8 by classes: as ``resolve_conflicts`` of ``linked_pairs``, but work grows with rows, not with pairs.

    Targets of a source are counted by class; only sources with a single one are joined with it. ``pairs``: value
    pairs that plans do not hold themselves, as ``looked_up_classes`` takes them.
    """
    found = linked_classes(sources, targets, plans, strict) if pairs is None else looked_up_classes(sources, targets, plans, pairs)
    s, t = (written(found.sources), written(found.targets)) if pairs is None else found[:2]
    met = written(found.met)
    held = t.groupBy("partition_key", "t_cells").agg(F.count("*").alias("n"))
    per = met.join(held.hint("merge"), ["partition_key", "t_cells"]).groupBy("partition_key", "s_cells").agg(F.sum("n").alias("n"))
    s = s.join(per.hint("merge"), ["partition_key", "s_cells"]).withColumn("targets", F.sum("n").over(Window.partitionBy("source_id")))
    s = written(s)
    free = s.filter("targets = 1 and extracted <> ''").drop("n")
    single = written(_expanded(Links(s, t, met, found.plans), free, t.filter("existing = ''")).select(*LINKED))
    takers = single.groupBy(F.col("target_id").alias("_id")).agg(F.count("*").alias("takers"))
    t = t.join(takers.hint("merge"), t.target_id.eqNullSafe(takers["_id"]), "left").drop("_id").withColumn("takers", F.coalesce("takers", F.lit(0)))
    counted = single.join(takers.hint("merge"), single.target_id.eqNullSafe(takers["_id"]))
    accepted, crowded = (counted.filter(c).select(*LINKED, F.lit(c == "takers = 1").alias("accepted")) for c in ("takers = 1", "takers > 1"))
    return Judged(Links(s, t, met, found.plans), accepted, crowded)


def resolved_pairs(j: Judged) -> DataFrame:
    """Pairs with accepted, manual_required and conflict_reason, judged before they are formed."""
    both = _expanded(j.links, j.links.sources, j.links.targets).withColumn("reason", _reason())
    return _verdicts(both, list(LINKED))


def pair_counts(j: Judged) -> DataFrame:
    """One row: candidates, accepted, conflicts, and manual of the pairs of ``resolved_pairs``, which are not formed."""
    rows = j.links.sources.join(j.links.plans.select("partition_key", "needs_review"), "partition_key")
    every = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"), F.coalesce(F.sum(F.when(F.col("needs_review"), F.col("n"))), F.lit(0)).alias("review"))
    good = j.accepted.agg(F.count("*").alias("accepted"), F.count_if("needs_review").alias("good_review"))
    # crowded pairs ask for a look in any partition; those of reviewed ones are counted there
    crowded = j.crowded.agg(F.count_if(~F.coalesce("needs_review", F.lit(False))).alias("crowded"))
    return every.crossJoin(good).crossJoin(crowded).select("candidates", "accepted", (F.col("candidates") - F.col("accepted")).alias("conflicts"), (F.col("review") - F.col("good_review") + F.col("crowded")).alias("manual"))


def unmatched(rows: DataFrame, accepted: DataFrame, id_name: str) -> DataFrame:
    """Rows of one side that no accepted pair has."""
    return rows.join(accepted.filter("accepted").select(F.col(id_name).alias("id")), "id", "left_anti")


def unpaired_partitions(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Partitions with rows on one side only."""
    s = sources.groupBy("partition_key").agg(F.count("*").alias("source_rows"))
    t = targets.groupBy("partition_key").agg(F.count("*").alias("target_rows"))
    both = s.join(t, "partition_key", "full_outer").filter("source_rows is null or target_rows is null")
    return both.select("partition_key", F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"))


def merge_values(targets: DataFrame, candidates: DataFrame, order: Column) -> DataFrame:
    """Target rows with the first accepted value filled in, the step at which it was, and the running total.

    Steps are partitions in natural order; a cell that is filled already stays. Snapshots are rows with
    filled_step up to a step: one table instead of one for each step.
    """
    first = Window.partitionBy("target_id").orderBy(F.col("source_id"))
    good = candidates.filter("accepted").withColumn("rank", F.row_number().over(first)).filter("rank = 1")
    steps = targets.select("partition_key").distinct().withColumn("sort_key", order)
    steps = steps.select("partition_key", F.dense_rank().over(Window.orderBy("sort_key")).alias("step"))  # as many rows as partitions
    filled = targets.join(good.select(F.col("target_id").alias("id"), "extracted", "source_id"), "id", "left").join(steps, "partition_key")
    return filled.withColumn("filled_step", F.when(F.col("source_id").isNotNull(), F.col("step")))


def merge_progress(merged: DataFrame) -> DataFrame:
    """Per step, values inserted and inserted so far."""
    per = merged.groupBy("step", "partition_key").agg(F.count("filled_step").alias("inserted"))
    return per.withColumn("inserted_so_far", F.sum("inserted").over(Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)))


def confidence(score: Column) -> Column:
    """The band of an additive score."""
    return F.when(score >= HIGH, "high").when(score >= MEDIUM, "medium").when(score >= LOW, "low").otherwise("conflict")


def scored_linkage(left: DataFrame, right: DataFrame, by: str, signals: dict[str, int], base: int, least: int) -> DataFrame:
    """A, b, score, confidence, fields: pairs of a block with an additive score of ``least`` or more.

    left: by, a and a column for each signal; right: by, b and the same columns, already normalised. Each
    equal, not blank signal adds its points to the base. Rows of a block with the same signals are one class;
    classes are paired and scored once, and their rows are joined last. Pairs of classes come from equi-joins on
    the smallest sets of signals that reach ``least``, so a block's classes do not all meet.
    """
    names = list(signals)
    enough = [set(c) for n in range(1, len(names) + 1) for c in combinations(names, n) if base + sum(signals[x] for x in c) >= least]
    smallest = [c for c in enough if not any(d < c for d in enough)]
    left_classes, right_classes = (rows.select(by, *names).distinct() for rows in (left, right))
    out = None
    for c in smallest:
        on = sorted(c)
        l = left_classes.filter(F.forall(F.array(*[F.col(x).cast("string") for x in on]), lambda v: F.coalesce(v != "", F.lit(False))))
        met = l.select(by, *[F.col(x).alias(f"l_{x}") for x in names]).join(right_classes.select(F.col(by).alias("_by"), *[F.col(x).alias(f"r_{x}") for x in names]), (F.col(by) == F.col("_by")) & reduce(lambda p, q: p & q, [F.col(f"l_{x}") == F.col(f"r_{x}") for x in on])).drop("_by")
        # a pair counts with the first of the sets that it meets
        before = [reduce(lambda p, q: p & q, [same(x) for x in d]) for d in smallest[: smallest.index(c)]]
        met = met.filter(~reduce(lambda p, q: p | q, before)) if before else met
        out = met if out is None else out.unionByName(met)
    score = sum((F.when(same(x), n).otherwise(0) for x, n in signals.items()), F.lit(base))
    fields = F.array_join(F.array_compact(F.array(*[F.when(same(x), x) for x in names])), "|")
    class_of = lambda p="": F.struct(*[F.col(f"{p}{x}").alias(x) for x in names])
    met = out.select(by, class_of("l_").alias("_l"), class_of("r_").alias("_r"), score.alias("score"), confidence(score).alias("confidence"), fields.alias("fields"))
    a, b = left.select(by, "a", class_of().alias("_l")), right.select(by, "b", class_of().alias("_r"))
    both = a.hint("merge").join(met, [by, "_l"]).join(b.hint("merge"), [by, "_r"])
    return both.select(by, "a", "b", "score", "confidence", "fields")


def same(signal: str) -> Column:
    """Whether both sides say the same, and something."""
    l, r = F.col(f"l_{signal}"), F.col(f"r_{signal}")
    return F.coalesce((l == r) & (l.cast("string") != ""), F.lit(False))
