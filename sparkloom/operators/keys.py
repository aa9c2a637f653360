"""Join keys for texts that contain one another or share most of their tokens, so that no row meets all others of its block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def own_gram(text: Column) -> Column:
    """What any text that contains this one has among its grams: its first characters."""
    return F.left(text, F.lit(GRAM))


def all_grams(text: Column) -> Column:
    """Every run of one to GRAM characters, each once."""

    def runs(n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.char_length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))
        return F.when(F.char_length(text) >= n, every).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(n) for n in range(1, GRAM + 1)]))


def token_prefix(text: Column, share: float) -> Column:
    """Tokens of which two texts have one in common if they share ``share`` of all their tokens: the first few in the order of a hash."""
    tokens = F.array_sort(F.transform(F.array_distinct(F.split(text, " ")), lambda t: F.struct(F.xxhash64(t).alias("h"), t.alias("t"))))
    few = F.size(tokens) - F.ceil(F.size(tokens) * share - 1e-9).cast("int") + 1
    return F.transform(F.slice(tokens, F.lit(1), few), lambda x: x["t"])


def tagged(tag: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(tag), k))


def keyed_join(left: DataFrame, right: DataFrame, on: list[str], lefts: str, rights: str) -> DataFrame:
    """Pairs of rows that share a key of two array columns, each pair once: where it meets at the smallest key they share.

    Neither side is sent whole: a row has many keys, which the size of the table does not tell. Keys tagged S are one
    a row on the left, where they come first, and keys tagged T one a row on the right: such a pair meets once under each.
    """
    a, b = left.withColumn("_key", F.explode(lefts)), right.withColumn("_key", F.explode(rights))
    both = a.join(b.hint("merge"), [*on, "_key"])
    once = (
        F.when((F.size(lefts) == 1) | (F.size(rights) == 1) | F.col("_key").startswith("S"), True)
        .when(F.col("_key").startswith("T"), ~F.array_contains(rights, F.get(lefts, F.lit(0))))
        .otherwise(F.col("_key") == F.array_min(F.array_intersect(lefts, rights)))
    )
    return both.filter(once).drop("_key", lefts, rights)


def mutually_contained(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str) -> DataFrame:
    """Pairs of rows of a block whose texts a and b are not blank and one of which contains the other."""
    l = left.filter(F.col(a) != "").withColumn("_l", F.concat(tagged("S", F.array(own_gram(F.col(a)))), tagged("T", all_grams(F.col(a)))))
    r = right.filter(F.col(b) != "").withColumn("_r", F.concat(tagged("S", all_grams(F.col(b))), tagged("T", F.array(own_gram(F.col(b))))))
    return keyed_join(l, r, on, "_l", "_r").filter(F.contains(a, F.col(b)) | F.contains(b, F.col(a)))
