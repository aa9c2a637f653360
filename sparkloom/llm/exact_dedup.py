"""Exact deduplication by deterministic block naming, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import join_counted, lower_ascii, save

BLOCK = 2048


def blocks_of(text: Column, block: int = BLOCK) -> Column:
    """Fixed-size blocks in order; the last may be shorter, and an empty text is one empty block."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    )


def named(distinct: DataFrame, *by: str) -> DataFrame:
    """Integer names for distinct rows: those of a hash partition are sorted and counted on from the partition's base."""
    return distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _named_blocks(rows: DataFrame, block: int) -> tuple[DataFrame, int]:
    """Names of all distinct blocks under a fingerprint that is proven to tell them apart, and its seed.

    Blocks are compared as whole texts when the names are given. Later steps refer to a block by its
    fingerprint, which is safe as no two distinct blocks of the corpus share one; if some do, another
    seed is taken.
    """
    seed = 0
    while True:
        each = rows.select(F.explode(blocks_of(F.col("norm"), block)).alias("block"))
        distinct = each.groupBy("block").agg(F.count("*").alias("n"))
        table = save(
            named(distinct, "block").select(
                F.xxhash64(F.lit(seed), "block").alias("print"), "name", "n"
            )
        )
        if table.groupBy("print").count().filter("count > 1").isEmpty():
            return table, seed
        seed += 1


def _recalled(parts: DataFrame, names: DataFrame) -> DataFrame:
    """parts with the name of what stands in ``print``; common ones are looked up by broadcast."""
    key = F.col("print").bitwiseAND(F.lit((1 << 63) - 1))
    # the sign bit moves to a column of its own so that keys are not negative
    names = names.select(key.alias("key"), F.struct((F.col("print") < 0).alias("neg"), "name").alias("one"), "n")
    names = names.groupBy("key").agg(F.collect_list("one").alias("ones"), F.sum("n").alias("n"))
    found = join_counted(parts.withColumn("key", key), names, "key", "n")
    pick = F.filter("ones", lambda x: x["neg"] == (F.col("print") < 0))[0]["name"]
    return found.select("id", "sha", "blocks", "pos", "copies", pick.alias("name"))


def block_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of docs: id, sha, blocks, name. Two texts are equal just when (blocks, name) are.

    Texts are cut into blocks; each distinct block gets an integer name. Then adjacent names of a
    document are paired, each distinct pair gets a name, and so on until one name is left. Documents
    of as many blocks take part in the same rounds, so that names of other lengths cannot be confused.
    """
    rows = docs.select(F.col(id_col).alias("id"), lower_ascii(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    names, seed = _named_blocks(rows, block)
    prints = F.transform(blocks_of(F.col("norm"), block), lambda b: F.xxhash64(F.lit(seed), b))
    parts = rows.select("id", F.unhex(F.sha2("norm", 256)).alias("sha"), prints.alias("prints")).select(
        "id", "sha", F.size("prints").alias("blocks"), F.lit(1).cast("long").alias("copies"), F.posexplode("prints").alias("pos", "print")
    )
    level = save(_recalled(parts, names))
    done = [level.filter("blocks = 1")]
    width = 1
    most = level.agg(F.max("blocks")).first()[0] or 0
    while width < most:
        open_ = level.filter(F.col("blocks") > width)
        # rows that repeat both id and text are one here, with their number kept
        even = F.col("pos") % 2 == 0
        pairs = open_.groupBy("id", "sha", "blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
            F.sum(F.when(even, F.col("copies")).otherwise(0)).alias("copies"),
        )
        pairs = save(pairs)
        table = save(named(pairs.groupBy("left", "right").agg(F.count("*").alias("n")), "left", "right"))
        both = F.xxhash64("left", "right")
        level = save(_paired(pairs.withColumn("print", both), table.withColumn("print", both)))
        width *= 2
        done.append(level.filter(F.col("blocks") <= width))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("id", "sha", "blocks", "name", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


def _paired(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Names of pairs; pairs that share a hash are told apart by the names in them."""
    key = F.col("print").bitwiseAND(F.lit((1 << 63) - 1))
    one = F.struct("left", "right", "name").alias("one")
    names = table.select(key.alias("key"), one, "n").groupBy("key").agg(F.collect_list("one").alias("ones"), F.sum("n").alias("n"))
    found = join_counted(pairs.withColumn("key", key), names, "key", "n")
    pick = F.filter("ones", lambda x: (x["left"] == F.col("left")) & (x["right"] == F.col("right")))[0]["name"]
    return found.select("id", "sha", "blocks", "pos", "copies", pick.alias("name"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs.

    Texts are equal when identical after lower-casing A-Z. Null counts as empty; empty texts are equal to
    each other. keep_id is the largest id of a group (null ids are smaller than all); rows that repeat
    an id and its text are each counted and share ``kept``. An empty table gives an empty table. Other
    columns of docs are not read.
    """
    named_rows = save(block_identities(docs, id_col, text_col, block))
    # rows meet their group by a hash of (blocks, name), and pick it by the pair itself
    groups = save(
        named_rows.groupBy("blocks", "name").agg(
            F.max("id").alias("keep_id"), F.count("*").alias("group_size")
        ).withColumn("key", F.xxhash64("blocks", "name").bitwiseAND(F.lit((1 << 63) - 1)))
    )
    facts = groups.groupBy("key").agg(
        F.collect_list(F.struct("blocks", "name", "keep_id", "group_size")).alias("all"), F.sum("group_size").alias("n")
    )
    rows = named_rows.withColumn("key", F.xxhash64("blocks", "name").bitwiseAND(F.lit((1 << 63) - 1)))
    found = join_counted(rows, facts, "key", "n")
    own = F.filter("all", lambda x: (x["blocks"] == F.col("blocks")) & (x["name"] == F.col("name")))[0]
    return found.select("id", "sha", own.alias("own")).select(
        F.col("id").alias("doc_id"),
        F.col("own.keep_id").alias("keep_id"),
        F.col("own.group_size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("own.keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""
