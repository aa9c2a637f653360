"""Written intermediate tables and joins that stay level when one key is very common."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_own_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local session, which has one machine, may do without."""
    global _own_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_root is None:
        _own_root = "file://" + tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
    return _own_root


def save(df: DataFrame) -> DataFrame:
    """Write a table in the shared folder and read it back: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: str | Column) -> Column:
    """Lower-case A-Z only. Texts of one byte a character take the built-in that is fast for them."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def join_counted(rows: DataFrame, facts: DataFrame, key: str, count: str, hot: int = 1000) -> DataFrame:
    """Left join of rows to facts on one non-negative long key that is unique in facts.

    facts carries in ``count`` how many rows each key has. The ``hot`` most frequent keys, a fixed number
    of them, are broadcast and looked up where the rows lie; every other key has at most 1/hot of all rows
    and goes through a shuffle. Rows that the broadcast served get spread-out negative keys meanwhile, so
    that no task of the shuffle gathers them.
    """
    values = [c for c in facts.columns if c not in (key, count)]
    top = facts.orderBy(F.desc(count), F.asc(key)).limit(hot)
    top = top.select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot"))
    spread = -1 - F.pmod(F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith("map")]), F.lit(1 << 40))
    marked = rows.join(F.broadcast(top), rows[key] == F.col("_hot_key"), "left")
    marked = marked.withColumn("_cold_key", F.when(F.col("_hot_key").isNull(), F.col(key)).otherwise(spread))
    cold = facts.select(F.col(key).alias("_fact_key"), F.struct(*values).alias("_cold"))
    joined = marked.join(cold, F.col("_cold_key") == F.col("_fact_key"), "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*rows.columns, *[found[v].alias(v) for v in values])


_held: dict = {}


def held(key, make: Callable):
    """make()'s result, kept in a Python worker until another is asked for: workers serve many stages, and hold one model at a time."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Drop the model that this Python worker holds."""
    _held.clear()


def give_back() -> None:
    """Hand freed memory back to the system: Arrow's pool and the C library keep it for later otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def tidy(run: Callable, model: bool = False) -> Callable:
    """run for mapInArrow, which gives memory back after each batch and at its end.

    An executor's Python workers wait for later stages, more of them than it has cores, and each would keep its
    largest batches. Without a model of its own (``held``), run also lets go of the one that its worker holds.
    """

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch], *args) -> Iterator[pa.RecordBatch]:
        def given() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        if not model:
            let_go()  # by its name: a task gets a copy of what a closure takes from a module
        try:
            yield from run(given(), *args)
        finally:
            give_back()

    return tidied


def to_arrays(df: DataFrame) -> dict[str, np.ndarray]:
    """Numeric columns of a table of bounded size as arrays; tasks pack them, so that the driver holds the bytes once."""
    names = df.columns

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in batch.columns], names)

    kinds = {"int": np.int32, "bigint": np.int64, "double": np.float64}
    rows = df.mapInArrow(tidy(pack), ", ".join(f"`{c}` binary" for c in names)).collect()
    return {c: np.frombuffer(b"".join(r[c] for r in rows), kinds[t]) for c, t in df.dtypes}
