"""Scans and sinks: file inventories, all-text tables, matrices, nested mappings, CSV and JSON output."""

from __future__ import annotations

import csv
import io
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells that a scan may read as missing.
NA_CELLS = ("", "#N/A", "#NA", "N/A", "NA", "NaN", "None", "null", "NULL", "nan", "n/a", "<NA>")
#: Encodings of sheets, tried in this order, and fields that mark an object as an entry.
ENCODINGS = ("utf-8-sig", "cp949", "latin-1")
ENTRY_FIELDS = ("source_image", "source_pdf", "source_page", "panels", "caption")
#: Directories and files that reference scans pass over.
SKIPPED = r"(^|/)(\.[^/]*|~\$[^/]*|__pycache__|output|outputs|cache)(/|$)"


def inventory(spark: SparkSession, root: str, extensions: tuple[str, ...], exclude: tuple[str, ...] = ()) -> DataFrame:
    """Path, size and role of files below a root; contents are not read. Paths that differ in case only count once."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    files = files.filter(F.lower("path").rlike(r"\.(" + "|".join(extensions) + ")$"))
    for e in exclude:
        files = files.filter(~F.contains("path", F.lit(e)))
    one = files.groupBy(F.lower("path").alias("key")).agg(F.min(F.struct("path", "length")).alias("f"))
    return one.select("f.path", "f.length", (F.col("f.length") > 0).alias("readable"))


def source_documents(spark: SparkSession, root: str, skip: tuple[str, ...] = ("output", "cache"), extension: str = "md") -> DataFrame:
    """Path and whole text of the documents below a root, but for folders to skip and hidden ones."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{extension}").text(root, wholetext=True)
    found = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    inside = F.regexp_replace(F.regexp_replace("path", "^[a-z]+:/*", "/"), "^" + re.escape(re.sub("^[a-z]+:/*", "/", root).rstrip("/")), "")
    return found.filter(~inside.rlike(r"/\.")).filter(~F.exists(F.split(inside, "/"), lambda part: part.isin(*skip)))


def reference_files(files: DataFrame) -> DataFrame:
    """An inventory without hidden, temporary, cache and output files, with PDFs last in ``place``."""
    return files.filter(~F.col("path").rlike(SKIPPED)).withColumn("place", F.when(F.lower("path").endswith(".pdf"), 1).otherwise(0))


def text_table(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8", na_as_blank: bool = False) -> DataFrame:
    """A table with a header, every cell as text; blanks are empty strings. ``na_as_blank`` reads words for missing as blank.

    Quoted cells may hold separators, doubled quotes and newlines; a file is read by one task. An empty file has no columns.
    """
    df = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("multiLine", True).option("escape", '"').csv(path)
    clean = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(""))
    if na_as_blank:
        clean = lambda c: F.when(F.coalesce(F.col(f"`{c}`"), F.lit("")).isin(*NA_CELLS), "").otherwise(F.col(f"`{c}`"))
    return df.select(*[clean(c).alias(c) for c in df.columns])


def union_with_source(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """S3: tables of differing columns as one, each row with its source's name; missing cells are empty."""
    out = None
    for name, df in tables:
        t = df.withColumn("source_file", F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in out.dtypes])


def _decoded(content: bytes) -> str:
    for encoding in ENCODINGS:
        try:
            return content.decode(encoding)
        except UnicodeDecodeError:
            continue
    return content.decode(ENCODINGS[0], "replace")


def matrix_cells(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Cells (sheet, r, c, value) of tables without a header; each file is a sheet, read whole by one task.

    r and c count from 1 in the order of the file. Rows may differ in width, and have just the cells that they have: a blank
    line is a row without cells, blank cells are empty. Quoted cells may hold separators, quotes and newlines. The first of
    ENCODINGS that fits a file is taken.
    """

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sheet, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = enumerate(csv.reader(io.StringIO(_decoded(content.as_py()), newline=""), delimiter=sep), 1)
                while part := list(itertools.islice(rows, 10_000)):
                    flat = [(r, c, v) for r, row in part for c, v in enumerate(row, 1)]
                    columns = list(zip(*flat)) or [(), (), ()]
                    yield pa.RecordBatch.from_arrays([pa.array([sheet] * len(flat), pa.string()), *(pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.string())))], ["sheet", "r", "c", "value"])

    read = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("sheet"), "content")
    return read.mapInArrow(cells, "sheet string, r int, c int, value string")


def mapping_entries(rows: DataFrame, body: str) -> DataFrame:
    """Entries of {folder: {item: {..}}} JSON, or of flat {item: {..}}: folder (empty for flat ones), item, entry (JSON).

    An object that has one of ENTRY_FIELDS is an entry, any other a folder. Names that begin with _ and values that are no objects are left out.
    """
    named = rows.select(F.explode(F.from_json(body, "map<string,string>")).alias("name", "value")).filter(~F.col("name").startswith("_") & F.col("value").startswith("{"))
    inside = named.withColumn("inside", F.from_json("value", "map<string,string>"))
    flat = F.arrays_overlap(F.map_keys("inside"), F.array(*map(F.lit, ENTRY_FIELDS)))
    own = F.array(F.struct(F.lit("").alias("folder"), F.col("name").alias("item"), F.col("value").alias("entry")))
    below = F.transform(F.map_entries("inside"), lambda e: F.struct(F.col("name").alias("folder"), e["key"].alias("item"), e["value"].alias("entry")))
    each = inside.select(F.explode(F.when(flat, own).otherwise(F.filter(below, lambda e: ~e["item"].startswith("_") & e["entry"].startswith("{")))).alias("e"))
    return each.select("e.*")


def listed_blocks(rows: DataFrame, body: str) -> DataFrame:
    """Item and block of {item: [..] or one value} JSON."""
    pairs = rows.select(F.explode(F.from_json(body, "map<string,string>")).alias("item", "raw"))
    many = F.from_json("raw", "array<string>")
    return pairs.select("item", F.explode(F.when(F.col("raw").startswith("["), many).otherwise(F.array("raw"))).alias("block"))


def numbered_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Lines that are not blank, with their numbers and white space in runs as one."""
    lines = docs.select("*", F.posexplode(F.split(text, "\n")).alias("_at", "_line")).drop(text)
    return lines.withColumn("line_no", F.col("_at") + 1).withColumn("line", F.trim(F.regexp_replace("_line", r"\s+", " "))).drop("_at", "_line").filter("line <> ''")


def write_table(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV of the given columns in order; missing columns and nulls are blank, others are left out."""
    have = set(df.columns)
    df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")).alias(c) for c in columns]).write.options(emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path, header=True)


def write_partitions(df: DataFrame, path: str, role: Column, by: str) -> DataFrame:
    """One folder per role and partition; returns the inventory of partitions with their row counts."""
    marked = df.withColumn("role", role)
    marked.write.partitionBy("role", by).parquet(path)
    return marked.groupBy("role", by).agg(F.count("*").alias("rows"))


def write_report(report: DataFrame, path: str) -> None:
    """One JSON object per row."""
    report.select(F.to_json(F.struct(*report.columns)).alias("value")).write.text(path)
