"""File sources and sinks: CSV tables with several missing-value tokens, JSON
documents, and the split / score sinks."""

from __future__ import annotations

import csv
import io
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import quoted
from tidemark.session import materialize

# The text tokens read as missing (the pandas read_csv defaults).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


CSV_OPTIONS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"', "quote": '"'}


def read_table(spark: SparkSession, path: str, null_tokens=NULL_TOKENS) -> DataFrame:
    """Header CSV, every column read as text (a UTF-8 BOM is dropped), then every null
    token mapped to null in one projection.  Typing is left to ``clean.coerce_numeric`` and
    ``clean.restore_booleans`` so one bad value cannot fail the scan.  Doubled quotes inside
    quoted cells are read as one, and cells may hold line breaks: where a first look finds a
    line with an odd number of quotes, records are put together by ``quoted_records``, else
    every line is a record.  Either way one file is read by many tasks."""
    lines = spark.read.option("lineSep", "\n").text(path)
    if lines.where(_quotes(F.col("value")) % 2 == 1).isEmpty():
        df = spark.read.options(header=True, inferSchema=False, encoding="UTF-8", **CSV_OPTIONS).csv(path)
    else:
        df = _parsed(quoted_records(spark, path))
    toks = list(null_tokens)
    return df.select(*[F.when(~quoted(c).isin(toks), quoted(c)).alias(c) for c in df.columns])


def _quotes(c):
    return F.length(c) - F.length(F.replace(c, F.lit('"')))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, record, text)``: the records of CSV files whose quoted cells may hold
    line breaks; ``record`` counts from 1 in the block of the file where it starts.

    Files are read in blocks by several tasks.  A break is inside a cell exactly if the
    quotes before it are odd in number, so each block's parity is counted, the parity before
    a block is a running sum over the blocks of its file, and a running sum inside the block
    gives that of every line.  Lines that are whole records go straight on; only the parts
    of broken ones are brought together, also across blocks.  Empty lines between records
    are dropped.  A quote that is never closed swallows the rest of its file into one cell,
    as in any CSV reader."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), _quotes(F.col("value")).alias("q"))
    blocks = lines.groupBy("file", "block").agg((F.sum("q") % 2).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file", "block").orderBy("line")
    q_before = F.col("before") + F.coalesce(F.sum("q").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = lines.join(blocks, ["file", "block"]).withColumn("starts", q_before % 2 == 0)
    record = F.sum(F.col("starts").cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = materialize(d.select("file", "block", "line", "value", record.alias("record"), (F.col("starts") & (F.col("q") % 2 == 0)).alias("whole")))
    # lines before a block's first record belong to the last record of the nearest block with one
    last = d.groupBy("file", "block").agg(F.max("record").alias("n"))
    owner = F.last(F.when(F.col("n") > 0, F.struct(F.col("block").alias("b"), F.col("n").alias("r"))), ignorenulls=True).over(earlier)
    last = last.select("file", "block", owner.alias("owner"))
    parts = d.where("not whole").join(last, ["file", "block"])
    here = F.when(F.col("record") > 0, F.struct(F.col("block").alias("b"), F.col("record").alias("r"))).otherwise(F.col("owner"))
    joined = parts.select("file", here.alias("at"), F.struct("block", "line", "value").alias("part")).groupBy("file", "at").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda x: x["value"]), "\n").alias("text"))
    single = d.where(F.col("whole") & (F.trim("value") != "") & (F.col("value") != "\r")).select("file", "block", "record", F.col("value").alias("text"))
    both = single.unionByName(joined.select("file", F.col("at.b").alias("block"), F.col("at.r").alias("record"), "text"))
    return both.withColumn("text", F.regexp_replace("text", "\\r$", ""))


def _parsed(records: DataFrame) -> DataFrame:
    """The cells of CSV records; each file's first record is its header, and the first
    file's header names the columns."""
    head = records.where((F.col("block") == 0) & (F.col("record") == 1)).orderBy("file").select("text").first()
    if head is None:
        return records.select().limit(0)
    names = next(csv.reader(io.StringIO(head["text"], newline="")))
    low = [n.lower() for n in names]
    names = [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    rows = records.where((F.col("block") != 0) | (F.col("record") != 1))
    cells = F.from_csv("text", schema, {**CSV_OPTIONS, "multiLine": "true"})
    return rows.select(cells.alias("c")).select(*[F.col("c").getField(n).alias(n) for n in names])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "overwrite") -> None:
    """C14: split / score / document sinks.  Parquet by default; ``partition_by`` gives
    one folder per split or scoring date (partition pruning for readers)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
             .option("escape", '"')
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def write_partitions(df: DataFrame, path: str, partition_by, fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite):
    re-running a scoring date or a split rewrites that folder and leaves the others, so
    a retried or repeated job does not duplicate rows."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .format(fmt).partitionBy(*cols).save(path))


#: Folder level that names a document written by ``write_json_documents``.
DOCUMENT = "document"


def write_json_documents(docs: DataFrame, path: str, name: str = "file", doc: str = "doc") -> None:
    """C14: one JSON document per name, each in a folder of its own (``document=<name>``);
    writing a name again replaces that document and leaves the others."""
    (docs.select(F.col(name).alias(DOCUMENT), F.col(doc).alias("value")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(DOCUMENT).text(path))


def read_json_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Whole JSON files as rows: ``file_name, stem, doc`` (text).  ``glob`` chooses by file
    name, or by the document's name in a folder of ``write_json_documents``.  Used for
    metric, threshold and selection documents; parsing is left to ``try_parse_json`` so bad
    files are rows whose document does not parse, not job failures."""
    files = spark.read.text(path, wholetext=True)
    if DOCUMENT in files.columns:
        pattern = "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob)
        df, name = files.where(F.col(DOCUMENT).rlike(f"^{pattern}$")), F.col(DOCUMENT).cast("string")
    else:
        df, name = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True), F.col("_metadata.file_name")
    return df.select(name.alias("file_name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.col("value").alias("doc"))
