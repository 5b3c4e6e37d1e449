"""Exact dedup by content sort.

Normalised texts are range-partitioned at sampled splitters and sorted by Spark's external
sort, so equal texts are neighbours; a streaming pass compares neighbours in full and
keeps the smallest id.  Copies met in one Arrow batch travel as one row with their ids, so
a text that a third of the rows share reaches its range once per batch, not once per row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens as tk
from tidemark.llm.storage import stored

SPACES = b" \t\n\r\x0b\x0c"
#: Splitters compare this many leading bytes, then a hash of the whole text: whole texts
#: would make the driver's sample as large as the texts in it.
SPLIT_BYTES = 24
#: Ids in one travelling row; more copies of a batch make more rows.
MAX_IDS = 4096


def normalise(text: bytes) -> bytes:
    """Each run of white space becomes one space."""
    core = b" ".join(text.split())
    if not core:
        return b" " if text else b""
    return (b" " if text[:1] in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c") else b"") + core + (
        b" " if text[-1:] in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c") else b"")


def _pack(it):
    """One row per distinct text of a block: its sort key, ids and normalised bytes."""
    for batch in it:
        ids = batch.column(0).to_pylist()
        data, offsets = tk.text_buffer(batch.column(1))
        for lo, hi in tk.row_blocks(offsets, 2 * tk.BLOCK_BYTES):
            raw = data[offsets[lo]:offsets[hi]].tobytes()
            found: dict[bytes, list] = {}
            for i in range(lo, hi):
                norm = normalise(raw[offsets[i] - offsets[lo]:offsets[i + 1] - offsets[lo]])
                found.setdefault(norm, []).append(ids[i])
            rows = []
            for norm, own in found.items():
                own.sort(key=lambda x: (x is None, x))
                digest = hashlib.sha256(norm).hexdigest()
                for k in range(0, len(own), MAX_IDS):
                    rows.append((norm[:SPLIT_BYTES], digest, norm, own[k], own[k:k + MAX_IDS]))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.list_(pa.int64()))],
                names=["lead", "sha", "norm", "first_id", "ids"])


def _runs(it):
    """Sorted rows in, the same rows out with the smallest id of their run of equal texts.

    Only the previous text is held.  Null ids sort last, so a run starts with its smallest
    id.  Sizes follow separately, since a run's end may be far away.
    """
    last, keep = None, None
    for batch in it:
        keeps = []
        norms = batch.column("norm")
        firsts = batch.column("first_id").to_pylist()
        for i in range(batch.num_rows):
            norm = norms[i].as_buffer()
            if last is None or not norm.equals(last):
                last, keep = norm, firsts[i]
            keeps.append(keep)
        if last is not None:
            last = pa.py_buffer(last.to_pybytes())
        yield pa.RecordBatch.from_arrays([batch.column("sha"), pa.array(keeps, pa.int64()), batch.column("ids")],
                                         names=["text_sha256", "keep_id", "ids"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    Texts are equal when identical after each run of space, tab, line feed, vertical tab,
    form feed and carriage return became one space; null counts as empty.  The smallest id
    of a group is kept; of rows that repeat this id all are kept = true.  Null ids come
    last (a group of null ids only has a null keep_id, kept = false).  Other columns are
    ignored; an empty table gives no rows.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    packed = given.mapInArrow(tk.tidy(_pack), "lead binary, sha string, norm binary, first_id long, ids array<long>")
    ordered = (packed.repartitionByRange("lead", "sha")
               .sortWithinPartitions("lead", "sha", "norm", F.col("first_id").asc_nulls_last()))
    rows = stored(ordered.mapInArrow(tk.tidy(_runs), "text_sha256 string, keep_id long, ids array<long>"), "runs")
    sizes = (rows.groupBy("text_sha256", "keep_id").agg(F.sum(F.size("ids")).alias("group_size"))
             .withColumnsRenamed({"text_sha256": "s", "keep_id": "k"}))
    joined = rows.join(sizes, (rows.text_sha256 == sizes.s) & rows.keep_id.eqNullSafe(sizes.k))
    return (joined.select(F.explode("ids").alias("doc_id"), "keep_id", "group_size", "text_sha256")
            .select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256"))


def _text_sha256(it):
    """The hash of the normalised text (last column) in place of the text."""
    for batch in it:
        data, offsets = tk.text_buffer(batch.columns[-1])
        raw = data.tobytes()
        sha = [hashlib.sha256(normalise(raw[a:b])).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sha, pa.string())], names=batch.schema.names)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text equals that of a row with a smaller id.  Rows
    are judged by id and text, so another text under a lost row's id stays, and rows that
    repeat the kept id and text all stay.  Rows with a null id have no smaller one: all stay."""
    lost = exact_groups(docs, id_col, text_col).where("not kept and doc_id is not null and doc_id <> keep_id")
    lost = lost.select("doc_id", "text_sha256").distinct()
    sha = "_text_sha256"
    while sha in {c.lower() for c in docs.columns}:
        sha = "_" + sha
    rows = docs.withColumn(sha, F.col(text_col).cast("string"))
    rows = rows.mapInArrow(tk.tidy(_text_sha256), rows.schema)
    same = (rows[id_col].cast("long") == lost.doc_id) & (rows[sha] == lost.text_sha256)
    return rows.join(lost, same, "left_anti").select(*docs.columns)
