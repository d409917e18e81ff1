"""Exact dedup by deterministic block naming.

Every text (white space runs made one space) is cut into blocks of
``block_bytes``. Equal blocks get one integer name by sorting; then adjacent
names are paired and the pairs named in turn, halving the sequence until one
name is left. That name, with the number of halvings, is the identity of the
text: equal texts share it and different texts never do (names come from
sorting whole values, so no hash can collide).

Scale: the text is shuffled once. Each map batch keeps a dictionary of its
distinct blocks, so a block that a third of all documents share is sent once
a batch; documents refer to blocks by (batch, number). All later levels move
integers only, one for every two blocks of the level before.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import bucket_names, pieces, text_buffers, written

BLOCK_BYTES = 4096
SPACE = r"[\x20\x09-\x0D]+"

_SCHEMA = ("chunk long, lid int, block binary, row long, pos int, n int, id long, sha string")
_ARROW = pa.schema([("chunk", pa.int64()), ("lid", pa.int32()), ("block", pa.binary()), ("row", pa.int64()),
                    ("pos", pa.int32()), ("n", pa.int32()), ("id", pa.int64()), ("sha", pa.string())])


def _cut(block_bytes: int):
    def cut(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        chunk, row = first, first
        for piece in pieces(batches, 1):
            text = pc.replace_substring_regex(pc.fill_null(piece.column(1), ""), SPACE, " ")
            offsets, raw = text_buffers(text)
            view = memoryview(raw)
            names: dict[bytes, int] = {}
            occ: list[tuple] = []
            ids = piece.column(0).to_pylist()
            for i, doc_id in enumerate(ids):
                a, b = int(offsets[i]), int(offsets[i + 1])
                n = max(1, -(-(b - a) // block_bytes))
                sha = hashlib.sha256(view[a:b]).hexdigest()
                for pos in range(n):
                    s = a + pos * block_bytes
                    block = bytes(view[s:min(b, s + block_bytes)])
                    lid = names.setdefault(block, len(names))
                    occ.append((chunk, lid, None, row, pos, n, doc_id if pos == 0 else None, sha if pos == 0 else None))
                row += 1
            rows = [(chunk, lid, block, None, None, None, None, None) for block, lid in names.items()] + occ
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)
            chunk += 1
    return cut


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, id, sha, level, name): one row per input row; equal texts share (level, name)."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = written(src.mapInArrow(_cut(block_bytes), _SCHEMA), "blocks")
    named = bucket_names(cut.where("block is not null").select("chunk", "lid", "block"), ["block"]).drop("block")
    level = written(cut.where("row is not null").select("chunk", "lid", "row", "pos", "n")
                    .join(named, ["chunk", "lid"]).select("row", "n", "pos", "name"), "names-0")
    longest = level.agg(F.max("n")).head()[0] or 1
    done = level.where("n = 1").select("row", F.lit(0).alias("level"), "name")
    for k in range(1, math.ceil(math.log2(longest)) + 1 if longest > 1 else 1):
        odd = F.col("pos") % 2 == 1
        pairs = (level.where("n > 1")
                 .groupBy("row", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(~odd, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b")))
        names = bucket_names(pairs.select("a", "b").distinct(), ["a", "b"])
        level = written(pairs.join(names, ["a", "b"])
                        .select("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"), f"names-{k}")
        done = done.unionByName(level.where("n = 1").select("row", F.lit(k).alias("level"), "name"))
    info = cut.where("pos = 0").select("row", "id", "sha")
    return info.join(done, "row")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null and empty texts are equal to each other (a text of white space only
    is one space, hence different). Rows that repeat a doc_id are documents of
    their own: of equal rows exactly one is kept. A row without doc_id can be
    dropped for one that has it; a group of such rows only has a null keep_id
    and keeps one. Other columns are ignored, so their names cannot clash.
    """
    ids = identities(docs, id_col, text_col, block_bytes)
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"))
    # written, so that joining back is a plain join whose hot groups Spark can split
    groups = written(ids.groupBy("level", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size")), "groups")
    return ids.join(groups, ["level", "name"]).select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns unchanged.

    Kept rows are found again by doc_id and digest, so the text moves once
    more; of rows equal in both, one stays.
    """
    from pyspark.sql import Window

    kept = (exact_dedup(docs, id_col, text_col).where("kept")
            .select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")))
    norm = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), SPACE, " ")
    tagged = docs.withColumns({"__id": F.col(id_col).cast("long"), "__sha": F.sha2(norm, 256)})
    same = tagged["__id"].eqNullSafe(kept["__id"]) & (tagged["__sha"] == kept["__sha"])
    one = F.row_number().over(Window.partitionBy("__id", "__sha").orderBy("__id"))
    return (tagged.join(kept, same, "left_semi").withColumn("__n", one).where("__n = 1")
            .drop("__id", "__sha", "__n"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
