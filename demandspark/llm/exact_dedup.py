"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. All blocks are sorted (range-partitioned, so a hot
block is spread over many tasks) and equal blocks get one integer name. Then adjacent names are paired, the
pairs are sorted and named in the same way, and so on until each text has one name. Two texts have the same
(level, name) exactly if they are equal byte by byte: names stand for contents, not for hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import by_number, map_batches, numbered, row_key, save, without

BLOCK_BYTES = 4096
_CARRIED = "row bigint, doc_id bigint, n bigint, sha string, pos bigint"


def _named(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names in one sorted partition: partition number and number of the run of equal keys. The first and the
    last key go out once more as ``edge``, since their runs may go on in a neighbouring partition."""
    base = (TaskContext.get().partitionId() << 36) - 1
    run, last = base, None
    schema = None
    for batch in rows:
        if not len(batch):
            continue
        key = batch.column("key")
        new = pa.concat_arrays([pa.array([last is None or key[0].as_py() != last]), pc.not_equal(key[1:], key[:-1])])
        names = pc.add(pc.cumulative_sum(new.cast(pa.int64())), run)
        columns = [batch.column(c) for c in ("row", "doc_id", "n", "sha", "pos")]
        out = [*columns, names, pa.nulls(len(batch), pa.binary())]
        labels = ["row", "doc_id", "n", "sha", "pos", "name", "edge"]
        schema = pa.schema(list(zip(labels, [c.type for c in out], strict=True)))
        if last is None:
            yield _edge(schema, names[0].as_py(), key[0].as_py())
        run, last = names[-1].as_py(), key[-1].as_py()
        yield pa.RecordBatch.from_arrays(out, schema=schema)
    if last is not None:
        yield _edge(schema, run, last)


def _edge(schema: pa.Schema, name: int, key: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"name": name, "edge": key}], schema=schema)


def name_keys(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, n, sha, pos, key) with a long ``name`` in place of the binary ``key``: equal keys
    have equal names, other keys other names. A key with many rows is dealt over several tasks by its row."""
    # ranges are of hashes: what is sampled to place them does not carry the contents, which are compared within partitions
    hashed = rows.withColumn("hash", F.xxhash64("key")).withColumn("digest", F.unhex(F.sha2("key", 256)))
    order = ["hash", "digest", "key", "row", "pos"]
    ranged = hashed.repartitionByRange("hash", "digest", "row", "pos").sortWithinPartitions(*order).select(*rows.columns)
    named = save(map_batches(ranged, _named, _CARRIED + ", name bigint, edge binary"), "block-names")
    edges = named.where("edge is not null").select("edge", "name")
    first = edges.groupBy("edge").agg(F.min("name").alias("first"))
    # at most two rows for each partition: bounded by the number of tasks, whatever the size of the tables
    other = edges.join(first, "edge").where("name <> first").select("name", "first").distinct()
    return named.where("edge is null").join(F.broadcast(other), "name", "left").select(
        "row", "doc_id", "n", "sha", "pos", F.coalesce("first", "name").alias("name"))


def name_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): row, doc_id, sha, level, name. Texts are equal exactly if
    level and name are. A null text is an empty one, and has one empty block."""
    return _name_rows(docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), block_bytes)


def _name_rows(keyed: DataFrame, block_bytes: int) -> DataFrame:
    blocks = keyed.select(
        "row", "doc_id",
        F.coalesce("text", F.lit("")).cast("binary").alias("bin"),
    ).select("row", "doc_id", "bin", F.sha2("bin", 256).alias("sha"),
             F.expr(f"greatest(1L, cast(ceil(octet_length(bin) / {block_bytes}) as bigint))").alias("n"))
    blocks = blocks.select("row", "doc_id", "n", "sha", F.posexplode(F.expr(
        f"transform(sequence(0L, n - 1), i -> substring(bin, cast(i * {block_bytes} as int) + 1, {block_bytes}))"
    )).alias("pos", "key"))
    blocks = blocks.select("row", "doc_id", "n", F.when(F.col("pos") == 0, F.col("sha")).alias("sha"),
                           F.col("pos").cast("long").alias("pos"), "key")
    names = name_keys(blocks)
    done, level = [], 0
    longest = names.agg(F.max("n")).first()[0] or 1
    while True:
        done.append(names.where("n = 1").select("row", "doc_id", "sha", F.lit(level).alias("level"), "name"))
        if longest <= 1:
            break
        even = F.col("pos") % 2 == 0
        pairs = names.where("n > 1").groupBy("row", "doc_id", "n", F.expr("pos div 2").alias("half")).agg(
            F.max("sha").alias("sha"), F.max(F.when(even, F.col("name"))).alias("a"),
            F.max(F.when(~even, F.col("name"))).alias("b"))
        # an odd last name is paired with none, which no name is
        key = F.unhex(F.concat(F.lpad(F.hex("a"), 16, "0"), F.coalesce(F.lpad(F.hex("b"), 16, "0"), F.lit(""))))
        names = name_keys(pairs.select("row", "doc_id", F.expr("(n + 1) div 2").alias("n"), "sha",
                                       F.col("half").alias("pos"), key.alias("key")))
        longest, level = (longest + 1) // 2, level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with its group of equal texts: row, doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays; of repeated rows with that doc_id, one. A null
    doc_id counts as smaller than any other. An empty table gives an empty result; other columns are not read.
    """
    return _grouped(name_texts(docs, block_bytes))


def _grouped(named: DataFrame) -> DataFrame:
    texts = save(named, "text-names")
    groups = save(texts.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("stays"), F.count(F.lit(1)).alias("size"),
    ).where("size > 1"), "text-groups")
    joined = texts.alias("t").join(groups.alias("g"), ["level", "name"], "left")
    return joined.select(
        "t.row", "t.doc_id", F.when(F.col("size") > 1, F.col("stays.doc_id")).otherwise(F.col("t.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("stays.row") == F.col("t.row"), F.lit(True)).alias("kept"),
        F.col("t.sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that an equal text with a larger doc_id replaces; all columns are kept, whatever their
    names. Of null and empty texts one row stays, as of any other text, and of repeated rows one; an empty table stays
    empty."""
    rows, name = numbered(docs, "copied-docs")
    return without(rows, name, save(_grouped(_name_rows(by_number(rows, name), block_bytes)).where(~F.col("kept")).select("row"), "copies"))
