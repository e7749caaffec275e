"""Sharding by fixed virtual slots, with DataFrame and SQL functions only.

Records are hashed by their text into a fixed number of virtual slots (equal texts share one), the bytes of
each slot are summed, and a versioned map says which shard has which slot. Rebalancing writes a new version in
which only the slots of shards that hold too much have moved; rows are never hashed anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import row_key, save

VIRTUAL_SLOTS = 4096
#: Parts in which the rows of one shard are numbered.
NUMBER_PARTS = 1024


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none), plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def virtual_slot(text: Column, slots: int = VIRTUAL_SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(slots)).cast("int")


def first_map(spark: SparkSession, shards: int, slots: int = VIRTUAL_SLOTS) -> DataFrame:
    """Version 0 of the map: slots dealt out in turn. Columns version, virtual_slot, shard."""
    return spark.range(slots).select(F.lit(0).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
                                     F.expr(f"cast(id % {shards} as int)").alias("shard"))


def rebalance(current: DataFrame, slot_bytes: DataFrame, shards: int) -> DataFrame:
    """The next version of the map ``current`` for ``slot_bytes`` (virtual_slot, bytes).

    Slots are looked at from the largest down: one stays in its shard while that remains within an equal share
    of all bytes, else it goes to the shard with the fewest. The work is on one row of as many entries as
    there are virtual slots, whatever the number of records."""
    sized = current.join(slot_bytes, "virtual_slot", "left").select(
        "version", F.struct(F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), "virtual_slot", "shard").alias("s"))
    one = sized.groupBy().agg(F.max("version").alias("version"), F.sum("s.bytes").alias("total"),
                              F.sort_array(F.collect_list("s"), asc=False).alias("slots"))
    # two steps in the state: choose the shard (`to`), then add the bytes to it
    placed = one.select("version", F.expr(f"""
        aggregate(slots, named_struct('loads', array_repeat(0L, {shards}), 'out', cast(array() as array<int>)),
          (s, x) -> transform(array(if(element_at(s.loads, x.shard + 1) + x.bytes <= total / {shards}, x.shard,
                                       cast(array_position(s.loads, array_min(s.loads)) - 1 as int))),
              t -> named_struct('loads', transform(s.loads, (v, i) -> if(i = t, v + x.bytes, v)),
                                'out', concat(s.out, array(t))))[0],
          s -> transform(s.out, (t, i) -> named_struct('virtual_slot', slots[i].virtual_slot, 'shard', t)))
        """).alias("placed"))
    return placed.select((F.col("version") + 1).alias("version"), F.inline("placed"))


def shard_documents(docs: DataFrame, shards: int = 8, slots: int = VIRTUAL_SLOTS,
                    slot_map: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` with their shard, and the map they were dealt by (all versions).

    Rows: doc_id, size, text_crc32, virtual_slot, shard, slot (place of the row in its shard, gapless from 0),
    map_version. ``slot_map`` is a stored map to go on from; without one, version 0 deals slots in turn. Null
    and empty texts share a slot; equal texts are always in one shard. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.col("text")
    base = save(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        virtual_slot(text, slots).alias("virtual_slot"),
        F.pmod(F.xxhash64(row_key()), F.lit(NUMBER_PARTS)).cast("int").alias("part")), "shard-rows")
    before = slot_map if slot_map is not None else first_map(spark, shards, slots)
    last = before.join(before.groupBy().agg(F.max("version").alias("version")), "version", "left_semi")
    slot_bytes = base.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    after = save(rebalance(last, slot_bytes, shards), "slot-map")
    # slots x 3 numbers: bounded by the number of virtual slots
    dealt = base.join(F.broadcast(after), "virtual_slot")
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = counts.selectExpr(
        "shard", "part", "sum(rows) over (partition by shard order by part) - rows as first")
    numbered = dealt.selectExpr("*", "row_number() over (partition by shard, part order by doc_id, text_crc32, size) - 1 as at")
    # one number for each shard and part: shards x NUMBER_PARTS rows
    rows = numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("at")).cast("long").alias("slot"),
        "virtual_slot", F.col("version").alias("map_version"))
    return rows, before.unionByName(after)
