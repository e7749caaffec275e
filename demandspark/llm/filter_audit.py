"""Interaction audit of five text filters by a recursive CTE.

Every document is reduced to the set of filters it fails, as a mask of bits, and documents are counted by part and
mask. A recursive common table expression extends prefixes of filter orders by the letters they have not used. Each
level joins the mask cells, carries the bits of the filters applied so far, and emits what its step does with a
document of each mask. Since a step depends on the prefix only and a mask is one of 32, the recursion has the same
325 prefixes and 32 masks whatever the size of the tables; the counts of the parts are joined to it by mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandspark.llm.common import save

#: Bit of each filter in a mask.
BITS = {"A": 1, "B": 2, "C": 4, "D": 8, "E": 16}
_LETTERS = ", ".join(f"named_struct('letter', '{k}', 'bit', {v})" for k, v in BITS.items())

_WALK = f"""
WITH RECURSIVE cells AS (SELECT explode(sequence(0, {sum(BITS.values())})) AS mask),
walk (prefix, step, letter, before, applied, mask, kept, removed, redundant) AS (
  SELECT '', 0, '', 0, 0, mask, true, false, false FROM cells
  UNION ALL
  SELECT concat(w.prefix, l.letter), w.step + 1, l.letter, w.applied, w.applied | l.bit, c.mask,
         (c.mask & (w.applied | l.bit)) = 0,
         (c.mask & w.applied) = 0 AND (c.mask & l.bit) <> 0,
         (c.mask & w.applied) <> 0 AND (c.mask & l.bit) <> 0
  FROM walk w JOIN cells c ON c.mask = w.mask
  LATERAL VIEW explode(filter(array({_LETTERS}), x -> (w.applied & x.bit) = 0)) next AS l
  WHERE w.step < {len(BITS)})
SELECT * FROM walk WHERE step > 0"""


def text_failures(text: Column) -> Column:
    """Bits A to D of a text that is not null. Words stand between the characters space and tab to carriage return."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    words = F.array_remove(F.split(spaced, " "), "")
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {"A": n < 100, "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
             "C": 100 * capitals > 10 * F.length(text), "D": F.rlike(text, F.lit("[#$%&*|]"))}
    return sum((F.when(c, BITS[k]).otherwise(0) for k, c in fails.items()), F.lit(0)).cast("int")


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic: the documents of each part by the set of filters that they fail.

    E, a text that a smaller doc_id has too, is found without one task for a hot text: the smallest doc_id of each
    text is a sum-like aggregate, and rows are looked up by text and doc_id, of which no two different rows share
    both. A null doc_id is neither smaller nor larger than any; rows with equal doc_id and text do not fail each
    other. A doc_id with several labels is good or toxic if one of them says so."""
    text = F.coalesce("text", F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_failures(F.col("text")).alias("mask"))
    # equal rows are one from here on
    rows = save(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("docs")), "audit-rows")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("first", F.lit(True))
    judged = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"),
    ).withColumn("salt", F.lit(0).cast("long"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marked = rows.join(firsts, ["digest", "doc_id"], "left").select(
        "doc_id", "part", "docs", F.when(copy, F.col("mask") + BITS["E"]).otherwise(F.col("mask")).alias("mask"),
        # rows without a doc_id match no label: dealt out by their text, not to the one task of null
        F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")).alias("salt"))
    known = marked.join(judged, ["doc_id", "salt"], "left")
    return known.groupBy("part", "mask").agg(
        F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("docs") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit_steps(cells: DataFrame) -> DataFrame:
    """One row for each part of ``cells`` (part, mask, docs, good, toxic), each order of the filters and each step of
    it: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = cells.sparkSession
    # 325 prefixes x 32 masks, whatever the tables
    walk = save(spark.sql(_WALK), "audit-walk")
    cells = save(cells, "audit-cells")
    n = F.col("docs")
    step = cells.join(F.broadcast(walk), "mask").groupBy("part", "prefix", "step", "letter").agg(
        F.sum(F.when(F.col("kept"), n).otherwise(0)).alias("kept"), F.sum(F.when(F.col("removed"), n).otherwise(0)).alias("removed"),
        F.sum(F.when(F.col("redundant"), n).otherwise(0)).alias("redundant"),
        F.sum(F.when(F.expr(f"mask = element_at(map({', '.join(f'{k!r}, {v}' for k, v in BITS.items())}), letter)"), n).otherwise(0)).alias("unique_fails"),
        F.sum(F.when(F.col("removed"), F.col("good")).otherwise(0)).alias("good_lost"),
        F.sum(F.when(F.col("removed"), F.col("toxic")).otherwise(0)).alias("toxic_lost"))
    # a prefix begins (5 - step)! orders; 65 prefixes end with one letter
    orders_of = F.expr(f"cast(factorial({len(BITS)} - step) as bigint)")
    step = step.withColumn("shapley", F.sum(F.col("removed") * orders_of).over(Window.partitionBy("part", "letter")))
    orders = walk.where(f"step = {len(BITS)} and mask = 0").select(F.col("prefix").alias("filter_order")).select(
        "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(BITS)))).alias("at")).select(
        "filter_order", F.expr("substring(filter_order, 1, at)").alias("prefix"))
    return step.join(F.broadcast(orders), "prefix").select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit_steps`` of ``docs`` (doc_id, text, lang) with ``labels`` (doc_id, quality, toxic).

    A null text is empty and fails A only (and E after another empty text); a null lang is the part of the empty
    string. Texts are equal if their SHA-256 is. Every row counts, repeated ones too. Other columns are not read. An
    empty table has no parts and gives no rows; without labels nothing good or toxic is lost."""
    return audit_steps(mask_cells(docs, labels))
