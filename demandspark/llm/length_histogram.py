"""Token counts from an exact histogram of encoded lengths.

Documents are encoded, counted by length, and the histogram's suffix sums answer for every context limit L: how
many tokens there are in all, how many remain when each text is cut to L, how many texts fit or are cut, and
quantiles of the length. Suffix sums are taken in ranges of lengths, so that no task sees the whole histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.bpe import RANKS, token_counts
from demandspark.llm.common import save


def length_range(length: Column) -> Column:
    """0, 1, ... 63 singly, and from there 32 ranges for each doubling: at most some 1,900 ranges for any length."""
    power = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double") + 0.5)).cast("int")
    return F.when(length < 64, length.cast("int")).otherwise(
        64 + (power - 6) * 32 + F.expr("int(shiftright(n_tokens, greatest(int(floor(log2(greatest(n_tokens, 1L) + 0.5D))) - 5, 0)) - 32)"))


def histogram(counts: DataFrame) -> DataFrame:
    """n_tokens, docs for each length that occurs in ``counts`` (n_tokens). Null lengths count as 0."""
    return counts.groupBy(F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("docs"))


def limits(hist: DataFrame) -> DataFrame:
    """For each length that occurs, as context limit: n_tokens, docs, docs_longer (documents that are cut),
    docs_fit, tokens_fit (tokens of documents that fit), tokens_kept (tokens when each text is cut there),
    tokens_total and quantile (share of documents up to that length).
    Any other limit is answered from the row of the next length above: see ``tokens_at``."""
    h = hist.withColumn("part", length_range(F.col("n_tokens"))).withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    parts = h.groupBy("part").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    # one row for each range of lengths, of which there are at most 2,000
    before = parts.selectExpr(
        "part", "sum(d) over (order by part) - d as d0", "sum(t) over (order by part) - t as t0",
        "sum(d) over () as d_all", "sum(t) over () as t_all")
    inner = h.selectExpr("*", "sum(docs) over (partition by part order by n_tokens) as d1",
                         "sum(tokens) over (partition by part order by n_tokens) as t1")
    out = inner.join(F.broadcast(before), "part")
    longer, fit = F.col("d_all") - F.col("d0") - F.col("d1"), F.col("t0") + F.col("t1")
    return out.select(
        "n_tokens", "docs", longer.alias("docs_longer"), (F.col("d0") + F.col("d1")).alias("docs_fit"),
        fit.alias("tokens_fit"), (fit + longer * F.col("n_tokens")).alias("tokens_kept"),
        F.col("t_all").alias("tokens_total"), ((F.col("d0") + F.col("d1")) / F.col("d_all")).alias("quantile"))


def tokens_at(answers: DataFrame, limit: int) -> DataFrame:
    """One row for any context limit: tokens_total, tokens_kept, docs_longer."""
    fit = answers.where(F.col("n_tokens") <= limit).agg(F.max(F.struct("n_tokens", "tokens_fit", "docs_longer", "tokens_total")).alias("a"))
    total = answers.agg(F.max("tokens_total").alias("t"), F.sum("docs").alias("d"))
    return total.join(fit).select(
        F.coalesce("t", F.lit(0)).alias("tokens_total"),
        (F.coalesce("a.tokens_fit", F.lit(0)) + limit * F.coalesce("a.docs_longer", "d", F.lit(0))).alias("tokens_kept"),
        F.coalesce("a.docs_longer", "d", F.lit(0)).alias("docs_longer"))


def length_quantile(answers: DataFrame, q: float) -> DataFrame:
    """The smallest length up to which at least the share ``q`` of the documents lies."""
    return answers.where(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``limits`` of the documents' encoded lengths. Null and empty texts have length 0; no rows, no limits."""
    return limits(save(histogram(token_counts(docs, ranks)), "length-histogram"))
