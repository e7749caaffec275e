"""Importance resampling towards a target distribution: array-scored weights, then a distributed LSD radix sort.

Texts are bags of hashed word n-grams. A bucket's gain says how much more often the target has it than the corpus,
and a document's weight is the sum of its features' gains, read from one array of a fixed number of buckets. A
Gumbel variate of the doc_id is added, so that the highest scores are a draw without replacement.

Ranks come from counting sorts, least significant digit first. Rows lie in blocks of positions. A pass counts each
block's rows by the digit; prefix sums over (digit, block) give where each run of equal digits begins; a row's
destination is that plus its place within the run. Runs are at most a block long, so no digit, however frequent, is
one task's work, and only one number for each (block, digit) is summed up globally.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandspark.llm.common import pieces, save, text_buffer
from demandspark.llm.rolling import WORD, word_spans

BUCKETS = 10000
DIGIT_BITS = 11
#: Rows of a block at least, and blocks at most: from there on blocks grow with the table.
BLOCK_ROWS, BLOCKS = 2048, 4096
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def span_crc32(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int = 64) -> np.ndarray:
    """Unsigned CRC-32 of each span of a byte buffer: byte by byte over all spans at once, longer ones singly."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, longest + 1), kind="stable")
    size, starts = size[order], starts[order]
    long = int(np.searchsorted(-size, -longest, "left"))
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for j in range(int(size[long]) if long < len(size) else 0):
        stop = int(np.searchsorted(-size, -j, "left"))  # spans with a byte at j
        c = crc[long:stop]
        crc[long:stop] = _CRC[(c ^ buf[starts[long:stop] + j]) & np.uint32(0xFF)] ^ (c >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        crc[i] = zlib.crc32(buf[starts[i]: starts[i] + size[i]].tobytes())
    out = np.empty_like(crc)
    out[order] = crc
    return out


def feature_buckets(buf: np.ndarray, at: np.ndarray, n: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every run of 1 to ``n`` words of a text buffer, and the words of each row. Words are runs of
    a-z (A-Z are lower-cased), 0-9 and bytes beyond ASCII; the words of a run are joined by one space."""
    starts, ends, rows = word_spans(buf, at, WORD)
    buf = _LOWER[buf]
    if n == 1:
        return span_crc32(buf, starts, ends).astype(np.int64) % buckets, rows, np.bincount(rows, minlength=len(at) - 1)
    # words laid out with one space between
    size = ends - starts
    to = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(int(to[-1]), 0x20, np.uint8)
    joined[np.repeat(to[:-1] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))] = \
        buf[np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))]
    found, owners = [], []
    for k in range(1, n + 1):
        first = np.arange(len(starts) - k + 1) if len(starts) >= k else np.zeros(0, np.int64)
        first = first[rows[first] == rows[first + k - 1]]
        found.append(span_crc32(joined, to[first], to[first + k - 1] + size[first + k - 1]).astype(np.int64) % buckets)
        owners.append(rows[first])
    return np.concatenate(found), np.concatenate(owners), np.bincount(rows, minlength=len(at) - 1)


def bucket_counts(texts: DataFrame, n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows of ``texts`` (text) in each bucket: an array of fixed size, whatever the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for part in (p for b in batches for p in pieces(b, limit=1 << 20)):
            counts += np.bincount(feature_buckets(*text_buffer(part.column("text")), n, buckets)[0], minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["bucket", "features"])

    summed = texts.select("text").mapInArrow(run, "bucket bigint, features bigint").groupBy("bucket").agg(F.sum("features").alias("features"))
    table = summed.toArrow()
    out = np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("features").to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + b) / ((float(s) + 1) * (t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """floor(-1000 ln(-ln u)) for u from the first 32 bits of sha256(``seed:doc_id``); no doc_id is the empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: np.ndarray, n: int = 1, seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part in (p for b in batches for p in pieces(b, limit=1 << 20)):
            bucket, owner, words = feature_buckets(*text_buffer(part.column("text")), n, len(table))
            order = np.argsort(owner, kind="stable") if n > 1 else slice(None)
            sums = np.concatenate([[0], np.cumsum(table[bucket[order]])])
            cuts = np.searchsorted(owner[order], np.arange(len(part) + 1))
            weight = sums[cuts[1:]] - sums[cuts[:-1]]
            score = weight + np.array([gumbel(i, seed) for i in part.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, np.diff(cuts), weight, score))],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def _digits(name: str, lo: int, hi: int, width: int) -> list[tuple[str, int, int]]:
    """Column, shift and bits of each digit of a key with values lo to hi, least significant first; bits in which no
    two values differ are left out."""
    bits = (lo ^ hi).bit_length()
    passes = -(-bits // width)
    return [(name, bits * i // passes, bits * (i + 1) // passes - bits * i // passes) for i in range(passes)]


def radix_ranks(rows: DataFrame, keys: list[str], width: int = DIGIT_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``rank`` (long, from 1 on) in the order of ``keys``: long columns that are not negative and not
    null, the most significant first. Rows with equal keys have ranks in a row."""
    spark, columns = rows.sparkSession, rows.columns
    state = save(rows.withColumn("_at", F.monotonically_increasing_id()), "radix-rows")
    ends = state.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{k}_{f.__name__}") for k in keys for f in (F.min, F.max)]).first()
    if not ends["n"]:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    block = max(block_rows, -(-ends["n"] // BLOCKS))
    passes = [d for k in reversed(keys) for d in _digits(k, ends[f"{k}_min"], ends[f"{k}_max"], width)]
    # without any digit to sort by, one pass over a digit that is always 0 makes the positions gapless
    for key, shift, bits in passes or [(keys[-1], 0, 0)]:
        state = save(_counting_sort(state, F.shiftrightunsigned(F.col(key), shift).bitwiseAND((1 << bits) - 1), block), "radix-pass")
    return state.select(*columns, (F.col("_at") + 1).alias("rank"))


def _counting_sort(state: DataFrame, digit: Column, block: int) -> DataFrame:
    """One stable pass: ``_at``, a row's position, becomes its position by ``digit`` and then by the one before."""
    dealt = state.select("*", digit.cast("int").alias("_digit"), F.expr(f"_at div {block}").alias("_block"))
    counts = dealt.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("_n"))
    # offsets of whole digits: at most 2^bits rows
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_d")).select(
        "_digit", (F.sum("_d").over(Window.orderBy("_digit")) - F.col("_d")).alias("_base"))
    before = F.sum("_n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("_n")
    offsets = counts.select("_digit", "_block", before.alias("_run")).join(F.broadcast(totals), "_digit").select(
        "_digit", "_block", (F.col("_base") + F.col("_run")).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("_at")) - 1
    return dealt.withColumn("_place", place).join(offsets, ["_digit", "_block"]).select(
        *[c for c in state.columns if c != "_at"], (F.col("_first") + F.col("_place")).alias("_at"))


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = 10, least_words: int = 20,
             seed: int = 2024) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_features, weight, score and rank.

    Of the N documents with at least ``least_words`` words the floor(N ``percent`` / 100) of highest score are drawn
    and ranked from 1 on, ties to the smaller doc_id, a null doc_id last; the rank of all others is null. ``target``
    (text) is what the draw should look like. Null and empty texts have no features and weight 0. Repeated rows are
    drawn each. Empty tables count as no features. Other columns are not read."""
    gains = bucket_gains(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    scored = save(weigh(docs, gains, n, seed), "resample-scores")
    able = scored.where(F.col("n_words") >= least_words)
    best = able.agg(F.max("score").alias("best"), F.count(F.lit(1)).alias("n")).first()
    # keys from 0 on: the higher the score the smaller; the id in two halves, since the range of ids may not fit a long
    keyed = able.select(
        "doc_id", "n_features", "weight", "score", (F.lit(best["best"] or 0) - F.col("score")).alias("_score"),
        F.when(F.col("doc_id").isNull(), 1).otherwise(0).cast("long").alias("_null"),
        (F.shiftright(F.coalesce("doc_id", F.lit(0)).cast("long"), 32) + (1 << 31)).alias("_high"),
        F.coalesce("doc_id", F.lit(0)).cast("long").bitwiseAND(0xFFFFFFFF).alias("_low"))
    ranked = radix_ranks(keyed, ["_score", "_null", "_high", "_low"])
    drawn = best["n"] * percent // 100
    out = ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return out.union(scored.where(F.col("n_words") < least_words).select(
        "doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
