"""Documents scored by cross-entropy difference between two n-gram language models.

A target model (texts one wants more of) and a background model (all texts) share one vocabulary, the words of the whole
corpus, and the same smoothing and interpolation, so that they differ in what they were trained on and nothing else. A
document's score is the mean over its tokens of the target model's loss less the background model's: the lower, the
closer to the target.

Counts are exact and grow with the corpus; neither the driver nor any one task holds them. Texts are laid out once in
blocks. A block names each of its distinct words and word pairs once, so a word that a third of all tokens are is
one entry for each block; the entries meet in bins of their hash, and the bins' sums go back to the blocks, whose texts
are then scored. Texts lie in a table bucketed by block: what is joined to them moves, they do not.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import by_cogroup, by_group, map_batches, pieces, row_key, save, shared_folder, text_buffer
from demandspark.llm.rolling import NOT_SPACE, mix, word_hashes, word_spans

#: Bytes of text in a block (one text if that is longer) and, about, of the texts whose entries meet in one bin.
BLOCK_BYTES = 8 << 20
BIN_BYTES = 8 << 20
#: Tokens whose losses are worked out in one step.
TOKENS = 1 << 18
#: The place before a text's first word. Keys of words are odd and those of pairs even.
START = np.uint64(0x5851F42D4C957F2D)
_ONE = np.uint64(1)


def _column(side: pa.Table, name: str) -> list:
    """Values of a column of one side of a cogroup: none if the side has no rows (it then has no columns either)."""
    return side.column(name).to_pylist() if len(side) else []


def _cut(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of ``values`` from each of ``edges`` to the next as a binary."""
    ends = pa.py_buffer((edges * values[:1].nbytes).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, ends, pa.py_buffer(values.tobytes())])


def pack(b: np.ndarray, t: np.ndarray, edges: np.ndarray) -> list[pa.Array]:
    """Counts in all and in target rows (the second at most the first), a binary of each from each of ``edges`` to the next:
    one byte a count, and for those of 255 or more their place, b and t as 8 bytes each in a third binary."""
    large = np.flatnonzero(b >= 255)
    starts = np.searchsorted(large, edges)
    own = large - np.repeat(edges[:-1], np.diff(starts))
    small = np.where(b < 255, t, 0).astype(np.uint8)
    return [_cut(np.minimum(b, 255).astype(np.uint8), edges), _cut(small, edges), _cut(np.stack([own, b[large], t[large]], 1).astype("<i8"), starts)]


def unpack(side: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts of all rows' binaries one after the other, and where each row begins and the last ends."""
    rows = _column(side, "b")
    edges = np.concatenate([[0], np.cumsum([len(x) for x in rows], dtype=np.int64)])
    b, t = (np.frombuffer(b"".join(x), np.uint8).astype(np.int64) for x in (rows, _column(side, "t")))
    large = _column(side, "large")
    places = np.frombuffer(b"".join(large), "<i8").reshape(-1, 3)
    at = places[:, 0] + np.repeat(edges[:-1], [len(x) // 24 for x in large])
    b[at], t[at] = places[:, 1], places[:, 2]
    return b, t, edges


def events(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, key of the word, whether it is its text's first, and key of its pair with the word before, of every token."""
    found, row = [], 0
    for part in pieces(pa.record_batch([texts], ["text"])):
        buf, at = text_buffer(part.column(0))
        starts, ends, rows = word_spans(buf, at, NOT_SPACE)
        word, first = word_hashes(buf, starts, ends) | _ONE, np.diff(rows, prepend=-1) > 0
        prior = np.empty_like(word)
        prior[1:] = word[:-1]
        prior[first] = START
        found.append(((rows + row).astype(np.int32), word, first, mix(mix(prior) ^ word) & ~_ONE))
        row += len(part)
    none = (np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*(found or [none]), strict=True))


def entries(word: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Distinct keys of a block in order (words, pairs and, if there are any, ``START``), and the places in them of each
    token's word, of its pair, and of ``START``."""
    words, at_word = np.unique(word, return_inverse=True)
    pairs, at_pair = np.unique(pair, return_inverse=True)
    keys = np.concatenate([words, pairs, [START][: len(words)]]).astype(np.uint64)
    order = np.argsort(keys)
    place = np.empty(len(keys), np.int32)
    place[order] = np.arange(len(keys), dtype=np.int32)
    return keys[order], place[at_word], place[at_pair + len(words)], int(place[-1]) if len(keys) else 0


def shorten(keys: np.ndarray, edges: np.ndarray, bases: np.ndarray) -> np.ndarray:
    """Ordered keys as differences (the first after each of ``edges`` from its base), in as many bytes as the largest takes."""
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[edges[:-1]] = keys[edges[:-1]] - bases
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def lengthen(shorts: list[bytes], numbers: np.ndarray, base: np.uint64) -> np.ndarray:
    """The keys of one bin's rows, one after the other, from their differences and how many each row has."""
    out = []
    for x, n in zip(shorts, numbers, strict=True):
        steps = np.zeros((n, 8), np.uint8)
        steps[:, : len(x) // n] = np.frombuffer(x, np.uint8).reshape(n, -1)
        out.append(np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64) + base)
    return np.concatenate(out or [np.zeros(0, np.uint64)])


def in_blocks(docs: DataFrame, target: Column, size: int) -> DataFrame:
    """``docs`` as a saved table (block, row, doc_id, text, target) bucketed by block, in some 256 MB a bucket and, for
    smaller tables, up to 200 buckets. It is written from the scan, without a shuffle, one file for each block."""
    keyed = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.coalesce(target, F.lit(False)).alias("target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 33, 0
        for part in (p for b in batches for p in pieces(b)):
            got = part.column("text").nbytes
            if held and held + got > BLOCK_BYTES:
                block, held = block + 1, 0
            held += got
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), *part.columns], ["block", *part.schema.names])

    name = f"lm_blocks_{uuid.uuid4().hex}"
    (map_batches(keyed, run, "block bigint, row bigint, doc_id bigint, text string, target boolean").write.format("parquet")
     .bucketBy(max(size >> 28, min(size >> 22, 200)) + 1, "block").option("compression", "zstd")
     .option("path", f"{shared_folder(docs.sparkSession)}/{name}").saveAsTable(name))
    return docs.sparkSession.table(name)


def _bases(bins: int) -> np.ndarray:
    """The smallest key of each bin; ``bins`` is a power of two."""
    return np.arange(bins, dtype=np.uint64) * np.uint64((1 << 64) // bins % (1 << 64))


def block_counts(blocks: DataFrame, wanted: DataFrame, bins: int) -> DataFrame:
    """For each block and bin with entries of it: bin, block, the keys as in ``shorten``, and how often they occur in all
    rows and in the ``wanted`` ones (block, row), as in ``pack``."""
    def run(texts: pa.Table, chosen: pa.Table) -> pa.Table:
        rows, word, first, pair = events(texts.column("text").combine_chunks())
        keys, at_word, at_pair, start = entries(word, pair)
        marked = np.isin(texts.column("row").to_numpy(), np.array(_column(chosen, "chosen"), np.int64))[rows]
        counts = []
        for taken in (np.ones(len(rows), bool), marked):
            counts.append(np.bincount(at_word[taken], minlength=len(keys)) + np.bincount(at_pair[taken], minlength=len(keys)))
            counts[-1][start: start + 1] += (first & taken).sum()
        lows = _bases(bins)
        edges = np.searchsorted(keys, lows)
        used = np.flatnonzero(np.diff(np.append(edges, len(keys))))
        edges = np.append(edges[used], len(keys))
        return pa.Table.from_arrays([pa.array(used, pa.int32()), pa.array(np.full(len(used), texts.column("block")[0].as_py())),
                                     _cut(shorten(keys, edges, lows[used]), edges), *pack(*counts, edges)],
                                    ["bin", "block", "keys", "b", "t", "large"])

    chosen_rows = wanted.select(F.col("block").alias("at"), F.col("row").alias("chosen"))  # names of its own: both sides are one table
    return blocks.select("block", "row", "text").groupBy("block").cogroup(chosen_rows.groupBy("at")).applyInArrow(
        by_cogroup(run), "bin int, block bigint, keys binary, b binary, t binary, large binary")


def corpus_counts(counted: DataFrame, bins: int) -> DataFrame:
    """Sums over all blocks for the keys of each block and bin (block, bin, and counts as in ``pack`` in the order of the
    keys). One row of each bin also tells how many distinct words the bin has, and their occurrences in all and in
    wanted rows."""
    def run(rows: pa.Table) -> pa.Table:
        *own, edges = unpack(rows)
        keys = lengthen(_column(rows, "keys"), np.diff(edges), _bases(bins)[rows.column("bin")[0].as_py()])
        keys, place = np.unique(keys, return_inverse=True)
        b, t = (np.bincount(place, c, len(keys)).astype(np.int64) for c in own)
        words = (keys & _ONE == _ONE) & (keys != START)
        once = np.zeros((3, len(rows)), np.int64)
        once[:, 0] = words.sum(), b[words].sum(), t[words].sum()
        return pa.Table.from_arrays([rows.column("block"), rows.column("bin"), *pack(b[place], t[place], edges), *map(pa.array, once)],
                                    ["block", "bin", "b", "t", "large", "words", "all_tokens", "target_tokens"])

    return counted.groupBy("bin").applyInArrow(
        by_group(run), "block bigint, bin int, b binary, t binary, large binary, words bigint, all_tokens bigint, target_tokens bigint")


def losses(word: np.ndarray, prior: np.ndarray, pair: np.ndarray, tokens: int, words: int, trust: float = 4.0) -> np.ndarray:
    """-log p of each token from the counts of its word, the word before and their pair: add-one words, and pairs
    interpolated with them (a word seen c times is trusted by c / (c + trust) as the one before; that a text ends
    after it is one of the ways to go on)."""
    single = (word + 1.0) / (tokens + words)
    return -np.log((pair + trust * single) / (prior + trust))


def score_documents(docs: DataFrame, target: Column | DataFrame) -> DataFrame:
    """One row for each row of ``docs``: row, doc_id, n_tokens, target_loss, background_loss (means per token)
    and difference (of the two: the lower, the more like the target).

    ``target`` is a condition on ``docs`` (null is false), or a table whose ``doc_id`` are those of the target rows (nulls
    and repeated ids in it count for nothing more). If it never holds, the target model is uniform over the words. Words
    stand between white space, A-Z are taken as a-z; 63-bit hashes stand for words and pairs. Null and empty texts
    have no tokens and 0 for all three; rows that repeat count and are scored one by one; an empty table gives no rows;
    further columns are not looked at. A text is one task's work, whatever its length."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    given = isinstance(target, DataFrame)
    blocks = in_blocks(docs, F.lit(False) if given else target, size)
    wanted = blocks.select("block", "row", "doc_id").join(target.select("doc_id"), "doc_id", "left_semi") if given else blocks.where("target")
    bins = 1 << (size // BIN_BYTES).bit_length()
    sums = save(corpus_counts(block_counts(blocks, wanted, bins), bins), "lm-counts")
    words, all_tokens, target_tokens = (x or 0 for x in sums.agg(F.sum("words"), F.sum("all_tokens"), F.sum("target_tokens")).first())

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        rows, word, first, pair = events(texts.column("text").combine_chunks())
        _, at_word, at_pair, start = entries(word, pair)
        del word, pair
        before = np.where(first, start, np.concatenate([at_word[:1], at_word[:-1]]))
        in_all, in_target, _ = unpack(found.sort_by("bin") if len(found) else found)
        count = np.bincount(rows, minlength=len(texts))
        t, b = np.zeros((2, len(texts)))
        for part in (slice(i, i + TOKENS) for i in range(0, len(rows), TOKENS)):
            for out, c, total in ((t, in_target, target_tokens), (b, in_all, all_tokens)):
                out += np.bincount(rows[part], losses(c[at_word[part]], c[before[part]], c[at_pair[part]], total, words), len(texts))
        t, b = t / np.maximum(count, 1), b / np.maximum(count, 1)
        return pa.Table.from_arrays([texts.column("row"), texts.column("doc_id"), *map(pa.array, (count.astype(np.int64), t, b, t - b))],
                                    ["row", "doc_id", "n_tokens", "target_loss", "background_loss", "difference"])

    return blocks.select("block", "row", "doc_id", "text").groupBy("block").cogroup(sums.select("block", "bin", "b", "t", "large").groupBy("block")).applyInArrow(
        by_cogroup(run), "row bigint, doc_id bigint, n_tokens bigint, target_loss double, background_loss double, difference double")
