"""Packing of tokenized documents into windows by order-preserving dynamic programming.

The documents of a partition, in their order, are one stream of tokens that is cut into windows of at most ``size``
tokens. A cut may stand after a document, after a sentence, or, where neither is near, inside a sentence; the further
down this list, the more it costs. A window costs its padding: ``size`` less its length, or nothing if its length is
a power of two. The cheapest cuts follow from

    f(j) = cut(j) + min over i < j <= i + size of  f(i) + padding(j - i),

where f(i) + size - (j - i) is f(i) + i but for a term in j alone: its minimum over a sliding range of i stands at the
front of a monotone queue. Lengths that are powers of two are looked up besides. Every place enters and leaves
the queue once, so the time is linear in the number of places to cut at.

A partition is worked off in blocks of a bounded number of tokens; a block ends in the cheapest place within its
last window, and what is left goes into the next one. One long document may be a block of its own.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.bpe import Codec, codec
from demandspark.llm.common import pieces

#: Ranks of the vocabulary of ``byte_bpe_50k.json``: the same ids, from a library that splits long texts.
RANKS = "byte_bpe_50k.tiktoken"
#: Characters that the codec encodes in one call.
LEAF_CHARS = 1 << 14
#: Tokens that one run of the dynamic programme looks at.
BLOCK_TOKENS = 1 << 19
_SENTENCE_ENDS = tuple(x.encode() for x in (".", "!", "?", "\n", "。", "！", "？"))


@dataclass(frozen=True)
class Costs:
    """Costs in tokens of padding: of a cut after a sentence, of one inside a sentence, and of a window as such.
    Cuts inside sentences stand ``stride`` tokens apart, in sentences that are longer."""

    sentence: int = 1
    inside: int = 8
    window: int = 2
    stride: int = 16
    #: The shortest power of two that a window may have instead of padding.
    shortest: int = 64


def cut_places(ids: np.ndarray, ends: np.ndarray, closing: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """Places to cut a stream of ids at, and what each costs. ``ends``: where documents end, the last one that of the
    stream; ``closing``: whether the token of an id closes a sentence."""
    after = np.flatnonzero(closing[ids]) + 1
    after = after[after < len(ids)]
    places = np.union1d(after, ends)
    gaps = np.diff(places, prepend=0)
    wide = np.flatnonzero(gaps > costs.stride)
    many = (gaps[wide] - 1) // costs.stride
    first = places[wide] - gaps[wide]
    inside = np.repeat(first, many) + (np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + 1) * costs.stride
    places = np.concatenate([places, inside])
    price = np.full(len(places), costs.sentence, np.int64)
    price[len(places) - len(inside):] = costs.inside
    order = np.argsort(places, kind="stable")
    places, price = places[order], price[order]
    price[np.searchsorted(places, ends)] = 0
    return places, price


def best_cuts(places: np.ndarray, price: np.ndarray, size: int, costs: Costs, last: bool) -> tuple[list[int], int]:
    """Places of the cheapest cuts of a stream from 0 on, and their cost; the last one is the stream's end if this is
    the ``last`` block, else it lies within ``size`` of the end. Neighbouring places are at most ``size`` apart."""
    at = np.concatenate([[0], places])
    powers = [1 << k for k in range(size.bit_length()) if costs.shortest <= 1 << k < size]
    jumps = []
    for p in powers:
        i = np.searchsorted(at, at - p)
        jumps.append(np.where(at[np.minimum(i, len(at) - 1)] == at - p, i, -1).tolist())
    at, price = at.tolist(), [0, *price.tolist()]
    cost, back = [0] * len(at), [0] * len(at)
    queue: deque[int] = deque([0])
    keys = [0] * len(at)  # cost + place: what the queue is ordered by
    for j in range(1, len(at)):
        here = at[j]
        while here - at[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        least = keys[i] + size - here
        for jump in jumps:
            k = jump[j]
            if k >= 0 and cost[k] < least:
                least, i = cost[k], k
        cost[j] = least = least + price[j] + costs.window
        back[j] = i
        key = keys[j] = least + here
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    j = len(at) - 1
    if not last:
        within = int(np.searchsorted(at, at[-1] - size, "right"))
        j = min(range(max(1, within), len(at)), key=lambda x: (cost[x], -x))
    total, cuts = cost[j], []
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1], total


def power_lengths(length: int, size: int, costs: Costs) -> list[int]:
    """The lengths that the last window of a partition is cut into: powers of two, if cheaper than its padding."""
    parts = [1 << k for k in range(size.bit_length()) if length >> k & 1][::-1]
    return parts if (len(parts) - 1) * (costs.inside + costs.window) < size - length else [length]


class _Packer:
    """The stream of one partition: documents go in, pieces come out."""

    def __init__(self, code: Codec, size: int, costs: Costs, block: int, part: int):
        self.code, self.size, self.costs, self.block = code, size, costs, block
        # a closing token of a sentence ends in one of its characters, be there quotes or brackets behind it or not
        self.closing = np.array([t.rstrip(b" \"')]").endswith(_SENTENCE_ENDS) for t in code.table] + [False], bool)
        self.window = (part << 33) - 1
        self.waiting: list[tuple[int | None, np.ndarray, int, int]] = []  # doc_id, ids left, ids before them, all ids
        self.held = 0

    def add(self, doc_id: int | None, text: str | None) -> Iterator[tuple]:
        ids = np.append(self.code.encode(text), np.uint32(0)).astype("<u4")
        self.waiting.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)
        if self.held >= self.block:
            yield from self.pack(False)

    def pack(self, last: bool) -> Iterator[tuple]:
        """Pieces (doc_id, start, length, crc, doc_tokens, sequence_id, offset) of the block; what lies behind the last cut waits."""
        if not self.waiting:
            return
        ids = np.concatenate([w[1] for w in self.waiting])
        begins = np.concatenate([[0], np.cumsum([len(w[1]) for w in self.waiting])])
        places, price = cut_places(ids, begins[1:], self.closing, self.costs)
        cuts, _ = best_cuts(places, price, self.size, self.costs, last)
        if last:
            start = cuts[-2] if len(cuts) > 1 else 0
            cuts[-1:] = (start + np.cumsum(power_lengths(cuts[-1] - start, self.size, self.costs))).tolist()
        edges = np.union1d(begins, cuts)
        edges = edges[edges <= cuts[-1]].tolist()
        doc, at, cut = 0, 0, -1
        firsts = [0, *cuts]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            while begins[doc + 1] <= a:
                doc += 1
            if a == firsts[cut + 1]:
                cut, at = cut + 1, a
                self.window += 1
            doc_id, part, before, total = self.waiting[doc]
            begin = int(begins[doc])
            yield (doc_id, before + a - begin, b - a, zlib.crc32(part[a - begin: b - begin].tobytes()), total, self.window, a - at)
        rest = []
        for doc in range(int(np.searchsorted(begins, cuts[-1], "right")) - 1, len(self.waiting)):
            doc_id, part, before, total = self.waiting[doc]
            gone = max(0, cuts[-1] - int(begins[doc]))
            rest.append((doc_id, part[gone:].copy(), before + gone, total))
        self.waiting, self.held = rest, len(ids) - cuts[-1]


def pack_documents(docs: DataFrame, size: int = 1024, costs: Costs = Costs(), ranks: str = RANKS,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each piece of a row of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A document is its ids and the id 0 behind them; null and empty texts are the id 0 alone. Pieces of one
    sequence_id, by offset, are a window of at most ``size`` ids, gapless from 0. Documents follow each other as in the
    partition that they are read in, and each partition has windows of its own. Null and repeated doc_ids are
    documents like others; other columns are not read; an empty table gives an empty result."""
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(codec(ranks, LEAF_CHARS), size, costs, block_tokens, TaskContext.get().partitionId())

        def rows(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names)

        for part in (p for b in batches for p in pieces(b)):
            found = [x for i, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True)
                     for x in packer.add(i, text.as_py())]
            if found:
                yield rows(found)
        if found := list(packer.pack(True)):
            yield rows(found)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
