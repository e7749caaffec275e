"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is halved until its parts are short; the parts are encoded and neighbours joined up the tree. A join
encodes a window around the seam anew and keeps the tokens outside. The window grows on each side to the next
place where the split pattern must end a match whatever stands around it; from there on, the tokens of both
sides are those of the whole. Where one match has no such place near, the seam is joined token by token: the
window grows until at each of its ends the two neighbouring tokens encode to themselves, and byte pair encoding
is the one sequence of tokens in which all neighbours do. Decoding concatenates up the tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import map_batches, pieces

#: Characters of a leaf: what is encoded in one call. Most texts are longer and go through joins.
LEAF_CHARS = 512
#: Characters that the window looks for an end in, before a seam inside one long match is joined by tokens.
NEAR = 12

#: Places where a match of the split pattern ends whatever comes before or after: the classes of characters
#: differ (an apostrophe may go on with a letter, white space with anything).
_SEAM = regex.compile(r"(?<=\P{White_Space})(?=\p{White_Space})|(?<=\p{L})(?=[^\p{L}\p{White_Space}])|(?<=\p{N})(?=[^\p{N}\p{White_Space}])|(?<=[^\p{White_Space}\p{L}\p{N}'])(?=[\p{L}\p{N}])")
_CLASSES = [regex.compile(x) for x in (r"\p{L}", r"\p{N}", r"[^\p{White_Space}\p{L}\p{N}']")]


class Codec:
    """``encode`` and ``decode`` for one rank file and split pattern."""

    def __init__(self, path: str, pattern: str, leaf_chars: int = LEAF_CHARS, near: int = NEAR):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        self.sizes = np.array([len(x) for x in self.table], np.int64)
        self.pattern = regex.compile(pattern)
        self.leaf, self.near = max(1, leaf_chars), near
        self.alone = lru_cache(1 << 16)(self._alone)

    def _leaf(self, text: str) -> np.ndarray:
        return self.core.encode_to_numpy(text, disallowed_special=()) if text else np.zeros(0, np.uint32)

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids (uint32) of the whole text; null is empty."""
        return self._node(text or "")

    def _node(self, text: str) -> np.ndarray:
        if len(text) <= self.leaf:
            return self._leaf(text)
        half = len(text) // 2
        return self._join(text, half, self._node(text[:half]), self._node(text[half:]))

    def _join(self, text: str, mid: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        reach = self.near
        while True:
            lo, hi = max(0, mid - reach), min(len(text), mid + reach)
            left, right = self._left(text, lo, mid), self._right(text, mid, hi)
            if left is not None and right is not None:
                return self._window(text, left, mid, right, a, b)
            if reach == self.near and any(c.match(text[mid - 1]) and c.match(text[mid]) for c in _CLASSES) \
                    and "'" not in text[max(0, mid - 3): mid]:
                return self._join_match(text, mid, a, b)
            reach *= 4

    @staticmethod
    def _left(text: str, lo: int, mid: int) -> int | None:
        """The last certain end of a match in text[:mid] from ``lo`` on. 0 is one."""
        at = [m.start() for m in _SEAM.finditer(text, lo, mid) if lo < m.start() < mid]
        return at[-1] if at else (0 if lo == 0 else None)

    @staticmethod
    def _right(text: str, mid: int, hi: int) -> int | None:
        """The first certain end of a match after ``mid``. The end of the text is one."""
        for m in _SEAM.finditer(text, mid, hi):
            if mid < m.start() < hi:
                return m.start()
        return len(text) if hi == len(text) else None

    def _drop(self, ids: np.ndarray, size: int, back: bool) -> int:
        """How many tokens at one end of ``ids`` make up ``size`` bytes."""
        some = 16
        while True:
            part = ids[-some:][::-1] if back else ids[:some]
            sums = np.cumsum(self.sizes[part])
            if size == 0:
                return 0
            if len(sums) and sums[-1] >= size:
                n = int(np.searchsorted(sums, size)) + 1
                assert sums[n - 1] == size
                return n
            some *= 4

    def _window(self, text: str, left: int, mid: int, right: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = self._drop(a, len(text[left:mid].encode()), True)
        y = self._drop(b, len(text[mid:right].encode()), False)
        return np.concatenate([a[: len(a) - x], self._leaf(text[left:right]), b[y:]])

    def _alone(self, x: int, y: int) -> bool:
        """Whether two tokens stand side by side in the encoding of their bytes."""
        return list(self.core._core_bpe.encode_single_piece(self.table[x] + self.table[y])) == [x, y]

    def _join_match(self, text: str, mid: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Join inside one match that goes on far beyond the seam on at least one side."""
        start, end, reach = None, None, self.near
        while start is None or end is None:
            reach *= 4
            start = self._left(text, max(0, mid - reach), mid) if start is None else start
            end = self._right(text, mid, min(len(text), mid + reach)) if end is None else end
        # scanned from a certain end, the last match before the seam is that of the whole text, as far as the seam
        for m in self.pattern.finditer(text, start, mid):
            start = m.start()
        end = self.pattern.match(text, mid, end).end()
        most_x, most_y = self._drop(a, len(text[start:mid].encode()), True), self._drop(b, len(text[mid:end].encode()), False)
        x, y = min(4, most_x), min(4, most_y)
        while True:
            raw = b"".join(self.table[i] for i in (*a[len(a) - x:], *b[:y]))
            ids = self.core._core_bpe.encode_single_piece(raw)
            good_x = x == most_x or self.alone(int(a[len(a) - x - 1]), ids[0])
            good_y = y == most_y or self.alone(ids[-1], int(b[y]))
            if good_x and good_y:
                return np.concatenate([a[: len(a) - x], np.array(ids, np.uint32), b[y:]])
            x, y = (x if good_x else min(most_x, 2 * x)), (y if good_y else min(most_y, 2 * y))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, halves first."""
        if len(ids) <= 1 << 16:
            return self.core._core_bpe.decode_bytes(ids.tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(4)
def codec(name: str, leaf_chars: int = LEAF_CHARS) -> Codec:
    """The codec of a rank file of ``public_tokenizers``; loaded once in each Python worker."""
    import public_tokenizers

    return Codec(public_tokenizers.path(name), public_tokenizers.PATTERN, leaf_chars)


RANKS = "byte_bpe_multi_50k.tiktoken"


def encode_documents(docs: DataFrame, ranks: str = RANKS, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id and ids (array<int>) of every row; a null text is empty and has no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, leaf_chars)
        for part in (p for b in batches for p in pieces(b)):
            ids = [c.encode(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id and text of rows with ids; bytes that are not UTF-8 become replacement characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for b in batches:
            text = [c.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, ranks: str = RANKS, leaf_chars: int = LEAF_CHARS, keep_ids: bool = False) -> DataFrame:
    """Each row's text encoded and the ids decoded: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if they
    are to be kept. One row for each row of ``docs``; null and empty texts have 0 tokens; other columns are not
    read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, leaf_chars)
        for part in (p for b in batches for p in pieces(b)):
            n, ids_sha, text_sha, kept = [], [], [], []
            for text in part.column("text"):
                ids = c.encode(text.as_py())
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
                kept.append(ids.astype(np.int32) if keep_ids else None)
            columns = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(n, pa.int64()),
                       "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if keep_ids:
                columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return map_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)


def token_counts(docs: DataFrame, ranks: str = RANKS, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id and n_tokens of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, leaf_chars)
        for part in (p for b in batches for p in pieces(b)):
            n = [len(c.encode(t.as_py())) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id bigint, n_tokens bigint")
