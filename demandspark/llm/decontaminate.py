"""Benchmark decontamination by the q-gram lemma.

A passage is any window of ``length`` bytes of a benchmark item. A text holds it within ``edits`` edits only if, in
some band of neighbouring diagonals (place in the text minus place in the item), they share at least
length + 1 - q (edits + 1) q-grams of the window. Shared q-grams are sorted by item, band (bands overlap, so that no
match is split) and place; every window in which enough of them lie is kept and verified by an alignment within the
band. Letters A-Z and a-z, and all white space, are taken as equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import by_number, filtered, map_batches, numbered, pieces, row_key, save, text_buffer, without
from demandspark.llm.rolling import FOLDED, char_hashes

#: Bytes of benchmark text that one pass over the documents looks for.
BLOCK_BYTES = 8 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[[0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0x20
_VALUES = FOLDED[_FOLD]
_FILTER_BITS = 22
#: Bytes of text whose q-grams are looked up in one step (about a hundred bytes a byte), and shared q-grams that are laid out at a time.
STEP_BYTES = 1 << 17
PART_GRAMS = 1 << 16


@dataclass(frozen=True)
class Item:
    item: int
    text: bytes
    window: int
    edits: int
    q: int
    offset: int = 0

    @property
    def least(self) -> int:
        """Shared q-grams that a window has at least, if it matches within the budget."""
        return self.window + 1 - self.q * (self.edits + 1)


def make_items(item: int, text: str | None, q: int, length: int, rate: float) -> list[Item]:
    """The item with its budget, in the parts whose windows are not those of an earlier place: of an item that repeats
    itself each window is looked for once. One of fewer than q bytes is one q-gram of all of them: found by exact match."""
    raw = _FOLD[np.frombuffer((text or "").strip().encode(), np.uint8)]
    if not len(raw):
        return []
    window, q = min(length, len(raw)), min(q, len(raw))
    # as many edits as the rate allows and the lemma can still filter
    edits = max(0, min(int(rate * window), window // q - 1))
    fresh = np.zeros(len(raw) - window + 1, bool)
    fresh[np.unique(char_hashes(raw, window), return_index=True)[1]] = True
    ends = np.flatnonzero(np.diff(np.concatenate([[False], fresh, [False]]).astype(np.int8)))
    return [Item(item, raw[a: b - 1 + window].tobytes(), window, edits, q, int(a)) for a, b in zip(ends[::2], ends[1::2], strict=True)]


class Index:
    """All q-grams of some items of one q, sorted by hash."""

    def __init__(self, items: list[Item], q: int):
        self.items, self.q = items, q
        grams = [char_hashes(np.frombuffer(p.text, np.uint8), q, _VALUES) for p in items]
        hashes = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, np.int64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.width = np.array([p.edits + 1 for p in items], np.int64)
        self.least = np.array([p.least for p in items], np.int64)
        self.window = np.array([p.window for p in items], np.int64)
        self.last = np.array([len(p.text) - p.window for p in items], np.int64)
        #: Bytes of text that a window's match takes at most.
        self.reach = max([p.window + p.edits + q for p in items], default=0)

    def regions(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows (text, item, first diagonal of the band, first and last start of windows) that reach the bound;
        diagonals count from the text's start."""
        h = char_hashes(buf, self.q, _VALUES)
        hit = np.flatnonzero(self.filter[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        lo = np.searchsorted(self.hashes, h[hit], "left")
        many = np.searchsorted(self.hashes, h[hit], "right") - lo
        hit, lo, many = hit[many > 0], lo[many > 0], many[many > 0]
        row = np.searchsorted(at, hit, "right") - 1
        inside = hit + self.q <= at[row + 1]
        hit, lo, many, row = hit[inside], lo[inside], many[inside], row[inside]
        found = [np.zeros((0, 5), np.int64)]
        # a bounded number of shared q-grams at a time; each part takes up again what a match that the cut goes through has
        cuts = np.concatenate([[0], np.cumsum(many)])
        start = 0
        while start < len(hit):
            again = int(np.searchsorted(hit, hit[start] + self.reach, "right"))
            most = max(PART_GRAMS, 4 * int(cuts[again] - cuts[start]))
            stop = max(again, int(np.searchsorted(cuts, cuts[start] + most, "right")) - 1)
            found.append(self._bands(hit[start:stop], lo[start:stop], many[start:stop], row[start:stop], at))
            if stop >= len(hit):
                break
            start = max(start + 1, int(np.searchsorted(hit, hit[stop] - self.reach, "left")))
        return np.unique(np.concatenate(found), axis=0)

    def _bands(self, hit: np.ndarray, lo: np.ndarray, many: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        entry = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        item, row, pos, place = self.owner[entry], np.repeat(row, many), np.repeat(hit, many), self.place[entry]
        band = (pos - at[row] - place) // self.width[item]  # two widths each, at every width: each diagonal is in two
        row, item, place = (np.concatenate([x, x]) for x in (row, item, place))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item, row))
        row, item, band, place = row[order], item[order], band[order], place[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
        key = np.cumsum(new)
        # the bound is reached by each run of `least` shared q-grams that one window holds
        i = np.arange(len(key))
        j = i + self.least[item] - 1
        i, j = i[j < len(key)], j[j < len(key)]
        i, j = i[key[i] == key[j]], j[key[i] == key[j]]
        first = np.maximum(0, place[j] - (self.window - self.q)[item[i]])
        last = np.minimum(place[i], self.last[item[i]])
        i, first, last = i[first <= last], first[first <= last], last[first <= last]
        if not len(i):
            return np.zeros((0, 5), np.int64)
        # both ends only grow within a key: runs that touch are one range of starts
        head = np.flatnonzero(np.concatenate([[True], (key[i][1:] != key[i][:-1]) | (first[1:] > last[:-1] + 1)]))
        tail = np.append(head[1:], len(i)) - 1
        k = i[head]
        return np.stack([row[k], item[k], band[k] * self.width[item[k]], first[head], last[tail]], 1)


def window_distances(windows: np.ndarray, regions: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the fewest edits that turn the window into some part of the region's first ``sizes`` bytes, and
    where that part ends."""
    steps = np.arange(regions.shape[1] + 1, dtype=np.int32)
    row = np.zeros((len(windows), len(steps)), np.int32)
    best = np.empty_like(row)
    for i in range(windows.shape[1]):
        best[:, 0] = i + 1
        np.minimum(row[:, :-1] + (regions != windows[:, i: i + 1]), row[:, 1:] + 1, out=best[:, 1:])
        row = np.minimum.accumulate(best - steps, axis=1) + steps
    row[steps > sizes[:, None]] = windows.shape[1] + 1
    return row.min(1), row.argmin(1)


def band_distance(probe: bytes, region: bytes) -> tuple[int, int]:
    """Fewest edits that turn the probe into some part of the region, and where that part ends."""
    if (found := region.find(probe)) >= 0:
        return 0, found + len(probe)
    edits, end = window_distances(*(np.frombuffer(x, np.uint8)[None] for x in (probe, region)), np.array([len(region)]))
    return int(edits[0]), int(end[0])


def matches(item: Item, text: np.ndarray, diagonal: int, first: int, last: int) -> Iterator[tuple[int, int, int, int]]:
    """Start and end in the (folded) text, start in the item and edits of each window that matches in the band."""
    m, width = item.window, item.edits + 1
    raw = np.frombuffer(item.text, np.uint8)
    span = 2 * width + m + item.edits
    for a in range(first, last + 1, 256):
        starts = np.arange(a, min(last + 1, a + 256))
        lo = np.maximum(0, diagonal + starts)
        sizes = np.minimum(len(text), diagonal + starts + span) - lo
        place = lo[:, None] + np.arange(span)
        regions = text[np.minimum(place, len(text) - 1)]
        windows = raw[starts[:, None] + np.arange(m)]
        edits, ends = np.full(len(starts), m + 1), np.zeros(len(starts), np.int64)
        for d in range(span - m, -1, -1):
            same = (d + m <= sizes) & (regions[:, d: d + m] == windows).all(1)
            edits[same], ends[same] = 0, d + m
        rest = np.flatnonzero(edits > 0) if item.edits else []
        if len(rest):
            edits[rest], ends[rest] = window_distances(windows[rest], regions[rest], sizes[rest])
        for k in np.flatnonzero(edits <= item.edits):
            end = int(lo[k] + ends[k])
            yield max(0, end - m), end, int(starts[k]) + item.offset, int(edits[k])


def find_passages(docs: DataFrame, benchmark: DataFrame, q: int = 12, length: int = 100, rate: float = 0.05,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Passages of ``benchmark`` (item_id, text) in ``docs`` (doc_id, text): row, doc_id, item_id, start and end
    (bytes of the text's UTF-8), probes (windows of the item that were found), edits (fewest of one).

    A passage is any ``length`` bytes of an item (all of it, if it is shorter) with at most ``rate`` edits a byte. An
    item of fewer than ``q`` bytes is found by exact match.
    The benchmark is looked for in blocks of a fixed number of bytes, each in one pass over all documents, so
    neither side has to be small. Null and empty texts and items match nothing; an item in several rows is one
    item; repeated rows of ``docs`` are reported each. No probes or no rows give an empty result.
    """
    keyed = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _passages(keyed, False, benchmark, q, length, rate, block_bytes)


def _passages(keyed: DataFrame, saved: bool, benchmark: DataFrame, q: int = 12, length: int = 100, rate: float = 0.05,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    schema = "row bigint, doc_id bigint, item_id bigint, start bigint, end bigint, probes bigint, edits bigint"
    sized, blocks = _benchmark(benchmark, block_bytes)
    if blocks == 1:
        return map_batches(keyed, _finder(keyed, _indexes(sized, 0, 1, q, length, rate)), schema)
    out = keyed.sparkSession.createDataFrame([], schema)
    if not saved:  # read once for each block
        keyed = save(keyed, "leak-docs")
    for block in range(blocks):  # one index at a time, on the driver and in the tasks
        finder = _finder(keyed, _indexes(sized, block, blocks, q, length, rate))
        out = out.unionByName(save(map_batches(keyed, finder, schema), "leak-block"))
        finder.shared.destroy()
    return out.groupBy("row", "doc_id", "item_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("probes").alias("probes"), F.min("edits").alias("edits"))


def _benchmark(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The items that are looked for, saved with a key, and the number of blocks they make."""
    items = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    sized = save(items.withColumn("key", F.monotonically_increasing_id()), "benchmark-items")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return sized, -(-total // block_bytes) or 1


def _indexes(sized: DataFrame, block: int, blocks: int, q: int, length: int, rate: float) -> list[Index]:
    rows = sized.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).select("item_id", "text").collect()
    made = [x for i, t in sorted(rows) for x in make_items(i, t, q, length, rate)]
    return [Index([x for x in made if x.q == size], size) for size in sorted({x.q for x in made})]


def found_in(part: pa.RecordBatch, indexes: list[Index]) -> dict[tuple[int, int], list]:
    """(row of the batch, item_id) to its matches: start, end, window of the item, edits."""
    buf, at = text_buffer(part.column("text"))
    found: dict[tuple[int, int], list] = {}
    folded = _FOLD[buf]
    for ix in indexes:
        regions, whole = ix.regions(buf, at), ix.window == ix.q
        for row, k in np.unique(regions[whole[regions[:, 1]]][:, :2], axis=0).tolist():  # items of one q-gram
            item, text = ix.items[k], folded[at[row]: at[row + 1]].tobytes()
            for start in {text.find(item.text), text.rfind(item.text)} - {-1}:
                found.setdefault((row, item.item), []).append((start, start + ix.q, 0, 0))
        for row, k, diagonal, first, last in regions[~whole[regions[:, 1]]].tolist():
            item, text = ix.items[k], folded[at[row]: at[row + 1]]
            for match in matches(item, text, diagonal, first, last):
                found.setdefault((row, item.item), []).append(match)
    return found


def _finder(docs: DataFrame, indexes: list[Index]):
    shared = docs.sparkSession.sparkContext.broadcast(indexes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in pieces(b, limit=STEP_BYTES)):
            if found := found_in(part, shared.value):
                ids, keys = part.column("doc_id").to_pylist(), part.column("row").to_pylist()
                rows = [(keys[r], ids[r], item, min(x[0] for x in m), max(x[1] for x in m), len({x[2] for x in m}), min(x[3] for x in m))
                        for (r, item), m in sorted(found.items())]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                 ["row", "doc_id", "item_id", "start", "end", "probes", "edits"])

    run.shared = shared
    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, q: int = 12, length: int = 100, rate: float = 0.05,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark; all columns are kept, whatever their names.

    A row's own text decides: with a benchmark of one block, rows are looked at and filtered in one pass; a larger one is
    looked for block by block, and the rows found go at the end. Null and empty texts stay, repeated rows go or stay
    together, an empty table stays empty, and without items nothing goes."""
    sized, blocks = _benchmark(benchmark, block_bytes)
    if blocks == 1:
        shared = docs.sparkSession.sparkContext.broadcast(_indexes(sized, 0, 1, q, length, rate))

        def clean(part: pa.RecordBatch) -> np.ndarray:
            keep = np.ones(len(part), bool)
            keep[[r for r, _ in found_in(part, shared.value)]] = False
            return keep

        return filtered(docs, clean, STEP_BYTES)
    rows, name = numbered(docs, "leak-docs")
    gone = _passages(by_number(rows, name), True, benchmark, q, length, rate, block_bytes)
    return without(rows, name, save(gone.select("row").distinct(), "leaks"))
