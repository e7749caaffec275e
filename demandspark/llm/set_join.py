"""Exact Jaccard join of documents on word n-grams, with the relations between sets used to skip work.

Each document is the set of its word n-grams (64-bit hashes). Sets are indexed by their prefixes: the rarest
n-grams, of which two sets that link must share one. The index lists are sorted and read in order, so that

* a list in which all entries are one set (exact copies) is skipped at once, and so is each entry whose size and
  position rule out a link with all others of its list;
* in each list the sets of nearly one size are first compared with the first of them only, and those that link
  to it take over its component as their answer (they are highly similar, so its answers are theirs);
* what remains to be found are links between different components. Lists are then cut into blocks by component,
  size and position; pairs of blocks whose size and position rule out enough shared n-grams are skipped whole,
  pairs within one component are never looked at, and only the blocks left are opened and verified;
* two sets meet in the list of the first n-gram they share: each entry names the n-grams its set has in the lists
  just before it, and pairs that have one of those in common are left to the list where they met.

No pair is lost: a pair is skipped only if its bound rules the link out, both sets already are in one component, or
another list has it. Counts that order the n-grams are approximate (a table of fixed size); any order gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandspark.llm.common import by_number, discard, map_batches, numbered, pieces, row_key, save, text_buffer, without
from demandspark.llm.rolling import NOT_SPACE, kgram_hashes, mix, word_hashes, word_spans

#: Lists up to this length are searched pair by pair for entries that no other can link with, before they are
#: written; longer ones are left to the blocks.
SHORT_LIST = 64
#: Counters of the table that orders n-grams by how often they occur, and bits of the filter on wanted sets.
COUNTERS = 1 << 18
FILTER_WORDS = 1 << 17
#: Two sets share at most the sum, over this many ranges of hashes, of the fewer that either has there.
BINS = 256
#: N-grams before an entry that it names.
EARLIER = 4


def text_sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its word n-grams: A-Z lower-cased words between white space; a
    text with fewer words than n is one n-gram of all of them, one without words the empty set."""
    buf, at = text_buffer(batch.column("text"))
    starts, ends, rows = word_spans(buf, at, NOT_SPACE)
    words = word_hashes(buf, starts, ends)
    grams = kgram_hashes(words, n)
    first = np.searchsorted(rows, np.arange(len(batch) + 1))
    out = []
    for i in range(len(batch)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= n:
            out.append(np.unique(grams[a: b - n + 1]))
        elif b > a:
            out.append(kgram_hashes(words[a:b], b - a) ^ mix(np.array([b - a], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_name(tokens: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed long."""
    return int((mix(tokens).sum(dtype=np.uint64) ^ mix(np.array([len(tokens)], np.uint64))).astype(np.int64)[0])


def least_overlap(x: int, y: int, percent: int) -> int:
    """Shared n-grams that sets of x and y n-grams need at least: 100 i >= percent (x + y - i)."""
    return -(-percent * (x + y) // (100 + percent))


def prefix_length(x: int, percent: int) -> int:
    """Two sets that link share one of this many first n-grams of either (in one order for all)."""
    return x - (-(-percent * x // 100)) + 1


def _each_set(docs: DataFrame, emit: Callable, schema: str, n: int) -> DataFrame:
    """Run ``emit(batch, sets, seen)`` over all rows; ``seen`` holds the names of the task's sets so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in (p for b in batches for p in pieces(b)):
            yield from emit(part, text_sets(part, n), seen)

    return map_batches(docs, run, schema)


def set_names(docs: DataFrame, n: int) -> DataFrame:
    """row, text_key, doc_id, n_shingles, set (its name) and bins (how many of its hashes fall on each of BINS) of each row."""
    def emit(part, sets, seen):
        bins = [np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=BINS).astype(np.uint32).tobytes() for s in sets]
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("text_key"), part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([set_name(s) for s in sets], pa.int64()), pa.array(bins, pa.binary())],
            ["row", "text_key", "doc_id", "n_shingles", "set", "bins"])

    return _each_set(docs, emit, "row bigint, text_key bigint, doc_id bigint, n_shingles bigint, set bigint, bins binary", n)


def slot_counts(docs: DataFrame, n: int, counters: int) -> np.ndarray:
    """How many n-grams fall on each counter: one array of fixed size, whatever the size of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(counters, np.int64)
        for part in (p for b in batches for p in pieces(b)):
            for s in text_sets(part, n):
                counts += np.bincount((s >> np.uint64(20)).astype(np.int64) % counters, minlength=counters) if len(s) > counters // 8 else 0
                if len(s) <= counters // 8:
                    np.add.at(counts, (s >> np.uint64(20)).astype(np.int64) % counters, 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["slot", "count"])

    found = map_batches(docs.select("text"), run, "slot bigint, count bigint").groupBy("slot").agg(F.sum("count").alias("count"))
    table = found.toArrow()
    out = np.zeros(counters, np.int64)
    out[table.column("slot").to_numpy()] = table.column("count").to_numpy()
    return out


def index_entries(docs: DataFrame, n: int, percent: int, counters: int) -> DataFrame:
    """The lists of all n-grams that two sets or more have in their prefixes, saved: token, set, n_shingles, pos.
    Sorted over the cluster by token and set, so that a long list is spread over several tasks."""
    counts = docs.sparkSession.sparkContext.broadcast(slot_counts(docs, n, counters))

    def emit(part, sets, seen):
        tokens, names, sizes, places = [], [], [], []
        for s in sets:
            name = set_name(s) if len(s) else None
            if name is None or name in seen:
                continue
            seen.add(name)
            length = prefix_length(len(s), percent)
            often = counts.value[(s >> np.uint64(20)).astype(np.int64) % counters]
            tokens.append(s[np.lexsort((s, often))[:length]])
            names.append(np.full(length, name, np.int64))
            sizes.append(np.full(length, len(s), np.int64))
            places.append(np.arange(length, dtype=np.int64))
        if tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (tokens, names, sizes, places)],
                ["token", "set", "n_shingles", "pos"])

    schema = "token bigint, set bigint, n_shingles bigint, pos bigint"
    # saved, since ranging looks at them twice: to place the ranges and to deal them out
    entries = save(_each_set(docs.select("text"), emit, schema, n), "join-entries")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Drops repeated entries, and lists of one entry unless they may go on in another partition."""
        kept = None  # the last list so far, which the next batch may go on with
        edge = True
        for batch in batches:
            if not len(batch):
                continue
            cols = [batch.column(c).to_numpy() for c in ("token", "set", "n_shingles", "pos")]
            if kept is not None:
                cols = [np.concatenate(x) for x in zip(kept, cols, strict=True)]
            fresh = np.ones(len(cols[0]), bool)
            fresh[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
            cols = [c[fresh] for c in cols]
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            kept = [c[last:] for c in cols]
            if last:
                yield from _several([c[:last] for c in cols], edge, False, percent)
                edge = False
        if kept is not None:
            yield from _several(kept, edge, True, percent)

    ranged = entries.repartitionByRange("token", "set").sortWithinPartitions("token", "set")
    lists = save(map_batches(ranged, shared, schema), "join-lists")
    discard(entries)
    return lists


def _several(cols: list[np.ndarray], first: bool, last: bool, percent: int) -> Iterator[pa.RecordBatch]:
    """The entries of whole lists that can link with another of their list. A list that may go on in another
    partition (the first and the last of one) is kept as it is."""
    starts = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1]]))
    sizes = np.diff(np.append(starts, len(cols[0])))
    open_ = np.zeros(len(starts), bool)
    open_[0] |= first
    open_[-1] |= last
    keep = np.repeat(open_ | (sizes > SHORT_LIST), sizes)
    rest = cols[2] - cols[3]  # n-grams from this place on: what can be shared if this is the first one
    for m in range(2, SHORT_LIST + 1):
        lists = starts[(sizes == m) & ~open_]
        for i in range(0, len(lists), max(1, 2_000_000 // (m * m))):
            at = lists[i: i + max(1, 2_000_000 // (m * m)), None] + np.arange(m)
            n, r = cols[2][at], rest[at]
            need = -(-percent * (n[:, :, None] + n[:, None, :]) // (100 + percent))
            can = np.minimum(r[:, :, None], r[:, None, :]) >= need
            can[:, np.arange(m), np.arange(m)] = False
            keep[at] = can.any(2)
    yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], ["token", "set", "n_shingles", "pos"])


class RowFilter:
    """A bit table of fixed size over text keys: lets a scan pass on the rows of a table and little else."""

    def __init__(self, rows: DataFrame, words: int = FILTER_WORDS):
        self.words = words
        hashed = rows.select(F.xxhash64("text_key").alias("h"))
        bits = hashed.select(F.pmod("h", F.lit(words)).alias("word"), F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 58) as int))").alias("bit"))
        table = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        self.bits = np.zeros(words, np.int64)
        self.bits[table.column("word").to_numpy()] = table.column("bits").to_numpy()

    def apply(self, table: DataFrame) -> DataFrame:
        """The rows of ``table`` (with text_key) that may be wanted, all that are among them."""
        shared, columns = table.sparkSession.sparkContext.broadcast(self.bits), table.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = batch.column("_h").to_numpy()
                bits = shared.value[h % len(shared.value)].view(np.uint64)
                yield batch.filter(pa.array((bits >> (h.view(np.uint64) >> np.uint64(58))) & np.uint64(1) == 1)).select(columns)

        return map_batches(table.withColumn("_h", F.xxhash64("text_key")), run, table.schema)


def _sides(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """set and text_key (of a text that has it) of both sides of the pairs."""
    return save(pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct().join(owners, "set"), "join-wanted")


def _compared(pairs: DataFrame, held: DataFrame, good: Callable) -> DataFrame:
    """The pairs a, b for whose sets' values in ``held`` (set, value) ``good(x, y)`` holds."""
    both = pairs.join(held.select(F.col("set").alias("a"), F.col("value").alias("x")), "a").join(
        held.select(F.col("set").alias("b"), F.col("value").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column("x"), batch.column("y")
            keep = [good(xs[i].as_buffer(), ys[i].as_buffer()) for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both.select("a", "b", "x", "y"), run, "a bigint, b bigint").distinct()


def verified(docs: DataFrame, names: DataFrame, owners: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs a, b (names of sets) that link: by the bound of their bins first, then by their whole sets."""
    def enough(shared: int, x: int, y: int) -> bool:
        return 100 * shared >= percent * (x + y - shared)

    def by_bins(x, y) -> bool:
        x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
        return enough(int(np.minimum(x, y).sum(dtype=np.int64)), int(x.sum(dtype=np.int64)), int(y.sum(dtype=np.int64)))

    def by_sets(x, y) -> bool:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        return enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))

    wanted = RowFilter(_sides(pairs, owners))
    bins = wanted.apply(names.select("text_key", "set", F.col("bins").alias("value")))
    held = save(bins.select("set", "value"), "join-bins")
    likely = save(_compared(pairs, held, by_bins), "join-likely")
    discard(held)
    wanted = RowFilter(_sides(likely, owners))

    def emit(part, sets, seen):
        fresh = {name: s for s in sets if (name := set_name(s)) not in seen}
        seen.update(fresh)
        yield pa.RecordBatch.from_arrays([pa.array(list(fresh), pa.int64()), pa.array([s.tobytes() for s in fresh.values()], pa.binary())], ["set", "value"])

    held = save(_each_set(wanted.apply(docs.select("text_key", "text")).select("text"), emit, "set bigint, value binary", n), "join-sets")
    links = save(_compared(likely, held, by_sets), "join-links")
    discard(held)
    return links


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it is connected with) of all nodes of ``links`` (a, b): the smallest
    label of the neighbours, then the label's own label, until nothing changes."""
    both = save(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "component-links")
    state = save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "component-labels")
    while True:
        near = both.join(state, both.b == state.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = save(state.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was")), "component-step")
        up = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        after = save(step.join(up, "to").select("node", F.least("to", "further").alias("label"), "was"), "component-labels")
        state = after.select("node", "label")
        if not after.where("label <> was").limit(1).count():
            return state


def _possible(x: str, y: str, percent: int) -> str:
    """SQL: whether sets with sizes and positions in x and y can link if this is the first n-gram they share."""
    need = f"cast(ceil({percent} * ({x}.n_shingles + {y}.n_shingles) / {100 + percent}.0D - 1e-9D) as bigint)"
    return f"least({x}.n_shingles - {x}.pos, {y}.n_shingles - {y}.pos) >= {need}"


def with_earlier(entries: DataFrame) -> DataFrame:
    """``entries`` with ``earlier``: the tokens of the set's EARLIER entries before this one, the nearest first; null where
    there are fewer."""
    order = Window.partitionBy("set").orderBy("pos")
    return entries.withColumn("earlier", F.array(*[F.lag("token", i + 1).over(order) for i in range(EARLIER)]))


def _not_met(x: str, y: str) -> str:
    """SQL: whether the n-grams named in x and y have none in common. All lists have one order, so this holds at the
    first n-gram that two sets share."""
    return f"not coalesce(arrays_overlap({x}, {y}), false)"


def set_links(docs: DataFrame, names: DataFrame, n: int = 5, percent: int = 80, counters: int = COUNTERS) -> DataFrame:
    """set and label for all sets that link with another set; sets with one label are connected by links.
    ``names`` is what ``set_names`` gives for ``docs``, saved."""
    owners = save(names.where("n_shingles > 0").groupBy("set").agg(F.min("text_key").alias("text_key")), "join-owners")
    lists = index_entries(docs, n, percent, counters)
    # answers taken over: within each list, sets of about one size against the first of them
    banded = lists.withColumn("band", F.floor(F.log2("n_shingles") * 4))
    firsts = save(banded.groupBy("token", "band").agg(F.min(F.struct("pos", "set", "n_shingles")).alias("f"), F.count(F.lit(1)).alias("c"))
                  .where("c > 1").select("token", "band", "f.*"), "join-firsts")
    stars = banded.alias("x").join(firsts.alias("y"), ["token", "band"]).where("x.set <> y.set").where(_possible("x", "y", percent))
    stars = save(stars.select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b")).distinct(), "join-stars")
    found = verified(docs, names, owners, stars, n, percent)
    labels = components(found)
    # what is left: links between components, by blocks of lists
    named = save(lists.join(labels.select(F.col("node").alias("set"), "label"), "set", "left")
                 .withColumn("label", F.coalesce("label", "set")), "join-named")
    discard(lists)
    mixed = save(named.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .where("lo <> hi").select("token"), "join-mixed")
    entries = save(with_earlier(named.join(mixed, "token", "left_semi")), "join-held")
    discard(named)
    # of a block the earlier n-grams that all its sets name at the same place
    places = [F.col("earlier")[i] for i in range(EARLIER)]
    blocks = save(entries.groupBy("token", "label", "n_shingles", "pos").agg(F.array(*[
        F.when((F.min(e) == F.max(e)) & (F.count(e) == F.count(F.lit(1))), F.min(e)) for e in places]).alias("earlier")), "join-blocks")
    open_ = blocks.alias("x").join(blocks.alias("y"), "token").where("x.label < y.label").where(
        _possible("x", "y", percent)).where(_not_met("x.earlier", "y.earlier"))
    open_ = save(open_.select("token", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in ("label", "n_shingles", "pos")]), "join-open")

    def members(side: str) -> DataFrame:
        return entries.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("label", "n_shingles", "pos", "earlier")], F.col("set").alias(side))

    pairs = open_
    for side in "xy":
        pairs = pairs.join(members(side), ["token", *[f"{side}_{c}" for c in ("label", "n_shingles", "pos")]])
    pairs = pairs.where(_not_met("x_earlier", "y_earlier"))
    pairs = save(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "join-pairs")
    discard(entries)
    more = verified(docs, names, owners, save(pairs.join(stars, ["a", "b"], "left_anti"), "join-rest"), n, percent)
    return components(found.union(more)).select(F.col("node").alias("set"), "label")


def similar_documents(docs: DataFrame, n: int = 5, percent: int = 80, counters: int = COUNTERS) -> DataFrame:
    """One row for each row of ``docs``: row, doc_id, n_shingles, component_id (the smallest doc_id that links
    lead to, its own included; equal sets link).

    Null and empty texts have the empty set and link with nothing, as do texts of white space. Repeated rows are
    equal sets. A null doc_id is never the smallest unless alone. An empty table gives an empty result. Rows
    are numbered in one job, whose result is saved; texts are found again by a hash of their contents, whatever way the
    files are cut then.
    """
    return _similar(docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), n, percent, counters)


def _similar(keyed: DataFrame, n: int, percent: int, counters: int) -> DataFrame:
    # of the id and the text: a text that many rows have is fetched from one of them
    keyed = keyed.withColumn("text_key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    names = save(set_names(keyed, n), "join-names")
    labels = set_links(keyed.select("text_key", "text"), names, n, percent, counters)
    rows = names.alias("r").join(labels.alias("l"), "set", "left").select(
        "r.row", "r.doc_id", "r.n_shingles", F.when(F.col("r.n_shingles") > 0, F.coalesce("l.label", "r.set")).alias("label"))
    rows = save(rows, "join-rows")
    least = save(rows.where("label is not null").groupBy("label").agg(
        F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("s"),
        F.count(F.lit(1)).alias("members")).where("members > 1").select("label", "component_id", F.col("s.row").alias("stays")), "join-least")
    return rows.join(least, "label", "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("stays") == F.col("row"), F.lit(True)).alias("kept"))


def drop_similar(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row, that of the smallest doc_id, of each group that links connect; all columns are kept,
    whatever their names. Null and empty texts have no links and stay; of repeated rows one stays, a null doc_id
    only if there is no other; an empty table stays empty."""
    rows, name = numbered(docs, "similar-docs")
    return without(rows, name, save(_similar(by_number(rows, name), n, percent, COUNTERS).where(~F.col("kept")).select("row"), "similar"))


__all__ = ["components", "drop_similar", "set_links", "similar_documents"]
