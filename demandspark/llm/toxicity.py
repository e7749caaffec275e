"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is the bag of its words and of their character n-grams (with the words' edges), each hashed to a bucket.
Buckets have embeddings; a text's embedding is their average, and a linear softmax over it gives the classes.
Embeddings and softmax are trained jointly in numpy, on a bounded sample of labelled texts. Misspelt words share
most n-grams with the words they come from. For scoring, each bucket's part in the logit is one number, so a text
of any length takes one pass and constant memory per step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import filtered, map_batches, pieces, row_key, text_buffer
from demandspark.llm.rolling import FOLDED, NOT_SPACE, char_hashes, mix, word_hashes, word_spans

BUCKET_BITS = 18
NGRAMS = (3, 4, 5)
#: Most labelled texts that a model is fitted on, half of them toxic if there are as many.
SAMPLE = 4000
_EDGE = np.where(NOT_SPACE, np.arange(256), 0x20).astype(np.uint8)


@dataclass
class Model:
    embeddings: np.ndarray  # buckets x d
    softmax: np.ndarray  # d x 2
    bias: np.ndarray  # 2
    scale: float

    def bucket_logits(self) -> np.ndarray:
        return (self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0]) * self.scale).astype(np.float64)

    @property
    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def subwords(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and n-gram of a text buffer, and its row. Words stand between white space, A-Z are
    taken as a-z; n-grams are of bytes, and may have an edge of the word at either end."""
    # one more edge byte before each row, so that all words have both
    rows = np.repeat(np.arange(len(at) - 1), np.diff(at))
    padded = np.full(len(buf) + len(at), 0x20, np.uint8)
    padded[np.arange(len(buf)) + rows + 1] = _EDGE[buf]
    begins = at + np.arange(len(at))
    edge = padded == 0x20
    sums = np.concatenate([[0], np.cumsum(edge)])
    buckets, owners = [], []
    for n in NGRAMS:
        h = char_hashes(padded, n, FOLDED)
        if not len(h):
            continue
        # no edge inside
        good = np.flatnonzero(sums[n - 1: n - 1 + len(h)] == sums[1: 1 + len(h)])
        buckets.append((mix(h[good] ^ np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        owners.append(np.searchsorted(begins, good, "right") - 1)
    starts, ends, word_rows = word_spans(buf, at, NOT_SPACE)
    buckets.append((word_hashes(buf, starts, ends) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    owners.append(word_rows)
    return np.concatenate(buckets), np.concatenate(owners)


def bags(texts: DataFrame) -> DataFrame:
    """label, buckets (int32) and counts (float32) of each row of ``texts`` (label, text): at most as many
    entries as there are buckets, however long the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in pieces(b, limit=1 << 20)):
            bucket, owner = subwords(*text_buffer(part.column("text")))
            order = np.argsort(owner, kind="stable")
            cuts = np.searchsorted(owner[order], np.arange(len(part) + 1))
            found = [np.unique(bucket[order[a:b]], return_counts=True) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.array([x.astype(np.int32).tobytes() for x, _ in found], pa.binary()),
                 pa.array([c.astype(np.float32).tobytes() for _, c in found], pa.binary())], ["label", "buckets", "counts"])

    return map_batches(texts, run, "label int, buckets binary, counts binary")


def train(sample: list[tuple[int, np.ndarray, np.ndarray]], prior: float, dims: int = 8, epochs: int = 8, rate: float = 0.1,
          scale: float = 10.0, batch: int = 32, least: int = 6, seed: int = 7) -> Model:
    """Embeddings and softmax by minibatch Adagrad on the cross-entropy; classes weigh the same in training, and
    ``prior`` (share of toxic texts) is put back into the bias at the end. ``sample``: label, buckets, counts; it is
    thinned out in place."""
    rng = np.random.default_rng(seed)
    n = 1 << BUCKET_BITS
    e = rng.normal(0, 0.05, (n, dims)).astype(np.float32)
    w = rng.normal(0, 0.5, (dims, 2)).astype(np.float32)
    b = np.zeros(2, np.float32)
    ge, gw, gb = np.full((n, dims), 1e-6, np.float32), np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    # what only a text or two have tells nothing of others
    texts = np.zeros(n, np.int64)
    for _, i, _ in sample:  # each bucket once; one text at a time, so that no second copy of the sample is made
        texts[i] += 1
    common = texts >= least
    e[~common] = 0
    for at, (y, i, c) in enumerate(sample):  # in place, so that the longer arrays go
        sample[at] = (y, i[common[i]], c[common[i]] / c.sum())
    sample = [s for s in sample if len(s[1])]
    labels = np.array([s[0] for s in sample], np.int64)
    share = [max(1, int((labels == c).sum())) for c in (0, 1)]
    weight = np.array([len(labels) / (2 * share[c]) for c in (0, 1)], np.float32)
    for _ in range(epochs if len(set(labels.tolist())) == 2 else 0):
        order = rng.permutation(len(sample))
        for at in range(0, len(order), batch):
            rows = [sample[i] for i in order[at: at + batch]]
            y = np.array([r[0] for r in rows])
            x = np.concatenate([r[2] for r in rows])[:, None] * scale
            ids = np.concatenate([r[1] for r in rows])
            cuts = np.cumsum([0, *[len(r[1]) for r in rows[:-1]]])
            mean = np.add.reduceat(e[ids] * x, cuts, axis=0)
            z = mean @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            d = (p - np.eye(2, dtype=np.float32)[y]) * weight[y][:, None] / len(rows)
            dw, db, dm = mean.T @ d, d.sum(0), d @ w.T
            used, where = np.unique(ids, return_inverse=True)
            de = np.zeros((len(used), dims), np.float32)
            each = np.repeat(dm, np.diff([*cuts, len(ids)]), axis=0) * x
            for j in range(dims):
                de[:, j] = np.bincount(where, each[:, j], len(used))
            ge[used] += de ** 2
            e[used] -= rate * de / np.sqrt(ge[used])
            gw += dw ** 2
            w -= rate * dw / np.sqrt(gw)
            gb += db ** 2
            b -= rate * db / np.sqrt(gb)
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    b[1] += np.log(prior / (1 - prior))
    return Model(e, w, b, scale)


def held_out(doc_id: Column) -> Column:
    """Rows that no model is trained on: crc32 of the doc_id as text, modulo 4, is 2. Null is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows (``labels``: doc_id, toxic) that are not held out. At most ``sample`` of
    them are used, taken by a hash of their id, the largest text of a repeated id; rows without a label, or with
    one besides 0 and 1, are left out. Without both classes the model gives every text the prior."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for label, most in ((1, sample // 2), (0, sample - min(sample // 2, counts.get(1, 0)))):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = some if chosen is None else chosen.union(some)
    # at most ``sample`` rows of two numbers; one text for each, however often an id is repeated
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    return train_in_task(bags(texts.select("label", "text")), counts.get(1, 0) / max(1, sum(counts.values())))


def train_in_task(sample: DataFrame, prior: float) -> Model:
    """The model of ``sample`` (label, buckets, counts; bounded), trained in one task: the driver gets the weights
    only. The task sorts its rows, so a repeated one gives the same model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(y.as_py(), np.frombuffer(i.as_buffer(), np.int32), np.frombuffer(c.as_buffer(), np.float32)) for batch in batches
                for y, i, c in zip(*(batch.column(x) for x in ("label", "buckets", "counts")), strict=True)]
        rows.sort(key=cmp_to_key(_order))
        model = train(rows, prior)
        yield pa.RecordBatch.from_pydict({
            "embeddings": pa.array([model.embeddings.tobytes()], pa.binary()), "softmax": pa.array([model.softmax.tobytes()], pa.binary()),
            "bias": pa.array([model.bias.tobytes()], pa.binary()), "scale": pa.array([model.scale], pa.float64())})

    trained = map_batches(sample.repartition(1), run, "embeddings binary, softmax binary, bias binary, scale double").head()
    if trained is None:  # no rows, no task
        return train([], prior)
    embeddings, softmax, bias = (np.frombuffer(trained[c], np.float32) for c in ("embeddings", "softmax", "bias"))
    return Model(embeddings.reshape(1 << BUCKET_BITS, -1), softmax.reshape(-1, 2), bias, trained["scale"])


def _order(x: tuple, y: tuple) -> int:
    """Order of sample rows; contents are looked at only where label and length are the same."""
    a, b = (x[0], len(x[1])), (y[0], len(y[1]))
    if a == b:
        a, b = ([r[1].tobytes(), r[2].tobytes()] for r in (x, y))
    return (a > b) - (a < b)


def text_scores(column: pa.Array, table: np.ndarray, offset: float) -> np.ndarray:
    """Probability of toxic of each text, from the buckets' parts in the logit; empty and null texts get the prior."""
    buf, at = text_buffer(column)
    total, count = np.zeros(len(column)), np.zeros(len(column))
    for a, b in _steps(buf, at):
        bucket, owner = subwords(buf[a:b], np.clip(at, a, b) - a)
        total += np.bincount(owner, table[bucket], len(column))
        count += np.bincount(owner, minlength=len(column))
    return 1 / (1 + np.exp(-np.clip(offset + total / np.maximum(count, 1), -50, 50)))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """row, doc_id and score (probability of toxic, 0 to 1) of each row; empty and null texts get the prior."""
    logits = docs.sparkSession.sparkContext.broadcast((model.bucket_logits(), model.offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in pieces(b)):
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), pa.array(text_scores(part.column("text"), *logits.value))],
                                             ["row", "doc_id", "score"])

    return map_batches(docs, run, "row bigint, doc_id bigint, score double")


def _steps(buf: np.ndarray, at: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Parts of a buffer, cut at white space where there is some: the n-grams of one take about a hundred bytes a byte."""
    a = 0
    while a < len(buf):
        b = min(len(buf), a + limit)
        if b < len(buf):
            space = np.flatnonzero(~NOT_SPACE[buf[a:b]])
            b = a + int(space[-1]) + 1 if len(space) else b
        yield a, b
        a = b


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of ``docs``: row, doc_id, held_out, score, predicted (1 if score >= threshold).

    Only the text is looked at. Null and empty texts get the share of toxic texts as score, repeated rows the
    same score; an empty table gives an empty result, and one without labels the prior for all."""
    return _scored(docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, threshold, sample)


def _scored(keyed: DataFrame, labels: DataFrame, threshold: float, sample: int) -> DataFrame:
    model = fit(keyed, labels, sample)
    return score_texts(keyed, model).select(
        "row", "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns are kept, whatever their names.

    A row's own text decides, so rows are scored and filtered in one pass. Null and empty texts stay unless the share
    of toxic texts itself reaches the threshold; repeated rows go or stay together; an empty table stays empty, and
    without labels nothing goes."""
    model = fit(docs, labels)
    logits = docs.sparkSession.sparkContext.broadcast((model.bucket_logits(), model.offset))
    return filtered(docs, lambda part: text_scores(part.column("text"), *logits.value) < threshold)
