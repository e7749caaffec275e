"""License scan by diagonal voting.

All rolling word k-gram hashes of the texts are joined in Spark to the places where license templates have them.
Each shared k-gram votes for one diagonal (place in the text minus place in the template); votes are added up by
diagonal, neighbouring diagonals are merged (words were put in or left out), and the merged span is verified by
how much of the template it covers. A phrase whose k-grams are all on one diagonal stands there word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import pieces, row_key, save, text_buffer
from demandspark.llm.rolling import WORD, kgram_hashes, word_hashes, word_spans

K = 3


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False  # counts only where its words stand consecutively


PHRASES = [Template("mit", "under the mit license", True), Template("apache-2", "apache license version 2", True),
           Template("cc-by-nc", "cc by nc", True)]

#: Sentences of well-known licenses and notices.
NOTICES = [
    Template("gpl-3", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-3", "under the terms of the gnu general public license as published by the free software foundation "
                      "either version 3 of the license or at your option any later version"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                          "associated documentation files to deal in the software without restriction"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
                    "that the following conditions are met"),
    Template("apache-2-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license"),
    Template("no-warranty", "the software is provided as is without warranty of any kind express or implied"),
]
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def template_places(spark: SparkSession, templates: list[Template], k: int = K) -> DataFrame:
    """hash, gram, template, tpos, grams (of the template) for every word k-gram of the templates."""
    rows = []
    for i, t in enumerate(templates):
        words = _WORDS.findall(t.text.lower().encode())
        for j, h in enumerate(_hashes(words, k)):
            rows.append((h, b" ".join(words[j: j + k]).decode(), i, j, len(words) - k + 1))
    return spark.createDataFrame(rows, "hash bigint, gram string, template int, tpos bigint, grams bigint")


def _hashes(words: list[bytes], k: int) -> list[int]:
    buf = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = word_spans(buf, np.array([0, len(buf)]), WORD)
    return kgram_hashes(word_hashes(buf, starts, ends), k).astype(np.int64).tolist()


def text_kgrams(docs: DataFrame, wanted: np.ndarray, k: int) -> DataFrame:
    """row, doc_id, n_words and hits (pos, hash, gram) of each row: its rolling k-gram hashes, less those that a
    filter of fixed size on the ``wanted`` hashes shows to be in no template."""
    mask = np.zeros(1 << 20, bool)
    mask[(wanted.astype(np.uint64) >> np.uint64(44)).astype(np.int64)] = True
    hit_type = pa.list_(pa.struct([("pos", pa.int64()), ("hash", pa.int64()), ("gram", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in pieces(b)):
            buf, at = text_buffer(part.column("text"))
            starts, ends, rows = word_spans(buf, at, WORD)
            h = kgram_hashes(word_hashes(buf, starts, ends), k)
            first = np.searchsorted(rows, np.arange(len(part) + 1))
            pos = np.flatnonzero(mask[(h >> np.uint64(44)).astype(np.int64)])
            pos = pos[rows[pos] == rows[pos + k - 1]] if len(pos) else pos
            hits: list[list] = [[] for _ in range(len(part))]
            for p, r, v in zip(pos.tolist(), rows[pos].tolist(), h[pos].astype(np.int64).tolist(), strict=True):
                gram = b" ".join(buf[starts[p + j]: ends[p + j]].tobytes() for j in range(k)).lower()
                hits[r].append({"pos": p - int(first[r]), "hash": v, "gram": gram.decode("utf-8", "replace")})
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(np.diff(first).astype(np.int64)), pa.array(hits, hit_type)],
                ["row", "doc_id", "n_words", "hits"])

    return docs.mapInArrow(run, "row bigint, doc_id bigint, n_words bigint, hits array<struct<pos:bigint,hash:bigint,gram:string>>")


def license_spans(hits: DataFrame, places: DataFrame, k: int = K, gap: int = 3) -> DataFrame:
    """row, template, start (first word), words, exact (whole template on one diagonal), covered (share of the
    template's k-grams) for each merged span of ``hits`` (row, pos, hash, gram)."""
    # the templates are a constant of the query: their k-grams are bounded, whatever the documents
    votes = hits.join(F.broadcast(places), ["hash", "gram"]).groupBy(
        "row", "template", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("tpos"), F.first("grams").alias("grams"))
    # a diagonal on which a template comes up whole is a span of its own
    votes = votes.withColumn("exact", F.size("tpos") == F.col("grams"))
    order = "over (partition by row, template, exact order by diagonal)"
    runs = votes.selectExpr("*", f"if(exact or diagonal - lag(diagonal) {order} <= {gap}, if(exact, 1, 0), 1) as new")
    runs = runs.selectExpr("*", f"sum(new) {order} as run")
    spans = runs.groupBy("row", "template", "exact", "run").agg(
        F.min(F.col("diagonal") + F.array_min("tpos")).alias("start"),
        F.max(F.col("diagonal") + F.array_max("tpos") + k).alias("stop"),
        F.size(F.array_distinct(F.flatten(F.collect_list("tpos")))).alias("found"), F.first("grams").alias("grams"))
    return spans.select("row", "template", "start", (F.col("stop") - F.col("start")).alias("words"), "exact",
                        (F.col("found") / F.col("grams")).alias("covered"))


def scan_licenses(docs: DataFrame, phrases: list[Template] = PHRASES, notices: list[Template] = NOTICES,
                  least: float = 0.6, k: int = K) -> DataFrame:
    """One row for each row of ``docs``: row, doc_id, n_words, n_base (places of phrases), first_word and
    last_word (their smallest and largest start), base_labels, labels (with those of notices of which a span
    covers at least the share ``least``), score (largest share covered).

    Null and empty texts have no words, labels '' and score 0. Repeated rows are scanned each. Only doc_id and
    text are read."""
    templates = [*phrases, *notices]
    places = template_places(docs.sparkSession, templates, k)
    wanted = np.array([r[0] for r in places.select("hash").collect()], np.int64)
    keyed = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = save(text_kgrams(keyed, wanted, k), "license-kgrams")
    hits = scanned.where("size(hits) > 0").select("row", F.inline("hits"))
    spans = license_spans(hits, places, k)
    names = F.array(*[F.lit(t.label) for t in templates])
    base = (F.col("template") < len(phrases)) & F.col("exact")
    other = (F.col("template") >= len(phrases)) & (F.col("covered") >= least)
    label = names[F.col("template")]
    found = spans.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, label))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(base | other, label))), ",").alias("labels"),
        F.max("covered").alias("score"))
    return scanned.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


__all__ = ["NOTICES", "PHRASES", "Template", "license_spans", "scan_licenses", "template_places", "text_kgrams"]
