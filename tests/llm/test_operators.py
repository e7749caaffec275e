"""Training-data operators against brute force, on small tables with nulls, empty and long texts, ties, repeated
rows, clashing extra columns, and no rows at all."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from demandspark.llm import (bpe, common, decontaminate, exact_dedup, length_histogram, license_scan, lm_score, set_join, sharding,
                             toxicity, url_filter)

SCHEMA = "doc_id bigint, text string, row string, name string, label string"
WORDS = "the of and that tion erst onble heed whan inth thou rest edle shan ofer".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


def edited(text, at, by="XX"):
    words = text.split(" ")
    words[at] = by
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    base, long = prose(1, 80), prose(2, 6000)
    texts = [base, base, edited(base, 40), edited(edited(base, 3), 40), base.upper(), None, "", "   \n", "one two", "One  two",
             long, long + " end", prose(3, 300), "x" * 20000, prose(4, 60) + "\n" + prose(5, 40)]
    out = [(i, t) for i, t in enumerate(texts)]
    return [*out, (3, texts[3]), (3, texts[3]), (None, "no id"), (None, base), (99, None)]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d.parquet")
    spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "d.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def test_exact_dedup(docs, rows):
    found = exact_dedup.exact_duplicates(docs, block_bytes=64).collect()
    assert len(found) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    for r in found:
        g = by_sha[r.text_sha256]
        known = [i for i in g if i is not None]
        assert (r.group_size, r.keep_id) == (len(g), max(known) if known else None)
    assert sum(r.kept for r in found) == len(groups)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_exact_dedup_of_one_hot_block(spark, tmp_path):
    # one block and one text hold most rows, over many partitions
    spark.range(0, 3000, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, F.lit("same " * 50)).otherwise(
        F.concat(F.lit("same " * 40), (F.col("id") % 700).cast("string"))).alias("text")).write.parquet(str(tmp_path / "d"))
    found = exact_dedup.exact_duplicates(spark.read.parquet(str(tmp_path / "d")), block_bytes=100)
    sizes = found.groupBy("keep_id").agg(F.count("*").alias("n"), F.max("group_size").alias("g"), F.min("group_size").alias("h"))
    assert sizes.where("n <> g or n <> h").count() == 0 and sizes.count() == 701


def brute_components(rows, n=5):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(rows)))
    for _ in rows:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    up[i] = up[j] = min(up[i], up[j])
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if up[j] == up[i] and sets[i] and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids) if ids else d))
    return out


def test_set_join(docs, rows):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in set_join.similar_documents(docs).collect()]
    assert sorted(found, key=key) == sorted(brute_components(rows), key=key)
    kept = set_join.drop_similar(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= {0, 5, 6, 7, 8, 10, 12, 13, 14}


def test_set_join_of_a_large_group_of_near_copies(spark, tmp_path):
    r, base = random.Random(5), prose(9, 60)
    rows = []
    for i in range(120):
        t = base
        for _ in range(r.randrange(6)):
            t = edited(t, r.randrange(60), f"n{r.randrange(1000)}")
        rows.append((i, t))
    rows += [(200 + i, prose(100 + i, 20) + " " + base[:150]) for i in range(40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(str(tmp_path / "d"))
    found = set_join.similar_documents(spark.read.parquet(str(tmp_path / "d")), counters=64).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in found) == sorted(brute_components(rows))


def test_rows_keep_their_numbers_when_files_are_cut_anew(spark, tmp_path, monkeypatch):
    """Each save changes how the next scan cuts the files, as executors that come and go do."""
    size, item = "spark.sql.files.maxPartitionBytes", prose(900, 40)
    near = [prose(i, 60) for i in range(300, 330)]
    rows = [*enumerate([prose(i, 5 + i) for i in range(200)]), *[(300 + i, t) for i, t in enumerate(near)],
            *[(400 + i, edited(t, 30)) for i, t in enumerate(near)], *[(500 + i, t) for i, t in enumerate(near)],
            *[(600 + i, f"{prose(950 + i, 30)} {item}") for i in range(30)]]
    random.Random(4).shuffle(rows)
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    benchmark = spark.createDataFrame([(1, item), (2, prose(901, 40))], "item_id bigint, text string")
    was, calls = spark.conf.get(size), []

    def other(df, label, real=common.save):
        out = real(df, label)
        calls.append(label)
        spark.conf.set(size, ["1000", "128m"][len(calls) % 2])
        return out

    for module in (common, set_join, exact_dedup, decontaminate):
        monkeypatch.setattr(module, "save", other)
    try:
        similar = {r.doc_id: r.component_id for r in set_join.similar_documents(docs).collect()}
        kept = [sorted(r.doc_id for r in f.select("doc_id").collect()) for f in (
            set_join.drop_similar(docs), exact_dedup.drop_duplicates(docs), decontaminate.drop_leaks(docs, benchmark))]
        leaks = {r.doc_id for r in decontaminate.find_passages(docs, benchmark, block_bytes=300).collect()}
    finally:
        spark.conf.set(size, was)
    ids = sorted(i for i, _ in rows)
    assert similar == {i: 300 + i % 100 if 300 <= i < 600 else i for i in ids}
    assert kept[0] == [i for i in ids if not 400 <= i < 600]
    assert kept[1] == [i for i in ids if not 300 <= i < 400]
    assert kept[2] == [i for i in ids if i < 600] and leaks == set(range(600, 630))


def test_sharding(docs, rows, spark):
    out, maps = sharding.shard_documents(docs, shards=4, slots=64)
    found = out.collect()
    assert len(found) == len(rows)
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in found) == sorted(
        (i or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    for s in range(4):
        places = sorted(r.slot for r in found if r.shard == s)
        assert places == list(range(len(places)))
    assert len({(r.text_crc32, r["size"], r.shard) for r in found}) == len({(r.text_crc32, r["size"]) for r in found})
    assert {tuple(r) for r in maps.groupBy("version").count().collect()} == {(0, 64), (1, 64)}
    even, _ = sharding.shard_documents(spark.range(5000).select("id", F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("text")))
    sizes = [r.s for r in even.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.01 * min(sizes)


def test_rebalancing_moves_few_slots(spark):
    first = sharding.first_map(spark, 4, 64)
    sizes = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), F.when(F.col("id") % 4 == 0, 200).otherwise(100).cast("long").alias("bytes"))
    second = sharding.rebalance(first, sizes, 4)
    moved = second.join(first.select("virtual_slot", F.col("shard").alias("was")), "virtual_slot").where("shard <> was").count()
    loads = [r.s for r in second.join(sizes, "virtual_slot").groupBy("shard").agg(F.sum("bytes").alias("s")).collect()]
    assert moved <= 8 and max(loads) - min(loads) <= 200


@pytest.mark.parametrize("leaf", [3, 50])
def test_bpe_equals_the_library(leaf):
    c = bpe.Codec(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN, leaf_chars=leaf, near=4)
    r = random.Random(leaf)
    parts = ["a", "the", " ", "  ", "\n", "'", "'s", "'re", "ll", "1", "22", "é", "中文字", "。", "!", "\u3000", "\U0001f600", "__", "\x85", "\u00a0"]
    for _ in range(400):
        text = "".join(r.choice(parts) * r.choice([1, 1, 2, 30]) for _ in range(r.randrange(20)))
        ids = c.encode(text)
        assert ids.tolist() == c.core.encode_ordinary(text), text
        assert c.decode(ids) == text.encode()


def test_bpe_round_trip(docs, rows):
    found = bpe.round_trip(docs, leaf_chars=200, keep_ids=True).collect()
    assert len(found) == len(rows)
    core = bpe.codec(bpe.RANKS).core
    want = sorted((hashlib.sha256((t or "").encode()).hexdigest(), len(core.encode_ordinary(t or ""))) for _, t in rows)
    assert sorted((r.decoded_sha256, r.n_tokens) for r in found) == want
    back = bpe.decode_documents(bpe.encode_documents(docs)).select("text").collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in rows)


def test_length_histogram(docs, rows):
    core = bpe.codec(bpe.RANKS).core
    n = [len(core.encode_ordinary(t or "")) for _, t in rows]
    answers = length_histogram.count_tokens(docs).cache()
    for r in answers.collect():
        assert (r.docs, r.docs_longer, r.docs_fit) == (n.count(r.n_tokens), sum(x > r.n_tokens for x in n), sum(x <= r.n_tokens for x in n))
        assert (r.tokens_kept, r.tokens_total) == (sum(min(x, r.n_tokens) for x in n), sum(n))
    for limit in (0, 1, 50, 333, 10 ** 6):
        got = length_histogram.tokens_at(answers, limit).first()
        assert (got.tokens_total, got.tokens_kept) == (sum(n), sum(min(x, limit) for x in n))
    assert length_histogram.length_quantile(answers, 0.5).first()[0] == sorted(n)[-(-len(n) // 2) - 1]


def test_decontaminate(spark, docs, tmp_path):
    item = prose(50, 40)
    bench = [(1, item), (2, "short one"), (3, None), (4, ""), (5, prose(3, 300)[200:330]), (1, item)]
    benchmark = spark.createDataFrame(bench, "item_id bigint, text string")
    texts = {200: "before " + item + " after", 201: edited(item, 20, "zz"), 202: item.upper().replace(" ", "\n"), 203: prose(60, 400),
             204: prose(61, 200) + item[100:230] + prose(62, 200), 205: item[:60]}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(str(tmp_path / "d"))
    more = spark.read.parquet(str(tmp_path / "d"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_passages(more, benchmark).collect()}
    assert found == {(200, 1), (201, 1), (202, 1), (204, 1)}
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.find_passages(more, benchmark, block_bytes=300).collect()}
    assert blocks == found
    assert {r.doc_id for r in decontaminate.find_passages(docs, benchmark).collect()} == {12}
    assert decontaminate.drop_leaks(docs, benchmark).count() == docs.count() - 1


def test_decontaminate_at_every_offset(spark):
    r = random.Random(9)
    item = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(270)).strip()
    texts = ["0123456789" * 20 + item[a: a + 100].strip() + "9876543210" * 20 for a in range(len(item) - 100)]
    near = [t[:260] + "#" + t[261:] for t in texts]
    rows = [(i, t) for i, t in enumerate([*texts, *near])] + [(9001, "so it is Shor T, as said"), (9002, "so it is shor, as said")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, item), (2, "shor t"), (3, ""), (4, None)], "item_id bigint, text string")
    got = {(x.doc_id, x.item_id): x for x in decontaminate.find_passages(docs, benchmark).collect()}
    assert set(got) == {(i, 1) for i in range(len(rows) - 2)} | {(9001, 2)}
    assert (got[(9001, 2)].start, got[(9001, 2)].end) == (9, 15)


def test_decontaminate_without_a_shared_gram_inside_a_row(spark):
    docs = spark.createDataFrame([(1, "abcdef"), (2, "ghijkl")], "doc_id bigint, text string").coalesce(1)
    benchmark = spark.createDataFrame([(1, "abcdefghijkl")], "item_id bigint, text string")
    assert decontaminate.find_passages(docs, benchmark).count() == 0


def test_band_distance():
    assert decontaminate.band_distance(b"abcdef", b"xxabcdefyy") == (0, 8)
    assert decontaminate.band_distance(b"abcdef", b"xxabXdefyy")[0] == 1
    assert decontaminate.band_distance(b"abcdef", b"abdef")[0] == 1


def test_license_scan(spark):
    texts = ["Released under the MIT License. under the mit license", "Apache License, Version 2.0 cc-by-nc", None, "",
             "This work is licensed under the GNU General Public License, version 3.", "under the mit big license",
             "cc by nc " * 3000, "Permission is hereby granted, free of charge, to ANY person obtaining one copy of this software and "
             "associated documentation files to deal in the software without restriction"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, template string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    phrases = {t.label: t.text.split() for t in license_scan.PHRASES}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        at = sorted((j, lab) for lab, p in phrases.items() for j in range(len(words)) if words[j: j + len(p)] == p)
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({lab for _, lab in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert got[4].labels == "gpl-3" and "mit-grant" in got[7].labels and got[2].score == 0


def test_url_filter(spark):
    rules = [url_filter.Rule("com", "/", True), url_filter.Rule("example.com", "/en/", False), url_filter.Rule("net", "/es/", False)]
    rows = [(1, "http://A.Example.COM/en/1?x=/y", None), (2, "https://b.com", ""), (3, "https://b.com/#f", "<a href='http://spam.net/es/1'>"),
            (4, None, "x"), (5, "no scheme", None), (6, "http://spam.net/es/1", ""), (7, "http://spam.net/de/1", ""),
            (8, "http://other.org/de/1", '<a HREF="//spam.net/x">'), (9, "http://good.org/1", ""), (9, "http://good.org/1", ""),
            (None, "x://telecom/en/", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("clash"))
    got = [tuple(r) for r in url_filter.judge_pages(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert len(got) == len(rows)
    by = {g[0]: g[1:] for g in got}
    assert by[1] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert by[2] == ("b.com", "", None, by[2][3]) and by[3][2:] == ("com/", "allow")
    assert by[4][:3] == ("", "", None) and by[5][:3] == ("", "", None)
    assert by[6][2:] == ("net/es/", "block") and by[7][2:] == (None, "block")
    assert by[8][2:] == (None, "block"), "links to a blocked host"
    assert by[9] == ("good.org", "/1", None, "allow") and by[None][0] == "telecom"


def test_toxicity_learns_subwords(spark):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = prose(i, 30).split(" ")
        bad = i % 5 == 0
        if bad:
            words[r.randrange(30)] = r.choice(["grumblax", "grumblaxer", "grumblaxing", "zorfnik", "zorfniks"])
            words[r.randrange(30)] = r.choice(["grumblax", "zorfnik"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    odd = {1000: prose(2000, 30) + " grumblaxxed zorfnikk grumblaxes", 1001: prose(2001, 30), 1002: None, 1003: ""}
    docs = spark.createDataFrame([*rows, *odd.items()], "doc_id bigint, text string")
    got = {x.doc_id: x for x in toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    held = [i for i in range(900) if got[i].held_out]
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in held]) > 0.97
    assert got[1000].predicted == 1 and got[1001].predicted == 0 and got[1002].score == got[1003].score
    none = toxicity.score_documents(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert none.where("predicted = 1").count() == 0


def test_toxicity_sample_is_bounded_for_repeated_ids(spark):
    rows = [(i, prose(i % 7, 30) + (" grumblax" if i % 3 == 0 else "")) for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(80)], "doc_id bigint, toxic int")
    once, often = (toxicity.fit(spark.createDataFrame(r, "doc_id bigint, text string"), labels) for r in (rows, rows + rows[1:3] * 40))
    assert once.embeddings.any() and once.embeddings.shape == (1 << toxicity.BUCKET_BITS, 8)
    assert all(np.array_equal(getattr(once, x), getattr(often, x)) for x in ("embeddings", "softmax", "bias"))


def test_lm_score(spark):
    rows = [(i, prose(i, 60) if i % 2 else " ".join(f"q{(i * 7 + j) % 23}" for j in range(60))) for i in range(100)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in lm_score.score_documents(docs, F.col("doc_id") % 2 == 0).collect()}
    assert max(got[i].difference for i in range(0, 100, 2)) < min(got[i].difference for i in range(1, 100, 2))
    assert (got[200].n_tokens, got[200].difference, got[201].target_loss) == (0, 0.0, 0.0)


def brute_losses(rows, good):
    """Mean losses of both models for each row, from plain dictionaries of words and pairs."""
    split = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split() for _, t in rows]
    models = []
    for chosen in ([x in good for x, _ in rows], [True] * len(rows)):
        word, pair = collections.Counter(), collections.Counter()
        for ws in (w for w, c in zip(split, chosen, strict=True) if c and w):
            word.update(["", *ws])
            pair.update(zip(["", *ws], ws, strict=False))
        models.append((word, pair, sum(n for w, n in word.items() if w)))
    size = len({w for ws in split for w in ws})
    return [tuple(sum(-math.log((pair[p, w] + 4 * (word[w] + 1) / (total + size)) / (word[p] + 4))
                      for p, w in zip(["", *ws], ws, strict=False)) / max(len(ws), 1) for word, pair, total in models) for ws in split]


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_lm_score_against_plain_counts(spark, rows, monkeypatch, block):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_score, "BIN_BYTES", 20_000 if block == 300 else 8 << 20)
    rows = [*rows, *((200 + i, prose(i % 5, 50 + i) + " Hot hot hot" * 20) for i in range(30))]
    good = {x for x, _ in rows if x is not None and x % 3 == 0}
    docs = spark.createDataFrame([(x, t, "b", 1) for x, t in rows], "doc_id bigint, text string, block string, target int").repartition(3)
    ids = spark.createDataFrame([(x,) for x in [*good, *good, None]], "doc_id bigint")
    want = sorted((-1 if x is None else x, round(t, 9), round(b, 9)) for (x, _), (t, b) in zip(rows, brute_losses(rows, good), strict=True))
    for target in (ids, F.col("doc_id") % 3 == 0):
        got = lm_score.score_documents(docs, target).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, round(r.target_loss, 9), round(r.background_loss, 9)) for r in got) == want
        assert len({r.row for r in got}) == len(rows) and all(abs(r.difference - (r.target_loss - r.background_loss)) < 1e-12 for r in got)


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    for out in (exact_dedup.exact_duplicates(nothing), set_join.similar_documents(nothing), sharding.shard_documents(nothing)[0],
                bpe.round_trip(nothing), length_histogram.count_tokens(nothing), decontaminate.find_passages(nothing, bench),
                license_scan.scan_licenses(nothing), toxicity.score_documents(nothing, labels),
                lm_score.score_documents(nothing, F.lit(True)), url_filter.judge_pages(pages, [])):
        assert out.count() == 0


def test_columns_of_any_name_stay(spark, tmp_path):
    item, copy, near = prose(900, 40), prose(901, 40), prose(902, 80)
    rows = [(1, f"{prose(903, 20)} {item}"), (2, copy), (3, copy), (4, near), (5, edited(near, 40)), (6, None), (7, ""), (None, "x"), (6, None)]
    spark.createDataFrame([(i, t, 7, 8, "r", i) for i, t in rows], "doc_id bigint, text string, _row int, _ROW_ int, row string, kept bigint").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    kept = {"toxic": toxicity.drop_toxic(docs, labels), "copies": exact_dedup.drop_duplicates(docs), "similar": set_join.drop_similar(docs),
            "leaks": decontaminate.drop_leaks(docs, benchmark), "blocks": decontaminate.drop_leaks(docs, benchmark, block_bytes=100)}
    for out in kept.values():
        assert out.schema.names == docs.schema.names and out.where("_row <> 7 or _ROW_ <> 8").count() == 0
    ids = {k: sorted((r.doc_id or 0) for r in out.select("doc_id").collect()) for k, out in kept.items()}
    assert ids["toxic"] == [0, 1, 2, 3, 4, 5, 6, 6, 7]
    assert len(ids["copies"]) == 6 and 3 in ids["copies"] and 2 not in ids["copies"]
    assert ids["similar"] == [0, 1, 2, 4, 6, 6, 7]
    assert ids["leaks"] == ids["blocks"] == [0, 2, 3, 4, 5, 6, 6, 7]


def test_decontaminate_repetitive_texts(spark):
    """A hundred thousand times one character against an item of a thousand: bounded parts, windows looked for once."""
    rows = [(1, "x" * 100_000), (2, "ab" * 3000 + "!" + prose(1, 30)), (3, prose(2, 50)), (4, "x" * 90), (5, "y" * 400 + "x" * 100)]
    benchmark = spark.createDataFrame([(1, "x" * 1000), (2, "ab" * 400), (3, "y" * 60 + "x" * 60)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_passages(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), benchmark).collect()}
    assert set(got) == {(1, 1), (2, 2), (5, 1), (5, 3)}
    assert (got[1, 1].start, got[1, 1].end, got[1, 1].edits) == (0, 100_000, 0)
    assert (got[2, 2].start, got[2, 2].end) == (0, 6000) or got[2, 2].end >= 6000
    assert (got[5, 1].end, got[5, 1].edits) == (500, 0)


def test_parts_of_an_item_have_each_window_once():
    parts = decontaminate.make_items(1, "a" * 300 + "b" * 50, 12, 100, 0.05)
    windows = [(p.text[i: i + p.window], p.offset + i) for p in parts for i in range(len(p.text) - p.window + 1)]
    assert len({w for w, _ in windows}) == len(windows) == 51
    assert all(("a" * 300 + "b" * 50).encode()[o: o + 100] == w for w, o in windows)


def test_found_windows_do_not_depend_on_the_parts(monkeypatch):
    r = random.Random(12)
    item = "".join(r.choice("ab ") for _ in range(400))
    text = "".join(r.choice("ab ") for _ in range(700)) + item[50:330] + "".join(r.choice("ab ") for _ in range(500))
    buf, at = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    found = []
    for size in (1 << 18, 64):
        monkeypatch.setattr(decontaminate, "PART_GRAMS", size)
        ix = decontaminate.Index(decontaminate.make_items(1, item, 12, 100, 0.05), 12)
        found.append({m for row, k, d, a, b in ix.regions(buf, at).tolist() for m in decontaminate.matches(ix.items[k], buf, d, a, b)})
    assert found[0] == found[1] and len({m[2] for m in found[0]}) >= 181
