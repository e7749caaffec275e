"""Packing, resampling and the filter audit against brute force, on nulls, empty and long texts, ties, repeated rows,
clashing extra columns and empty tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandspark.llm import filter_audit, packing, resample, url_filter
from demandspark.llm.queries import ORACLE_SQL
from tests.llm.test_operators import docs, nothing, prose, rows  # noqa: F401

# ---- packing ------------------------------------------------------------------------------------------------


def cheapest(places, price, size, costs):
    at, cost = [0, *places], [0]
    for j in range(1, len(at)):
        best = math.inf
        for i in range(j):
            n = at[j] - at[i]
            if n <= size:
                power = n & (n - 1) == 0 and n >= costs.shortest
                best = min(best, cost[i] + (0 if power else size - n))
        cost.append(best + price[j - 1] + costs.window)
    return cost[-1]


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_the_cheapest(seed):
    r = random.Random(seed)
    places = np.cumsum([r.randrange(1, 20) for _ in range(60)])
    price = np.array([r.choice([0, 1, 8]) for _ in places])
    costs = packing.Costs(shortest=r.choice([4, 16]))
    cuts, total = packing.best_cuts(places, price, 64, costs, True)
    assert total == cheapest(places.tolist(), price.tolist(), 64, costs)
    assert cuts[-1] == places[-1] and max(np.diff([0, *cuts])) <= 64 and set(cuts) <= set(places.tolist())
    some, _ = packing.best_cuts(places, price, 64, costs, False)
    assert places[-1] - some[-1] <= 64


def test_places_to_cut_are_never_far_apart():
    ids, closing = np.array([5] * 10 + [7] + [5] * 200), np.zeros(9, bool)
    closing[7] = True
    places, price = packing.cut_places(ids, np.array([100, 211]), closing, packing.Costs(stride=16))
    assert np.diff([0, *places]).max() <= 16 and (np.diff(places) > 0).all()
    assert dict(zip(places.tolist(), price.tolist()))[11] == 1
    assert [p for p, c in zip(places.tolist(), price.tolist()) if c == 0] == [100, 211]


@pytest.mark.parametrize("block", [200, packing.BLOCK_TOKENS])
def test_packing(docs, rows, block):
    found = packing.pack_documents(docs, block_tokens=block).collect()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    windows, whole = collections.defaultdict(list), collections.defaultdict(list)
    for p in found:
        windows[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id, p.doc_tokens].append((p.start, p.length, p.ids_crc32))
    for w in windows.values():
        ends = np.cumsum([n for _, n in sorted(w)])
        assert [o for o, _ in sorted(w)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert {k[:2] for k in want} == set(whole)
    assert sum(p.length for p in found) == sum(n * c for (_, n, _), c in want.items())
    by_id = {i: text for i, text in rows if i not in (3, 99, None)}
    for i, text in by_id.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(whole[i, len(ids)])
        assert [a for a, _, _ in parts] == [0, *np.cumsum([n for _, n, _ in parts])[:-1]]
        assert all(zlib.crc32(ids[a: a + n].tobytes()) == c for a, n, c in parts)


def test_packing_leaves_little_padding(spark, tmp_path):
    r = random.Random(1)
    spark.createDataFrame([(i, ". ".join(prose(i * 7 + j, r.randrange(1, 30)) for j in range(r.randrange(1, 60)))) for i in range(300)],
                          "doc_id bigint, text string").coalesce(2).write.parquet(str(tmp_path / "d"))
    made = packing.pack_documents(spark.read.parquet(str(tmp_path / "d")))
    n = [x.n for x in made.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert sum(0 if x & (x - 1) == 0 else 1024 - x for x in n) < 0.01 * sum(n)


def test_packing_of_nothing(nothing):
    assert packing.pack_documents(nothing).count() == 0


# ---- resampling ---------------------------------------------------------------------------------------------

def test_crc_of_spans():
    r = np.random.default_rng(3)
    buf = r.integers(0, 256, 5000, dtype=np.uint8)
    ends = np.sort(r.choice(np.arange(1, 5000), 400, replace=False))
    starts = np.concatenate([[0], ends[:-1]])
    starts, ends = np.append(starts, [0, 7, 7]), np.append(ends, [900, 7, 71])
    assert resample.span_crc32(buf, starts, ends).tolist() == [zlib.crc32(buf[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert len(resample.span_crc32(buf, starts[:0], ends[:0])) == 0


def brute_resample(rows, target, n=1, buckets=10000, percent=10, least=20, seed=2024):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i: i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    bags = [features(t) for _, t in rows]
    s = collections.Counter(b for _, f in bags for b in f)
    t = collections.Counter(b for x in target for b in features(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in s}
    out = []
    for (i, _), (words, f) in zip(rows, bags):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = [(*x[:1], *x[2:], r + 1 if r < len(able) * percent // 100 else None) for r, x in enumerate(able)]
    return drawn + [(*x[:1], *x[2:], None) for x in out if x[1] < least]


def _key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("n", [1, 2])
def test_resample(spark, docs, rows, n):
    target = [prose(40, 30), "the OF é42 naïve", None, ""]
    bench = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, doc_id bigint")
    got = [tuple(r) for r in resample.resample(docs, bench, n=n, percent=50, least_words=2).collect()]
    assert sorted(got, key=_key) == sorted(brute_resample(rows, target, n, percent=50, least=2), key=_key)


def test_radix_ranks_over_many_blocks(spark):
    r = random.Random(2)
    keys = [(r.choice([7, 7, 7, r.randrange(1 << 40)]), r.choice([r.randrange(30), (1 << 32) - 1])) for _ in range(900)]
    df = spark.createDataFrame(keys, "a bigint, b bigint").repartition(7)
    got = resample.radix_ranks(df, ["a", "b"], width=4, block_rows=16).orderBy("rank").collect()
    assert [(x.a, x.b) for x in got] == sorted(keys) and [x["rank"] for x in got] == list(range(1, 901))
    same = resample.radix_ranks(spark.createDataFrame([(4,)] * 50, "a bigint").repartition(5), ["a"], block_rows=8)
    assert sorted(x["rank"] for x in same.collect()) == list(range(1, 51))


def test_resample_of_extreme_ids_and_nothing(spark, nothing):
    ids = [-(1 << 63), (1 << 63) - 1, 0, -1, None, 5, 5]
    rows = [(i, "a b c") for i in ids]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    none = spark.createDataFrame([], "text string")
    got = [tuple(r) for r in resample.resample(df, none, percent=100, least_words=1).collect()]
    assert sorted(got, key=_key) == sorted(brute_resample(rows, [], percent=100, least=1), key=_key)
    assert resample.resample(nothing, none).count() == 0


# ---- filter audit -------------------------------------------------------------------------------------------

def brute_audit(rows, labels):
    first, parts = {}, collections.defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {k for k, c in {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                                "D": re.search(r"[#$%&*|]", t), "E": i is not None and i > first[t]}.items() if c}
        mine = [x for x in labels if x[0] == i and i is not None]
        parts[lang or ""].append((fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part, found in parts.items():
        shapley = collections.Counter()
        steps = []
        for order in itertools.permutations("ABCDE"):
            for s, letter in enumerate(order):
                early = set(order[:s])
                here = [x for x in found if letter in x[0] and not x[0] & early]
                shapley[letter] += len(here)
                steps.append((letter, ["".join(order), s + 1, sum(not x[0] & {*early, letter} for x in found), len(here),
                                       sum(letter in x[0] and bool(x[0] & early) for x in found), sum(x[0] == {letter} for x in found),
                                       sum(x[1] for x in here), sum(x[2] for x in here)]))
        out += [(part, *x, shapley[letter]) for letter, x in steps]
    return sorted(out)


def test_filter_audit(spark, rows, tmp_path):
    r = random.Random(8)
    texts = [*[t for _, t in rows], "A B" * 60, "x#y " * 120, "word " * 200, "　\x0b a\x0cb", "\U0001f600" * 3]
    table = [(i if i != 3 else None, t, r.choice(["en", "de", None, ""])) for i, t in [*rows, *enumerate(texts * 2, 50)]]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(60)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    df = spark.createDataFrame([(*x, 1, "z") for x in table], "doc_id bigint, text string, lang string, part int, mask string").repartition(3)
    got = filter_audit.audit_filters(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert sorted(tuple(x) for x in got.collect()) == brute_audit(table, labels)


def test_filter_audit_of_one_hot_text(spark):
    df = spark.range(0, 3000, 1, 6).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"),
        F.when(F.col("id") < 1500, F.lit("same text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    cells = filter_audit.mask_cells(df, spark.createDataFrame([(0, 1, 0), (1, 1, 1)], "doc_id bigint, quality int, toxic int"))
    assert sorted(tuple(x) for x in cells.collect()) == [("en", 1, 1501, 1, 0), ("en", 17, 1499, 1, 1)]


def test_filter_audit_of_nothing(spark, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit_filters(nothing.withColumn("lang", F.lit("en")), none).count() == 0


# ---- SQL ----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op12_radix_resample", "op13_filter_orders"])
def test_sql(spark, name):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL
    got = entry.queries()[name](spark, SF_SMALL)
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(ORACLE_SQL[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == sorted(res.fetchall(), key=str)


# ---- url filter ---------------------------------------------------------------------------------------------

def test_propagation_is_personalised_pagerank(spark):
    r = random.Random(5)
    links = {(r.randrange(12), r.randrange(12)): float(r.randrange(1, 4)) for _ in range(30)}
    links = {k: w for k, w in links.items() if k[0] != k[1]}
    seeds = {0: (1.0, 0.0), 3: (0.25, 0.5), 11: (0.0, 1.0), 20: (0.0, 1.0)}
    got = {x.host: x for x in url_filter.propagate(
        spark.createDataFrame([(f"h{a}", f"h{b}", w) for (a, b), w in links.items()], "src string, dst string, weight double"),
        spark.createDataFrame([(f"h{h}", *s) for h, s in seeds.items()], "host string, trust double, distrust double"), 1e-6).collect()}
    w = np.zeros((21, 21))
    for (a, b), x in links.items():
        w[a, b] = x
    given = np.array([seeds.get(i, (0.0, 0.0)) for i in range(21)])
    rank = np.ones((21, 2)) * given.sum(0) / 21
    for _ in range(300):  # the walk itself: all mass each time, what is not passed on goes back to the seeds
        for k, m in enumerate((w, w.T)):
            passed = 0.85 * (m / (m.sum(1, keepdims=True) + url_filter.SEED_WEIGHT)).T @ rank[:, k]
            rank[:, k] = passed + (rank[:, k].sum() - passed.sum()) * given[:, k] / given[:, k].sum()
    for i in range(21):
        x = got.get(f"h{i}")
        assert (x.trust, x.distrust) == pytest.approx(tuple(rank[i]), abs=3e-6) if x else not rank[i].any()
    assert sum(x.trust for x in got.values()) == pytest.approx(1.25) and sum(x.distrust for x in got.values()) == pytest.approx(2.5)


def test_deep_hosts_and_long_chains(spark):
    rules = [url_filter.Rule("bad.net", "/", False), url_filter.Rule("good.com", "/", True), url_filter.Rule("f.com", "/x/", False)]
    link = '<a href="http://{}/">'.format
    rows = [(1, "http://bad.net/1", ""), (2, "http://good.com/", link("fine.org") + link("mixed.org")), (3, "http://a.b.c.d.e.f.com/", ""),
            (4, "http://f.com/x/1", ""), (5, "http://mixed.org/", link("fine.org")), (6, "http://fine.org/", "")]
    rows += [(100 + i, f"http://s{i}.net/", link(f"s{i - 1}.net" if i else "bad.net")) for i in range(14)]
    rows += [(200 + i, f"http://u{i}.large.io/", "") for i in range(40)] + [(300, "http://u0.large.io/x", ""), (301, "http://u1.large.io/", link("bad.net"))]
    got = {r.page_id: r for r in url_filter.judge_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"), rules).collect()}
    edges = {(r.src, r.dst) for r in url_filter.parent_links(spark.createDataFrame([("a.b.c.d.e.f.com",), ("x.org",)], "host string")).collect()}
    assert {("e.f.com", "f.com"), ("f.com", "e.f.com"), ("a.b.c.d.e.f.com", "b.c.d.e.f.com")} <= edges and len(edges) == 10
    assert got[3].distrust > 0, "through all its parents"
    assert all(got[100 + i].verdict == "block" and got[100 + i].distrust > 0 for i in range(5)) and got[113].distrust > 0
    assert got[6].verdict == got[5].verdict == "allow" and got[6].trust > 0, "trust wins"
    assert got[201].verdict == "block" and all(got[200 + i].verdict == "allow" for i in range(40) if i != 1), "not all of a domain for one host"
