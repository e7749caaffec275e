"""The pipeline's stages on one small folder: what each has to catch goes, the rest stays."""

import random

import corpus_pipeline
from tests.llm.test_operators import edited, prose


def test_pipeline(spark, tmp_path):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = prose(i, 40).split(" ")
        if i % 6 == 0:
            for at in r.sample(range(40), 3):
                words[at] = r.choice(["grumblax", "zorfnik", "grumblaxer"])
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(i % 6 == 0)))
    item, copy, near = prose(900, 40), prose(901, 40), prose(902, 80)
    rows += [(700, prose(903, 20) + " " + item, "en", "s", 1), (701, copy, "en", "s", 1), (702, copy, "en", "s", 1),
             (703, near, "en", "s", 1), (704, edited(near, 40), None, None, None), (705, None, "en", "s", 1)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = {x.doc_id for x in corpus_pipeline.run(spark, sf).collect()}
    assert not got & {700, 701, 704} and got >= {702, 703, 705}
    clean = {i for i in range(600) if i % 6}
    assert len(clean - got) < 15 and len(got & {*range(0, 600, 6)}) < 8
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "encode"]


def test_pipeline_of_odd_rows_and_of_none(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, row string"
    item = prose(900, 40)
    rows = [(None, "no id at all"), (None, "no id at all"), (3, prose(3, 30)), (3, prose(3, 30)), (3, prose(33, 30)), (4, None), (5, ""),
            (6, "  \n"), (7, "x" * 60_000), (8, " ".join(prose(i, 200) for i in range(40))), (9, prose(9, 20) + " " + item)]
    for name, some in (("odd", rows), ("none", [])):
        sf = f"{tmp_path}/{name}"
        spark.createDataFrame([(i, t, None, "s", 1, 5, "r") for i, t in some], schema).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, item)] if some else [], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
        docs = spark.read.schema(schema).parquet(f"{sf}/documents.parquet")
        for step, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.schema.names == docs.schema.names, step
            out.write.parquet(f"{sf}/{step}")
            docs = spark.read.schema(schema).parquet(f"{sf}/{step}")
        got = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
        # of the rows that equal another one stays; null, empty and blank texts are no near copies of each other
        assert sorted(x.doc_id or 0 for x in got) == ([0, 3, 3, 5, 6, 7, 8] if some else [])
